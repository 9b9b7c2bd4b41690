"""Cut points: tables written to the folder that all executors share, for work that goes on in rounds."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_folder: list[str] = []  # of a session on this machine alone that names none
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor sees; one of our own only where the session names none and runs on this machine alone."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="spark-cohortlake-"))
        atexit.register(shutil.rmtree, _own_folder[0], ignore_errors=True)
    return _own_folder[0]


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    return written_parts([df], label)


def written_parts(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """As ``written``, of parts that are worked out one after the other, each without the shuffle files of those before."""
    path, schema = None, None
    for df in parts:
        if path is None:
            spark, schema = df.sparkSession, df.schema
            path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        else:
            swept(spark)
        df.write.mode("append").option("compression", "zstd").parquet(path)
    out = spark.read.schema(schema).parquet(path)
    _paths[out] = path
    _written.append(path)
    return out


def swept(spark: SparkSession) -> None:
    """Lets the shuffle files of finished work go, which else stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def deleted(spark: SparkSession, *paths: str) -> None:
    """Delete what lies in the shared folder under these paths and no later read needs."""
    _delete(spark, list(paths))


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        if path in _written:
            _written.remove(path)


def dropped(*tables: DataFrame) -> None:
    """Delete tables that ``written`` gave and that no later read needs."""
    for t in tables:
        if t in _paths:
            _delete(t.sparkSession, [_paths.pop(t)])


@contextmanager
def intermediate(spark: SparkSession, *keep: DataFrame) -> Iterator[list[DataFrame]]:
    """Tables that ``written`` gives within the block are deleted behind it, but for those in the list that it yields: what is read later goes there."""
    before, kept = set(_written), list(keep)
    yield kept
    stay = before | {_paths[k] for k in kept if k in _paths}
    _delete(spark, [p for p in _written if p not in stay])
