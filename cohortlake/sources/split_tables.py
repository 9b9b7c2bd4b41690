"""Quoted tables read in splits: one file of many records is read by many tasks, wherever its quotes and line ends lie.

Spark's text reader cuts files at line ends. Whether a line begins inside quotes depends on all quotes before
it, so each split counts its quotes, its records if it begins outside of quotes, and its records if it begins
inside. Sums over the splits of a file (one row each) then tell how each split begins and how many records lie
before it. A record on one line passes straight on; only lines of records that span several shuffle, by record.

Quotes stand around a field or, doubled, inside one. Line ends inside fields become line feeds. Blank lines
outside of fields are no records. Every file begins with the same header. Numbers are those of the records in
their file, the header's excluded, and the same for any size of splits.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from io import StringIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LINES = "file string, block long, seq long, odd boolean, flips boolean, blank boolean, outside long, inside long, value string"


def place() -> list[Column]:
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each line, as if its split began outside of quotes: whether it begins inside, whether it turns that, and how many records have begun, either way."""
    split, seen, turns, begun = None, 0, 0, np.zeros(2, np.int64)
    for batch in batches:
        files, blocks, values = (batch.column(c) for c in ("file", "block", "value"))
        quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False).astype(np.int64)
        blank = pc.equal(pc.utf8_trim_whitespace(values), "").to_numpy(zero_copy_only=False)
        same = np.r_[False, pc.and_(pc.equal(files[1:], files[:-1]), pc.equal(blocks[1:], blocks[:-1])).to_numpy(zero_copy_only=False)] if len(batch) else np.zeros(0, bool)
        cuts = [*np.flatnonzero(~same).tolist(), len(batch)]
        for low, high in zip(cuts, cuts[1:], strict=False):
            if split != (key := (files[low].as_py(), blocks[low].as_py())):
                split, seen, turns, begun = key, 0, 0, np.zeros(2, np.int64)
            ends = turns + np.cumsum(quotes[low:high])
            odd = (ends - quotes[low:high]) % 2 == 1
            starts = np.column_stack([~odd, odd]) & ~blank[low:high, None]
            run = begun + np.cumsum(starts, axis=0)
            columns = [files[low:high], blocks[low:high], pa.array(np.arange(seen, seen + high - low)), pa.array(odd), pa.array(quotes[low:high] % 2 == 1), pa.array(blank[low:high]), pa.array(run[:, 0].copy()), pa.array(run[:, 1].copy()), values[low:high]]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in LINES.split(", ")])
            seen, turns, begun = seen + high - low, int(ends[-1]), run[-1]


def split_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, number (0 for the header), value: the text of each record."""
    lines = spark.read.text(paths).select(F.col("value"), *place()).mapInArrow(_counted, LINES)
    splits = lines.groupBy("file", "block").agg((F.count_if("flips") % 2).alias("turns"), F.max("outside").alias("outside"), F.max("inside").alias("inside"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row for each split
    splits = splits.withColumn("opens", F.coalesce(F.sum("turns").over(before), F.lit(0)) % 2 == 1)
    splits = splits.withColumn("before", F.coalesce(F.sum(F.when(F.col("opens"), F.col("inside")).otherwise(F.col("outside"))).over(before), F.lit(0)))
    splits = splits.select(F.col("file").alias("_f"), F.col("block").alias("_b"), "opens", "before")
    met = lines.join(splits, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")))
    goes_on = F.col("odd") != F.col("opens")
    number = F.col("before") + F.when(F.col("opens"), F.col("inside")).otherwise(F.col("outside")) - 1
    met = met.where(goes_on | ~F.col("blank")).select("file", number.alias("number"), "block", "seq", "value", (~goes_on & ~F.col("flips")).alias("whole"))
    ordered = F.array_sort(F.collect_list(F.struct("block", "seq", "value")))
    spread = met.where("NOT whole").groupBy("file", "number").agg(F.array_join(F.transform(ordered, lambda s: s["value"]), "\n").alias("value"))
    return met.where("whole").select("file", "number", "value").unionByName(spread)


def header_of(records: DataFrame, sep: str = ",") -> list[str]:
    """The names in the files' header, which must be one."""
    found = {tuple(c.strip() for c in next(csv.reader(StringIO(r["value"].lstrip("﻿")), delimiter=sep))) for r in records.where("number = 0").select("value").distinct().limit(100).collect()}
    if len(found) != 1:
        raise ValueError(f"files have {len(found)} different headers")
    return list(found.pop())


def read_split_table(spark: SparkSession, paths: str | list[str], sep: str = ",") -> DataFrame:
    """The header's columns as texts, and ``_file`` and ``_number`` (from 1 in each file)."""
    records = split_records(spark, paths)
    names = header_of(records, sep)
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    fields = F.from_csv("value", schema, {"sep": sep, "escape": '"', "maxCharsPerColumn": "-1"})
    out = records.where("number > 0").select(fields.alias("r"), F.col("file").alias("_file"), F.col("number").alias("_number"))
    return out.select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(names)], "_file", "_number")


def numbered_across(df: DataFrame, name: str = "number") -> DataFrame:
    """``_file`` and ``_number`` as one number from 1, files in the order of their names."""
    counts = df.groupBy("_file").agg(F.max("_number").alias("n"))
    ahead = F.sum("n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))  # one row for each file
    ahead = counts.select(F.col("_file").alias("_f"), F.coalesce(ahead, F.lit(0)).alias("_before"))
    return df.join(ahead, F.col("_file") == F.col("_f")).withColumn(name, F.col("_before") + F.col("_number")).drop("_f", "_before", "_file", "_number")
