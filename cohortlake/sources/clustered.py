"""The record table clustered by study: study-level aggregations, windows and joins need no exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortlake.tables import swept


def write_clustered(df: DataFrame | list[DataFrame], name: str, keys: list[str], buckets: int, path: str | None = None) -> DataFrame:
    """Writes ``df`` as a table dealt to ``buckets`` by ``keys`` and sorted by them within; a table by this name is an error. Dealt before the write, so that a bucket is one file.

    Of a list, the parts of a table, each is dealt and added without the shuffle files of those before; a bucket is then one file of each.
    """
    parts = [df] if isinstance(df, DataFrame) else df
    for i, part in enumerate(parts):
        if i:
            swept(part.sparkSession)
        writer = part.repartition(buckets, *keys).write.mode("append" if i else "errorifexists").option("compression", "zstd").bucketBy(buckets, *keys).sortBy(*keys)
        (writer.option("path", path) if path else writer).saveAsTable(name)
    return parts[0].sparkSession.table(name)
