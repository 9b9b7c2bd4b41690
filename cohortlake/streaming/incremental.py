"""A pooled table kept up to date by micro-batches: the sums of each stratum are mergeable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortlake.operators.pool import poolable


def partial_sums(df: DataFrame, dims: list[str], value: str = "gm_summary", weight: str = "sample_size") -> DataFrame:
    rows = poolable(df, dims, value, weight)
    return rows.groupBy(*dims).agg(F.sum(F.col("w") * F.ln("v")).alias("swl"), F.sum("w").alias("sw"), F.count("*").alias("n"))


def merged(sums: DataFrame, dims: list[str]) -> DataFrame:
    """gm, record_count and total_sample_size from any number of partial sums."""
    return sums.groupBy(*dims).agg(F.exp(F.sum("swl") / F.sum("sw")).alias("gm"), F.sum("n").alias("record_count"), F.sum("sw").alias("total_sample_size"))


def follow(stream: DataFrame, dims: list[str], path: str, checkpoint: str) -> StreamingQuery:
    """Writes each micro-batch's sums to a folder of its own, so that a batch that is run again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        partial_sums(batch, dims).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
