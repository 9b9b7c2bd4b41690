"""A pooled table that follows corrections: a record's later version replaces what its earlier one gave, a withdrawal takes it back.

State is kept by record, so that no stratum, however large, is one key: the version last taken and what it
gave to which stratum. Records are dealt to shards by hash, each of which is one state value, so that many records are looked up at once. A newer version emits minus the old and plus the new contribution; older versions that arrive late
change nothing. The signed contributions of a micro-batch are summed by stratum and written to the batch's own folder, so
that a batch that is run again replaces itself; sums over all folders are the pooled table, whatever the order of batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from cohortlake.operators.pool import poolable
from cohortlake.plans.dims import period_of

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SIGNED = "stratum string, v double, w double, sign int"
KEPT = ["record_id", "version", "stratum", "v", "w"]


class LastContributions(StatefulProcessor):
    """Keeps (version, stratum, v, w) of each record of a shard, as one Arrow table; a withdrawn record keeps its version without a stratum."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "kept binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = pd.concat([batch[KEPT] for batch in rows]).sort_values(["version", "stratum", "v", "w"], na_position="first")
        newest = came.drop_duplicates("record_id", keep="last")  # of one version sent twice the greatest
        kept = self.last.get()[0] if self.last.exists() else None
        kept = pa.ipc.open_stream(kept).read_pandas() if kept is not None else newest.iloc[:0]
        met = newest.merge(kept, on="record_id", how="left", suffixes=("", "_old"))
        met = met[met["version_old"].isna() | (met["version"] > met["version_old"])]
        if not len(met):
            return
        rest = kept[~kept["record_id"].isin(met["record_id"])]
        now = pa.Table.from_pandas(pd.concat([x for x in (rest, met[KEPT]) if len(x)]), TABLE, preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, now.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(now)
        self.last.update((sink.getvalue().to_pybytes(),))
        gone = met[met["stratum_old"].notna()]
        gone = pd.DataFrame({"stratum": gone["stratum_old"], "v": gone["v_old"], "w": gone["w_old"], "sign": -1})
        new = met[met["stratum"].notna()][["stratum", "v", "w"]].assign(sign=1)
        out = pd.concat([x for x in (gone, new) if len(x)] or [new])
        if len(out):
            yield out.astype({"v": float, "w": float, "sign": "int32"})

    def close(self) -> None:
        pass


TABLE = pa.schema([("record_id", pa.string()), ("version", pa.int64()), ("stratum", pa.string()), ("v", pa.float64()), ("w", pa.float64())])


def contributions(df: DataFrame, dims: list[str], value: str = "gm_summary", weight: str = "sample_size") -> DataFrame:
    """record_id, version, stratum (the dims as JSON; null if withdrawn or not to be pooled), v, w."""
    if "period" in dims and "period" not in df.columns:
        df = df.withColumn("period", period_of(F.col("sampling_year")))
    inside = F.col("period").isNotNull() if "period" in dims else F.lit(True)
    marked = df.where(inside).withColumns({"_value": F.when(~F.coalesce("withdrawn", F.lit(False)), F.col(value)), "_row": F.struct("record_id", "version")})
    keyed = marked.drop("record_id").withColumn("record_id", F.col("_row"))  # poolable carries record_id along
    pooled = poolable(keyed, dims, "_value", weight).select("record_id.record_id", "record_id.version", F.to_json(F.struct(*dims)).alias("stratum"), "v", "w")
    gone = df.where(~F.coalesce(inside & (F.col(value) > 0) & (F.col(weight) > 0) & ~F.coalesce("withdrawn", F.lit(False)), F.lit(False)))
    nothing = gone.select("record_id", "version", F.lit(None).cast("string").alias("stratum"), F.lit(None).cast("double").alias("v"), F.lit(None).cast("double").alias("w"))
    return pooled.unionByName(nothing)


def follow_corrections(stream: DataFrame, dims: list[str], path: str, checkpoint: str, value: str = "gm_summary", weight: str = "sample_size", shards: int = 64) -> StreamingQuery:
    """``stream``: record_id, version, withdrawn, the dims, value and weight. Reads what is there in micro-batches and stops.

    ``shards``: about one for every thousand to ten thousand records that are ever to come; it can't change for a checkpoint.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    each = contributions(stream, dims, value, weight).withColumn("shard", F.pmod(F.xxhash64("record_id"), F.lit(shards))).groupBy("shard")
    signed = each.transformWithStateInPandas(statefulProcessor=LastContributions(), outputStructType=SIGNED, outputMode="Append", timeMode="None")

    def write(batch: DataFrame, number: int) -> None:
        w = F.col("sign") * F.col("w")
        batch.groupBy("stratum").agg(F.sum(w * F.ln("v")).alias("swl"), F.sum(w).alias("sw"), F.sum("sign").alias("n")).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return signed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def corrected_table(spark: SparkSession, path: str, dims: list[str]) -> DataFrame:
    """dims, gm, record_count, total_sample_size of all batches so far; strata whose records have all gone are left out."""
    schema = ", ".join(f"`{d}` string" for d in dims)
    sums = spark.read.schema("stratum string, swl double, sw double, n long").parquet(path).groupBy("stratum").agg(*[F.sum(c).alias(c) for c in ("swl", "sw", "n")]).where("n > 0")
    return sums.select(F.from_json("stratum", schema).alias("s"), "*").select("s.*", F.exp(F.col("swl") / F.col("sw")).alias("gm"), F.col("n").alias("record_count"), F.col("sw").alias("total_sample_size"))
