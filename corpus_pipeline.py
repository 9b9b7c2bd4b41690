"""The corpus pipeline: five stages over ``documents``, each written and reread before the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of
``docs``; ``text`` and ``n_chars`` change where a stage edits texts.

Defined cases, of every stage: a null text counts as empty; null ids and repeated rows are rows like any other,
told apart by their texts; extra columns, whatever their names, pass through; an empty ``docs`` gives an empty
result; without labels or benchmark items every document stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm.bpe_codec import round_trip
from cohortlake.llm.common import dropped, intermediate, light_join, table, text_of, written
from cohortlake.llm.decontamination import decontaminate
from cohortlake.llm.line_dedup import repeated_lines
from cohortlake.llm.quality_classifier import select_quality
from cohortlake.llm.simhash_dedup import simhash_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the best grade is a half or more stay."""
    return select_quality(docs, table(spark, sf_dir, "labels")).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of three lines, or of 50 words in fewer, leave the texts; every document stays."""
    marks = repeated_lines(docs)
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id"), text_of()).alias("key"))
    joined = light_join(packed, marks, "left")
    gone = F.expr("map_from_entries(transform(removed, i -> struct(i, true)))")
    kept = F.array_join(F.filter(F.split("row.text", "\n", -1), lambda _, i: F.element_at(gone, i).isNull()), "\n")
    text = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(kept)
    joined = joined.withColumn("row", F.col("row").withField("text", text))
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("removed").isNull(), F.col("row.n_chars")).otherwise(F.char_length("row.text").cast(docs.schema["n_chars"].dataType))
        joined = joined.withColumn("row", F.col("row").withField("n_chars", n_chars))
    return joined.select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays, null ids last; of several with this id and one text one."""
    return simhash_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the number of tokens, and digests of the ids and of the decoded text, one row for each document."""
    return round_trip(docs)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("SimHash near-dedup", near_dedup), ("benchmark decontamination", decontamination), ("BPE encoding and decoding", encoding)]

# The classifier and the latent search can't be said in SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with intermediate(spark) as keep:
            before, docs = docs, written(stage(spark, docs, sf_dir), "stage-" + name.lower().replace(" ", "-"))
            keep.append(docs)
        dropped(before)
    return docs
