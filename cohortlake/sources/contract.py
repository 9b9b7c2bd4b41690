"""Readers and writers of the record table, the citation library and DOI metadata, by their contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.sources.split_tables import read_split_table

# What stands for a missing value (lower case), and the columns of the contract by type.
MISSING = ["", "na", "n/a", "nan", "none", "null", "-", "—", "未报告"]
NUMBERS = "time time_start time_end latitude longitude age_mean height weight bmi initial_gm initial_mean initial_sd initial_median initial_p25 initial_p75 initial_p05 initial_p95 initial_min initial_max initial_gsd gm_summary gsd_summary".split()
INTEGERS = "t_publication male_n female_n sample_size".split()
BOOLEANS = "flag_occupational flag_disease flag_endemic_area flag_mixed_occupational flag_blood_matrix qc_reported verified".split()
LIBRARY = ["record_id", "authors", "year", "title", "journal", "volume", "issue", "pages", "doi"]
METADATA = "DOI string, title array<string>, `container-title` array<string>, issued struct<`date-parts`:array<array<int>>>, volume string, issue string, page string"


def present(c: Column) -> Column:
    """The trimmed text; null for a token that stands for a missing value."""
    text = F.trim(F.regexp_replace(c.cast("string"), r"^\x{FEFF}", ""))
    return F.when(~F.lower(text).isin(*MISSING), text)


def clean_missing(df: DataFrame) -> DataFrame:
    """Every text column trimmed and without tokens for missing values."""
    return df.select(*[present(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f"`{f.name}`") for f in df.schema.fields])


def typed(df: DataFrame) -> DataFrame:
    """Texts of the contract's columns in their types; what can't be read as a number is null, true, 1, yes, y and 是 are true."""
    kinds = {**dict.fromkeys(NUMBERS, "double"), **dict.fromkeys(INTEGERS, "long")}

    def one(name: str) -> Column:
        if name in kinds:
            return F.expr(f"cast(try_cast(`{name}` AS double) AS {kinds[name]})").alias(name)
        if name in BOOLEANS:
            return F.lower(F.col(name).cast("string")).isin("true", "1", "yes", "y", "是").alias(name)
        return F.col(f"`{name}`")

    return df.select(*map(one, df.columns))


def read_records(spark: SparkSession, paths: str | list[str], kind: str = "csv") -> DataFrame:
    """The record table by its header: a byte order mark, blanks around names and missing tokens are taken off, rows without any value skipped."""
    if kind not in ("csv", "parquet"):
        raise ValueError(f"unknown kind {kind}")
    raw = read_split_table(spark, paths).drop("_file", "_number") if kind == "csv" else spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
    raw = raw.toDF(*[c.lstrip("﻿").strip() for c in raw.columns])
    clean = clean_missing(raw)
    return typed(clean.where(F.coalesce(*[F.col(f"`{c}`").cast("string") for c in clean.columns]).isNotNull()))


def read_library(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The citation library; a blank record_id becomes a hash of the row, the same in every run."""
    raw = read_split_table(spark, paths).drop("_file", "_number")
    raw = clean_missing(raw.toDF(*[c.lstrip("﻿").strip().lower() for c in raw.columns]))
    if "title" not in raw.columns or "authors" not in raw.columns:
        raise ValueError(f"a library has authors and title, not {raw.columns}")
    out = raw.select(*[F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in LIBRARY])
    return out.withColumn("record_id", F.coalesce("record_id", F.concat(F.lit("row-"), F.hex(F.xxhash64(*LIBRARY[1:])))))


def read_doi_metadata(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """doi, title, journal, year, volume, issue, pages from a dump of one JSON message a line."""
    raw = spark.read.schema(METADATA).json(paths)
    return raw.select(F.col("DOI").alias("doi"), F.get("title", F.lit(0)).alias("title"), F.get(F.col("`container-title`"), F.lit(0)).alias("journal"), F.get(F.get(F.col("issued.`date-parts`"), F.lit(0)), F.lit(0)).alias("year"), "volume", "issue", F.col("page").alias("pages"))


def write_table(df: DataFrame, path: str, fingerprint: dict[str, str], kind: str = "parquet", partition: str = "sample_type") -> None:
    """Results with the fingerprint of what they were made from (table digest, configuration) as columns, partitioned by matrix where there is one."""
    if kind not in ("csv", "parquet"):
        raise ValueError(f"unknown kind {kind}")
    writer = df.withColumns({k: F.lit(v) for k, v in fingerprint.items()}).write.mode("errorifexists")
    writer = writer.partitionBy(partition) if partition in df.columns else writer
    writer.option("header", True).csv(path) if kind == "csv" else writer.parquet(path)
