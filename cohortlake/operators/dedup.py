"""Screening for cohorts that are counted twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.plans.dims import PERIODS, period_of
from cohortlake.tables import written

# Names that tell of a cohort, and wordings that count people instead of records.
COHORT = r"(?i)birth\s+cohort|出生队列|prospective\s+cohort|母子队列|母婴队列|队列研究|cohort\s+study|longitudinal\s+cohort"
WORDING = r"(?i)\d[\d,]*\s+(?:participants|individuals|subjects)\b"
GOOD_WORDING = r"(?i)participant\s+records"


def first_author(c: Column) -> Column:
    first = F.trim(F.split(c, "[;；]")[0])
    run = F.regexp_extract(first, r"[A-Za-z\x{4e00}-\x{9fff}\-]+", 0)
    return F.when(run != "", run).otherwise(F.substring(first, 1, 10))


def clean_city(c: Column) -> Column:
    """Empty for lists of cities and long texts."""
    return F.when(c.isNull() | c.rlike("[，,;；]") | (F.length(c) > 12), "").otherwise(F.trim(c))


def cohort_hint(c: Column) -> Column:
    return F.regexp_extract(c, COHORT, 0)


def build_studies(df: DataFrame) -> DataFrame:
    """One row per study: the attributes of its first record, its counts and sample size."""
    first = F.min_by(F.struct("author", "city", "province", "sample_type", "title"), "record_id")
    out = df.groupBy("study_no").agg(first.alias("f"), F.sum("sample_size").alias("total_n"), F.count("*").alias("n_records"))
    return out.select("study_no", first_author(F.col("f.author")).alias("first_author"), clean_city(F.col("f.city")).alias("city"), "f.sample_type", F.lower(cohort_hint(F.col("f.title"))).alias("cohort"), "total_n", "n_records")


def _memberships(studies: DataFrame, city_least: int = 4, author_least: int = 3, cohort_least: int = 2) -> DataFrame:
    """kind, name, least, study_no, n_records: by city and matrix, by author and matrix, by cohort."""
    kinds = F.array(
        F.struct(F.lit("city").alias("kind"), F.when(F.col("city") != "", F.concat_ws("|", "city", "sample_type")).alias("name"), F.lit(city_least).alias("least")),
        F.struct(F.lit("author").alias("kind"), F.when(F.col("first_author") != "", F.concat_ws("|", "first_author", "sample_type")).alias("name"), F.lit(author_least).alias("least")),
        F.struct(F.lit("cohort").alias("kind"), F.when(F.col("cohort") != "", F.concat_ws("|", "cohort", "city")).alias("name"), F.lit(cohort_least).alias("least")),
    )
    return studies.select(F.explode(kinds).alias("k"), "study_no", "n_records").where("k.name IS NOT NULL").select("k.*", "study_no", "n_records")


def clusters(studies: DataFrame, city_least: int = 4, author_least: int = 3, cohort_least: int = 2) -> DataFrame:
    """kind, name, n_studies, n_records: by city and matrix, by author and matrix, by cohort."""
    each = _memberships(studies, city_least, author_least, cohort_least)
    return each.groupBy("kind", "name", "least").agg(F.count("*").alias("n_studies"), F.sum("n_records").alias("n_records")).where("n_studies >= least").drop("least")


def cluster_members(studies: DataFrame, **least: int) -> DataFrame:
    """kind, name, study_no: the studies of every cluster that is large enough."""
    large = clusters(studies, **least).select(F.col("kind").alias("_k"), F.col("name").alias("_n"))
    each = _memberships(studies, **least)
    return each.join(large, (F.col("kind") == F.col("_k")) & (F.col("name") == F.col("_n"))).select("kind", "name", "study_no")


def keep_largest(df: DataFrame, periods=PERIODS) -> DataFrame:
    """Of a city, matrix and period the record with the largest sample, of several the first by id; records outside of the periods stay, unranked."""
    df = df.withColumn("_period", period_of(F.col("sampling_year"), periods))
    inside, outside = df.where("_period IS NOT NULL"), df.where("_period IS NULL")
    best = F.min_by(F.struct("*"), F.struct(F.col("sample_size").isNull(), -F.col("sample_size"), F.col("record_id")))
    kept = inside.groupBy(F.col("city").alias("_c"), F.col("sample_type").alias("_s"), F.col("_period").alias("_p")).agg(best.alias("r")).select("r.*")
    return kept.unionByName(outside).drop("_period")


def strategy_impact(df: DataFrame, periods=PERIODS, city_least: int = 4) -> DataFrame:
    """strategy, records and sample size before and after: keep all, keep the largest, merge within clusters.

    Merging makes one record of each cluster of studies by city and matrix and leaves the sample size as it is.
    """
    inside = period_of(F.col("sampling_year"), periods)
    df = written(df.select("study_no", "record_id", "author", "city", "province", "sample_type", "title", "sampling_year", "sample_size"), "screened-records")
    cells = df.groupBy("city", "sample_type", inside.alias("p")).agg(F.count("*").alias("k"), F.sum("sample_size").alias("n"), F.max("sample_size").alias("top"))
    one = F.when(F.col("p").isNull(), F.col("k")).otherwise(1)
    out = cells.agg(F.sum("k").alias("records_before"), F.sum("n").alias("n_before"), F.sum(one).alias("records_one"), F.sum(F.when(F.col("p").isNull(), F.col("n")).otherwise(F.col("top"))).alias("n_one"))
    merged = clusters(build_studies(df), city_least).where("kind = 'city'").agg(F.coalesce(F.sum(F.col("n_records") - 1), F.lit(0)).alias("fewer"))
    out = out.withColumn("records_merged", F.col("records_before") - F.lit(merged.first()["fewer"]))
    rows = F.explode(F.array(*[F.struct(F.lit(s).alias("strategy"), F.col(r).alias("records_after"), F.col(n).alias("n_after")) for s, r, n in (("keep_all", "records_before", "n_before"), ("keep_largest", "records_one", "n_one"), ("merge_within_cohort", "records_merged", "n_before"))]))
    return out.select("records_before", "n_before", rows.alias("s")).select("s.strategy", "records_before", "n_before", "s.records_after", "s.n_after")


def wording_hits(docs: DataFrame, around: int = 60) -> DataFrame:
    """doc_id, hit, context: counts of people where records are meant, with what stands around them."""
    hits = F.regexp_extract_all("text", F.lit(rf"(?is).{{0,{around}}}{WORDING.removeprefix('(?i)')}.{{0,{around}}}"), F.lit(0))
    return docs.select("doc_id", F.explode(hits).alias("context")).select("doc_id", F.regexp_extract("context", WORDING, 0).alias("hit"), F.trim("context").alias("context"))


def good_wording(text: Column) -> Column:
    """Whether a text speaks of participant records, as it should where sums are of records."""
    return text.rlike(GOOD_WORDING)


def screen(df: DataFrame, docs: DataFrame | None = None, periods=PERIODS) -> dict[str, DataFrame]:
    """The whole screening: studies, clusters, strategies, and, with manuscripts, their wording."""
    studies = build_studies(df)
    out = {"studies": studies, "clusters": clusters(studies), "strategies": strategy_impact(df, periods)}
    return out if docs is None else out | {"wording": wording_hits(docs)}
