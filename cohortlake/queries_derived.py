"""Registered queries of derived columns and dimension checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.functions.text import citations
from cohortlake.operators import derived, pool, quality, raw_records, references, statistics
from cohortlake.plans.dims import records
from cohortlake.queries import query, rounded
from cohortlake.queries_review import _library, _table


@query("SELECT record_id, CASE WHEN region IN ('ASIA', 'EUROPE') THEN region ELSE 'UNKNOWN' END AS region FROM rec")
def assigned_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension of two regions' provinces; the other provinces are unknown."""
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    dim = nation.join(region.where("r_name IN ('ASIA', 'EUROPE')"), nation["n_regionkey"] == region["r_regionkey"]).select(F.col("n_name").alias("province"), F.col("r_name").alias("region"))
    return derived.assign_region(records(spark, sf_dir), dim).select("record_id", "region")


@query("SELECT province, count(DISTINCT population_group) AS n_regions FROM rec GROUP BY province HAVING count(DISTINCT population_group) > 1")
def split_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check for keys with several values, on a mapping that has them."""
    return derived.split_provinces(records(spark, sf_dir).select("province", F.col("population_group").alias("region")))


@query("SELECT record_id, CAST(floor((sampling_year + t_publication) / 2) AS INT) AS year, sampling_year <> t_publication AS time_represented FROM rec")
def representative_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = records(spark, sf_dir).withColumns({"year_from": F.col("sampling_year"), "year_to": F.col("t_publication")})
    return derived.representative_year(rec, "midpoint").select("record_id", "year", "time_represented")


@query("SELECT record_id FROM (SELECT record_id, o, min(o) OVER (PARTITION BY study_no, sample_type, population_group, sampling_year) AS best FROM (SELECT *, CASE adjusted WHEN 'Creatinine' THEN 0 WHEN 'SpecificGravity' THEN 1 ELSE 2 END AS o FROM rec)) WHERE o = best")
def preferred_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.prefer_basis(records(spark, sf_dir)).select("record_id")


@query("SELECT page_id, regexp_matches(t, 'occupational|workers|smelter') AND NOT regexp_matches(t, 'non-?occupational') AS title_occupational, regexp_matches(t, 'patients|disease|poisoning') AS title_disease, regexp_matches(t, 'endemic') AS title_endemic, regexp_matches(regexp_replace(t, 'non-?occupational', '', 'g'), 'occupational|workers|smelter') AND regexp_matches(t, 'non-?occupational') AS title_mixed_occupational, regexp_matches(t, 'serum|plasma|血清|血浆') AS title_blood_matrix FROM (SELECT page_id, lower(regexp_extract(html, '<title>([^<]*)', 1)) AS t FROM pages)")
def flagged_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)", 1).alias("title"))
    return derived.title_flags(pages).drop("title")


@query("SELECT province, count(*) AS n FROM rec WHERE region NOT IN ('ASIA', 'EUROPE') GROUP BY province")
def unlisted_provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provinces of records that a dimension of two regions lacks."""
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    dim = nation.join(region.where("r_name IN ('ASIA', 'EUROPE')"), nation["n_regionkey"] == region["r_regionkey"]).select(F.col("n_name").alias("province"))
    return derived.unlisted(records(spark, sf_dir), "province", dim)


@query("SELECT 'cohort' AS name, n AS n_all, a AS n_lost, n - a AS n_left, CASE WHEN n - a < 30 THEN 'few' WHEN n - a > 50000 THEN 'many' ELSE 'fine' END AS size FROM (SELECT count(*) AS n, count(*) FILTER (regexp_matches(title, '(?i)birth cohort')) AS a FROM rec) UNION ALL SELECT 'any', n, n, 0, 'few' FROM (SELECT count(*) AS n FROM rec)")
def exclusion_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two groups of words to exclude: one that costs some records, one that costs all."""
    return raw_records.exclusion_groups(records(spark, sf_dir), F.col("title"), {"cohort": ["birth cohort"], "any": ["study of", "report of"]})


@query("SELECT group_key, count(*) AS n FROM (SELECT CASE WHEN s_suppkey % 2 = 0 THEN '10.1234/x.' || (s_suppkey % 5) ELSE chr(97 + CAST(s_nationkey AS INT)) || 'uthor|' || (1990 + s_suppkey % 20) || '|levels of arsenic' END AS group_key FROM supplier) GROUP BY group_key HAVING count(*) > 1")
def library_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A library whose even entries share five DOIs, and whose odd ones have none and one title."""
    lib = _library(spark, sf_dir).withColumn("n", F.substring("record_id", 2, 6).cast("int"))
    doi = F.when(F.col("n") % 2 == 0, F.concat(F.lit("https://doi.org/10.1234/X."), F.col("n") % 5)).otherwise(F.lit("NO_DOI"))
    return references.library_duplicates(lib.withColumns({"doi": doi, "title": F.lit("Levels of Arsenic")}))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 OR o_orderstatus = 'P'")
def stale_artefacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as artefacts of a snapshot by status: every third has no digest, those of one status an old one."""
    orders, digest = _table(spark, sf_dir, "orders"), F.sha2("o_orderstatus", 256)
    current = orders.select(F.col("o_orderstatus").alias("snapshot_tag")).distinct().withColumn("sha256", F.when(F.col("snapshot_tag") == "P", "new").otherwise(F.sha2("snapshot_tag", 256)))
    made = orders.select("o_orderkey", F.col("o_orderstatus").alias("snapshot_tag"), F.when(F.col("o_orderkey") % 3 != 0, digest).alias("sha256"))
    return quality.stale(made, current).select("o_orderkey")


@query("SELECT label, start, \"end\" FROM (SELECT *, lag(\"end\") OVER (ORDER BY start) AS b FROM (SELECT o_orderpriority AS label, CAST(substr(o_orderpriority, 1, 1) AS INT) * 5 AS start, CAST(substr(o_orderpriority, 1, 1) AS INT) * 5 + CAST(count(DISTINCT year(o_orderdate)) AS INT) - 2 AS \"end\" FROM orders GROUP BY o_orderpriority)) WHERE start <= b OR \"end\" < start")
def overlapping_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods by priority of orders: five years apart, each as long as its orders' years less one."""
    start = F.substring("o_orderpriority", 1, 1).cast("int") * 5
    years = _table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.countDistinct(F.year("o_orderdate")).cast("int").alias("n"))
    return derived.overlapping_periods(years.select(F.col("o_orderpriority").alias("label"), start.alias("start"), (start + F.col("n") - 2).alias("end")))


_SPREADS = {"S1": ("w", "xi"), "S2": ("w", "xi"), "S3": ("w", "1.9079"), "S4": ("q", "xi"), "S5": ("q", "xi"), "S6": ("q", "1.349"), "S7": ("q", "qw")}


@query(
    f"""SELECT stat_type, {', '.join(f"round(avg({v} / {c}) FILTER ({v} > 0 AND {c} > 0), 6) AS sd_{k}" for k, (v, c) in _SPREADS.items())}
FROM (SELECT stat_type, initial_max - initial_min AS w, initial_p75 - initial_p25 AS q, xi, qw FROM rec LEFT JOIN widths ON rec.sample_size = widths.sample_size) GROUP BY stat_type"""
)
def spread_formulas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean standard deviation by each formula, for each type of statistic."""
    names = [f"sd_{k}" for k in _SPREADS]
    return rounded(statistics.spread(records(spark, sf_dir)).groupBy("stat_type").agg(*[F.avg(c).alias(c) for c in names]), *names)


@query("SELECT sample_type, region, round(exp(sum(sample_size * ln(gm_direct)) / sum(sample_size)), 6) AS gm FROM rec WHERE gm_direct > 0 AND sample_size > 0 GROUP BY sample_type, region ORDER BY sample_type, region")
def strata_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = ["sample_type", "region"]
    return pool.in_order(rounded(pool.pool(records(spark, sf_dir), dims, "gm_direct").select(*dims, "gm"), "gm"), dims)


@query("SELECT c_custkey AS doc_id, unnest(['who|' || y, 'us epa|' || y, 'united states environmental protection agency|' || y, 'smith|' || y]) AS key FROM (SELECT c_custkey, 1985 + c_custkey % 30 AS y FROM customer)")
def institutional_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manuscripts that cite two institutions, one by its abbreviation and one by its name, and a person."""
    year = (1985 + F.col("c_custkey") % 30).cast("string")
    text = F.concat(F.lit("As was found (see WHO, "), year, F.lit("; US EPA "), year, F.lit("; United States Environmental Protection Agency, "), year, F.lit("; Smith et al., "), year, F.lit(")."))
    return citations(_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_id"), text.alias("text")))
