"""Registered queries of what works in rounds, in splits, by intervals, along links or on changes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.operators import audit, components, convert, dedup, deltas, derived, intervals, lineage, pool, quality, sensitivity, statistics, term_index
from cohortlake.plans.dims import record_count, record_parts, records
from cohortlake.queries import PERIOD_SQL, query, rounded
from cohortlake.queries_review import _OLD, _STUDIES, _SUMS, _table
from cohortlake.sources.clustered import write_clustered
from cohortlake.sources.doi_messages import doi_fields, shape_findings
from cohortlake.sources.split_tables import read_split_table
from cohortlake.streaming.corrections import corrected_table, follow_corrections
from cohortlake.tables import deleted, dropped, shared_folder, swept, written, written_parts


def _folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


_ONE_FEED = r"regexp_replace({}, '\r\n?', '{}'{})"


@query("SELECT doc_id, source, lang, sha256(" + _ONE_FEED.format("text", "\n", ", 'g'") + ") AS text_sha256 FROM documents")
def split_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a quoted export whose texts hold line ends and quotes, read back in splits."""
    path, docs = _folder(spark, "export"), _table(spark, sf_dir, "documents")
    docs.select("doc_id", "source", "lang", "text").write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    read = read_split_table(spark, path)
    return read.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


_DIMS = ["sample_type", "region", "period"]


@query(
    f"""SELECT sample_type, region, period, round(exp(sum(w * ln(v)) / sum(w)), 6) AS gm, count(*) AS record_count, round(sum(w), 6) AS total_sample_size
FROM (SELECT sample_type, region, {PERIOD_SQL} AS period, CAST(sample_size AS DOUBLE) AS w, gm_direct * CASE WHEN study_no LIKE '%3' THEN 1.5 ELSE 1 END AS v FROM rec WHERE NOT study_no LIKE '%9')
WHERE v > 0 AND w > 0 AND period IS NOT NULL GROUP BY ALL"""
)
def pooled_with_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in three versions: later ones correct every tenth study's values and withdraw another's, and come before the first ones.

    Followed part by part of the records, all versions of a record in one part, whose files and state go when its stream has ended.
    """
    path, count = _folder(spark, "versions"), record_count(spark, sf_dir)
    parts = record_parts(spark, sf_dir, count)
    for i, part in enumerate(parts):
        _write_versions(part, f"{path}/{i}/in")
        stream = spark.readStream.schema(_VERSIONS).option("maxFilesPerTrigger", 1000).parquet(f"{path}/{i}/in")
        shards = max(64, count // len(parts) // 10_000)
        follow_corrections(stream, _DIMS, f"{path}/sums/part={i}", f"{path}/{i}/checkpoint", shards=shards).awaitTermination()
        deleted(spark, f"{path}/{i}")
        swept(spark)
    return rounded(corrected_table(spark, f"{path}/sums", _DIMS), "gm", "total_sample_size")


_VERSIONS = "record_id string, version long, withdrawn boolean, sample_type string, region string, sampling_year int, gm_summary double, sample_size int"


def _write_versions(rec: DataFrame, path: str) -> None:
    """The versions in the order in which they come: third, first, second."""
    columns = ["record_id", F.lit(1).cast("long").alias("version"), F.lit(False).alias("withdrawn"), "sample_type", "region", "sampling_year", F.col("gm_direct").cast("double").alias("gm_summary"), "sample_size", "study_no"]
    first = written(rec.select(*columns), "first-versions")
    corrected = first.where(F.col("study_no").endswith("3")).withColumns({"version": F.lit(3).cast("long"), "gm_summary": F.col("gm_summary") * 1.5})
    withdrawn = first.where(F.col("study_no").endswith("9")).withColumns({"version": F.lit(2).cast("long"), "withdrawn": F.lit(True)})
    wrong = first.where(F.col("study_no").endswith("3")).withColumns({"version": F.lit(2).cast("long"), "gm_summary": F.col("gm_summary") * 9})
    for part in (corrected, first, withdrawn.unionByName(wrong)):
        part.drop("study_no").write.mode("append").option("compression", "zstd").parquet(path)
    dropped(first)


_STATES = f"""o AS (SELECT record_id, sample_type, region, {PERIOD_SQL} AS period, gm_direct AS v, CAST(sample_size + CASE WHEN study_no LIKE '%7' THEN 1 ELSE 0 END AS DOUBLE) AS w FROM rec WHERE {_OLD}),
n AS (SELECT record_id, sample_type, region, {PERIOD_SQL} AS period, gm_direct AS v, CAST(sample_size AS DOUBLE) AS w FROM rec WHERE sampling_year > 1995),
a AS (SELECT * FROM o WHERE v > 0 AND w > 0 AND period IS NOT NULL), b AS (SELECT * FROM n WHERE v > 0 AND w > 0 AND period IS NOT NULL),
d AS ((SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT ALL SELECT * FROM a)),
t AS (SELECT sample_type, region, period, count(*) AS n_changes FROM d GROUP BY ALL),
x AS (SELECT sample_type, region, period, round(exp(sum(w * ln(v)) / sum(w)), 6) AS gm_before, count(*) AS n_before FROM a GROUP BY ALL),
y AS (SELECT sample_type, region, period, round(exp(sum(w * ln(v)) / sum(w)), 6) AS gm_after, count(*) AS n_after FROM b GROUP BY ALL)"""


@query(f"WITH {_STATES} SELECT sample_type, region, period, gm_before, gm_after, coalesce(n_before, 0) AS n_before, coalesce(n_after, 0) AS n_after, n_changes FROM t LEFT JOIN x USING (sample_type, region, period) LEFT JOIN y USING (sample_type, region, period)")
def strata_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strata of an older state of the table brought up to a newer one by what changed between them."""
    rec = records(spark, sf_dir)
    old = rec.where(_OLD).withColumn("sample_size", F.when(F.col("study_no").endswith("7"), F.col("sample_size") + 1).otherwise(F.col("sample_size")))
    new = rec.where("sampling_year > 1995")
    changes = deltas.stratum_deltas(deltas.signed_contributions(old, new, _DIMS, "gm_direct"), _DIMS)
    return rounded(deltas.updated_strata(deltas.stratum_sums(old, _DIMS, "gm_direct"), changes, _DIMS), "gm_before", "gm_after")


@query(
    """WITH RECURSIVE links AS (SELECT 'snapshot ' || n_regionkey AS source, 'table ' || n_nationkey AS made FROM nation
  UNION SELECT 'table ' || s_nationkey, 'figure ' || s_suppkey FROM supplier UNION SELECT 'figure ' || s_suppkey, 'snapshot ' || s_nationkey % 5 FROM supplier WHERE s_suppkey % 25 = 1),
changed AS (SELECT 'snapshot ' || r_regionkey AS name FROM region WHERE r_regionkey = 1 UNION SELECT 'table ' || n_nationkey FROM nation WHERE n_nationkey = 7 UNION SELECT 'figure ' || s_suppkey FROM supplier WHERE s_suppkey % 10 = 3),
reached AS (SELECT name, 0 AS depth, name AS origin FROM changed UNION SELECT made, depth + 1, origin FROM reached JOIN links ON source = name WHERE depth < 12)
SELECT name, CAST(min(depth) AS INTEGER) AS depth, first(origin ORDER BY depth, origin) AS origin, count(DISTINCT origin) AS n_origins FROM reached GROUP BY name"""
)
def stale_downstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions as snapshots, nations as tables, suppliers as figures, some of which go into a snapshot again, so that there are cycles."""
    nation, supplier, region = (_table(spark, sf_dir, n) for n in ("nation", "supplier", "region"))
    named = lambda kind, c: F.concat(F.lit(kind + " "), c)
    snapshot, made, figure = named("snapshot", F.col("n_regionkey")), named("table", F.col("n_nationkey")), named("figure", F.col("s_suppkey"))
    links = nation.select(snapshot.alias("source"), made.alias("made")).union(supplier.select(named("table", F.col("s_nationkey")), figure)).union(supplier.where("s_suppkey % 25 = 1").select(figure, named("snapshot", F.col("s_nationkey") % 5)))
    names = region.select(named("snapshot", F.col("r_regionkey")).alias("name"), (F.col("r_regionkey") == 1).alias("old")).union(nation.select(made, F.col("n_nationkey") == 7)).union(supplier.select(figure, F.col("s_suppkey") % 10 == 3))
    current = names.select("name", F.sha2("name", 256).alias("sha256"))
    return lineage.stale_downstream(names.select("name", F.when(~F.col("old"), F.sha2("name", 256)).alias("sha256")), links, current)


@query("SELECT record_id FROM rec WHERE EXISTS (SELECT 1 FROM part WHERE p_partkey % 7 = 0 AND contains(' ' || lower(title) || ' ', ' ' || lower(p_name) || ' ')) AND (contains(title, 'Study') OR contains(title, 'Report')) AND NOT contains(lower(title), 'birth cohort')")
def term_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh part's name as a phrase, with words of another block and a phrase to exclude."""
    names = _table(spark, sf_dir, "part").where("p_partkey % 7 = 0").select(F.lit("item").alias("block"), F.col("p_name").alias("term"))
    more = spark.createDataFrame([("kind", "stud*"), ("kind", "report"), ("out", "birth cohort*")], "block string, term string")
    parts = record_parts(spark, sf_dir, record_count(spark, sf_dir))
    titled = written_parts([part.select("record_id", "title") for part in parts], "titled-records")
    return term_index.search(titled, "record_id", F.col("title"), names.unionByName(more), ["out"]).select("record_id")


_MEMBERS = f"""s AS ({_STUDIES}),
m AS (SELECT 'city' AS kind, city || '|' || sample_type AS name, 4 AS least, study_no FROM s WHERE city <> '' UNION ALL SELECT 'author', first_author || '|' || sample_type, 3, study_no FROM s WHERE first_author <> ''
  UNION ALL SELECT 'cohort', cohort || '|' || city, 2, study_no FROM s WHERE cohort <> ''),
l AS (SELECT * FROM m QUALIFY count(*) OVER (PARTITION BY kind, name) >= least),
e AS (SELECT DISTINCT a.study_no AS a, b.study_no AS b FROM l a JOIN l b ON a.kind = b.kind AND a.name = b.name),
r AS (SELECT study_no AS a, study_no AS b FROM s UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
g AS (SELECT a AS study_no, min(b) AS group_id FROM r GROUP BY a)"""
_RECURSIVE_MEMBERS = "WITH RECURSIVE " + _MEMBERS


def _recursive(sql: str) -> str:
    """The SQL in a subquery of its own, as ``rec`` goes before it without RECURSIVE."""
    return f"SELECT * FROM ({_RECURSIVE_MEMBERS} {sql}) AS q WHERE EXISTS (SELECT 1 FROM rec)"


@query(_recursive("SELECT s.study_no, group_id, coalesce(k, 0) AS n_clusters, n_records FROM s JOIN g USING (study_no) LEFT JOIN (SELECT study_no, count(*) AS k FROM l GROUP BY study_no) USING (study_no)"))
def cohort_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Studies joined by any chain of shared clusters."""
    return components.cohort_groups(records(spark, sf_dir))


@query(_recursive("SELECT CAST(sum(k) AS BIGINT) AS n_studies, count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS records_before, CAST(sum(CASE WHEN k > 1 THEN 1 ELSE n END) AS BIGINT) AS records_after FROM (SELECT group_id, count(*) AS k, sum(n_records) AS n FROM s JOIN g USING (study_no) GROUP BY group_id)"))
def merge_groups_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.merge_groups_impact(records(spark, sf_dir))


# A period for each priority of orders: three years each, two apart, so that neighbours share one; the last lies behind a gap.
_PERIODS = "SELECT DISTINCT o_orderpriority AS label, 1989 + 2 * k + CASE WHEN k = 5 THEN 1 ELSE 0 END AS start, 1991 + 2 * k + CASE WHEN k = 5 THEN 1 ELSE 0 END AS \"end\" FROM (SELECT o_orderpriority, CAST(substr(o_orderpriority, 1, 1) AS INT) AS k FROM orders)"


def _periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.substring("o_orderpriority", 1, 1).cast("int")
    start = 1989 + 2 * k + F.when(k == 5, 1).otherwise(0)
    return _table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("label"), start.alias("start"), (start + 2).alias("end")).distinct()


@query(f"SELECT label, sample_type, count(*) AS n_records, sum(sample_size) AS total_sample_size FROM rec LEFT JOIN ({_PERIODS}) AS p ON sampling_year BETWEEN start AND \"end\" GROUP BY ALL")
def records_by_period_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in the periods of a table, with those of none."""
    met = intervals.interval_join(records(spark, sf_dir).select("record_id", "sampling_year", "sample_type", "sample_size"), "sampling_year", _periods(spark, sf_dir), how="left")
    return met.groupBy("label", "sample_type").agg(F.count("*").alias("n_records"), F.sum("sample_size").alias("total_sample_size"))


@query(f"SELECT record_id, string_agg(label, ';' ORDER BY label) AS labels FROM rec JOIN ({_PERIODS}) AS p ON sampling_year BETWEEN start AND \"end\" GROUP BY record_id HAVING count(*) > 1")
def records_in_two_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.in_several(records(spark, sf_dir), "record_id", "sampling_year", _periods(spark, sf_dir))


@query(f"SELECT label, CASE WHEN start <= b THEN 'overlaps' ELSE 'gap' END AS fault FROM (SELECT *, max(\"end\") OVER (ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM ({_PERIODS}) AS p) WHERE start <= b OR start > b + 1")
def period_table_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.interval_faults(_periods(spark, sf_dir))


@query("SELECT r_name AS label, c_mktsegment, count(*) AS n FROM customer JOIN region ON c_acctbal BETWEEN r_regionkey * 2200.0 - 1000 AND r_regionkey * 2200.0 + 1199.99 GROUP BY ALL")
def customers_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands of a value that isn't whole, one for each region, as age bands would be."""
    bound = lambda sql: F.expr(sql).cast("double")  # noqa: E731  reckoned in decimals: sums of doubles miss the bound that is meant
    bands = _table(spark, sf_dir, "region").select(F.col("r_name").alias("label"), bound("r_regionkey * 2200.0 - 1000").alias("start"), bound("r_regionkey * 2200.0 + 1199.99").alias("end"))
    return intervals.interval_join(_table(spark, sf_dir, "customer").select("c_acctbal", "c_mktsegment"), "c_acctbal", bands).groupBy("label", "c_mktsegment").agg(F.count("*").alias("n"))


# Messages of five shapes, one of which is no JSON, made of the parts' names.
_SHAPES = [
    '{"DOI": "10.1/K", "title": ["N"], "container-title": ["J"], "issued": {"date-parts": [[2001, 5]]}, "volume": "7", "page": "1-9"}',
    '{"DOI": "10.1/K", "title": "N", "container-title": [], "issued": {"date-parts": [2002]}, "volume": 8}',
    '{"DOI": "10.1/K", "title": {"value": "N"}, "issued": "2003-04-01", "issue": ["2"]}',
    '{"DOI": ["10.1/K"], "title": null, "issued": {"date-parts": [[null]]}, "volume": true}',
    '["10.1/K"]',
    "10.1/K N {",
]


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = F.array(*[F.lit(s) for s in _SHAPES])[(F.col("p_partkey") % len(_SHAPES)).cast("int")]
    return _table(spark, sf_dir, "part").select("p_partkey", F.replace(F.replace(shape, F.lit("K"), F.col("p_partkey").cast("string")), F.lit('"N"'), F.concat(F.lit('"'), "p_name", F.lit('"'))).alias("value"))


@query("""SELECT p_partkey, k <= 4 AS readable, CASE WHEN k <= 3 THEN '10.1/' || p_partkey END AS doi, CASE WHEN k <= 1 THEN p_name END AS title, CASE WHEN k = 0 THEN 'J' END AS journal, CASE k WHEN 0 THEN '7' WHEN 1 THEN '8' END AS volume,
  CASE WHEN k = 2 THEN '2' END AS issue, CASE WHEN k = 0 THEN '1-9' END AS pages, CAST(CASE k WHEN 0 THEN 2001 WHEN 1 THEN 2002 WHEN 2 THEN 2003 END AS INTEGER) AS year FROM (SELECT *, p_partkey % 6 AS k FROM part)""")
def doi_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doi_fields(_messages(spark, sf_dir))


_FOUND = {0: [("issue", "missing")], 1: [("issue", "missing"), ("pages", "missing")], 2: [("title", "object"), ("journal", "missing"), ("volume", "missing"), ("pages", "missing")], 3: [("title", "missing"), ("journal", "missing"), ("volume", "other"), ("issue", "missing"), ("pages", "missing")], 4: [("message", "list")], 5: [("message", "unreadable")]}


@query(" UNION ALL ".join(f"SELECT p_partkey, '{field}' AS field, '{kind}' AS kind FROM part WHERE p_partkey % 6 = {k}" for k, found in _FOUND.items() for field, kind in found))
def doi_message_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape_findings(_messages(spark, sf_dir), "p_partkey")


@query(_STUDIES)
def clustered_studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Studies over the record table clustered by study: no exchange behind the scan."""
    count = record_count(spark, sf_dir)
    buckets = max(16, count // 1_000_000)  # a bucket of a larger table would be too much for one task to sort in memory
    table = write_clustered(record_parts(spark, sf_dir, count, most=16), f"records_{uuid.uuid4().hex}", ["study_no"], buckets, _folder(spark, "clustered"))
    return dedup.build_studies(table)


_FLAGGED = {"flag_disease": "study_no LIKE '%4'", "flag_endemic_area": "region = 'ASIA'", "flag_blood_matrix": "blood_matrix = 'Serum'"}
_LEFT_OUT = _SUMS.replace("'without=occupational' END]", "'without=occupational' END, " + ", ".join(f"CASE WHEN NOT coalesce({condition}, false) THEN 'without={name}' END" for name, condition in (("disease", _FLAGGED["flag_disease"]), ("endemic_area", _FLAGGED["flag_endemic_area"]), ("blood_matrix_flagged", _FLAGGED["flag_blood_matrix"]))) + "]")


@query(
    f"""SELECT * FROM (SELECT sample_type, printf('S%02d', row_number() OVER (PARTITION BY sample_type ORDER BY analysis <> 'main', analysis) - 1) AS analysis_id, analysis, n_records, n_studies, pattern,
  pattern = max(pattern) FILTER (analysis = 'main') OVER (PARTITION BY sample_type) AS consistent_with_main FROM ({_LEFT_OUT})) WHERE analysis LIKE 'without=%'"""
)
def sensitivity_leave_outs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every group of records that a flag leaves out, in the run of all analyses."""
    flagged = records(spark, sf_dir).withColumns({name: F.expr(condition) for name, condition in _FLAGGED.items()})
    return sensitivity.sensitivity(statistics.standardize(convert.convert_units(flagged))).where("startswith(analysis, 'without=')").select("sample_type", "analysis_id", "analysis", "n_records", "n_studies", "pattern", "consistent_with_main")


_REGION_STRATA = "SELECT sample_type, region, exp(sum(sample_size * ln(gm_direct)) / sum(sample_size)) AS gm FROM rec WHERE gm_direct > 0 AND sample_size > 0 GROUP BY sample_type, region"


@query(f"""SELECT sample_type AS matrix, 'region' AS dim, region AS stratum, round(CASE WHEN region = 'ASIA' THEN gm * 1.2 ELSE gm END, 3) AS value, round(gm, 6) AS recomputed,
  CASE WHEN region = 'ASIA' THEN 'MISMATCH' ELSE 'OK' END AS status, region = 'ASIA' AND sample_type = 'Urine' AS linked_change FROM ({_REGION_STRATA})""")
def audited_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manuscripts that state regional means in words, those of one region wrong and with words of change."""
    strata = pool.pool(records(spark, sf_dir), ["sample_type", "region"], "gm_direct").select(F.col("sample_type").alias("matrix"), F.lit("region").alias("dim"), F.col("region").alias("stratum"), "gm")
    words = F.when(F.col("matrix") == "Urine", "Urinary").when(F.col("matrix") == "Blood", "Blood").otherwise("Cord blood")
    wrong = F.col("stratum") == "ASIA"
    value = F.round(F.when(wrong, F.col("gm") * 1.2).otherwise(F.col("gm")), 3).cast("decimal(18,3)").cast("string")
    verb = F.when(wrong & (F.col("matrix") == "Urine"), F.lit(" levels declined to ")).otherwise(F.lit(" levels were "))
    docs = strata.select(F.concat_ws("|", "matrix", "stratum").alias("doc_id"), F.concat(words, verb, value, F.lit(" µg / L in the "), F.lower("stratum"), F.lit(" region.")).alias("text"))
    names = {r["r_name"].lower(): r["r_name"] for r in _table(spark, sf_dir, "region").select("r_name").collect()}  # a dimension
    out = audit.audit_numbers(docs, strata, names)
    return rounded(out.select("matrix", "dim", "stratum", "value", "recomputed", "status", "linked_change"), "recomputed")


@query("SELECT p_partkey AS doc_id, p_partkey % 3 <> 1 AS says_records FROM part")
def wording_of_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes on parts, two of three of which speak of participant records."""
    said = F.when(F.col("p_partkey") % 3 == 0, "12 participant records").when(F.col("p_partkey") % 3 == 1, "12 participants, and records of them").otherwise("Participant\n records")
    docs = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"), F.concat("p_name", F.lit(" holds "), said).alias("text"))
    return docs.select("doc_id", dedup.good_wording(F.col("text")).alias("says_records"))


# Each nation as a project: some lack a country, a freeze date or a rule, or have a rule that isn't one.
_SETTINGS = {
    "project.analyte": "'As'", "project.country": "CASE WHEN n_nationkey % 5 <> 0 THEN n_name END", "period_scheme.freeze_date": "CASE WHEN n_nationkey % 4 = 0 THEN ' ' ELSE '2024-01-01' END",
    "standardization.median_to_gm_strategy": "CASE WHEN n_nationkey % 3 = 0 THEN 'mean' ELSE 'as_gm' END", "standardization.wan_variant": "'minus'",
}


@query(
    "SELECT n_nationkey AS project, key, fault FROM (SELECT n_nationkey, 'project.country' AS key, 'missing' AS fault FROM nation WHERE n_nationkey % 5 = 0 UNION ALL SELECT n_nationkey, 'period_scheme.freeze_date', 'missing' FROM nation WHERE n_nationkey % 4 = 0"
    " UNION ALL SELECT n_nationkey, 'standardization.median_to_gm_strategy', 'not allowed' FROM nation WHERE n_nationkey % 3 = 0 UNION ALL SELECT n_nationkey, 'standardization.creatinine_path_mode', 'missing' FROM nation)"
)
def settings_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(key).alias("key"), F.expr(value).alias("value")) for key, value in _SETTINGS.items()])
    settings = _table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("project"), F.explode(entries).alias("e")).select("project", "e.*")
    return derived.settings_findings(settings)


@query("SELECT sample_type, count(*) AS n FROM rec WHERE sample_type <> 'Urine' GROUP BY sample_type")
def matrices_without_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A policy made of the records' matrices that leaves blank the unit of all but urine."""
    rec = records(spark, sf_dir).select("sample_type")
    policy = rec.distinct().withColumn("unit", F.when(F.col("sample_type") == "Urine", "ug/g Cr").otherwise(" "))
    return derived.matrices_without_unit(rec, policy)


@query("SELECT record_id, CAST(count(*) AS INTEGER) AS n FROM (SELECT record_id FROM rec UNION ALL SELECT record_id FROM rec WHERE study_no LIKE '%3') GROUP BY record_id HAVING count(*) > 1")
def repeated_ids_of_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table to which one study in ten was added again."""
    rec = records(spark, sf_dir).select("record_id", "study_no")
    return quality.repeated_ids(rec.unionByName(rec.where("endswith(study_no, '3')"))).withColumn("n", F.col("n").cast("int"))


@query("SELECT study_no, count(*) AS n_records FROM (SELECT split_part(record_id, '-', 1) AS study_no, sample_size FROM rec) GROUP BY study_no HAVING count(*) > 1 AND count(DISTINCT sample_size) = 1")
def same_sample_size_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as studies, of which some report one size throughout."""
    return quality.same_sample_size(records(spark, sf_dir).withColumn("study_no", F.split("record_id", "-")[0]))
