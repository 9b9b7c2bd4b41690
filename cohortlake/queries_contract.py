"""Registered queries of the contract: table rules on a view that breaks each of them, flags, raw records, the audit's items and de-identification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.functions.text import row_hash
from cohortlake.operators import audit, dedup, quality, raw_records, references, statistics
from cohortlake.plans.dims import FLAG_RULES, KNOWN_FLAGS, records
from cohortlake.plans.faults import CONTRACT_SQL, contract_records
from cohortlake.queries import PERIOD_SQL, query, rounded, standard
from cohortlake.queries_review import _CITED_SQL, _LIB_SQL, _library, _manuscripts, _table
from cohortlake.sources.bibliography import fingerprint_table
from cohortlake.sources.contract import present
from cohortlake.tables import written

POLICY = {"Urine": "ug/g Cr", "Blood": "ug/L", "CordBlood": "ug/L"}
_C = f"SELECT * FROM ({CONTRACT_SQL})"


def _where(rule: str, severity: str, field: str, condition: str) -> str:
    return f"SELECT record_id, '{rule}' AS rule, '{severity}' AS severity, '{field}' AS field FROM con WHERE {condition}"


def _not_in(field: str, values: str) -> str:
    return _where("enum", "ERROR", field, f"{field} NOT IN ({', '.join(repr(v) for v in values.split())})")


_FINDINGS = [
    _not_in("sample_type", "Urine Blood CordBlood BreastMilk Nail Hair Serum Plasma Other"), _not_in("population_group", "Adults Minors Pregnant Elderly Mixed Unknown"), _not_in("gender", "Male Female Both Unknown"),
    _not_in("stat_type", "GM_GSD GM_only AM_SD Median_IQR Median_Range Median_only Min_Max P25_P75 Other"), _not_in("adjusted", "No Creatinine SpecificGravity ReferenceConversion NotApplicable"),
    _not_in("blood_matrix", "WholeBlood Serum Plasma Unspecified"), _not_in("analyte_species", "Total iAs iAs+MMA+DMA MeHg Unknown"), _not_in("inclusion_decision", "Include Exclude Pending"),
    _not_in("extracted_by", "AI Human AI+Human"), _not_in("region", "North Northeast East Central South Southwest Northwest UNKNOWN"),
    _where("conditional", "ERROR", "blood_matrix", "sample_type = 'Blood' AND blood_matrix IS NULL"), _where("conditional", "ERROR", "adjusted", "sample_type = 'Urine' AND adjusted IS NULL"), _where("conditional", "ERROR", "exclusion_reason", "inclusion_decision = 'Exclude' AND exclusion_reason IS NULL"),
    *[_where("numeric", "ERROR", f, f"{f} <= 0") for f in ("sample_size", "initial_gm", "gm_summary", "initial_gsd", "gsd_summary")], _where("numeric", "ERROR", "time", "time < 1900 OR time > 2100"),
    _where("unit_policy", "ERROR", "unit_final", "sample_type = 'Urine' AND unit_final = 'mg/L' AND coalesce(adjusted, '') <> 'SpecificGravity' OR sample_type IN ('Blood', 'CordBlood') AND unit_final <> 'ug/L'"), _where("unit_policy", "WARN", "unit_final", "sample_type = 'Urine' AND unit_final = 'mg/L' AND adjusted = 'SpecificGravity'"),
    _where("inferred", "ERROR", "inferred_flags", "conversion_path LIKE '%Wan_%' AND coalesce(inferred_flags, '') = ''"),
    _where("imputed", "ERROR", "time", "inferred_flags = 'value_interpolated_time'"), _where("imputed", "ERROR", "gm_summary", "inferred_flags = 'value_interpolated'"),
    _where("gm_over_mean", "WARN", "initial_gm", "initial_mean > 0 AND initial_gm > 1.5 * initial_mean"), _where("gm_is_mean", "WARN", "initial_gm", "initial_gm = initial_mean"),
    _where("quantiles", "ERROR", "initial_p25", "initial_p25 > initial_median"), _where("quantiles", "ERROR", "initial_p75", "initial_p75 < initial_median"), _where("range", "ERROR", "initial_min", "initial_min > initial_max"),
    _where("gsd_under_one", "WARN", "initial_gsd", "initial_gsd < 1"), _where("gm_under_min", "WARN", "initial_gm", "initial_gm < initial_min"), _where("gm_over_max", "WARN", "initial_gm", "initial_gm > initial_max"),
    _where("time", "ERROR", "time", "time > t_publication"), _where("time", "WARN", "time", "time = t_publication"), _where("interval", "ERROR", "time_start", "time_start > time_end"),
    _where("magnitude", "WARN", "unit_original", "sample_type = 'Urine' AND (coalesce(initial_gm, gm_summary) > 1000 OR coalesce(initial_gm, gm_summary) < 0.1)"), _where("magnitude", "WARN", "gm_summary", "sample_type = 'Blood' AND gm_summary > 50"),
    "SELECT record_id, 'repeated_stratum', 'WARN', 'study_no,sample_type,population,time' FROM (SELECT record_id, row_number() OVER (PARTITION BY study_no, sample_type, population, time ORDER BY record_id) AS rn FROM con) WHERE rn > 1",
    "SELECT record_id, 'unique_id', 'ERROR', 'record_id' FROM con GROUP BY record_id HAVING count(*) > 1",
    "SELECT NULL, 'verified', CASE WHEN avg(CASE WHEN verified = 'Yes' THEN 1.0 ELSE 0.0 END) < 0.9 THEN 'ERROR' ELSE 'WARN' END, 'verified' FROM con",
]


@query(f"SELECT * FROM (WITH con AS MATERIALIZED ({_C}) " + " UNION ALL ".join(_FINDINGS) + ") AS f WHERE EXISTS (SELECT 1 FROM rec)")
def contract_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of the contract; the view breaks each of them."""
    return quality.contract_findings(contract_records(spark, sf_dir), POLICY)


@query(
    "SELECT record_id, field FROM (WITH con AS (" + _C + ") " + " UNION ALL ".join(f"SELECT record_id, '{f}' AS field FROM con WHERE {c}" for f, c in (("sample_size", "sample_size IS NULL"), ("row_hash", "row_hash = ''"), ("flag_occupational", "flag_occupational IS NULL"), ("blood_matrix", "sample_type = 'Blood' AND blood_matrix IS NULL"), ("adjusted", "sample_type = 'Urine' AND adjusted IS NULL"), ("exclusion_reason", "inclusion_decision = 'Exclude' AND exclusion_reason IS NULL"))) + ") AS o WHERE EXISTS (SELECT 1 FROM rec)"
)
def open_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.open_fields(contract_records(spark, sf_dir))


@query(f"SELECT count(*) AS n_records, round(avg(CASE WHEN verified = 'Yes' THEN 1.0 ELSE 0.0 END), 6) AS share_verified, count(*) FILTER (inclusion_decision = 'Pending') AS n_pending, count(*) FILTER (gm_summary IS NOT NULL AND conversion_path = '') AS n_without_path, count(*) FILTER (inferred_flags LIKE 'made_up%' OR inferred_flags = 'value_interpolated_time') AS n_unknown_flags FROM ({_C}) AS con WHERE EXISTS (SELECT 1 FROM rec)")
def gate_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gate_metrics(contract_records(spark, sf_dir), KNOWN_FLAGS)


@query(f"SELECT record_id, CASE WHEN inferred_flags LIKE 'made_up%' THEN 'made_up' ELSE inferred_flags END AS flags FROM ({_C}) AS con WHERE (inferred_flags LIKE 'made_up%' OR inferred_flags = 'value_interpolated_time') AND EXISTS (SELECT 1 FROM rec)")
def unknown_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    con = contract_records(spark, sf_dir).withColumn("flags", F.array_join(statistics.unknown_flags(F.col("inferred_flags")), ";"))
    return con.where("flags <> ''").select("record_id", "flags")


@query(
    f"""SELECT record_id, array_to_string(list_sort(list_filter(d, lambda x: NOT list_contains(s, x))), ';') AS missing, array_to_string(list_sort(list_filter(s, lambda x: NOT list_contains(d, x))), ';') AS surplus
FROM (SELECT record_id, CASE WHEN conversion_path = 'reported_GM' THEN [] ELSE ['gm_from_median', 'gm_from_range'] END AS d, CASE WHEN inferred_flags IS NULL THEN [] ELSE list_transform(string_split(inferred_flags, ';'), lambda x: trim(x)) END AS s FROM ({_C}) AS con WHERE EXISTS (SELECT 1 FROM rec))
WHERE len(list_filter(d, lambda x: NOT list_contains(s, x))) + len(list_filter(s, lambda x: NOT list_contains(d, x))) > 0"""
)
def flag_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.flag_mismatch(contract_records(spark, sf_dir))


_HITS = " UNION ALL ".join(f"SELECT record_id, '{flag}' AS flag, '{piece}' AS rule, {i} AS i FROM std WHERE contains(conversion_path, '{piece}') AND NOT ends_with(conversion_path, 'reported_GM')" for i, (piece, flags) in enumerate(FLAG_RULES) for flag in flags)
_UNIT_HITS = " UNION ALL ".join(f"SELECT record_id, '{flag}', '{piece}', 0 FROM std WHERE contains(conversion_path, '{piece}') AND ends_with(conversion_path, 'reported_GM')" for piece, flag in (("ICRP89", "unit_converted_creatinine"), ("nmol/L", "molar_conversion")))
_NO_HITS = "SELECT record_id, '<none>', conversion_path, -1 FROM std WHERE ends_with(conversion_path, 'reported_GM') AND NOT contains(conversion_path, 'ICRP89') AND NOT contains(conversion_path, 'nmol/L')"


@query(f"SELECT record_id, flag, arg_min(rule, i) AS rule FROM ({_HITS} UNION ALL {_UNIT_HITS} UNION ALL {_NO_HITS}) GROUP BY record_id, flag")
def flag_derivation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By which piece of its conversion path each record has each flag."""
    return statistics.flag_rules(standard(spark, sf_dir))


# Raw records: a document's first line as title; some ids, years, sources and hashes are at fault.
_RAW_SQL = """SELECT CASE WHEN doc_id % 41 = 0 THEN '' WHEN doc_id % 43 = 0 THEN concat('x-', CAST(doc_id % 3 AS STRING)) ELSE concat('d-', CAST(doc_id AS STRING)) END AS record_id,
  CASE WHEN doc_id % 47 = 0 THEN 'Dial' ELSE 'PubMed' END AS source_database, CASE WHEN doc_id % 37 = 0 THEN ' ' ELSE concat('t', CAST(doc_id AS STRING)) END AS title, 'abs' AS abstract,
  CASE WHEN doc_id % 31 = 0 THEN '20x1' WHEN doc_id % 29 = 0 THEN '' ELSE '2001' END AS year, CASE WHEN doc_id % 23 = 0 THEN '' WHEN doc_id % 19 = 0 THEN 'beef' END AS given, doc_id FROM documents"""


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = spark.sql(_RAW_SQL.replace("FROM documents", "FROM {documents}"), documents=_table(spark, sf_dir, "documents"))
    return raw.withColumn("raw_row_hash", F.coalesce("given", row_hash(F.col("title"), F.col("abstract")))).drop("given")


@query(
    "WITH raw AS (" + _RAW_SQL + ") SELECT record_id, rule FROM (" + " UNION ALL ".join(f"SELECT record_id, '{rule}' AS rule FROM raw WHERE {c}" for rule, c in (("id_blank", "record_id = ''"), ("title_blank", "trim(title) = ''"), ("year_format", "year = '20x1'"), ("source_unknown", "source_database = 'Dial'"), ("hash_blank", "given = ''"), ("hash_differs", "given = 'beef'"))) + " UNION ALL SELECT record_id, 'id_repeated' FROM (SELECT record_id, row_number() OVER (PARTITION BY record_id ORDER BY doc_id) AS rn FROM raw WHERE record_id <> '') WHERE rn > 1)"
)
def raw_record_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_records.raw_findings(_raw(spark, sf_dir))


@query("SELECT source AS source_database, CASE WHEN log THEN 'arsenic AND urine' END AS search_string, CASE WHEN log THEN '2024-01-02' END AS search_date, CASE WHEN log THEN n + n_labels END AS hit_count, n AS exported_count, CASE WHEN log THEN n_labels END AS not_exported, CASE WHEN log THEN '' ELSE 'search string and hit count are to be filled in' END AS note FROM (SELECT source, count(*) AS n, count(l.doc_id) AS n_labels, source <> (SELECT min(source) FROM documents) AS log FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id GROUP BY source)")
def search_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source against a log whose hits exceed them by their labels and which lacks the first source."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("source_database"))
    labelled = docs.join(_table(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("has", F.lit(1)), "doc_id", "left")
    first = docs.agg(F.min("source_database").alias("first"))
    log = labelled.groupBy("source_database").agg((F.count("*") + F.count("has")).cast("string").alias("hit_count")).join(F.broadcast(first), F.col("source_database") != F.col("first"))
    return raw_records.reconcile(docs, log.select("source_database", F.lit("arsenic AND urine").alias("search_string"), F.lit("2024-01-02").alias("search_date"), "hit_count"))


@query("SELECT lang AS name, CASE WHEN trim(lower(lang)) IN ('pm', 'cnki') THEN lang END AS x, count(*) AS n FROM (SELECT CASE CAST(doc_id % 4 AS INT) WHEN 0 THEN ' PM ' WHEN 1 THEN 'Web of Science' WHEN 2 THEN 'cnki' ELSE concat('dial-', lang) END AS lang FROM documents) GROUP BY ALL".replace("lang AS name, CASE WHEN trim(lower(lang)) IN ('pm', 'cnki') THEN lang END AS x", "CASE lang WHEN ' PM ' THEN 'PubMed' WHEN 'Web of Science' THEN 'WebOfScience' WHEN 'cnki' THEN 'CNKI' END AS source_database"))
def canonical_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 4
    name = F.when(k == 0, " PM ").when(k == 1, "Web of Science").when(k == 2, "cnki").otherwise(F.concat(F.lit("dial-"), "lang"))
    named = _table(spark, sf_dir, "documents").select(raw_records.normalize_source(name).alias("source_database"))
    return named.groupBy("source_database").agg(F.count("*").alias("n"))


@query("SELECT identified, identified - screened AS duplicates, screened, excluded, pending, included, screened = excluded + pending + included AS balanced FROM (SELECT CAST(sum(k) AS BIGINT) AS identified, count(*) AS screened, count(*) FILTER (r = 0) AS included, count(*) FILTER (r = 1) AS excluded, count(*) FILTER (r = 2) AS pending FROM (SELECT t, count(*) AS k, min(r) AS r FROM (SELECT lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS t, CASE WHEN quality = 1 AND toxic = 0 THEN 0 WHEN quality IS NULL THEN 2 ELSE 1 END AS r FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id) GROUP BY t))")
def screening_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records, decided by their labels: from identified to included, with its balance."""
    labels = _table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    decision = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "Include").when(F.col("quality").isNotNull(), "Exclude")
    return raw_records.selection_flow(_table(spark, sf_dir, "documents").join(labels, "doc_id", "left").withColumn("decision", decision), "text", "decision")


@query("SELECT c_custkey, x FROM (SELECT c_custkey, CASE CAST(c_custkey % 5 AS INT) WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE trim(c_name) END AS x FROM customer)")
def missing_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' names, some of which are tokens for missing values."""
    k = F.col("c_custkey") % 5
    return _table(spark, sf_dir, "customer").select("c_custkey", present(F.when(k == 0, " N/A ").when(k == 1, "—").when(k == 2, "未报告").otherwise(F.concat(F.lit(" "), "c_name"))).alias("x"))


@query("SELECT c_custkey, 'note' AS field, CASE CAST(c_custkey % 6 AS INT) WHEN 0 THEN 'doi' WHEN 1 THEN 'pmid' WHEN 2 THEN 'volume' ELSE 'author_year' END AS kind FROM customer WHERE c_custkey % 6 < 4")
def identifying_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with notes, four of six of which identify a publication; a placeholder and a plain note don't."""
    k, tail = F.col("c_custkey") % 6, F.col("c_custkey").cast("string")
    note = F.when(k == 0, F.concat(F.lit("see 10.1234/x."), tail)).when(k == 1, F.concat(F.lit("PMID: "), tail)).when(k == 2, F.concat(F.lit("2001; 12: "), tail)).when(k == 3, F.concat("c_name", F.lit(" et al. (1999"))).when(k == 4, F.concat(F.lit("10.1234/EXAMPLE-"), tail)).otherwise(F.concat(F.lit("note "), tail))
    return quality.forbidden_cells(_table(spark, sf_dir, "customer").select("c_custkey", note.alias("note"), "c_mktsegment"), "c_custkey")


@query(
    f"""WITH by_region AS (SELECT sample_type, region, exp(sum(sample_size * ln(gm_direct)) / sum(sample_size)) AS gm FROM rec WHERE gm_direct > 0 AND sample_size > 0 AND {PERIOD_SQL} IS NOT NULL GROUP BY sample_type, region),
edi AS (SELECT population_group, exp(sum(sample_size * ln(gm_direct)) / sum(sample_size)) AS gm FROM rec WHERE sample_type = 'Urine' AND population_group = 'Adults' AND gm_direct > 0 AND sample_size > 0 GROUP BY population_group),
items AS (SELECT region AS doc, 'region_GM' AS type, sample_type AS matrix, 'region' AS dim, region AS stratum, round(gm, 2) * CASE WHEN sample_type = 'Blood' THEN 1.1 ELSE 1 END AS v, gm AS recomputed, 0.005 AS tol FROM by_region
  UNION ALL SELECT region, 'edi', 'Urine', 'edi', 'Adults', round(b.gm, 2), e.gm * 1.35 / (60.0 * 0.7), 0.01 FROM by_region b, edi e WHERE b.sample_type = 'Urine'
  UNION ALL SELECT region, 'count', 'records', 'count', 'all', 7.0, CAST((SELECT count(*) FROM rec) AS DOUBLE), 0.0 FROM by_region b WHERE b.sample_type = 'Urine')
SELECT doc AS doc_id, type, matrix, dim, stratum, round(v, 3) AS value, round(recomputed, 6) AS recomputed, CASE WHEN doc = 'ASIA' THEN 'STALE' WHEN abs(round(v, 3) - recomputed) / recomputed <= tol THEN 'OK' ELSE 'MISMATCH' END AS status FROM items"""
)
def audited_placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manuscripts that state means by placeholder, an intake that is a concentration, and a wrong count; Asia's manuscript is of an older snapshot."""
    rec = records(spark, sf_dir)
    strata = written(audit.strata_of(rec, "gm_direct"), "strata")
    means = strata.where("dim = 'region'")
    text = lambda c: F.round(c, 3).cast("decimal(18,3)").cast("string")
    stated = F.round("recomputed", 2) * F.when(F.col("matrix") == "Blood", 1.1).otherwise(1.0)
    parts = means.select("stratum", F.concat(F.lit("The mean {{region_GM:"), "matrix", F.lit(":"), "stratum", F.lit("}} was "), text(stated), F.lit(" ug/L.\n")).alias("a"), F.when(F.col("matrix") == "Urine", F.concat(F.lit("Intake {{ edi : Urine : Adults }} was "), text(F.round("recomputed", 2)), F.lit(".\nWe pooled {{count:records:all}} = 7 records."))).alias("b"))
    docs = parts.groupBy(F.col("stratum").alias("doc_id")).agg(F.concat(F.array_join(F.sort_array(F.collect_list("a")), ""), F.max("b")).alias("text"))
    docs = docs.withColumn("snapshot_tag", F.when(F.col("doc_id") == "ASIA", "old").otherwise("now"))
    out = audit.audit_items(docs, strata, {}, "now")
    return rounded(out.select("doc_id", "type", "matrix", "dim", "stratum", F.round("value", 3).alias("value"), "recomputed", "status"), "recomputed")


@query(f"WITH lib AS ({_LIB_SQL}), cited AS ({_CITED_SQL}), n AS (SELECT key, count(*) AS n, min(record_id) AS record_id FROM lib GROUP BY key) SELECT doc_id, cited.key, record_id, row_number() OVER (PARTITION BY doc_id ORDER BY cited.key, record_id) AS place FROM cited JOIN n ON cited.key = n.key WHERE n = 1")
def inserted_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortlake.functions.text import citations

    library = _library(spark, sf_dir)
    return references.insert_table(references.crosswalk(citations(_manuscripts(spark, sf_dir)), library), library)


@query("SELECT c_custkey AS doc_id, printf('%d participants', c_custkey) AS hit FROM customer WHERE c_custkey % 2 = 0")
def wording_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    docs = _table(spark, sf_dir, "customer").select(k.alias("doc_id"), F.when(k % 2 == 0, F.concat(F.lit("In all "), k.cast("string"), F.lit(" participants took part."))).otherwise(F.lit("Sums are record-level.")).alias("text"))
    return dedup.wording_hits(docs).select("doc_id", "hit")


@query()
def table_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest and counts of two whole tables, whatever the order of their rows."""
    one = fingerprint_table(_table(spark, sf_dir, "documents"), "doc_id", "source").withColumn("table", F.lit("documents"))
    return one.unionByName(fingerprint_table(records(spark, sf_dir), "record_id", "study_no").withColumn("table", F.lit("records")))
