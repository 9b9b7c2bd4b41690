"""Registered queries of review work: quality, double cohorts, sensitivity, manuscripts, references, raw records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.functions.text import CHANGE_WORDS, citations, norm_text, normalize_doi, row_hash, search_match, tells_change, valid_doi
from cohortlake.operators import audit, dedup, pool, quality, raw_records, references
from cohortlake.operators import sensitivity as analyses
from cohortlake.plans.dims import records
from cohortlake.queries import PERIOD_SQL, query, rounded, standard


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_RULES = [
    ("required", "ERROR", "sample_size", "sample_size IS NULL"),
    ("numeric", "ERROR", "sample_size", "sample_size <= 0"),
    ("suspicious", "ERROR", "time_after_publication", "sampling_year > t_publication"),
    ("suspicious", "WARN", "time_is_publication", "sampling_year = t_publication"),
    ("suspicious", "ERROR", "p25_over_median", "initial_p25 > initial_median"),
    ("suspicious", "ERROR", "p75_under_median", "initial_p75 < initial_median"),
    ("suspicious", "ERROR", "min_over_max", "initial_min > initial_max"),
    ("suspicious", "ERROR", "gsd_under_one", "initial_gsd < 1"),
    ("suspicious", "WARN", "gm_over_mean", "initial_gm > 1.5 * initial_mean"),
    ("suspicious", "ERROR", "gm_outside_range", "gm_direct < initial_min OR gm_direct > initial_max"),
    ("suspicious", "WARN", "urine_magnitude", "sample_type = 'Urine' AND (gm_direct > 1000 OR gm_direct < 0.1)"),
]


@query(" UNION ALL ".join(f"SELECT record_id, '{r}' AS rule, '{s}' AS severity, '{f}' AS field FROM rec WHERE {c}" for r, s, f, c in _RULES))
def validate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_findings(records(spark, sf_dir))


@query("SELECT record_id, count(*) AS n FROM rec GROUP BY record_id HAVING count(*) > 1")
def repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_ids(records(spark, sf_dir))


@query("SELECT record_id, first_id FROM (SELECT record_id, row_number() OVER w AS n, first_value(record_id) OVER w AS first_id FROM rec WINDOW w AS (PARTITION BY study_no, sample_type, population_group, sampling_year ORDER BY record_id)) WHERE n > 1")
def repeated_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_strata(records(spark, sf_dir))


@query("SELECT study_no, count(*) AS n_records FROM rec GROUP BY study_no HAVING count(*) > 1 AND count(DISTINCT sample_size) = 1")
def same_sample_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.same_sample_size(records(spark, sf_dir))


@query("SELECT count(*) AS n_records, count(*) FILTER (status = 'FAILED') AS n_failed, count(*) FILTER (gm_summary IS NOT NULL AND conversion_path = '') AS n_without_path, round(avg(CASE WHEN contains(conversion_path, 'Wan_S') THEN 1.0 ELSE 0.0 END), 6) AS share_estimated FROM std")
def release_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.readiness(standard(spark, sf_dir))


_FIELDS = ["sample_size", "initial_gm", "initial_mean", "initial_median", "blood_matrix"]


@query(" UNION ALL ".join(f"SELECT '{f}' AS field, count(*) FILTER ({f} IS NULL) AS n_missing, round(avg(CAST({f} IS NULL AS DOUBLE)), 6) AS share FROM rec" for f in _FIELDS))
def missing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_fields(records(spark, sf_dir), _FIELDS)


_OLD = "sample_size IS NOT NULL AND sampling_year < 2001"


@query(
    f"""SELECT record_id, change FROM (SELECT coalesce(o.record_id, n.record_id) AS record_id, CASE WHEN o.record_id IS NULL THEN 'added' WHEN n.record_id IS NULL THEN 'removed' WHEN o.sample_size <> n.sample_size THEN 'changed' END AS change
FROM (SELECT record_id, CASE WHEN ends_with(study_no, '7') THEN sample_size + 1 ELSE sample_size END AS sample_size FROM rec WHERE {_OLD}) o FULL JOIN (SELECT record_id, sample_size FROM rec WHERE sample_size IS NOT NULL AND sampling_year > 1995) n ON o.record_id = n.record_id) WHERE change IS NOT NULL"""
)
def table_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older state of the table, made of its earlier years with some sizes corrected since, against a newer one."""
    rec = records(spark, sf_dir)
    old = rec.where(_OLD).withColumn("sample_size", F.when(F.col("study_no").endswith("7"), F.col("sample_size") + 1).otherwise(F.col("sample_size")))
    return quality.drift(old, rec.where("sample_size IS NOT NULL AND sampling_year > 1995"), ["record_id", "sample_size", "sampling_year", "sample_type"])


_STUDIES = """SELECT study_no, arg_min(split_part(author, ';', 1), record_id) AS a, arg_min(city, record_id) AS city0, arg_min(sample_type, record_id) AS sample_type, lower(regexp_extract(arg_min(title, record_id), '(?i)birth\\s+cohort', 0)) AS cohort, sum(sample_size) AS total_n, count(*) AS n_records FROM rec GROUP BY study_no"""
_STUDIES = f"SELECT study_no, regexp_extract(a, '[A-Za-z-]+', 0) AS first_author, CASE WHEN length(city0) > 12 THEN '' ELSE city0 END AS city, sample_type, cohort, total_n, n_records FROM ({_STUDIES})"


@query(_STUDIES)
def studies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.build_studies(records(spark, sf_dir))


@query(
    f"""SELECT kind, name, count(*) AS n_studies, CAST(sum(n_records) AS BIGINT) AS n_records FROM (
SELECT 'city' AS kind, city || '|' || sample_type AS name, 4 AS least, n_records FROM ({_STUDIES}) WHERE city <> '' UNION ALL SELECT 'author', first_author || '|' || sample_type, 3, n_records FROM ({_STUDIES}) WHERE first_author <> '' UNION ALL SELECT 'cohort', cohort || '|' || city, 2, n_records FROM ({_STUDIES}) WHERE cohort <> '')
GROUP BY kind, name, least HAVING count(*) >= least"""
)
def cohort_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.clusters(dedup.build_studies(records(spark, sf_dir)))


@query(f"SELECT record_id FROM (SELECT record_id, {PERIOD_SQL} AS p, row_number() OVER (PARTITION BY city, sample_type, {PERIOD_SQL} ORDER BY sample_size DESC NULLS LAST, record_id) AS rn FROM rec) WHERE rn = 1 OR p IS NULL")
def keep_largest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.keep_largest(records(spark, sf_dir)).select("record_id")


@query(
    f"""SELECT s.strategy, CAST(rb AS BIGINT) AS records_before, CAST(nb AS BIGINT) AS n_before, CAST(CASE s.strategy WHEN 'keep_all' THEN rb WHEN 'keep_largest' THEN r1 ELSE rb - fewer END AS BIGINT) AS records_after, CAST(CASE s.strategy WHEN 'keep_largest' THEN n1 ELSE nb END AS BIGINT) AS n_after
FROM (SELECT sum(k) AS rb, sum(n) AS nb, sum(CASE WHEN p IS NULL THEN k ELSE 1 END) AS r1, sum(CASE WHEN p IS NULL THEN n ELSE top END) AS n1 FROM (SELECT city, sample_type, {PERIOD_SQL} AS p, count(*) AS k, sum(sample_size) AS n, max(sample_size) AS top FROM rec GROUP BY ALL)),
(SELECT coalesce(sum(k - 1), 0) AS fewer FROM (SELECT sum(n_records) AS k FROM ({_STUDIES}) WHERE city <> '' GROUP BY city, sample_type HAVING count(*) >= 4)),
(SELECT unnest(['keep_all', 'keep_largest', 'merge_within_cohort']) AS strategy) s"""
)
def dedup_strategies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.strategy_impact(records(spark, sf_dir))


_TREND = "CASE WHEN {a} IS NULL OR {b} IS NULL THEN '?' WHEN ({b} - {a}) / {a} < -0.05 THEN '↓' WHEN ({b} - {a}) / {a} > 0.05 THEN '↑' ELSE '→' END"


_SUMS = f"""SELECT *, {_TREND.format(a='g0', b='g1')} || {_TREND.format(a='g1', b='g2')} AS pattern FROM (SELECT sample_type, analysis, count(w) AS n_records, count(DISTINCT study_no) FILTER (w IS NOT NULL) AS n_studies,
  exp(sum(w * l) FILTER (p = '1995-1996') / sum(w) FILTER (p = '1995-1996')) AS g0, exp(sum(w * l) FILTER (p = '1997-1998') / sum(w) FILTER (p = '1997-1998')) AS g1, exp(sum(w * l) FILTER (p = '1999-2000') / sum(w) FILTER (p = '1999-2000')) AS g2,
  {', '.join(f"count(w) FILTER (p = '{p}') AS n{i}, count(DISTINCT study_no) FILTER (w IS NOT NULL AND p = '{p}') AS s{i}" for i, p in enumerate(('1995-1996', '1997-1998', '1999-2000')))}
FROM (SELECT *, CASE WHEN gm_summary > 0 AND sample_size > 0 AND p IS NOT NULL THEN CAST(sample_size AS DOUBLE) END AS w, CASE WHEN gm_summary > 0 THEN ln(gm_summary) END AS l, unnest(list_filter(['main', CASE WHEN sample_type = 'Urine' THEN 'adjusted=' || adjusted END, 'gm_source=' || src, CASE WHEN sample_type <> 'Urine' THEN 'blood_matrix=' || blood_matrix END, 'species=' || analyte_species, CASE WHEN population_group <> 'Mixed' THEN 'population=' || population_group END,
  CASE WHEN src = 'reported_GM' THEN 'subset=direct' END, CASE WHEN NOT list_contains(flag_list, 'no_n_fallback') THEN 'subset=with_sample_size' END, CASE WHEN sample_size >= 30 THEN 'subset=large' END, 'subset=not_split', CASE WHEN NOT flag_occupational THEN 'without=occupational' END], lambda x: x IS NOT NULL)) AS analysis
FROM (SELECT *, {PERIOD_SQL} AS p, CASE WHEN contains(conversion_path, 'reported_GM') THEN 'reported_GM' WHEN contains(conversion_path, 'Wan_S') THEN 'Wan_estimated' WHEN contains(conversion_path, 'Median_as_GM') THEN 'Median_as_GM' WHEN contains(conversion_path, 'AMSD_to_LN') THEN 'AMSD_to_LN' END AS src FROM std)) GROUP BY sample_type, analysis)"""


@query(
    f"""SELECT b.sample_type, printf('S%02d', row_number() OVER (PARTITION BY b.sample_type ORDER BY analysis <> 'main', analysis) - 1) AS analysis_id, analysis, n_records, n_studies, round(n_records / t.total, 6) AS ratio_of_total, pattern, pattern = max(pattern) FILTER (analysis = 'main') OVER (PARTITION BY b.sample_type) AS consistent_with_main, n_records / t.total < 0.2 AS reduced
FROM ({_SUMS}) b JOIN (SELECT sample_type, count(*) AS total FROM rec GROUP BY sample_type) t ON b.sample_type = t.sample_type"""
)
def sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.sensitivity(standard(spark, sf_dir))


@query("SELECT sample_type, analysis, period, round(gm, 6) AS gm, n_records, n_studies FROM (" + " UNION ALL ".join(f"SELECT sample_type, analysis, '{p}' AS period, g{i} AS gm, n{i} AS n_records, s{i} AS n_studies FROM ({_SUMS})" for i, p in enumerate(("1995-1996", "1997-1998", "1999-2000"))) + ")")
def sensitivity_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analyses.sensitivity_by_period(standard(spark, sf_dir)), "gm")


@query(f"""SELECT sample_type, analysis, pattern[1:1] AS "1995-1996 to 1997-1998", pattern[2:2] AS "1997-1998 to 1999-2000" FROM ({_SUMS})""")
def pattern_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyses.pattern_matrix(standard(spark, sf_dir))


@query(
    f"""SELECT sample_type, analysis, round(off, 6) AS max_level_diff, CASE WHEN pattern <> main THEN 'direction_changed' WHEN off > 0.2 THEN 'level_differs' ELSE 'robust' END AS grade
FROM (SELECT b.*, m.pattern AS main, greatest(abs(b.g0 - m.g0) / m.g0, abs(b.g1 - m.g1) / m.g1, abs(b.g2 - m.g2) / m.g2) AS off FROM ({_SUMS}) b JOIN (SELECT * FROM ({_SUMS}) WHERE analysis = 'main') m ON b.sample_type = m.sample_type WHERE b.analysis <> 'main')"""
)
def robustness_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analyses.robustness(standard(spark, sf_dir)), "max_level_diff")


# Raw records: a document's first line is its title, the whole text its abstract.
@query("SELECT doc_id, sha256(lower(trim(regexp_replace(split_part(text, chr(10), 1), '\\s+', ' ', 'g'))) || chr(10) || lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))) AS raw_row_hash FROM documents")
def raw_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", row_hash(F.split("text", "\n")[0], F.col("text")).alias("raw_row_hash"))


@query("SELECT h AS raw_row_hash, count(*) AS n, count(DISTINCT source) AS n_sources, CASE WHEN count(DISTINCT source) > 1 THEN 'cross_source' ELSE 'within_source' END AS kind FROM (SELECT source, sha256(lower(trim(regexp_replace(split_part(text, chr(10), 1), '\\s+', ' ', 'g'))) || chr(10) || lower(trim(regexp_replace(text, '\\s+', ' ', 'g')))) AS h FROM documents) GROUP BY h HAVING count(*) > 1")
def suspect_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortlake.sources.bibliography import suspect_duplicates as suspects

    docs = _table(spark, sf_dir, "documents")
    return suspects(docs.select(F.col("source").alias("source_database"), row_hash(F.split("text", "\n")[0], F.col("text")).alias("raw_row_hash")))


@query("SELECT source, count(*) AS exported_count, count(*) FILTER (text IS NULL OR trim(text) = '') AS n_blank FROM documents GROUP BY source")
def source_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_records.source_summary(_table(spark, sf_dir, "documents"), "source", "text")


@query("SELECT record_id FROM rec WHERE regexp_matches(title, '(?i)widget|bolt') AND regexp_matches(sample_type, '(?i)urine|blood') AND NOT regexp_matches(title, '(?i)birth cohort') AND sampling_year BETWEEN 1996 AND 1999")
def search_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = records(spark, sf_dir).where("sampling_year BETWEEN 1996 AND 1999")
    found = search_match(rec, [["widget", "bolt"]], ["birth cohort"], F.col("title"))
    return search_match(found, [["urine", "blood"]], [], F.col("sample_type")).select("record_id")


@query("SELECT count(*) AS n_all, count(*) FILTER (NOT regexp_matches(title, '(?i)birth cohort')) AS without_cohort, count(*) FILTER (NOT coalesce(flag_occupational, false)) AS without_occupational FROM rec WHERE regexp_matches(title, '(?i)widget|bolt')")
def exclusion_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search_match(records(spark, sf_dir), [["widget", "bolt"]], [], F.col("title"))
    return found.agg(F.count("*").alias("n_all"), F.count_if(~F.col("title").rlike("(?i)birth cohort")).alias("without_cohort"), F.count_if(~F.coalesce("flag_occupational", F.lit(False))).alias("without_occupational"))


@query("SELECT count(*) AS identified, count(DISTINCT t) AS after_duplicates, count(*) FILTER (quality = 1 AND toxic = 0) AS included FROM (SELECT d.doc_id, quality, toxic, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS t FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id)")
def selection_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    docs = _table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    return docs.agg(F.count("*").alias("identified"), F.countDistinct(F.xxhash64(F.lower(norm_text(F.col("text"))))).alias("after_duplicates"), F.count_if((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("included"))


@query("SELECT page_id, doi, regexp_matches(doi, '^10\\.\\d{4,9}/[-._;()/:a-zA-Z0-9]+$') AS valid FROM (SELECT page_id, trim(regexp_replace(regexp_replace('https://doi.org/10.5555' || regexp_replace(url, '^https?://[^/]*', ''), '(?i)^https?://(dx\\.)?doi\\.org/', ''), '\\.+$', '')) AS doi FROM pages)")
def normalized_dois(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit("https://doi.org/10.5555"), F.regexp_replace("url", "^https?://[^/]*", ""))
    out = _table(spark, sf_dir, "pages").select("page_id", normalize_doi(raw).alias("doi"))
    return out.withColumn("valid", valid_doi(F.col("doi")))


def _library(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _table(spark, sf_dir, "supplier")
    letter = F.chr(65 + F.col("s_nationkey").cast("int"))
    return s.select(F.format_string("L%06d", "s_suppkey").alias("record_id"), F.concat(letter, F.lit("uthor; Other")).alias("authors"), (1990 + F.col("s_suppkey") % 20).alias("year"), F.col("s_name").alias("title"), F.lit("Environ Int").alias("journal"), F.concat(F.lit("doi:10.1234/x."), "s_suppkey").alias("doi"))


def _manuscripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer")
    letter = F.chr(65 + (F.col("c_custkey") % 26).cast("int"))
    year = (1985 + F.col("c_custkey") % 30).cast("string")
    return c.select(F.col("c_custkey").alias("doc_id"), F.concat(F.lit("Levels rose (see "), letter, F.lit("uthor et al., "), year, F.lit("; Nobody, 1999).")).alias("text"))


_LIB_SQL = "SELECT printf('L%06d', s_suppkey) AS record_id, lower(chr(65 + CAST(s_nationkey AS INT))) || 'uthor|' || (1990 + s_suppkey % 20) AS key FROM supplier"
_CITED_SQL = "SELECT DISTINCT c_custkey AS doc_id, unnest([lower(chr(65 + CAST(c_custkey % 26 AS INT))) || 'uthor|' || (1985 + c_custkey % 30), 'nobody|1999']) AS key FROM customer"


@query(
    f"""WITH lib AS ({_LIB_SQL}), cited AS ({_CITED_SQL}), n AS (SELECT key, count(*) AS n FROM lib GROUP BY key)
SELECT doc_id, cited.key, CASE WHEN n IS NULL THEN 'MISSING' WHEN n = 1 THEN 'MATCHED' ELSE 'AMBIGUOUS' END AS status, coalesce(n, 0) AS n_matches FROM cited LEFT JOIN n ON cited.key = n.key"""
)
def citation_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.crosswalk(citations(_manuscripts(spark, sf_dir)), _library(spark, sf_dir))


@query(f"WITH lib AS ({_LIB_SQL}), cited AS ({_CITED_SQL}) SELECT record_id, key, CASE WHEN count(*) OVER (PARTITION BY key) > 1 AND row_number() OVER (PARTITION BY key ORDER BY record_id) <= 26 THEN chr(CAST(96 + row_number() OVER (PARTITION BY key ORDER BY record_id) AS INT)) ELSE '' END AS suffix FROM lib WHERE key NOT IN (SELECT key FROM cited)")
def unused_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return references.unused(citations(_manuscripts(spark, sf_dir)), _library(spark, sf_dir)).select("record_id", "key", "suffix")


@query(
    """SELECT printf('L%06d', s_suppkey) AS key, CASE WHEN s_suppkey % 7 = 0 THEN 'DOI_INVALID' WHEN s_suppkey % 5 = 0 OR s_suppkey % 3 = 0 THEN 'MISMATCH' ELSE 'VERIFIED' END AS status,
  CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE concat_ws(';', CASE WHEN s_suppkey % 5 = 0 THEN 'title' END, CASE WHEN s_suppkey % 3 = 0 THEN 'year' END) END AS fields FROM supplier"""
)
def verified_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The library against metadata that lacks every seventh reference and differs in some titles and years."""
    lib = _library(spark, sf_dir).withColumn("n", F.substring("record_id", 2, 6).cast("int"))
    metadata = lib.where("n % 7 <> 0").select(F.concat(F.lit("https://doi.org/10.1234/x."), "n").alias("doi"), F.when(F.col("n") % 5 == 0, F.concat(F.lit("Another "), "title")).otherwise(F.upper("title")).alias("title"), F.lit("Environment International").alias("journal"), F.when(F.col("n") % 3 == 0, F.col("year") + 1).otherwise(F.col("year")).alias("year"))
    return references.verify_references(lib.withColumnRenamed("record_id", "key"), metadata)


_STRATA = "SELECT sample_type, region, period, exp(sum(sample_size * ln(gm_direct)) / sum(sample_size)) AS gm FROM (SELECT *, {p} AS period FROM rec) WHERE gm_direct > 0 AND sample_size > 0 AND period IS NOT NULL GROUP BY sample_type, region, period".format(p=PERIOD_SQL)


@query(
    f"""SELECT sample_type AS matrix, 'period' AS dim, period AS stratum, region, round(round(r.gm, 3) * 1.0, 3) AS value, round(a.gm, 6) AS recomputed, CASE WHEN abs(round(r.gm, 3) - a.gm) / a.gm <= 0.005 THEN 'OK' ELSE 'MISMATCH' END AS status
FROM ({_STRATA}) r JOIN (SELECT sample_type, period, exp(sum(sample_size * ln(gm_direct)) / sum(sample_size)) AS gm FROM (SELECT *, {PERIOD_SQL} AS period FROM rec) WHERE gm_direct > 0 AND sample_size > 0 AND period IS NOT NULL GROUP BY sample_type, period) a USING (sample_type, period)"""
)
def audited_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manuscripts that state regional means as those of a whole period, against the period's means."""
    rec = records(spark, sf_dir)
    regional = pool.pool(rec, ["sample_type", "region", "period"], "gm_direct")
    words = F.when(F.col("sample_type") == "Urine", "urine").when(F.col("sample_type") == "Blood", "blood").otherwise("cord blood")
    docs = regional.select(F.concat_ws("|", "region", "sample_type", "period").alias("doc_id"), F.concat(F.lit("The "), words, F.lit(" mean was "), F.round("gm", 3).cast("decimal(18,3)").cast("string"), F.lit(" ug/L in "), "period", F.lit(".")).alias("text"))
    periods = pool.pool(rec, ["sample_type", "period"], "gm_direct")
    strata = periods.select(F.col("sample_type").alias("matrix"), F.lit("period").alias("dim"), F.col("period").alias("stratum"), "gm")
    out = audit.audit_numbers(docs, strata, {})
    return rounded(out.select("matrix", "dim", "stratum", F.split("doc_id", "\\|")[0].alias("region"), "value", "recomputed", "status"), "recomputed")


@query(f"SELECT doc_id, count(*) AS n_sentences, count(*) FILTER (regexp_matches(lower(s), '{'|'.join(CHANGE_WORDS)}')) AS n_change FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS s FROM documents) WHERE trim(s) <> '' GROUP BY doc_id")
def change_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("s")).where("trim(s) <> ''")
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_sentences"), F.count_if(tells_change(F.col("s"))).alias("n_change"))
