"""Registered queries over the given tables, each with the SQL that must give the same rows where SQL can."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.functions.stats import norm_ppf_sql, with_quantile, with_widths
from cohortlake.operators import convert, intake, pool, statistics
from cohortlake.plans.dims import FLAG_RULES, INTAKE, MASS_FACTORS, MOLAR_MASS, PERIODS, RECORD_SQL, URINE_REFERENCE, records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL; ``rec`` and ``std`` may be used in the SQL."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            std = re.search(r"\b(std|widths)\b", sql)
            parts = [f"rec AS ({RECORD_SQL})"] if std or re.search(r"\brec\b", sql) else []
            if std:
                parts += [f"widths AS MATERIALIZED ({WIDTHS_SQL})", f"std AS ({STANDARD_SQL})"]
            text = sql.strip()
            more = text.startswith("WITH ")
            ORACLES[f.__name__] = f"WITH {', '.join(parts)}{',' if more else ''} {text.removeprefix('WITH ')}" if parts else text
        return f

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _case(key: str, values: dict, otherwise: str = "NULL") -> str:
    show = lambda v: repr(v) if isinstance(v, (int, float)) else f"'{v}'"
    return f"CASE {key} " + " ".join(f"WHEN '{k}' THEN {show(v)}" for k, v in values.items()) + f" ELSE {otherwise} END"


PERIOD_SQL = "CASE " + " ".join(f"WHEN sampling_year BETWEEN {a} AND {b} THEN '{p}'" for p, a, b in PERIODS) + " END"

WIDTHS_SQL = f"""SELECT sample_size, abs(2 * {norm_ppf_sql('p')}) AS xi, 2 * {norm_ppf_sql('q')} AS qw
FROM (SELECT DISTINCT sample_size, (sample_size - 0.375) / (sample_size + 0.25) AS p, (0.75 * sample_size - 0.125) / (sample_size + 0.25) AS q FROM rec WHERE sample_size > 0)"""

# Units and statistics, written for the record view: its urine units, its matrices and its statistic types.
_GROUP = "CASE WHEN population_group = 'Pregnant' THEN 'Pregnant' WHEN population_group = 'Minors' THEN 'Minors' WHEN population_group IN ('Adults','Elderly') THEN CASE gender WHEN 'Male' THEN 'Adult_Male' WHEN 'Female' THEN 'Adult_Female' ELSE 'Adults' END ELSE 'Adults' END"
_COARSE = "population_group IN ('Minors','Mixed')"


def _standard_sql(quartiles: str, ranged: str, min_max_median: str) -> str:
    flags = " ".join(f"|| CASE WHEN contains(p, '{piece}') THEN '{''.join(f + ';' for f in fl)}' ELSE '' END" for piece, fl in FLAG_RULES)
    return f"""
SELECT * REPLACE (CASE WHEN status = 'FAILED' THEN NULL ELSE gm_summary END AS gm_summary, CASE WHEN status = 'FAILED' THEN NULL ELSE gsd_summary END AS gsd_summary),
  CASE WHEN ends_with(conversion_path, 'reported_GM') THEN CASE WHEN contains(conversion_path, 'nmol/L') THEN ['molar_conversion'] ELSE [] END || CASE WHEN contains(conversion_path, 'ICRP89') THEN ['unit_converted_creatinine'] ELSE [] END
    ELSE list_distinct(list_filter(string_split('' {flags.replace('(p,', '(conversion_path,')}, ';'), lambda x: x <> '')) END AS flag_list
FROM (SELECT *, unit_path || '→' || stat_path AS conversion_path,
  CASE WHEN unit_status = 'FAILED' OR stat_status = 'FAILED' THEN 'FAILED' WHEN unit_status = 'WARN' OR stat_status = 'WARN' THEN 'WARN' WHEN unit_status = 'SKIP' AND stat_status = 'SKIP' THEN 'SKIP' ELSE 'OK' END AS status
FROM (SELECT *, r.gm AS gm_summary, r.gsd AS gsd_summary, r.path AS stat_path, r.status AS stat_status
FROM (SELECT *, CASE
  WHEN stat_type IN ('GM_GSD','GM_only') THEN {{'gm': g, 'gsd': initial_gsd, 'path': 'reported_GM', 'status': 'SKIP'}}
  WHEN stat_type = 'AM_SD' THEN CASE WHEN m > 0 AND s >= 0 THEN {{'gm': m / sqrt(1 + (s / m) ** 2), 'gsd': exp(sqrt(ln(1 + (s / m) ** 2))), 'path': 'AM_SD→AMSD_to_LN→GM', 'status': CASE WHEN s / m > 2 THEN 'WARN' ELSE 'OK' END}} ELSE {{'gm': NULL, 'gsd': NULL, 'path': 'AM_SD→AMSD_to_LN→GM', 'status': 'FAILED'}} END
  WHEN stat_type IN ('Median_IQR','P25_P75') THEN {quartiles}
  WHEN stat_type = 'Median_Range' THEN {ranged}
  WHEN stat_type = 'Min_Max' AND med IS NOT NULL THEN {min_max_median}
  WHEN stat_type = 'Min_Max' THEN {_estimate_sql('m', "CASE WHEN sample_size > 0 THEN (hi - lo) / nullif(xi, 0) ELSE (hi - lo) / 1.9079 END", "CASE WHEN sample_size > 0 THEN 'Min_Max→Wan_S1→GM' ELSE 'Min_Max→Wan_S3→GM' END", "'OK'")}
  WHEN stat_type = 'Median_only' THEN {{'gm': NULL, 'gsd': NULL, 'path': 'Median_only→FAILED', 'status': 'FAILED'}} END AS r
FROM (SELECT *, initial_gm * f AS g, initial_mean * f AS m, initial_sd * f AS s, initial_median * f AS med, initial_p25 * f AS q1, initial_p75 * f AS q3, initial_min * f AS lo, initial_max * f AS hi
FROM (SELECT *, coalesce(uf, 1.0) AS f,
  CASE WHEN adjusted = 'SpecificGravity' THEN 'SKIP' WHEN uf IS NULL THEN 'FAILED' WHEN unit_original = 'ug/g Cr' THEN CASE WHEN {_COARSE} THEN 'WARN' ELSE 'SKIP' END WHEN sample_type = 'Urine' AND {_COARSE} THEN 'WARN' ELSE 'OK' END AS unit_status,
  CASE WHEN adjusted = 'SpecificGravity' THEN 'specific_gravity_reported' WHEN uf IS NULL THEN unit_original || '→FAILED' WHEN unit_original = 'ug/g Cr' THEN 'reported_creatinine_corrected'
    WHEN sample_type = 'Urine' THEN unit_original || '→ICRP89_' || grp || '→ug/g Cr' ELSE unit_original || '→ug/L' END AS unit_path
FROM (SELECT *, {_GROUP} AS grp, CASE WHEN adjusted = 'SpecificGravity' OR unit_original = 'ug/g Cr' THEN 1.0
  WHEN sample_type = 'Urine' THEN (CASE unit_original WHEN 'nmol/L' THEN {MOLAR_MASS['As']} / 1000 ELSE {_case('lower(unit_original)', MASS_FACTORS)} END) * (1 / {_case('(' + _GROUP + ')', {k: v[2] for k, v in URINE_REFERENCE.items()})})
  ELSE {_case('lower(unit_original)', MASS_FACTORS)} END AS uf FROM rec LEFT JOIN widths USING (sample_size))))) ) )
"""


def _estimate_sql(centre: str, sd: str, path: str, good: str) -> str:
    cv = f"(({sd}) / {centre})"
    return f"CASE WHEN {centre} > 0 AND ({sd}) > 0 THEN {{'gm': {centre} / sqrt(1 + {cv} * {cv}), 'gsd': exp(sqrt(ln(1 + {cv} * {cv}))), 'path': {path}, 'status': {good}}} ELSE {{'gm': NULL, 'gsd': NULL, 'path': {path}, 'status': 'FAILED'}} END"


def _as_gm_sql(centre: str, path: str) -> str:
    return f"{{'gm': {centre}, 'gsd': NULL, 'path': '{path}→Median_as_GM→GM', 'status': 'SKIP'}}"


STANDARD_SQL = _standard_sql(_as_gm_sql("coalesce(med, (q1 + q3) / 2)", "Median_IQR"), _as_gm_sql("med", "Median_Range"), _as_gm_sql("med", "Median_Range"))
_N = "sample_size > 0"
_range_sd = f"CASE WHEN {_N} THEN (hi - lo) / nullif(xi, 0) ELSE (hi - lo) / 1.9079 END"
WAN_SQL = _standard_sql(
    _estimate_sql("coalesce(med, (q1 + q3) / 2)", f"CASE WHEN {_N} THEN (q3 - q1) / nullif(qw, 0) ELSE (q3 - q1) / 1.349 END", f"CASE WHEN {_N} THEN 'Median_IQR→Wan_S7→GM' ELSE 'Median_IQR→Wan_S6→GM' END", "CASE WHEN sample_size < 25 THEN 'WARN' ELSE 'OK' END"),
    _estimate_sql("med", _range_sd, f"CASE WHEN {_N} THEN 'Median_Range→Wan_S2→GM' ELSE 'Median_Range→Wan_S3→GM' END", "'OK'"),
    _estimate_sql("med", _range_sd, f"CASE WHEN {_N} THEN 'Median_Range→Wan_S2→GM' ELSE 'Median_Range→Wan_S3→GM' END", "'OK'"),
)


def standard(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return statistics.standardize(convert.convert_units(records(spark, sf_dir)), **options)


def flags_text(column: str | Column = "inferred_flags") -> Column:
    return F.array_join(F.array_sort(column), ";")


_POOL_SQL = """
SELECT {dims}, round(exp(mu), 6) AS gm, round(exp(sqrt(swd / t)), 6) AS gsd, n AS record_count, ns AS study_count, t AS total_sample_size, round(mw / t, 6) AS max_weight_share,
  round(exp(mu - sqrt(swd / t)), 6) AS bar_low, round(exp(mu + sqrt(swd / t)), 6) AS bar_high,
  round(CASE WHEN n > 1 THEN exp(mu - 1.96 * sqrt(swd / ((n - 1) * t))) END, 6) AS ci_low, round(CASE WHEN n > 1 THEN exp(mu + 1.96 * sqrt(swd / ((n - 1) * t))) END, 6) AS ci_high,
  concat_ws('; ', CASE WHEN n < 3 THEN 'fewer than 3 records' END, CASE WHEN mw / t > 0.3 THEN 'one record over 30 % of the weight' END) AS note,
  CASE WHEN mw / t < 0.1 THEN 'low' WHEN mw / t <= 0.3 THEN 'moderate' ELSE 'high' END AS weight_grade,
  CASE WHEN n >= 10 THEN 'good' WHEN n >= 3 THEN 'limited' ELSE 'sparse' END AS record_grade, 'record-level sums' AS count_note
FROM (SELECT {dims}, mu, sum(w * (ln(v) - mu) * (ln(v) - mu)) AS swd, sum(w) AS t, count(*) AS n, count(DISTINCT study_no) AS ns, max(w) AS mw
  FROM (SELECT *, sum(w * ln(v)) OVER (PARTITION BY {dims}) / sum(w) OVER (PARTITION BY {dims}) AS mu
    FROM (SELECT *, {period} AS period, CAST(sample_size AS DOUBLE) AS w, {value} AS v FROM {source}) WHERE v > 0 AND w > 0 AND period IS NOT NULL)
  GROUP BY {dims}, mu)
"""
_POOL_ROUND = ("gm", "gsd", "max_weight_share", "bar_low", "bar_high", "ci_low", "ci_high")


@query(_POOL_SQL.format(dims="sample_type, period, region", period=PERIOD_SQL, value="gm_direct", source="rec"))
def pool_by_period_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pool.pool(records(spark, sf_dir), ["sample_type", "period", "region"], "gm_direct"), *_POOL_ROUND)


@query(_POOL_SQL.format(dims="sample_type, period, region, province, population_group", period=PERIOD_SQL, value="gm_summary", source="std"))
def pool_standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From reported statistics to pooled means: units, statistics, pooling by all dims."""
    return rounded(pool.pool(standard(spark, sf_dir), ["sample_type", "period", "region", "province", "population_group"]), *_POOL_ROUND)


@query(f"SELECT count(*) AS n_records, count(*) FILTER (NOT coalesce(gm_direct > 0 AND sample_size > 0, false)) AS n_skipped, count(*) FILTER (gm_direct > 0 AND sample_size > 0 AND {PERIOD_SQL} IS NULL) AS n_out_of_range FROM rec")
def pool_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pool.exclusions(records(spark, sf_dir), "gm_direct")


@query(
    f"""SELECT concat_ws('+', CASE WHEN GROUPING(period) = 0 THEN 'period' END, CASE WHEN GROUPING(population_group) = 0 THEN 'population_group' END, CASE WHEN GROUPING(province) = 0 THEN 'province' END, CASE WHEN GROUPING(region) = 0 THEN 'region' END) AS stratum,
  sample_type, period, population_group, province, region, round(exp(sum(sample_size * ln(gm_direct)) / sum(sample_size)), 6) AS gm, count(*) AS record_count, CAST(sum(sample_size) AS DOUBLE) AS total_sample_size
FROM (SELECT *, {PERIOD_SQL} AS period FROM rec WHERE gm_direct > 0 AND sample_size > 0) WHERE period IS NOT NULL
GROUP BY GROUPING SETS ((sample_type), (sample_type, period), (sample_type, region), (sample_type, province), (sample_type, population_group))"""
)
def pool_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pool.pool_sets(records(spark, sf_dir), "sample_type", [["period"], ["region"], ["province"], ["population_group"]], "gm_direct"), "gm")


@query(
    """SELECT sample_type, population_group, min(v) FILTER (c >= 0.05 * t) AS p05, min(v) FILTER (c >= 0.25 * t) AS p25, min(v) FILTER (c >= 0.5 * t) AS p50, min(v) FILTER (c >= 0.75 * t) AS p75, min(v) FILTER (c >= 0.95 * t) AS p95
FROM (SELECT sample_type, population_group, gm_direct AS v, sum(CAST(sample_size AS DOUBLE)) OVER (PARTITION BY sample_type, population_group ORDER BY gm_direct RANGE UNBOUNDED PRECEDING) AS c, sum(CAST(sample_size AS DOUBLE)) OVER (PARTITION BY sample_type, population_group) AS t FROM rec WHERE gm_direct > 0 AND sample_size > 0)
GROUP BY sample_type, population_group"""
)
def weighted_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pool.weighted_quantiles(records(spark, sf_dir), ["sample_type", "population_group"], [0.05, 0.25, 0.5, 0.75, 0.95], "gm_direct")


@query(
    """SELECT record_id, sample_type, region, round(CASE WHEN t - w > 0 THEN exp((s - w * l) / (t - w)) END, 6) AS gm_without
FROM (SELECT record_id, sample_type, region, CAST(sample_size AS DOUBLE) AS w, ln(gm_direct) AS l, sum(sample_size * ln(gm_direct)) OVER p AS s, sum(CAST(sample_size AS DOUBLE)) OVER p AS t FROM rec WHERE gm_direct > 0 AND sample_size > 0 WINDOW p AS (PARTITION BY sample_type, region))"""
)
def leave_one_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pool.leave_one_out(records(spark, sf_dir), ["sample_type", "region"], "gm_direct"), "gm_without")


_DOMINANT = ["sample_type", "study_no", "region", "population_group"]


@query(
    f"""SELECT {', '.join(_DOMINANT)}, CASE WHEN w1 / t > 0.3 THEN top END AS dropped, round(exp(s / t), 6) AS gm_all,
  round(CASE WHEN w1 / t <= 0.3 THEN exp(s / t) WHEN t - w1 > 0 THEN exp((s - w1 * l1) / (t - w1)) END, 6) AS gm
FROM (SELECT {', '.join(_DOMINANT)}, sum(w * l) AS s, sum(w) AS t, max(w) AS w1, arg_max(record_id, rn) AS top, arg_max(l, rn) AS l1
  FROM (SELECT *, CAST(sample_size AS DOUBLE) AS w, ln(gm_direct) AS l, row_number() OVER (PARTITION BY {', '.join(_DOMINANT)} ORDER BY sample_size, record_id) AS rn FROM rec WHERE gm_direct > 0 AND sample_size > 0) GROUP BY {', '.join(_DOMINANT)})"""
)
def leave_dominant_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pool.without_dominant(records(spark, sf_dir), _DOMINANT, "gm_direct"), "gm_all", "gm")


@query(
    f"""SELECT sample_type, region, concat(CASE WHEN a IS NULL OR b IS NULL THEN '?' WHEN (b - a) / a < -0.05 THEN '↓' WHEN (b - a) / a > 0.05 THEN '↑' ELSE '→' END, CASE WHEN b IS NULL OR c IS NULL THEN '?' WHEN (c - b) / b < -0.05 THEN '↓' WHEN (c - b) / b > 0.05 THEN '↑' ELSE '→' END) AS pattern
FROM (SELECT sample_type, region, max(gm) FILTER (period = '1995-1996') AS a, max(gm) FILTER (period = '1997-1998') AS b, max(gm) FILTER (period = '1999-2000') AS c
  FROM (SELECT sample_type, region, period, exp(sum(sample_size * ln(gm_direct)) / sum(sample_size)) AS gm FROM (SELECT *, {PERIOD_SQL} AS period FROM rec) WHERE gm_direct > 0 AND sample_size > 0 AND period IS NOT NULL GROUP BY sample_type, region, period) GROUP BY sample_type, region)"""
)
def period_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    pooled = pool.pool(records(spark, sf_dir), ["sample_type", "region", "period"], "gm_direct")
    return pool.period_change(pooled, ["sample_type", "region"])


@query("SELECT sample_type, region, round(gm, 6) AS gm, rank() OVER (PARTITION BY sample_type ORDER BY gm DESC) AS place FROM (SELECT sample_type, region, exp(sum(sample_size * ln(gm_direct)) / sum(sample_size)) AS gm FROM rec WHERE gm_direct > 0 AND sample_size > 0 GROUP BY sample_type, region)")
def region_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    pooled = pool.pool(records(spark, sf_dir), ["sample_type", "region"], "gm_direct")
    return rounded(pool.ranked(pooled.select("sample_type", "region", "gm"), ["sample_type"]), "gm")


@query(
    """SELECT sample_type, region, round(exp(sum(l / se2) / sum(1 / se2)), 6) AS gm, count(se2) AS n_used, count(*) - count(se2) AS n_without_se
FROM (SELECT sample_type, region, ln(gm_direct) AS l, CASE WHEN initial_sd > 0 AND sample_size > 0 THEN initial_sd * initial_sd / sample_size END AS se2 FROM rec) GROUP BY sample_type, region"""
)
def pool_inverse_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pool.inverse_variance(records(spark, sf_dir), ["sample_type", "region"], "gm_direct", "initial_sd"), "gm")


_STD_COLUMNS = ["record_id", "unit_path", "stat_path", "conversion_path", "unit_status", "stat_status", "status"]
_STD_SELECT = f"SELECT {', '.join(_STD_COLUMNS)}, round(gm_summary, 6) AS gm_summary, round(gsd_summary, 6) AS gsd_summary, array_to_string(list_sort(flag_list), ';') AS flags FROM "


@query(_STD_SELECT + "std")
def standardize_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(standard(spark, sf_dir).select(*_STD_COLUMNS, "gm_summary", "gsd_summary", flags_text().alias("flags")), "gm_summary", "gsd_summary")


@query(_STD_SELECT + f"({WAN_SQL}) AS x")
def standardize_records_wan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians by estimated standard deviations instead of as means, quartiles by the paper's formula."""
    out = standard(spark, sf_dir, median_strategy="via_wan", iqr_formula="S7")
    return rounded(out.select(*_STD_COLUMNS, "gm_summary", "gsd_summary", flags_text().alias("flags")), "gm_summary", "gsd_summary")


@query("SELECT conversion_path, count(*) AS n FROM std GROUP BY 1 ORDER BY n DESC, conversion_path LIMIT 20")
def top_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standard(spark, sf_dir).groupBy("conversion_path").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "conversion_path").limit(20)


@query("SELECT 'status' AS dim, status AS value, count(*) AS n FROM std GROUP BY ALL UNION ALL SELECT 'unit_original', unit_original, count(*) FROM std GROUP BY ALL UNION ALL SELECT 'stat_type', stat_type, count(*) FROM std GROUP BY ALL UNION ALL SELECT 'adjusted', adjusted, count(*) FROM std GROUP BY ALL")
def distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = ["status", "unit_original", "stat_type", "adjusted"]
    pairs = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).alias("value")) for d in dims])
    return standard(spark, sf_dir).select(F.explode(pairs).alias("p")).groupBy("p.dim", "p.value").agg(F.count("*").alias("n"))


@query("SELECT flag, count(*) AS n_records FROM (SELECT unnest(flag_list) AS flag FROM std) GROUP BY flag")
def flag_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.flag_hits(standard(spark, sf_dir)).groupBy("flag").agg(F.count("*").alias("n_records"))


@query("SELECT record_id, coalesce(initial_gm, initial_median, initial_mean) AS point_value, CASE WHEN initial_gm IS NOT NULL THEN 'initial_gm' WHEN initial_median IS NOT NULL THEN 'initial_median' WHEN initial_mean IS NOT NULL THEN 'initial_mean' END AS point_source FROM rec")
def point_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert.point_estimate(records(spark, sf_dir)).select("record_id", "point_value", "point_source")


@query("SELECT count(*) AS n_records, count(*) FILTER (coalesce(initial_gm, initial_gsd, initial_mean, initial_sd, initial_median, initial_p25, initial_p75, initial_min, initial_max) IS NOT NULL) AS n_reported FROM rec")
def input_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert.has_input(records(spark, sf_dir))


@query("SELECT sample_size, round(xi / 2, 9) AS z, round(xi, 9) AS xi, round(qw, 9) AS quartile_width FROM widths")
def range_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = records(spark, sf_dir).where("sample_size > 0").select("sample_size").distinct()
    out = with_quantile(with_widths(sizes), (F.col("sample_size") - 0.375) / (F.col("sample_size") + 0.25), "z")
    return rounded(out.select("sample_size", F.abs("z").alias("z"), F.col("range_width").alias("xi"), "quartile_width"), "z", "xi", "quartile_width", digits=9)


def _edi_sql(parameters: dict[str, tuple]) -> str:
    part = lambda i: _case("population_group", {k: v[i] for k, v in parameters.items() if v[i] is not None})
    return f"""
SELECT *, CASE WHEN sample_type = 'CordBlood' OR (sample_type = 'Urine' AND ce IS NULL) OR (sample_type = 'Blood' AND population_group = 'Mixed') THEN 'SKIP' WHEN a IS NULL THEN 'FAILED' WHEN sample_type = 'Blood' OR abs(a - b) / a > 0.03 THEN 'WARN' ELSE 'OK' END AS edi_status,
  concat_ws(';', CASE WHEN abs(a - b) / a > 0.03 THEN 'inconsistent_param' END, CASE WHEN sample_type = 'Urine' AND population_group IN ('Elderly','Minors') THEN 'coarse_age' END, CASE WHEN sample_type = 'Blood' AND population_group <> 'Mixed' THEN 'exploratory_reconstruction' END,
    CASE WHEN sample_type = 'Blood' AND population_group <> 'Mixed' AND bw IS NULL THEN 'bw_unused' END, CASE WHEN sample_type = 'CordBlood' THEN 'cordblood_edi_skipped' END) AS edi_flags
FROM (SELECT *, {part(3)} AS bw, {part(0)} AS ce,
  CASE sample_type WHEN 'Urine' THEN gm_summary * {part(0)} / ({part(3)} * 0.7) WHEN 'Blood' THEN CASE WHEN population_group <> 'Mixed' THEN gm_summary * 2.0 / 0.7 END END AS a,
  CASE sample_type WHEN 'Urine' THEN gm_summary * {part(2)} * {part(1)} / ({part(3)} * 0.7) END AS b FROM std)
"""


EDI_SQL = _edi_sql(INTAKE)


@query(f"SELECT record_id, CASE sample_type WHEN 'Urine' THEN 'urine' WHEN 'Blood' THEN 'blood' ELSE 'cord' END AS route, round(a, 6) AS edi_primary, round(b, 6) AS edi_secondary, round(abs(a - b) / a, 6) AS cross_check_rel_diff, edi_status, edi_flags FROM ({EDI_SQL})")
def daily_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = intake.daily_intake(standard(spark, sf_dir))
    return rounded(out.select("record_id", "route", "edi_primary", "edi_secondary", "cross_check_rel_diff", "edi_status", "edi_flags"), "edi_primary", "edi_secondary", "cross_check_rel_diff")


@query(
    f"""SELECT sample_type, population_group, round(exp(any_value(mu)), 6) AS gm, round(exp(sqrt(sum(w * (ln(a) - mu) * (ln(a) - mu)) / sum(w))), 6) AS gsd, count(*) AS n, sum(w) AS total_sample_size,
  {', '.join(f"round(min(a) FILTER (c >= {p} * t), 6) AS p{round(100 * p):02d}" for p in (0.05, 0.25, 0.5, 0.75, 0.95))}, round(min(a) FILTER (rn = n2), 6) AS median
FROM (SELECT *, sum(w) OVER (p ORDER BY a RANGE UNBOUNDED PRECEDING) AS c, sum(w) OVER p AS t, sum(w * ln(a)) OVER p / sum(w) OVER p AS mu, row_number() OVER (p ORDER BY a) AS rn, count(*) OVER p // 2 + 1 AS n2 FROM (SELECT *, CAST(sample_size AS DOUBLE) AS w FROM ({EDI_SQL})) WHERE a > 0 AND w > 0 WINDOW p AS (PARTITION BY sample_type, population_group)) GROUP BY sample_type, population_group"""
)
def intake_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = intake.intake_summary(standard(spark, sf_dir), ["sample_type", "population_group"])
    return rounded(out, "gm", "gsd", "p05", "p25", "p50", "p75", "p95", "median")


# The elderly without a body weight: urine fails, blood tells that it needs none.
_NO_WEIGHT = {**INTAKE, "Elderly": (*INTAKE["Elderly"][:3], None)}


@query(f"SELECT record_id, round(a, 6) AS edi_primary, edi_status, edi_flags FROM ({_edi_sql(_NO_WEIGHT)})")
def intake_without_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = intake.daily_intake(standard(spark, sf_dir), parameters=_NO_WEIGHT)
    return rounded(out.select("record_id", "edi_primary", "edi_status", "edi_flags"), "edi_primary")


@query(f"SELECT edi_status, count(*) AS n FROM ({EDI_SQL}) GROUP BY edi_status")
def intake_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.daily_intake(standard(spark, sf_dir)).groupBy("edi_status").agg(F.count("*").alias("n"))


@query(f"SELECT sample_type, population_group, round(exp(sum(sample_size * ln(a)) / sum(sample_size)) * 0.7 / 1.0, 6) AS edi_low, round(exp(sum(sample_size * ln(a)) / sum(sample_size)) * 0.7 / 0.5, 6) AS edi_high FROM ({EDI_SQL}) WHERE a > 0 AND sample_size > 0 GROUP BY sample_type, population_group")
def intake_absorption_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(intake.absorption_range(standard(spark, sf_dir), [0.5, 0.6, 0.7, 0.8, 0.9, 1.0], ["sample_type", "population_group"]), "edi_low", "edi_high")


# Ages that fall in every group, made of lines and parts; None for every sixth.
_AGE = "CASE WHEN line % 6 = 0 THEN NULL ELSE (line * 5 + part % 9) / 4.0 END"
_AGED = f"SELECT *, {_AGE} AS age FROM (SELECT *, CAST(split_part(record_id, '-', 2) AS INT) AS line, CAST(split_part(record_id, '-', 3) AS INT) AS part FROM rec)"
_BY_SEX = lambda plain: f"CASE gender WHEN 'Male' THEN '{plain[0]}_Male' WHEN 'Female' THEN '{plain[0]}_Female' ELSE '{plain[1]}' END"
_AGE_GROUP = f"CASE WHEN population_group = 'Pregnant' THEN 'Pregnant' WHEN age < 0.5 THEN 'Newborn' WHEN age < 4 THEN 'Infant' WHEN age < 8 THEN 'Toddler' WHEN age < 13 THEN 'Child' WHEN age < 18 THEN {_BY_SEX(('Adolescent', 'Adolescent'))} WHEN age IS NOT NULL OR population_group IN ('Adults', 'Elderly') THEN {_BY_SEX(('Adult', 'Adults'))} WHEN population_group = 'Minors' THEN 'Minors' ELSE 'Adults' END"


def _aged(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part = (F.split("record_id", "-")[i].cast("int") for i in (1, 2))
    return records(spark, sf_dir).where("sample_type = 'Urine'").withColumn("age", F.when(line % 6 != 0, (line * 5 + part % 9) / 4.0))


def _urine_factor(per_creatinine: str, litre: bool) -> str:
    mass = f"CASE unit_original WHEN 'nmol/L' THEN {MOLAR_MASS['As']} / 1000 ELSE {_case('lower(unit_original)', MASS_FACTORS)} END"
    inner = f"CASE WHEN unit_original = 'ug/g Cr' THEN {per_creatinine} ELSE {mass} END" if litre else f"CASE WHEN unit_original = 'ug/g Cr' THEN 1.0 ELSE ({mass}) * {per_creatinine} END"
    return f"CASE WHEN adjusted = 'SpecificGravity' THEN 1.0 ELSE {inner} END"


_CONVERTED = "SELECT record_id, CASE WHEN adjusted = 'SpecificGravity' OR {kept} THEN NULL ELSE g END AS unit_group, round({factor}, 9) AS unit_factor, CASE WHEN adjusted = 'SpecificGravity' THEN unit_original ELSE '{final}' END AS unit_final FROM (SELECT *, {group} AS g FROM ({aged})) WHERE sample_type = 'Urine'"


@query(_CONVERTED.format(kept="unit_original = 'ug/g Cr'", factor=_urine_factor(f"({_case('g', {k: v[1] for k, v in URINE_REFERENCE.items()})} / {_case('g', {k: v[0] for k, v in URINE_REFERENCE.items()})})", False), final="ug/g Cr", group=_AGE_GROUP, aged=_AGED))
def urine_by_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urine per creatinine through daily excretion and volume (CE and V), groups by age before population."""
    out = convert.convert_units(_aged(spark, sf_dir), mode="CEV_equivalent", age=F.col("age"))
    return rounded(out.select("record_id", "unit_group", "unit_factor", "unit_final"), "unit_factor", digits=9)


@query(_CONVERTED.format(kept="false", factor=_urine_factor(_case("g", {k: v[2] for k, v in URINE_REFERENCE.items()}), True), final="ug/L", group=_AGE_GROUP, aged=_AGED))
def urine_to_litre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other way: urine per creatinine back to its volume."""
    out = convert.convert_units(_aged(spark, sf_dir), urine_target="ug/L", age=F.col("age"))
    return rounded(out.select("record_id", "unit_group", "unit_factor", "unit_final"), "unit_factor", digits=9)
