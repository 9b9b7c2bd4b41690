"""Dimension values and the record view.

Small dimensions are literals: Catalyst folds them into the projection, so no join is needed. Each can be
replaced by the caller's own values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Unit factors to ug/L, creatinine units to ug/g Cr, tissue units, molar masses (g/mol).
MASS_FACTORS = {"ug/l": 1.0, "ng/ml": 1.0, "mg/l": 1000.0, "ug/dl": 10.0, "ng/l": 0.001, "pg/ml": 0.001, "ug/ml": 1000.0, "mg/ml": 1000000.0}
CREATININE_FACTORS = {"ug/g cr": 1.0, "ug/g creatinine": 1.0, "mg/g cr": 1000.0}
TISSUE_UNITS = ["ug/g", "mg/kg", "ug/kg", "ng/g"]
MOLAR_MASS = {"As": 74.92, "As2O3": 197.84, "Cd": 112.41, "Cr": 52.0, "Pb": 207.2, "Hg": 200.59, "MeHg": 215.63, "Ni": 58.69, "Ti": 47.87, "V": 50.94, "PFOA": 414.07, "PFOS": 500.13}
# Urine reference by group (creatinine g/day, volume L/day, creatinine g/L).
URINE_REFERENCE = {
    "Newborn": (0.05, 0.3, 0.167),
    "Infant": (0.11, 0.4, 0.275),
    "Toddler": (0.33, 0.5, 0.66),
    "Child": (0.65, 0.7, 0.929),
    "Adolescent": (1.2, 1.4, 0.857),
    "Adolescent_Male": (1.4, 1.6, 0.875),
    "Adolescent_Female": (1.0, 1.2, 0.833),
    "Minors": (0.925, 1.05, 0.815),
    "Adults": (1.35, 1.4, 0.964),
    "Adult_Male": (1.7, 1.6, 1.063),
    "Adult_Female": (1.0, 1.2, 0.833),
    "Pregnant": (1.275, 2.0, 0.638),
}
# Intake parameters by population (CE, V, CC, body weight), absorption, distribution volume, turnover.
INTAKE = {"Adults": (1.35, 1.4, 0.964, 60.0), "Pregnant": (1.275, 2.0, 0.638, 60.0), "Minors": (0.925, 1.05, 0.815, 20.0), "Elderly": (1.35, 1.4, 0.964, 60.0)}
ABSORPTION, VOLUME, TURNOVER = 0.7, 2.0, 1.0
# The closed set of inferred flags that a conversion path can give, by the piece of path that gives them.
FLAG_RULES = [
    ("Wan_S1", ["gm_from_mean_sd", "gm_from_range"]),
    ("Wan_S2", ["gm_from_median", "gm_from_range"]),
    ("Wan_S3", ["gm_from_range", "no_n_fallback"]),
    ("Wan_S4", ["gm_from_median", "gm_from_iqr"]),
    ("Wan_S5", ["gm_from_mean_sd", "gm_from_iqr"]),
    ("Wan_S6", ["gm_from_median", "gm_from_iqr", "no_n_fallback"]),
    ("Wan_S7", ["gm_from_median", "gm_from_iqr"]),
    ("AMSD_to_LN", ["gm_from_mean_sd"]),
    ("Median_IQR→Median_as_GM", ["gm_from_median", "gm_from_iqr"]),
    ("Median_Range→Median_as_GM", ["gm_from_median", "gm_from_range"]),
    ("Median_as_GM", ["gm_from_median"]),
    ("sd_from_iqr", ["sd_from_iqr"]),
    ("nmol/L", ["molar_conversion"]),
    ("ICRP89", ["unit_converted_creatinine"]),
    ("time_represented", ["time_represented"]),
    ("blood_matrix_assumed", ["blood_matrix_assumed"]),
    ("species_total_assumed", ["species_total_assumed"]),
]
# The closed set of flags.
KNOWN_FLAGS = [
    "gm_from_mean_sd", "gm_from_median", "gm_from_iqr", "gm_from_range", "sd_from_iqr", "unit_converted_creatinine", "unit_converted_volume", "molar_conversion",
    "time_represented", "blood_matrix_assumed", "species_total_assumed", "coord_random", "value_interpolated", "value_estimated_from_figure", "sample_size_estimated",
    "record_split_from_study", "subgroup_selected", "no_n_fallback", "coarse_age", "cordblood_edi_skipped", "exploratory_reconstruction", "inconsistent_param", "bw_unused",
]
PERIODS = [("1995-1996", 1995, 1996), ("1997-1998", 1997, 1998), ("1999-2000", 1999, 2000)]


def lookup(key: Column, values: dict) -> Column:
    """The value of a literal dimension; null outside of it."""
    items = iter(values.items())
    k, v = next(items)
    out = F.when(key == k, F.lit(v))
    for k, v in items:
        out = out.when(key == k, F.lit(v))
    return out


def period_of(year: Column, periods: list[tuple[str, int, int]] = PERIODS) -> Column:
    """Label of the closed interval that holds the year; null outside of all."""
    for (_, _, end), (_, start, _) in zip(periods, periods[1:], strict=False):
        if start <= end:
            raise ValueError("periods overlap or are out of order")
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for label, start, end in periods:
        out = out.when(year.between(start, end), F.lit(label))
    return out


RECORD_SQL = """
SELECT record_id, study_no, title, author, doi, t_publication, sampling_year, province, city, region,
  population_group, gender, sample_type, 'As' AS analyte, 'Total' AS analyte_species, stat_type, unit_original, sample_size,
  CASE WHEN stat_type IN ('GM_GSD','GM_only') THEN x END AS initial_gm,
  CASE WHEN stat_type = 'GM_GSD' THEN 1 + 10 * disc END AS initial_gsd,
  CASE WHEN stat_type = 'AM_SD' OR (stat_type = 'Min_Max' AND ln % 2 = 0) THEN x END AS initial_mean,
  CASE WHEN stat_type = 'AM_SD' THEN x * tax * 5 END AS initial_sd,
  CASE WHEN stat_type IN ('Median_IQR','Median_Range','Median_only') OR (stat_type = 'Min_Max' AND ln % 2 = 1) THEN x END AS initial_median,
  CASE WHEN stat_type IN ('Median_IQR','P25_P75') THEN x * (1 - 3 * disc) END AS initial_p25,
  CASE WHEN stat_type IN ('Median_IQR','P25_P75') THEN x * (1 + 4 * disc) END AS initial_p75,
  CASE WHEN stat_type IN ('Median_Range','Min_Max') THEN x * (1 - 8 * disc) END AS initial_min,
  CASE WHEN stat_type IN ('Median_Range','Min_Max') THEN x * (1 + 9 * disc) END AS initial_max,
  CASE WHEN sample_type <> 'Urine' THEN 'NotApplicable' WHEN unit_original = 'ug/g Cr' THEN 'Creatinine' WHEN gender = 'Both' AND unit_original = 'ug/L' THEN 'SpecificGravity' ELSE 'No' END AS adjusted,
  CASE WHEN sample_type = 'Blood' THEN CASE WHEN gender = 'Male' THEN 'Serum' ELSE 'WholeBlood' END END AS blood_matrix,
  flag_occupational, x AS gm_direct
FROM (
SELECT
  concat('R', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING)) AS record_id,
  concat('S', CAST(l_suppkey AS STRING)) AS study_no,
  concat('Study of ', p_name, CASE WHEN l_partkey % 5 = 0 THEN ' birth cohort' ELSE '' END) AS title,
  concat('Author', CAST(l_suppkey % 40 AS STRING), '; Other') AS author,
  CASE WHEN l_suppkey % 9 = 0 THEN 'NO_DOI' ELSE concat('10.1234/x.', CAST(l_suppkey AS STRING)) END AS doi,
  year(o_orderdate) + CAST(l_partkey % 3 AS INT) AS t_publication,
  year(l_shipdate) AS sampling_year,
  n_name AS province, n_name AS city, r_name AS region,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Adults' WHEN 'BUILDING' THEN 'Minors' WHEN 'FURNITURE' THEN 'Pregnant' WHEN 'HOUSEHOLD' THEN 'Elderly' ELSE 'Mixed' END AS population_group,
  CASE CAST(o_custkey % 3 AS INT) WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Both' END AS gender,
  CASE l_returnflag WHEN 'A' THEN 'Urine' WHEN 'N' THEN 'Blood' ELSE 'CordBlood' END AS sample_type,
  CASE CAST((l_partkey + l_linenumber) % 8 AS INT) WHEN 0 THEN 'GM_GSD' WHEN 1 THEN 'GM_only' WHEN 2 THEN 'AM_SD' WHEN 3 THEN 'Median_IQR' WHEN 4 THEN 'Median_Range' WHEN 5 THEN 'Median_only' WHEN 6 THEN 'Min_Max' ELSE 'P25_P75' END AS stat_type,
  CASE WHEN l_returnflag = 'A' THEN CASE CAST(l_suppkey % 4 AS INT) WHEN 0 THEN 'ug/g Cr' WHEN 1 THEN 'ug/L' WHEN 2 THEN 'nmol/L' ELSE 'mg/L' END
       ELSE CASE CAST(l_suppkey % 4 AS INT) WHEN 0 THEN 'ug/L' WHEN 1 THEN 'ng/mL' WHEN 2 THEN 'ug/dL' ELSE 'ug/g' END END AS unit_original,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE CAST(l_quantity AS INT) END AS sample_size,
  l_extendedprice / 1000 AS x, l_discount AS disc, l_tax AS tax,
  l_linenumber AS ln, l_linestatus = 'O' AND l_partkey % 13 = 0 AS flag_occupational
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey
) AS b
"""


def spread_out(df: DataFrame) -> DataFrame:
    """A table read in fewer parts than there are cores, dealt to all of them; a larger one as it is.

    A small file is one part, and broadcast joins add no shuffle that would share the work behind it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def records(spark: SparkSession, sf_dir: str, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """The record table as a projection of the given tables, all tables read with pushdown. ``part`` (i, n): the records of every n-th order by hash, from 0."""
    names = ("lineitem", "orders", "customer", "nation", "region", "part")
    sql = RECORD_SQL
    for name in names:
        sql = sql.replace(f"FROM {name} ", f"FROM {{{name}}} ").replace(f"JOIN {name} ", f"JOIN {{{name}}} ")
    tables = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}
    if part[1] > 1:
        for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
            tables[name] = tables[name].where(F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(part[1])) == part[0])
    tables["lineitem"] = spread_out(tables["lineitem"].select(*[c for c in tables["lineitem"].columns if c in RECORD_SQL]))
    return spark.sql(sql, **tables)


PART, MOST_PARTS = 1_000_000, 8  # records of a part; parts


def record_count(spark: SparkSession, sf_dir: str) -> int:
    """Rows that the record table has at most, from the files' footers."""
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()


def record_parts(spark: SparkSession, sf_dir: str, count: int, most: int = MOST_PARTS) -> list[DataFrame]:
    """The record table of ``count`` rows in parts, together whole, each record in one.

    Its joins shuffle every record up to three times. Work that writes the table part by part holds one part's shuffle files at a time.
    """
    n = min(most, max(1, -(-count // PART)))
    return [records(spark, sf_dir, (i, n)) for i in range(n)]
