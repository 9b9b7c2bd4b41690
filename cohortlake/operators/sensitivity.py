"""Sensitivity analyses: every record goes to the analyses that it belongs to, then one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.functions.stats import trend
from cohortlake.plans.dims import PERIODS, period_of

SMALL = 0.2
# The groups of records that are left out, each by its flag, where the table has it.
LEAVE_OUT = {"occupational": "flag_occupational", "disease": "flag_disease", "blood_matrix_flagged": "flag_blood_matrix", "endemic_area": "flag_endemic_area"}


def gm_source(path: Column) -> Column:
    return F.when(path.contains("reported_GM"), "reported_GM").when(path.contains("Wan_S"), "Wan_estimated").when(path.contains("Median_as_GM"), "Median_as_GM").when(path.contains("AMSD_to_LN"), "AMSD_to_LN").otherwise("other")


def _sums(df: DataFrame, periods, least_n: int) -> DataFrame:
    """sample_type, analysis, all, and w-sums, records and studies in total and by period (gm0, n0, studies0, ...): one scan, one aggregation."""
    source = gm_source(F.col("conversion_path"))
    name = lambda kind, value, when=None: F.when(value.isNotNull() if when is None else when & value.isNotNull(), F.concat(F.lit(kind + "="), value))
    belongs = F.array(
        F.lit("main"),
        name("adjusted", F.col("adjusted"), F.col("sample_type") == "Urine"),
        name("gm_source", source, source != "other"),
        name("blood_matrix", F.col("blood_matrix"), F.col("sample_type") != "Urine"),
        name("species", F.col("analyte_species")),
        name("population", F.col("population_group"), F.col("population_group") != "Mixed"),
        F.when(source == "reported_GM", "subset=direct"),
        F.when(~F.array_contains("inferred_flags", "no_n_fallback"), "subset=with_sample_size"),
        F.when(F.col("sample_size") >= least_n, "subset=large"),
        F.when(~F.array_contains("inferred_flags", "record_split_from_study"), "subset=not_split"),
        *[F.when(~F.coalesce(F.col(c), F.lit(False)), F.lit("without=" + name)) for name, c in LEAVE_OUT.items() if c in df.columns],
    )
    good = (F.col("gm_summary") > 0) & (F.col("sample_size") > 0)
    period = period_of(F.col("sampling_year"), periods)
    each = df.select("sample_type", "study_no", period.alias("period"), F.when(good & period.isNotNull(), F.col("sample_size").cast("double")).alias("w"), F.ln(F.when(good, F.col("gm_summary"))).alias("l"), F.explode(F.filter(belongs, lambda x: x.isNotNull())).alias("analysis"))
    # Studies are a key of the first aggregation, so that distinct ones are counted without a row for each record and count.
    first = each.groupBy("sample_type", "analysis", "period", "study_no").agg(F.count("*").alias("k"), F.count("w").alias("n"), F.sum("w").alias("sw"), F.sum(F.col("w") * F.col("l")).alias("swl"))
    known = F.when(F.col("n") > 0, F.col("study_no"))
    sums = []
    for i, (p, _, _) in enumerate(periods):
        inside = lambda c, p=p: F.when(F.col("period") == p, c)
        sums += [F.exp(F.sum(inside(F.col("swl"))) / F.sum(inside(F.col("sw")))).alias(f"gm{i}"), F.coalesce(F.sum(inside(F.col("n"))), F.lit(0)).alias(f"n{i}"), F.countDistinct(inside(known)).alias(f"studies{i}")]
    by = first.groupBy("sample_type", "analysis").agg(F.sum("k").alias("all"), F.sum("n").alias("n_records"), F.countDistinct(known).alias("n_studies"), *sums)
    return by.withColumn("pattern", F.concat(*[trend(F.col(f"gm{i}"), F.col(f"gm{i + 1}")) for i in range(len(periods) - 1)]))


def _of_main(column: str) -> Column:
    """The main analysis' value, by a window over the analyses."""
    return F.max(F.when(F.col("analysis") == "main", F.col(column))).over(Window.partitionBy("sample_type"))


def sensitivity(df: DataFrame, periods=PERIODS, least_n: int = 30) -> DataFrame:
    """sample_type, analysis, n_records, n_studies, ratio_of_total, pattern, consistent_with_main, reduced, and analysis_id: S00 for main, then S01 ... by name."""
    ratio = F.col("n_records") / F.col("total")
    by = _sums(df, periods, least_n).withColumns({"total": _of_main("all"), "main_pattern": _of_main("pattern")})
    place = F.row_number().over(Window.partitionBy("sample_type").orderBy(F.col("analysis") != "main", "analysis")) - 1
    return by.select("sample_type", F.format_string("S%02d", place).alias("analysis_id"), "analysis", "n_records", "n_studies", F.round(ratio, 6).alias("ratio_of_total"), "pattern", (F.col("pattern") == F.col("main_pattern")).alias("consistent_with_main"), (ratio < SMALL).alias("reduced"))


def sensitivity_by_period(df: DataFrame, periods=PERIODS, least_n: int = 30) -> DataFrame:
    """sample_type, analysis, period, gm, n_records, n_studies."""
    cells = F.array(*[F.struct(F.lit(p).alias("period"), F.col(f"gm{i}").alias("gm"), F.col(f"n{i}").alias("n_records"), F.col(f"studies{i}").alias("n_studies")) for i, (p, _, _) in enumerate(periods)])
    return _sums(df, periods, least_n).select("sample_type", "analysis", F.explode(cells).alias("c")).select("sample_type", "analysis", "c.*")


def pattern_matrix(df: DataFrame, periods=PERIODS, least_n: int = 30) -> DataFrame:
    """Analyses against periods: one column for each step from a period to the next, with its trend label."""
    steps = {f"{a[0]} to {b[0]}": trend(F.col(f"gm{i}"), F.col(f"gm{i + 1}")) for i, (a, b) in enumerate(zip(periods, periods[1:], strict=False))}
    return _sums(df, periods, least_n).select("sample_type", "analysis", *[label.alias(name) for name, label in steps.items()])


def robustness(df: DataFrame, periods=PERIODS, least_n: int = 30, level: float = 0.2) -> DataFrame:
    """sample_type, analysis, max_level_diff, grade: whether an analysis leads where the main one does.

    ``direction_changed`` if its pattern is another, else ``level_differs`` if its mean of some period is off by over ``level``, else ``robust``.
    """
    by = _sums(df, periods, least_n)
    by = by.withColumns({"main_pattern": _of_main("pattern"), **{f"main{i}": _of_main(f"gm{i}") for i in range(len(periods))}})
    off = F.greatest(*[F.abs(F.col(f"gm{i}") - F.col(f"main{i}")) / F.col(f"main{i}") for i in range(len(periods))])
    grade = F.when(F.col("pattern") != F.col("main_pattern"), "direction_changed").when(off > level, "level_differs").otherwise("robust")
    return by.where("analysis <> 'main'").select("sample_type", "analysis", off.alias("max_level_diff"), grade.alias("grade"))
