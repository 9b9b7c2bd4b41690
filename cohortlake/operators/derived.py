"""Columns and checks derived from the record table's dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def assign_region(df: DataFrame, regions: DataFrame) -> DataFrame:
    """Region of each province by the dimension (province, region); UNKNOWN where it isn't listed, never guessed."""
    one = regions.groupBy("province").agg(F.min("region").alias("region"))
    return df.drop("region").join(one, "province", "left").withColumn("region", F.coalesce("region", F.lit("UNKNOWN")))


def split_provinces(regions: DataFrame) -> DataFrame:
    """Provinces that the dimension puts in more than one region."""
    return regions.groupBy("province").agg(F.countDistinct("region").alias("n_regions")).where("n_regions > 1")


def unlisted(df: DataFrame, column: str, dimension: DataFrame) -> DataFrame:
    """Values of a column that the dimension of the same column lacks, with their rows' number."""
    return df.groupBy(column).agg(F.count("*").alias("n")).join(dimension.select(column).distinct(), column, "left_anti").where(F.col(column).isNotNull())


def overlapping_periods(periods: DataFrame) -> DataFrame:
    """Periods that begin before the one in front of them has ended, or end before they begin. A dimension of a few rows."""
    before = F.lag("end").over(Window.orderBy("start"))
    return periods.withColumn("_b", before).where((F.col("start") <= F.col("_b")) | (F.col("end") < F.col("start"))).drop("_b")


def representative_year(df: DataFrame, rule: str) -> DataFrame:
    """Adds year and time_represented for an interval year_from..year_to."""
    rules = {"start": F.col("year_from"), "end": F.col("year_to"), "midpoint": F.floor((F.col("year_from") + F.col("year_to")) / 2).cast("int")}
    if rule not in rules:
        raise ValueError(f"unknown rule {rule}")
    return df.withColumns({"year": rules[rule], "time_represented": F.col("year_from") != F.col("year_to")})


def title_flags(df: DataFrame) -> DataFrame:
    """Adds what a title tells of a population: occupational (unless it says non-occupational), disease, endemic area, occupational and other people together, and parts of blood."""
    low = F.lower("title")
    return df.withColumns({"title_occupational": low.rlike("occupational|workers|smelter") & ~low.rlike("non-?occupational"), "title_disease": low.rlike("patients|disease|poisoning"), "title_endemic": low.rlike("endemic"), "title_mixed_occupational": F.regexp_replace(low, "non-?occupational", "").rlike("occupational|workers|smelter") & low.rlike("non-?occupational"), "title_blood_matrix": low.rlike("serum|plasma|血清|血浆")})


def prefer_basis(df: DataFrame) -> DataFrame:
    """Where a study reports a stratum in several urine bases, the records of the best one: creatinine, then specific gravity, then the rest."""
    order = F.when(F.col("adjusted") == "Creatinine", 0).when(F.col("adjusted") == "SpecificGravity", 1).otherwise(2)
    w = Window.partitionBy("study_no", "sample_type", "population_group", "sampling_year")
    return df.withColumn("_o", order).withColumn("_best", F.min("_o").over(w)).where("_o = _best").drop("_o", "_best")


# What a project's settings must hold, and the values that some may have.
SETTINGS = ["project.analyte", "project.country", "period_scheme.freeze_date"]
DOMAINS = {"standardization.median_to_gm_strategy": ["as_gm", "via_wan"], "standardization.wan_variant": ["minus"], "standardization.creatinine_path_mode": ["CC_direct", "CEV_equivalent"]}


def settings_findings(settings: DataFrame, project: str = "project") -> DataFrame:
    """project, key, fault of projects' settings (project, key, value): required ones that are missing or blank, and values outside of their domain."""
    value = F.trim(F.coalesce("value", F.lit("")))
    held = settings.groupBy(project).agg(F.map_from_entries(F.collect_list(F.struct("key", value.alias("value")))).alias("s"))  # a handful of keys
    of = lambda key: F.coalesce(F.col("s")[key], F.lit(""))
    found = [F.when(of(key) == "", F.struct(F.lit(key).alias("key"), F.lit("missing").alias("fault"))) for key in [*SETTINGS, *DOMAINS]]
    found += [F.when((of(key) != "") & ~of(key).isin(*allowed), F.struct(F.lit(key).alias("key"), F.lit("not allowed").alias("fault"))) for key, allowed in DOMAINS.items()]
    return held.select(project, F.explode(F.array_compact(F.array(*found))).alias("f")).select(project, "f.*")


def matrices_without_unit(df: DataFrame, policy: DataFrame) -> DataFrame:
    """sample_type, n: matrices of the records for which the policy (sample_type, unit) names no target unit."""
    named = policy.where(F.trim(F.coalesce("unit", F.lit(""))) != "").select("sample_type").distinct()
    return df.groupBy("sample_type").agg(F.count("*").alias("n")).join(named, "sample_type", "left_anti")


def parameters_of_several(parameters: DataFrame) -> DataFrame:
    """population_group, n: populations that a table of intake parameters has more than once."""
    return parameters.groupBy("population_group").agg(F.count("*").alias("n")).where("n > 1")
