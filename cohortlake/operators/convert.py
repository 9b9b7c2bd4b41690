"""Unit conversion: from reported values to the target unit of each matrix, with the trail of what was done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.stats import settled
from cohortlake.functions.text import normalize_unit
from cohortlake.plans.dims import CREATININE_FACTORS, MASS_FACTORS, MOLAR_MASS, TISSUE_UNITS, URINE_REFERENCE, lookup

SCALED = ["initial_gm", "initial_mean", "initial_sd", "initial_median", "initial_p25", "initial_p75", "initial_min", "initial_max"]


def classify_unit(unit: Column) -> Column:
    """mass_volume, creatinine, molar, tissue or unknown; ``unit`` is normalised."""
    return (
        F.when(unit.isin(*MASS_FACTORS), "mass_volume")
        .when(unit.isin(*CREATININE_FACTORS), "creatinine")
        .when(unit.contains("mol/l"), "molar")
        .when(unit.isin(*TISSUE_UNITS) | unit.endswith("/g") | unit.contains("/kg"), "tissue")
        .otherwise("unknown")
    )


def urine_group(population: Column, sex: Column, age: Column) -> Column:
    """Pregnant before age before population; unknown populations fall back to adults."""
    by_sex = lambda plain, male, female: F.when(sex == "Male", male).when(sex == "Female", female).otherwise(plain)
    adult = by_sex("Adults", "Adult_Male", "Adult_Female")
    by_age = F.when(age < 0.5, "Newborn").when(age < 4, "Infant").when(age < 8, "Toddler").when(age < 13, "Child").when(age < 18, by_sex("Adolescent", "Adolescent_Male", "Adolescent_Female")).otherwise(adult)
    return F.when(population == "Pregnant", "Pregnant").when(age.isNotNull(), by_age).when(population.isin("Adults", "Elderly"), adult).when(population == "Minors", "Minors").otherwise("Adults")


def convert_units(df: DataFrame, mode: str = "CC_direct", urine_target: str = "ug/g Cr", age: Column | None = None) -> DataFrame:
    """Adds unit_status, unit_factor, unit_final, unit_path, unit_group and unit_params (what the factor was made with), and scales the reported statistics.

    Urine given by specific gravity keeps its unit; urine given per creatinine stays unless the target is
    ug/L; a matrix other than urine can't be given per creatinine; tissue units can't be converted.
    """
    if mode not in ("CC_direct", "CEV_equivalent"):
        raise ValueError(f"unknown mode {mode}")
    if urine_target not in ("ug/g Cr", "ug/L"):
        raise ValueError(f"unknown target {urine_target}")
    unit, urine = F.col("_unit"), F.col("sample_type") == "Urine"
    out = settled(df, {"_unit": normalize_unit(F.col("unit_original"))})
    sex = F.col("gender")
    out = settled(out, {"_kind": classify_unit(unit), "_group": urine_group(F.coalesce("population_group", F.lit("")), sex, F.lit(None).cast("double") if age is None else age)})
    molar = F.coalesce(lookup(F.col("analyte_species"), MOLAR_MASS), lookup(F.col("analyte"), MOLAR_MASS))
    to_litre = F.when(F.col("_kind") == "mass_volume", lookup(unit, MASS_FACTORS)).when(F.col("_kind") == "molar", F.when(unit.contains("nmol/l"), molar / 1000).when(unit.contains("umol/l"), molar).otherwise(molar * 1000))
    part = lambda i: lookup(F.col("_group"), {g: v[i] for g, v in URINE_REFERENCE.items()})
    per_creatinine = 1 / part(2) if mode == "CC_direct" else part(1) / part(0)
    kept = urine & (F.col("adjusted") == "SpecificGravity")
    reported = urine & (F.col("_kind") == "creatinine")
    to_creatinine = urine & F.lit(urine_target == "ug/g Cr")
    reverse = F.lit(urine_target == "ug/L")
    creatinine = lookup(unit, CREATININE_FACTORS)
    factor = F.when(kept, F.lit(1.0)).when(reported, F.when(reverse, creatinine * part(2)).otherwise(creatinine)).when(F.col("_kind") == "creatinine", F.lit(None)).when(to_creatinine, to_litre * per_creatinine).otherwise(to_litre)
    coarse = F.col("_group").isin("Minors") | ~F.col("population_group").isin("Adults", "Elderly", "Minors", "Pregnant")
    out = settled(out, {"unit_factor": factor.cast("double")})
    ok = F.col("unit_factor").isNotNull()
    out = settled(
        out,
        {
            "unit_status": F.when(~ok, "FAILED").when(kept | (reported & ~reverse & ~coarse), "SKIP").when(urine & coarse, "WARN").otherwise("OK"),
            "unit_final": F.when(kept, F.col("unit_original")).when(~ok, F.lit(None)).when(to_creatinine, "ug/g Cr").otherwise("ug/L"),
            "unit_path": F.when(kept, "specific_gravity_reported")
            .when(~ok, F.concat("unit_original", F.lit("→FAILED")))
            .when(reported & ~reverse, "reported_creatinine_corrected")
            .when(reported, F.concat(F.lit("ug/g Cr→ICRP89_"), F.col("_group"), F.lit("→ug/L")))
            .when(to_creatinine, F.concat("unit_original", F.lit("→ICRP89_"), "_group", F.lit("→ug/g Cr")))
            .otherwise(F.concat("unit_original", F.lit("→ug/L"))),
            "unit_group": F.when(ok & urine & ~kept & ~(reported & ~reverse), F.col("_group")),
            "unit_params": F.when(ok & ~kept, F.concat_ws("; ", F.concat(F.lit("factor="), F.col("unit_factor").cast("string")), F.when(urine & ~(reported & ~reverse), F.concat(F.lit(f"mode={mode}; group="), F.col("_group"))), F.when(F.col("_kind") == "molar", F.concat(F.lit("molar_mass="), molar.cast("string"))))),
            **{c: F.col(c) * F.coalesce("unit_factor", F.lit(1.0)) for c in SCALED},
        },
    )
    return out.drop("_unit", "_kind", "_group")


def point_estimate(df: DataFrame) -> DataFrame:
    """Adds point_value and point_source: the first of geometric mean, median and mean that is reported."""
    names = ["initial_gm", "initial_median", "initial_mean"]
    source = F.coalesce(*[F.when(F.col(c).isNotNull(), c) for c in names])
    return df.withColumns({"point_value": F.coalesce(*names), "point_source": source})


def has_input(df: DataFrame) -> DataFrame:
    """One row: how many records report any statistic; raises if no such column exists."""
    names = [c for c in df.columns if c.startswith("initial_")]
    if not names:
        raise ValueError("no initial_* column")
    any_of = F.coalesce(*[F.col(c).cast("string") for c in names]).isNotNull()
    return df.agg(F.count("*").alias("n_records"), F.count_if(any_of).alias("n_reported"))
