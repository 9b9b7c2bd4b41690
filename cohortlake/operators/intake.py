"""Estimated daily intake from urine and blood."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.operators.pool import value_summary
from cohortlake.plans.dims import ABSORPTION, INTAKE, TURNOVER, VOLUME, lookup

NOT_CLOSED = 0.03


# Populations without parameters of their own.
NO_PARAMETERS = ["Mixed", "Unknown", ""]


def daily_intake(df: DataFrame, value: str = "gm_summary", absorption: float = ABSORPTION, volume: float = VOLUME, turnover: float = TURNOVER, parameters: dict[str, tuple] = INTAKE) -> DataFrame:
    """Adds route, edi_primary, edi_secondary, cross_check_rel_diff, edi_status and edi_flags.

    Urine has two ways, by creatinine excretion and by volume; blood is exploratory and never divided by
    body weight, as the distribution volume already is (``bw_unused`` tells where there is none); cord blood and
    populations without parameters are skipped. ``parameters``: CE, V, CC and body weight by population, any of which may be None.
    """
    if absorption <= 0 or turnover <= 0:
        raise ValueError("absorption and turnover must be positive")
    ce, v, cc, weight = (lookup(F.col("population_group"), {k: x[i] for k, x in parameters.items()}).cast("double") for i in range(4))
    x = F.when(F.col(value) > 0, F.col(value))
    urine, blood, cord = (F.col("sample_type") == s for s in ("Urine", "Blood", "CordBlood"))
    none = F.trim(F.coalesce("population_group", F.lit(""))).isin(*NO_PARAMETERS)
    primary = F.when(urine, x * ce / (weight * absorption)).when(blood & ~none, x * volume / (absorption * turnover))
    secondary = F.when(urine, x * cc * v / (weight * absorption))
    out = df.withColumns({"route": F.when(urine, "urine").when(blood, "blood").when(cord, "cord"), "edi_primary": primary, "edi_secondary": secondary})
    diff = F.abs(F.col("edi_primary") - F.col("edi_secondary")) / F.col("edi_primary")
    out = out.withColumn("cross_check_rel_diff", F.when(urine, diff))
    apart = F.coalesce(F.col("cross_check_rel_diff") > NOT_CLOSED, F.lit(False))
    coarse = F.col("population_group").isin("Elderly", "Minors")
    status = F.when(cord | F.col("route").isNull(), "SKIP").when(urine & ce.isNull() | blood & none, "SKIP").when(F.col("edi_primary").isNull(), "FAILED").when(blood | apart, "WARN").otherwise("OK")
    flags = F.concat_ws(";", F.when(urine & apart, "inconsistent_param"), F.when(urine & coarse & ce.isNotNull(), "coarse_age"), F.when(blood & ~none, "exploratory_reconstruction"), F.when(blood & ~none & weight.isNull(), "bw_unused"), F.when(cord, "cordblood_edi_skipped"))
    return out.withColumns({"edi_status": status, "edi_flags": flags})


def absorption_range(df: DataFrame, values: list[float], dims: list[str]) -> DataFrame:
    """Range of the mean intake over the absorption values; one pass, as intake is proportional to 1/absorption."""
    with_edi = daily_intake(df, absorption=1.0).where("edi_primary IS NOT NULL AND sample_size > 0")
    base = with_edi.groupBy(*dims).agg(F.exp(F.sum(F.col("sample_size") * F.ln("edi_primary")) / F.sum("sample_size")).alias("unit_edi"))
    return base.select(*dims, (F.col("unit_edi") / max(values)).alias("edi_low"), (F.col("unit_edi") / min(values)).alias("edi_high"))


def intake_summary(df: DataFrame, dims: list[str], **parameters) -> DataFrame:
    """Per stratum of the daily intakes: gm, gsd, weighted P05, P25, P50, P75, P95, upper median and counts."""
    return value_summary(daily_intake(df, **parameters).where("edi_primary IS NOT NULL"), dims, "edi_primary", [0.05, 0.25, 0.5, 0.75, 0.95])


def intake_table(df: DataFrame, routes: list[str] | None = None, **parameters) -> DataFrame:
    """The intake of each record, of some routes (urine, blood, cord) only if given."""
    out = daily_intake(df, **parameters)
    if routes is None:
        return out
    if unknown := {*routes} - {"urine", "blood", "cord"}:
        raise ValueError(f"unknown routes {sorted(unknown)}")
    return out.where(F.col("route").isin(*routes))
