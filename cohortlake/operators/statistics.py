"""From reported statistics to geometric means, with formula, path, flags and status of each record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.stats import gm_of, gsd_of, settled, with_widths
from cohortlake.plans.dims import FLAG_RULES, KNOWN_FLAGS

MAX_CV = 2.0


def spread(df: DataFrame) -> DataFrame:
    """Adds sd_S1 ... sd_S7: standard deviations by each formula; null where it degenerates."""
    df = with_widths(df)
    width, iqr = F.col("initial_max") - F.col("initial_min"), F.col("initial_p75") - F.col("initial_p25")
    by = lambda c, w: F.when((w > 0) & (c > 0), c / w)
    xi, quartiles = F.col("range_width"), F.col("quartile_width")
    one = F.lit(1.0)
    sds = {"S1": by(width, xi), "S2": by(width, xi), "S3": by(width, one) / 1.9079, "S4": by(iqr, xi), "S5": by(iqr, xi), "S6": by(iqr, one) / 1.349, "S7": by(iqr, quartiles)}
    return df.withColumns({f"sd_{k}": v for k, v in sds.items()}).drop("range_width", "quartile_width")


def _choice(kind: str, path: str, centre: Column | None = None, sd: Column | None = None, formula: str = "none", warn: Column | None = None) -> Column:
    null = F.lit(None).cast("double")
    return F.struct(F.lit(kind).alias("kind"), F.lit(path).alias("path"), F.lit(formula).alias("formula"), (null if centre is None else centre).alias("centre"), (null if sd is None else sd).alias("sd"), F.coalesce(F.lit(False) if warn is None else warn, F.lit(False)).alias("warn"))


def to_gm(df: DataFrame, median_strategy: str = "as_gm", iqr_formula: str = "S4") -> DataFrame:
    """Adds gm_summary, gsd_summary, formula, stat_path and stat_status.

    First the statistic's type chooses the way, the centre and the spread; then all estimates take one formula.
    """
    if median_strategy not in ("as_gm", "via_wan"):
        raise ValueError(f"unknown strategy {median_strategy}")
    if iqr_formula not in ("S4", "S7"):
        raise ValueError(f"unknown formula {iqr_formula}")
    columns = df.columns
    df = spread(df)
    c = {x: F.col(f"initial_{x}") for x in ("gm", "gsd", "mean", "sd", "median", "p25", "p75", "min", "max")}
    st, n = F.col("stat_type"), F.col("sample_size")
    both = lambda a, b: c[a].isNotNull() & c[b].isNotNull()
    failed = lambda path: _choice("failed", path)

    def by_size(origin: str, centre: Column, sized: str, unsized: str, warn: Column | None = None) -> Column:
        one = lambda s, w=None: _choice("estimate", f"{origin}→Wan_{s}→GM", centre, F.col(f"sd_{s}"), f"Wan_{s}", w)
        return F.when(n > 0, one(sized, warn)).otherwise(one(unsized))

    reported = F.when(c["gm"].isNull(), failed("reported_GM")).otherwise(_choice("reported", "reported_GM", c["gm"], c["gsd"]))
    mean_sd = _choice("estimate", "AM_SD→AMSD_to_LN→GM", c["mean"], c["sd"], "AMSD", c["sd"] > MAX_CV * c["mean"])
    middle = F.coalesce(c["median"], (c["p25"] + c["p75"]) / 2)
    if median_strategy == "as_gm":
        quartiles = _choice("as_gm", "Median_IQR→Median_as_GM→GM", middle, None, "Median_as_GM")
        ranged = _choice("as_gm", "Median_Range→Median_as_GM→GM", c["median"], None, "Median_as_GM")
    else:
        quartiles = by_size("Median_IQR", middle, iqr_formula, "S6", n < 25)
        ranged = by_size("Median_Range", c["median"], "S2", "S3")
    min_max = F.when(c["mean"].isNotNull(), by_size("Min_Max", c["mean"], "S1", "S3")).when(c["median"].isNotNull(), by_size("Min_Max", c["median"], "S2", "S3")).otherwise(failed("Min_Max→GM"))
    choice = (
        F.when(st.isin("GM_GSD", "GM_only"), reported)
        .when((st == "AM_SD") & (c["mean"].isNull() | c["sd"].isNotNull()) | both("mean", "sd"), mean_sd)
        .when(st.isin("Median_IQR", "P25_P75") | c["median"].isNotNull() & both("p25", "p75"), F.when(both("p25", "p75"), quartiles).otherwise(failed("Median_IQR→GM")))
        .when((st == "Median_Range") | c["median"].isNotNull() & both("min", "max"), F.when(both("min", "max") & c["median"].isNotNull(), ranged).otherwise(failed("Median_Range→GM")))
        .when(st == "Min_Max", min_max)
        .when(st == "Median_only", failed("Median_only→FAILED"))
        .otherwise(failed("unknown→FAILED"))
    )
    out = settled(df, {"_r": choice}).select(*columns, *[F.col(f"_r.{k}").alias(f"_{k}") for k in ("kind", "path", "formula", "centre", "sd", "warn")])
    # A standard deviation of zero is a valid report; an estimate of zero is none, and is null above.
    good = (F.col("_centre") > 0) & (F.col("_sd") >= 0)
    estimate = F.col("_kind") == "estimate"
    ok = F.when(estimate, good).otherwise(F.col("_kind") != "failed")
    new = {
        "gm_summary": F.when(F.col("_ok"), F.when(estimate, gm_of(F.col("_centre"), F.col("_sd"))).otherwise(F.col("_centre"))),
        "gsd_summary": F.when(F.col("_ok"), F.when(estimate, gsd_of(F.col("_centre"), F.col("_sd"))).otherwise(F.col("_sd"))),
        "formula": F.when(F.col("_ok"), F.col("_formula")).otherwise("none"),
        "stat_path": F.col("_path"),
        "stat_status": F.when(~F.col("_ok"), "FAILED").when(F.col("_warn"), "WARN").when(estimate, "OK").otherwise("SKIP"),
    }
    return settled(settled(out, {"_ok": F.coalesce(ok, F.lit(False))}), new).select(*[c for c in columns if c not in new], *new)


def derive_flags(path: Column) -> Column:
    """Flags that a conversion path gives; a path that ends in a reported value keeps those of units only."""
    rules = lambda keep: F.array_distinct(F.flatten(F.filter(F.array(*[F.when(path.contains(piece), F.array(*map(F.lit, flags))) for piece, flags in FLAG_RULES if keep(piece)]), lambda x: x.isNotNull())))
    volume = F.when(path.contains("ug/g Cr") & path.endswith("ug/L"), F.array(F.lit("unit_converted_volume"))).otherwise(F.array().cast("array<string>"))
    none = F.array().cast("array<string>")
    return F.when(path.isNull() | path.isin("reported_GM", "reported_creatinine_corrected"), none).when(path.endswith("reported_GM"), rules(lambda p: p in ("ICRP89", "nmol/L"))).otherwise(F.array_union(rules(lambda p: True), volume))


def standardize(df: DataFrame, median_strategy: str = "as_gm", iqr_formula: str = "S4") -> DataFrame:
    """Chains the paths of unit and statistic and adds conversion_path, inferred_flags and status; failed records keep their path and lose their mean."""
    out = to_gm(df, median_strategy, iqr_formula)
    worst = F.when((F.col("unit_status") == "FAILED") | (F.col("stat_status") == "FAILED"), "FAILED").when((F.col("unit_status") == "WARN") | (F.col("stat_status") == "WARN"), "WARN").when((F.col("unit_status") == "SKIP") & (F.col("stat_status") == "SKIP"), "SKIP").otherwise("OK")
    out = settled(out, {"conversion_path": F.concat_ws("→", "unit_path", "stat_path"), "status": worst})
    return settled(out, {"inferred_flags": derive_flags(F.col("conversion_path")), **{c: F.when(F.col("status") != "FAILED", F.col(c)) for c in ("gm_summary", "gsd_summary")}})


def flag_hits(df: DataFrame) -> DataFrame:
    """One row for each record and flag."""
    return df.select("record_id", F.explode("inferred_flags").alias("flag"))


def flag_rules(df: DataFrame) -> DataFrame:
    """record_id, flag, rule: by which piece of its path each flag of a record comes, the first that gives it; ``<none>`` for paths without inference."""
    path = F.trim(F.coalesce("conversion_path", F.lit("")))
    unit = ("ICRP89", "nmol/L")
    reported = path.endswith("reported_GM")
    hits = [F.when(path.contains(piece) & (~reported | F.lit(piece in unit)), F.struct(F.lit(flag).alias("flag"), F.lit(piece).alias("rule"), F.lit(i).alias("i"))) for i, (piece, flags) in enumerate(FLAG_RULES) for flag in flags]
    hits.append(F.when(~reported & path.contains("ug/g Cr") & path.endswith("ug/L"), F.struct(F.lit("unit_converted_volume").alias("flag"), F.lit("ug/g Cr→ug/L").alias("rule"), F.lit(len(FLAG_RULES)).alias("i"))))
    none = F.array(F.struct(F.lit("<none>").alias("flag"), path.alias("rule"), F.lit(-1).alias("i")))
    found = F.filter(F.array(*hits), lambda x: x.isNotNull())
    found = F.when(path.isin("reported_GM", "reported_creatinine_corrected") | (reported & (F.size(found) == 0)), none).otherwise(found)
    each = settled(df.select("record_id", path.alias("conversion_path")), {"_h": found}).select("record_id", F.explode("_h").alias("h"))
    return each.groupBy("record_id", "h.flag").agg(F.min_by("h.rule", "h.i").alias("rule"))


def flag_set(flags: Column) -> Column:
    """The flags of a ``;`` list, trimmed."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(flags, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != ""))


def unknown_flags(flags: Column) -> Column:
    """Flags of a ``;`` list that the closed set lacks."""
    return F.array_except(flag_set(flags), F.array(*map(F.lit, KNOWN_FLAGS)))


def flag_mismatch(df: DataFrame) -> DataFrame:
    """record_id, missing, surplus: stored flags against those that the path gives, where the sets differ."""
    stored, derived = flag_set(F.col("inferred_flags")), derive_flags(F.col("conversion_path"))
    both = settled(df.select("record_id", "inferred_flags", "conversion_path"), {"_s": stored, "_d": derived})
    text = lambda a, b: F.array_join(F.array_sort(F.array_except(a, b)), ";")
    return both.select("record_id", text("_d", "_s").alias("missing"), text("_s", "_d").alias("surplus")).where("missing <> '' OR surplus <> ''")
