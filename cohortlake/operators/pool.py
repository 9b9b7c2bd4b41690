"""Pooling with sample-size weights. All sums combine before the shuffle; only strata, studies and bins of values cross it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.operators.selection import select_values
from cohortlake.plans.dims import PERIODS, period_of
from cohortlake.tables import written

COUNT_NOTE = "record-level sums"


def poolable(df: DataFrame, dims: list[str], value: str, weight: str, periods=PERIODS, out_of_range: str = "exclude") -> DataFrame:
    """v, w and the dims of the records that can be pooled; blank dims are UNKNOWN."""
    if out_of_range not in ("exclude", "OUT_OF_RANGE"):
        raise ValueError(f"unknown rule {out_of_range}")
    if "period" in dims and "period" not in df.columns:
        period = period_of(F.col("sampling_year"), periods)
        df = df.withColumn("period", F.coalesce(period, F.lit("OUT_OF_RANGE")) if out_of_range == "OUT_OF_RANGE" else period).where("period IS NOT NULL")
    blank = lambda d: F.when(F.trim(F.col(d)) == "", None).otherwise(F.trim(F.col(d)))
    return df.where((F.col(value) > 0) & (F.col(weight) > 0)).select(*[F.coalesce(blank(d), F.lit("UNKNOWN")).alias(d) for d in dims], F.col(value).cast("double").alias("v"), F.col(weight).cast("double").alias("w"), *[c for c in ("study_no", "record_id") if c in df.columns and c not in dims])


BIN = 0.25  # of the logarithm


def binned(rows: DataFrame, keys: list[str], count: Column | None = None) -> DataFrame:
    """Sums of v and w by key and bin of ln v (rows may stand for ``count`` values each), around the bin's lower edge: small numbers, so that nothing cancels when spreads are taken from them."""
    bin_ = F.floor(F.ln("v") / BIN)
    rows = rows.withColumns({"_bin": bin_, "_d": F.ln("v") - bin_ * BIN})
    d, w = F.col("_d"), F.col("w")
    sums = rows.groupBy(*keys, "_bin").agg(F.sum(w).alias("sw"), F.sum(w * d).alias("sd"), F.sum(w * d * d).alias("sdd"), (F.count("*") if count is None else F.sum(count)).alias("k"), F.max("w").alias("max_w"), F.min("v").alias("low"), F.max("v").alias("high"))
    return sums.withColumns({"mean": F.col("_bin") * BIN + F.col("sd") / F.col("sw"), "within": F.greatest(F.col("sdd") - F.col("sd") * F.col("sd") / F.col("sw"), F.lit(0.0))})


def spreads(bins: DataFrame, dims: list[str]) -> DataFrame:
    """Adds mu, the mean of ln v of the stratum, to each bin: a window over bins, not over records."""
    over = Window.partitionBy(*dims)
    return bins.withColumn("mu", F.sum(F.col("sw") * F.col("mean")).over(over) / F.sum("sw").over(over))


def swd() -> Column:
    """The stratum's weighted squared deviations: those within bins and those of the bins' means."""
    apart = F.col("mean") - F.col("mu")
    return F.sum(F.col("within") + F.col("sw") * apart * apart)


def pool(df: DataFrame, dims: list[str], value: str = "gm_summary", weight: str = "sample_size", periods=PERIODS, out_of_range: str = "exclude") -> DataFrame:
    """Per stratum: gm, gsd, counts, max_weight_share, error bar, confidence limits, notes and grades. One scan."""
    rows = poolable(df, dims, value, weight, periods, out_of_range)
    study = [] if "study_no" in dims else ["study_no"]
    bins = spreads(binned(rows, [*dims, *study]), dims)
    studies = F.countDistinct(F.when(F.trim("study_no") != "", F.col("study_no")))
    out = bins.groupBy(*dims).agg(F.first("mu").alias("mu"), F.sum("sw").alias("total_sample_size"), F.sum("k").alias("record_count"), studies.alias("study_count"), F.max("max_w").alias("max_w"), F.min("low").alias("low"), F.max("high").alias("high"), swd().alias("swd"))
    n, share = F.col("record_count"), F.col("max_w") / F.col("total_sample_size")
    se = F.when(n > 1, F.sqrt(F.col("swd") / ((n - 1) * F.col("total_sample_size"))))
    gm, gsd = F.exp("mu"), F.exp(F.sqrt(F.col("swd") / F.col("total_sample_size")))
    note = F.concat_ws("; ", F.when(n < 3, "fewer than 3 records"), F.when(share > 0.3, "one record over 30 % of the weight"), F.when((gm < F.col("low") - 1e-9) | (gm > F.col("high") + 1e-9), "mean outside of range"))
    return out.select(
        *dims,
        gm.alias("gm"),
        gsd.alias("gsd"),
        n,
        F.when(F.col("study_count") > 0, F.col("study_count")).otherwise(n).alias("study_count"),
        "total_sample_size",
        share.alias("max_weight_share"),
        (gm / gsd).alias("bar_low"),
        (gm * gsd).alias("bar_high"),
        (gm * F.exp(-1.96 * se)).alias("ci_low"),
        (gm * F.exp(1.96 * se)).alias("ci_high"),
        note.alias("note"),
        F.when(share < 0.1, "low").when(share <= 0.3, "moderate").otherwise("high").alias("weight_grade"),
        F.when(n >= 10, "good").when(n >= 3, "limited").otherwise("sparse").alias("record_grade"),
        F.lit(COUNT_NOTE).alias("count_note"),
    )


def exclusions(df: DataFrame, value: str = "gm_summary", weight: str = "sample_size", periods=PERIODS) -> DataFrame:
    """One row: records that pool, that lack a value or weight, and that lie outside of all periods."""
    good = (F.col(value) > 0) & (F.col(weight) > 0)
    out = period_of(F.col("sampling_year"), periods).isNull()
    return df.agg(F.count("*").alias("n_records"), F.count_if(~F.coalesce(good, F.lit(False))).alias("n_skipped"), F.count_if(good & out).alias("n_out_of_range"))


def pool_sets(df: DataFrame, fixed: str, sets: list[list[str]], value: str = "gm_summary", weight: str = "sample_size", periods=PERIODS) -> DataFrame:
    """Several groupings in one pass; ``fixed`` (the matrix) is in each of them. ``stratum`` names the dims that are grouped."""
    dims = sorted({d for s in sets for d in s})
    rows = poolable(df, [fixed, *dims], value, weight, periods)
    keys = [*sets, []] if [] not in sets else sets
    grouped = rows.groupingSets([[F.col(fixed), *[F.col(d) for d in s]] for s in keys], F.col(fixed), *[F.col(d) for d in dims])
    stratum = F.concat_ws("+", *[F.when(F.grouping(d) == 0, d) for d in dims])
    sums = grouped.agg(stratum.alias("stratum"), F.exp(F.sum(F.col("w") * F.ln("v")) / F.sum("w")).alias("gm"), F.count("*").alias("record_count"), F.sum("w").alias("total_sample_size"))
    return sums.select("stratum", fixed, *dims, "gm", "record_count", "total_sample_size")


def _named(p: float) -> str:
    return f"p{round(100 * p):02d}"


def weighted_quantiles(df: DataFrame, dims: list[str], probs: list[float], value: str = "gm_summary", weight: str = "sample_size", **limits) -> DataFrame:
    """Per stratum and probability the smallest value whose cumulative weight reaches it (no interpolation), by histograms in rounds."""
    rows = poolable(df, dims, value, weight).groupBy(*dims, "v").agg(F.sum("w").alias("w"), F.count("*").alias("k"))
    return select_values(rows, dims, {_named(p): p * F.col("w") for p in probs}, **limits)


def value_summary(df: DataFrame, dims: list[str], value: str, probs: list[float], weight: str = "sample_size", **limits) -> DataFrame:
    """Per stratum gm, gsd, n, weighted quantiles and the upper unweighted median. The values are summed by distinct value once, for the sums and for all rounds."""
    rows = written(poolable(df, dims, value, weight).groupBy(*dims, "v").agg(F.sum("w").alias("w"), F.count("*").alias("k")), "distinct-values")
    values = select_values(rows, dims, {_named(p): p * F.col("w") for p in probs}, {"median": F.floor(F.col("k") / 2) + 1}, **limits)
    bins = spreads(binned(rows, dims, F.col("k")), dims)
    sums = bins.groupBy(*dims).agg(F.exp(F.first("mu")).alias("gm"), F.exp(F.sqrt(swd() / F.sum("sw"))).alias("gsd"), F.sum("k").alias("n"), F.sum("sw").alias("total_sample_size"))
    return sums.join(values, dims)


def upper_median(df: DataFrame, dims: list[str], value: str, **limits) -> DataFrame:
    """The element n div 2 (from 0) of the sorted values, and n."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*dims, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("k"), F.lit(0.0).alias("w"))
    counts = written(counts, "distinct-values")
    medians = select_values(counts, dims, {}, {"median": F.floor(F.col("k") / 2) + 1}, **limits)
    same = [F.col(d).eqNullSafe(F.col(f"_{d}")) for d in dims]
    return medians.join(counts.groupBy(*[F.col(d).alias(f"_{d}") for d in dims]).agg(F.sum("k").alias("n")), same).select(*dims, "median", "n")


def leave_one_out(df: DataFrame, dims: list[str], value: str = "gm_summary", weight: str = "sample_size") -> DataFrame:
    """For each record the mean of its stratum without it, from the stratum's sums. What is pooled is written once, for the sums and for the records."""
    rows = written(poolable(df, dims, value, weight), "pooled-rows")
    sums = rows.groupBy(*dims).agg(F.sum(F.col("w") * F.ln("v")).alias("s"), F.sum("w").alias("t"))
    left = F.col("t") - F.col("w")
    return rows.join(sums, dims).select("record_id", *dims, F.when(left > 0, F.exp((F.col("s") - F.col("w") * F.ln("v")) / left)).alias("gm_without"))


def without_dominant(df: DataFrame, dims: list[str], value: str = "gm_summary", weight: str = "sample_size", share: float = 0.3) -> DataFrame:
    """Mean of each stratum after its heaviest record, where that holds over ``share`` of the weight."""
    rows = poolable(df, dims, value, weight)
    term = F.col("w") * F.ln("v")
    sums = rows.groupBy(*dims).agg(F.sum(term).alias("s"), F.sum("w").alias("t"), F.count("*").alias("n"), F.max(F.struct("w", F.col("record_id"), term.alias("term"))).alias("top"))
    drop = F.col("top.w") / F.col("t") > share
    left = F.col("t") - F.col("top.w")
    return sums.select(*dims, F.when(drop, F.col("top.record_id")).alias("dropped"), F.exp(F.col("s") / F.col("t")).alias("gm_all"), F.when(~drop, F.exp(F.col("s") / F.col("t"))).when(left > 0, F.exp((F.col("s") - F.col("top.term")) / left)).alias("gm"))


def inverse_variance(df: DataFrame, dims: list[str], value: str, sd: str) -> DataFrame:
    """Mean with weights 1/SE**2, SE = SD / sqrt(n); counts the records without SE."""
    se2 = F.when((F.col(sd) > 0) & (F.col("sample_size") > 0) & (F.col(value) > 0), F.col(sd) * F.col(sd) / F.col("sample_size"))
    rows = df.withColumn("_w", 1 / se2)
    return rows.groupBy(*dims).agg((F.exp(F.sum(F.col("_w") * F.ln(F.when(F.col("_w").isNotNull(), F.col(value)))) / F.sum("_w"))).alias("gm"), F.count("_w").alias("n_used"), F.count_if(F.col("_w").isNull()).alias("n_without_se"))


def period_change(pooled: DataFrame, keys: list[str], periods=PERIODS) -> DataFrame:
    """Trend labels between consecutive periods as one string; a missing period gives '?'."""
    from cohortlake.functions.stats import trend

    by = pooled.groupBy(*keys).pivot("period", [p[0] for p in periods]).agg(F.first("gm"))
    labels = [trend(F.col(f"`{a[0]}`"), F.col(f"`{b[0]}`")) for a, b in zip(periods, periods[1:], strict=False)]
    return by.select(*keys, F.concat(*labels).alias("pattern"))


def ranked(pooled: DataFrame, within: list[str], by: Column | str = "gm") -> DataFrame:
    """Adds place: rank by descending mean."""
    return pooled.withColumn("place", F.rank().over(Window.partitionBy(*within).orderBy(F.desc(by))))


def in_order(pooled: DataFrame, dims: list[str]) -> DataFrame:
    """Strata sorted by their dimensions, unknown ones last."""
    return pooled.orderBy(*[F.col(d).asc_nulls_last() for d in dims])
