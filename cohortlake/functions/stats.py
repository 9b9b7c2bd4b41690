"""Scalar statistics as SQL text and columns; no Python runs on rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Coefficients of Wichura's algorithm AS 241 (1988), highest power first.
_CENTRE = (
    [2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4, 1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080e0],
    [5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4, 5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0],
)
_MIDDLE = (
    [7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e0, 3.64784832476320460504e0, 5.76949722146069140550e0, 4.63033784615654529590e0, 1.42343711074968357734e0],
    [1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1, 6.89767334985100004550e-1, 1.67638483018380384940e0, 2.05319162663775882187e0, 1.0],
)
_TAIL = (
    [2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2, 2.96560571828504891230e-1, 1.78482653991729133580e0, 5.46378491116411436990e0, 6.65790464350110377720e0],
    [2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4, 1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0],
)


def _horner(coefficients: list[float], x: str) -> str:
    out = f"CAST({coefficients[0]!r} AS DOUBLE)"
    for c in coefficients[1:]:
        out = f"({out} * {x} + CAST({c!r} AS DOUBLE))"
    return out


def _ratio(pair: tuple[list[float], list[float]], x: str) -> str:
    return f"{_horner(pair[0], x)} / {_horner(pair[1], x)}"


def norm_ppf_sql(p: str) -> str:
    """Standard normal quantile of ``p`` in (0, 1), null outside; runs alike on Spark and other SQL engines."""
    q = f"({p} - 0.5)"
    r = f"sqrt(-ln(CASE WHEN {q} < 0 THEN {p} ELSE 1 - {p} END))"
    tail = f"CASE WHEN {r} <= 5 THEN {_ratio(_MIDDLE, f'({r} - 1.6)')} ELSE {_ratio(_TAIL, f'({r} - 5)')} END"
    return f"CASE WHEN {p} > 0 AND {p} < 1 THEN CASE WHEN abs({q}) <= 0.425 THEN {q} * {_ratio(_CENTRE, f'(0.180625 - {q} * {q})')} WHEN {q} < 0 THEN -({tail}) ELSE {tail} END END"


def xi_sql(n: str) -> str:
    """Width in standard deviations of the expected range of n values."""
    p = f"((CAST({n} AS DOUBLE) - 0.375) / (CAST({n} AS DOUBLE) + 0.25))"
    return f"CASE WHEN {n} > 0 THEN abs(2 * {norm_ppf_sql(p)}) END"


def quartile_width_sql(n: str) -> str:
    """Width of the expected quartile range of n values, by the formula of the cited paper."""
    p = f"((0.75 * CAST({n} AS DOUBLE) - 0.125) / (CAST({n} AS DOUBLE) + 0.25))"
    return f"CASE WHEN {n} > 0 THEN 2 * {norm_ppf_sql(p)} END"


def settled(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Adds (or replaces) columns behind a generator of one row. Filters and later projections then take their values and aren't
    rewritten in terms of what they are made from, which grows exponentially over long chains of conditions."""
    return df.select(*[c for c in df.columns if c not in new], F.inline(F.array(F.struct(*[v.alias(k) for k, v in new.items()]))))


def with_quantile(df: DataFrame, p: Column, name: str) -> DataFrame:
    """Adds the standard normal quantile of ``p``. In steps, each of which is used more than once, so that the optimizer keeps them apart.

    No step can be null, so that the generated code holds no tests for it and stays short enough to be compiled.
    """
    a, b, c, d = (f"_{k}_{name}" for k in "pqcr")
    df = df.withColumn(a, F.coalesce(p.cast("double"), F.lit(0.0)))
    df = df.withColumns({b: F.col(a) - 0.5, d: F.sqrt(F.coalesce(-F.ln(F.least(F.col(a), 1 - F.col(a))), F.lit(0.0)))})
    df = df.withColumns({c: 0.180625 - F.col(b) * F.col(b), f"{d}m": F.col(d) - 1.6, f"{d}t": F.col(d) - 5})
    ratio = lambda pair, x: f"coalesce({_ratio(pair, x)}, 0D)"
    size = f"CASE WHEN {d} <= 5 THEN {ratio(_MIDDLE, d + 'm')} ELSE {ratio(_TAIL, d + 't')} END"
    z = f"CASE WHEN {a} > 0 AND {a} < 1 THEN CASE WHEN abs({b}) <= 0.425 THEN {b} * {ratio(_CENTRE, c)} ELSE sign({b}) * {size} END END"
    return df.withColumn(name, F.expr(z)).drop(a, b, c, d, f"{d}m", f"{d}t")


def with_widths(df: DataFrame, n: str = "sample_size") -> DataFrame:
    """Adds range_width and quartile_width: expected widths in standard deviations; null without a sample size."""
    size = F.when(F.col(n) > 0, F.col(n).cast("double"))
    df = with_quantile(df, (size - 0.375) / (size + 0.25), "range_width")
    df = with_quantile(df, (0.75 * size - 0.125) / (size + 0.25), "quartile_width")
    return df.withColumns({"range_width": F.abs(2 * F.col("range_width")), "quartile_width": 2 * F.col("quartile_width")})


def gm_of(mean: Column, sd: Column) -> Column:
    """Geometric mean of a lognormal with this mean and standard deviation; null if it has none."""
    return F.when((mean > 0) & (sd >= 0), mean / F.sqrt(1 + (sd / mean) * (sd / mean)))


def gsd_of(mean: Column, sd: Column) -> Column:
    return F.when((mean > 0) & (sd >= 0), F.exp(F.sqrt(F.ln(1 + (sd / mean) * (sd / mean)))))


def trend(a: Column, b: Column, flat: float = 0.05) -> Column:
    change = (b - a) / a
    return F.when(a.isNull() | b.isNull() | (a <= 0), "?").when(change < -flat, "↓").when(change > flat, "↑").otherwise("→")
