"""Exact weighted selection in rounds: no stratum, however large, is sorted by one task.

Asked for are values at which a stratum's cumulative weight (or count) first reaches a need. Each round lays a
histogram over the range that a value is still known to lie in, one for each stratum and need, with the weight, the smallest and
the largest value of each bin; it combines before the shuffle. Prefix sums over the bins, of which there are
``BINS`` at most, name the one bin that holds the value, and the next round looks at what that bin's values span.
A bin of one value is the answer, however many rows share it; a range of few rows is sorted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.tables import written

BINS = 1024
FEW = 20_000  # rows that one window may sort


def _matched(rows: DataFrame, state: DataFrame, dims: list[str]) -> DataFrame:
    """Each row with every need of its stratum whose range holds it; ``s`` is what is summed for it."""
    per = state.groupBy(*[F.col(d).alias(f"_{d}") for d in dims]).agg(F.collect_list(F.struct("name", "counts", "need", "low", "high", "below")).alias("needs"))  # as many as there are needs
    same = reduce(lambda a, b: a & b, [F.col(d).eqNullSafe(F.col(f"_{d}")) for d in dims], F.lit(True))
    near = F.filter("needs", lambda t: F.col("v").between(t["low"], t["high"]))
    met = rows.join(per, same).select(*dims, "v", "w", "k", F.inline(near))
    return met.withColumn("s", F.when(F.col("counts"), F.col("k").cast("double")).otherwise(F.col("w")))


def _narrowed(rows: DataFrame, state: DataFrame, dims: list[str], bins: int) -> DataFrame:
    """The state of the one bin of each need that holds its value."""
    low, high, v = F.col("low"), F.col("high"), F.col("v")
    # Ranges over several powers of two are cut by the logarithm, narrower ones evenly; both rise with the value.
    share = F.when((low > 0) & (high > 2 * low), (F.ln(v) - F.ln(low)) / F.nullif(F.ln(high) - F.ln(low), F.lit(0.0))).otherwise((v - low) / F.nullif(high - low, F.lit(0.0)))
    met = _matched(rows, state, dims).withColumn("bin", F.least(F.floor(share * bins), F.lit(bins - 1)))
    sums = met.groupBy(*dims, "name", "counts", "need", "below", "bin").agg(F.sum("s").alias("s"), F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n"))
    over = Window.partitionBy(*dims, "name").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    run = sums.withColumn("reached", F.col("below") + F.sum("s").over(over))
    at = F.struct((F.col("reached") - F.col("s")).alias("below"), "low", "high", "n")
    # Rounding may leave the last bin short of a need for everything: then it is the last one.
    chosen = F.coalesce(F.min_by(at, F.when(F.col("reached") >= F.col("need"), F.col("bin"))), F.max_by(at, "bin"))
    return run.groupBy(*dims, "name", "counts", "need").agg(chosen.alias("at")).select(*dims, "name", "counts", "need", "at.below", "at.low", "at.high", "at.n")


def _sorted(rows: DataFrame, state: DataFrame, dims: list[str]) -> DataFrame:
    """The values of needs whose range holds few rows."""
    over = Window.partitionBy(*dims, "name").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    run = _matched(rows, state, dims).withColumn("reached", F.col("below") + F.sum("s").over(over))
    return run.groupBy(*dims, "name").agg(F.coalesce(F.min(F.when(F.col("reached") >= F.col("need"), F.col("v"))), F.max("v")).alias("v"))


def select_values(rows: DataFrame, dims: list[str], needs: dict[str, Column], counted: dict[str, Column] | None = None, few: int = FEW, bins: int = BINS) -> DataFrame:
    """dims and one column for each need: the smallest value at which the weights (``needs``) or counts (``counted``) up to it reach it.

    ``rows``: dims, v, w, k; one row may stand for many equal values. Needs are expressions of the stratum's totals
    ``w`` and ``k``. A stratum without rows has no row in the result.
    """
    own, dims = dims, [f"_dim{i}" for i in range(len(dims))]  # names of a caller's may be ours
    rows = written(rows.select(*[F.col(c).alias(d) for c, d in zip(own, dims, strict=True)], "v", "w", "k"), "selection-rows")
    totals = rows.groupBy(*dims).agg(F.min("v").alias("low"), F.max("v").alias("high"), F.sum("w").alias("w"), F.sum("k").alias("k"), F.count("*").alias("n"))
    every = [(n, False, c) for n, c in needs.items()] + [(n, True, c) for n, c in (counted or {}).items()]
    asked = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(by).alias("counts"), c.cast("double").alias("need")) for n, by, c in every])
    state = written(totals.withColumn("asked", asked).select(*dims, "low", "high", "n", F.lit(0.0).alias("below"), F.inline("asked")), "selection-state")
    found = []
    while True:
        found.append(state.where("low = high").select(*dims, "name", F.col("low").alias("v")))
        found.append(_sorted(rows, state.where(f"low < high AND n <= {few}"), dims))
        wide = state.where(f"low < high AND n > {few}")
        if wide.isEmpty():
            break
        state = written(_narrowed(rows, wide, dims, bins), "selection-state")
    every_value = reduce(DataFrame.unionByName, found)
    out = every_value.groupBy(*dims).agg(*[F.max(F.when(F.col("name") == n, F.col("v"))).alias(n) for n, _, _ in every])
    return out.withColumnsRenamed(dict(zip(dims, own, strict=True)))
