"""Pooled strata kept up to date by signed contributions: what left the record table counts minus, what came counts plus.

Sums of strata are mergeable, so that only strata with a net change are touched; the records of both states meet
once, by record and content, and what both have cancels there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.operators.pool import poolable

SUMS = ["swl", "sw", "n"]


def stratum_sums(df: DataFrame, dims: list[str], value: str = "gm_summary", weight: str = "sample_size") -> DataFrame:
    """dims, swl, sw, n: what is kept of each stratum."""
    return poolable(df, dims, value, weight).groupBy(*dims).agg(F.sum(F.col("w") * F.ln("v")).alias("swl"), F.sum("w").alias("sw"), F.count("*").alias("n"))


def signed_contributions(old: DataFrame, new: DataFrame, dims: list[str], value: str = "gm_summary", weight: str = "sample_size") -> DataFrame:
    """record_id, dims, v, w, sign: the net changes; a record whose content stays, moves or repeats cancels as often as both states hold it."""
    side = lambda df, sign: poolable(df, dims, value, weight).select("record_id", *dims, "v", "w", F.lit(sign).alias("sign"))
    both = side(old, -1).unionByName(side(new, 1))
    return both.groupBy("record_id", *dims, "v", "w").agg(F.sum("sign").alias("sign")).where("sign <> 0")


def stratum_deltas(changes: DataFrame, dims: list[str]) -> DataFrame:
    """dims and the change of each sum."""
    w = F.col("sign") * F.col("w")
    return changes.groupBy(*dims).agg(F.sum(w * F.ln("v")).alias("swl"), F.sum(w).alias("sw"), F.sum("sign").alias("n"), F.count("*").alias("n_changes"))


def updated_strata(sums: DataFrame, deltas: DataFrame, dims: list[str]) -> DataFrame:
    """dims, gm_before, gm_after, n_before, n_after, n_changes of touched strata only; a stratum that came or went has no mean before or after."""
    theirs = deltas.select(*[F.col(d).alias(f"_{d}") for d in dims], *[F.col(s).alias(f"d_{s}") for s in SUMS], "n_changes")
    same = reduce(lambda a, b: a & b, [F.col(d).eqNullSafe(F.col(f"_{d}")) for d in dims])
    met = theirs.join(sums, same, "left")
    before = {s: F.coalesce(F.col(s), F.lit(0)) for s in SUMS}
    after = {s: before[s] + F.col(f"d_{s}") for s in SUMS}
    mean = lambda of: F.when(of["n"] > 0, F.exp(of["swl"] / F.nullif(of["sw"], F.lit(0.0))))
    return met.select(*[F.col(f"_{d}").alias(d) for d in dims], mean(before).alias("gm_before"), mean(after).alias("gm_after"), before["n"].alias("n_before"), after["n"].alias("n_after"), "n_changes")


def merged_sums(sums: DataFrame, deltas: DataFrame, dims: list[str]) -> DataFrame:
    """The sums to keep after the changes; empty strata go."""
    every = sums.select(*dims, *SUMS).unionByName(deltas.select(*dims, *SUMS))
    return every.groupBy(*dims).agg(*[F.sum(s).alias(s) for s in SUMS]).where("n > 0")
