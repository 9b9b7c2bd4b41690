"""Joins with tables of intervals (periods, age bands) of any length, instead of chains of conditions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def interval_faults(intervals: DataFrame, step: float = 1) -> DataFrame:
    """label, fault of intervals ``start`` to ``end``, both inclusive, of values ``step`` apart: that end before they begin, begin before an earlier one has ended, or leave a gap behind all earlier ones."""
    before = Window.orderBy("start", "end", "label").rowsBetween(Window.unboundedPreceding, -1)  # a dimension, which one task may sort
    sound = F.when(F.col("end") >= F.col("start"), F.col("end"))
    reach = F.max(sound).over(before)
    fault = F.when(F.col("end") < F.col("start"), "ends before it begins").when(F.col("start") <= reach, "overlaps").when(F.col("start") > reach + step, "gap")
    return intervals.select("label", fault.alias("fault")).where("fault IS NOT NULL")


def bin_width(intervals: DataFrame) -> float:
    """The mean length of the intervals, so that an interval spans about two bins; one value from the table of intervals."""
    r = intervals.where("end >= start").agg(F.avg(F.col("end") - F.col("start")).alias("mean")).first()
    return float(r["mean"] or 1) or 1.0


def interval_join(rows: DataFrame, value: str, intervals: DataFrame, width: float | None = None, how: str = "inner") -> DataFrame:
    """Each row with ``label``, ``start`` and ``end`` of every interval that holds its value: equality on bins of the value's axis, then the exact test.

    An interval is repeated for each bin that it touches; a row looks at one bin. ``how="left"`` keeps rows of no interval.
    """
    width = bin_width(intervals) if width is None else width
    touched = F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))
    bins = intervals.where("end >= start").select("label", "start", "end", F.explode(touched).alias("_bin"))
    placed = rows.withColumn("_at", F.floor(F.col(value) / width))
    inside = (F.col("_at") == F.col("_bin")) & F.col(value).between(F.col("start"), F.col("end"))
    return placed.join(bins, inside, how).drop("_at", "_bin")


def in_several(rows: DataFrame, key: str, value: str, intervals: DataFrame, width: float | None = None) -> DataFrame:
    """key, labels: rows that lie in two intervals or more."""
    met = interval_join(rows.select(key, value), value, intervals, width)
    return met.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("label")), ";").alias("labels"), F.countDistinct("label").alias("n")).where("n > 1").drop("n")
