"""Staleness along derivation: what was made, directly or through others, from something whose digest has changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RECURSION = """
WITH RECURSIVE reached AS (
  SELECT name, 0 AS depth, name AS origin, array(name) AS path FROM {changed}
  UNION ALL
  SELECT l.made, r.depth + 1, r.origin, array_append(r.path, l.made) FROM reached r JOIN {links} l ON l.source = r.name
  WHERE NOT array_contains(r.path, l.made))
SELECT name, min(depth) AS depth, min_by(origin, struct(depth, origin)) AS origin, count(DISTINCT origin) AS n_origins FROM reached GROUP BY name
"""


def changed_artefacts(artefacts: DataFrame, current: DataFrame) -> DataFrame:
    """name of artefacts (name, sha256) whose digest isn't the current one; a missing digest counts as changed, one that isn't current any more too."""
    now = current.select("name", F.col("sha256").alias("now"))
    return artefacts.join(now, "name", "left").where(F.coalesce(F.col("sha256") != F.col("now"), F.lit(True))).select("name").distinct()


def stale_downstream(artefacts: DataFrame, links: DataFrame, current: DataFrame) -> DataFrame:
    """name, depth, origin, n_origins: artefacts that are changed (depth 0) or derive from changed ones, by the fewest steps; of several nearest origins the first by name.

    ``links``: source, made. A cycle ends where a way comes back to an artefact that it has passed, so each
    of the cycle's members is stale once, at its least depth. Ways are followed one by one, which suits derivations of few steps
    (figures from tables from snapshots); the session's limits of recursion stop others.
    """
    spark = artefacts.sparkSession
    return spark.sql(RECURSION, changed=changed_artefacts(artefacts, current), links=links.select("source", "made").distinct())
