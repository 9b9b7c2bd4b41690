"""Clusters that overlap: studies joined by any chain of shared clusters are one group, merged once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.operators.dedup import build_studies, cluster_members
from cohortlake.tables import dropped, written


def connected(links: DataFrame) -> DataFrame:
    """node, component (the smallest node that it is joined to) of links ``a``, ``b`` between texts.

    Rounds hang every node's larger neighbours, then its smaller ones, on the smallest of them, until nothing
    moves; the number of rounds grows with the logarithm of the longest chain. The driver sees a count and a checksum.
    """
    down = lambda x, y: F.struct(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
    edges = written(links.where("a <> b").select(F.inline(F.array(down(F.col("a"), F.col("b"))))).distinct(), "component-links")
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("sum")).first()
        if state == before or not state["n"]:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("top"))
        larger = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("top").alias("b")).distinct()
        top = larger.groupBy("a").agg(F.min("b").alias("top"))
        smaller = larger.join(top, "a").where("b <> top").select(F.col("b").alias("a"), F.col("top").alias("b"))
        old, edges = edges, written(smaller.unionByName(top.select("a", F.col("top").alias("b"))).distinct(), "component-links")
        dropped(old)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def cohort_groups(df: DataFrame, **least: int) -> DataFrame:
    """study_no, group_id (the smallest study of the group), n_clusters, n_records of every study; a study in no cluster is a group of its own."""
    studies = build_studies(df)
    members = written(cluster_members(studies, **least), "cluster-members")
    # A cluster is a node beside its studies, so that a large one gives as many links as it has studies, not pairs. "~" sorts behind studies.
    joined = connected(members.select(F.col("study_no").alias("a"), F.concat_ws("|", F.lit("~"), "kind", "name").alias("b"))).where("NOT startswith(node, '~|')")
    counts = members.groupBy("study_no").agg(F.count("*").alias("n_clusters"))
    out = studies.select("study_no", "n_records").join(joined.withColumnRenamed("node", "study_no"), "study_no", "left").join(counts, "study_no", "left")
    return out.select("study_no", F.coalesce("component", "study_no").alias("group_id"), F.coalesce("n_clusters", F.lit(0)).alias("n_clusters"), "n_records")


def merge_groups_impact(df: DataFrame, **least: int) -> DataFrame:
    """One row: studies, groups, records, and records if each group of two studies or more counts as one record."""
    groups = cohort_groups(df, **least).groupBy("group_id").agg(F.count("*").alias("k"), F.sum("n_records").alias("n"))
    after = F.sum(F.when(F.col("k") > 1, 1).otherwise(F.col("n")))
    return groups.agg(F.sum("k").alias("n_studies"), F.count("*").alias("n_groups"), F.sum("n").alias("records_before"), after.alias("records_after"))
