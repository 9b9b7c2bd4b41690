"""Queries that read the record view once: what they return reads only what was written from it."""

import pytest

from cohortlake import queries, queries_contract, queries_distributed, queries_review  # noqa: F401

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["contract_findings", "leave_one_out", "dedup_strategies", "weighted_quantiles", "intake_summary"])
def test_the_view_is_not_read_again(spark, name):
    plan = queries.QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey") == 0 and "Relation" in plan


@pytest.mark.parametrize("name", ["pool_standardized", "sensitivity", "flag_derivation", "robustness_grades", "strata_drift"])
def test_one_scan(spark, name):
    plan = queries.QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    scans = plan.count("Relation [l_orderkey")
    assert scans == (3 if name == "strata_drift" else 1)


def test_quantiles_have_no_window_over_values(spark):
    """Windows sort bins of a histogram or ranges of few rows, never a stratum's values."""
    from pyspark.sql import functions as F

    from cohortlake.operators.selection import select_values

    rows = spark.range(5000).select(F.lit("a").alias("s"), F.col("id").cast("double").alias("v"), F.lit(1.0).alias("w"), F.lit(1).cast("long").alias("k"))
    out = select_values(rows, ["s"], {"q": 0.5 * F.col("w")}, few=10, bins=8)
    assert out.first()["q"] == 2499.0
