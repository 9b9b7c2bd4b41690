"""Selection by histograms in rounds against sorting."""

import random

import pytest
from pyspark.sql import functions as F

from cohortlake.operators import pool
from cohortlake.operators.selection import select_values

PROBS = [0.0001, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


def brute(values, p):
    total, seen = sum(w for _, w in values), 0.0
    for v, w in sorted(values):
        seen += w
        if seen >= p * total:
            return v
    return max(v for v, _ in values)


def strata():
    dice = random.Random(4)
    return {
        "even": [(dice.uniform(1, 2), dice.randint(1, 9)) for _ in range(600)],
        "wide": [(10 ** dice.uniform(-300, 300), dice.randint(1, 9)) for _ in range(600)],
        "ties": [(float(dice.randint(1, 4)), dice.randint(1, 9)) for _ in range(600)],
        "near": [(1 + dice.randint(0, 40) * 2**-52, 1) for _ in range(600)],
        "steps": [(2.0**-i, 1 + i % 3) for i in range(400)],
        "one": [(3.5, 2)],
        "heavy": [(dice.uniform(0, 1), 1) for _ in range(300)] + [(0.5, 10_000)],
    }


@pytest.mark.parametrize(("few", "bins"), [(20_000, 1024), (5, 16), (1, 2)])
def test_weighted_selection(spark, few, bins):
    data = strata() if bins > 2 else {k: v[:60] for k, v in strata().items() if k in ("even", "ties", "near", "one")}
    rows = [(name, v, float(w), 1) for name, values in data.items() for v, w in values]
    needs = {f"q{i}": p * F.col("w") for i, p in enumerate(PROBS)}
    out = select_values(spark.createDataFrame(rows, "stratum string, v double, w double, k long").repartition(5), ["stratum"], needs, {"median": F.floor(F.col("k") / 2) + 1}, few=few, bins=bins)
    got = {r["stratum"]: r for r in out.collect()}
    assert set(got) == set(data)
    for name, values in data.items():
        assert [got[name][f"q{i}"] for i in range(len(PROBS))] == [brute(values, p) for p in PROBS], name
        assert got[name]["median"] == sorted(v for v, _ in values)[len(values) // 2]


def test_no_rows_and_null_strata(spark):
    schema = "stratum string, v double, w double, k long"
    assert select_values(spark.createDataFrame([], schema), ["stratum"], {"q": 0.5 * F.col("w")}).collect() == []
    rows = [(None, float(i), 1.0, 1) for i in range(50)] + [("a", 1.0, 1.0, 1)]
    got = {r["stratum"]: r["q"] for r in select_values(spark.createDataFrame(rows, schema), ["stratum"], {"q": 0.5 * F.col("w")}, few=3, bins=4).collect()}
    assert got == {None: 24.0, "a": 1.0}


def test_quantiles_in_rounds_sort_no_stratum(spark):
    dice = random.Random(1)
    rows = [("Urine", "s", dice.uniform(1, 900), dice.randint(1, 50)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "sample_type string, study_no string, gm_summary double, sample_size int")
    out = pool.weighted_quantiles(df, ["sample_type"], [0.05, 0.5], few=20)
    exact = [brute([(v, w) for _, _, v, w in rows], p) for p in (0.05, 0.5)]
    r = out.first()
    assert [r["p05"], r["p50"]] == exact
    summary = pool.value_summary(df, ["sample_type"], "gm_summary", [0.5], few=20).first()
    assert summary["p50"] == exact[1] and summary["n"] == 3000 and summary["median"] == sorted(v for _, _, v, _ in rows)[1500]
