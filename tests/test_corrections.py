"""Corrections in any order of batches give the table that pooling the last versions gives."""

import random

import pytest

from cohortlake.operators.pool import pool
from cohortlake.streaming.corrections import corrected_table, follow_corrections

SCHEMA = "record_id string, version long, withdrawn boolean, sample_type string, region string, sampling_year int, study_no string, gm_summary double, sample_size int"


def versions():
    dice = random.Random(8)
    out = []
    for i in range(60):
        for version in range(1, dice.randint(2, 4)):
            out.append((f"R{i}", version, dice.random() < 0.15, dice.choice("UB"), dice.choice(["N", None, "S"]), 1996, "s", dice.choice([None, 0.0, *[dice.uniform(1, 90)] * 4]), dice.choice([0, 5, 9])))
    return out + [out[0]]


@pytest.mark.parametrize("seed", [0, 1])
def test_any_order_of_batches(spark, tmp_path, seed):
    rows = versions()
    random.Random(seed).shuffle(rows)
    for k in range(3):
        spark.createDataFrame(rows[k::3], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    dims = ["sample_type", "region"]
    query = follow_corrections(stream, dims, str(tmp_path / "sums"), str(tmp_path / "checkpoint"))
    query.awaitTermination(200)
    assert query.exception() is None and len(query.recentProgress) >= 3
    last = {}
    for r in rows:
        if r[1] >= last.get(r[0], r)[1]:
            last[r[0]] = r
    want = pool(spark.createDataFrame([r for r in last.values() if not r[2]], SCHEMA), dims)
    got = {(r["sample_type"], r["region"]): r for r in corrected_table(spark, str(tmp_path / "sums"), dims).collect()}
    want = {(r["sample_type"], r["region"]): r for r in want.collect()}
    assert set(got) == set(want)
    for key, r in want.items():
        assert got[key]["gm"] == pytest.approx(r["gm"]) and got[key]["record_count"] == r["record_count"] and got[key]["total_sample_size"] == pytest.approx(r["total_sample_size"])
