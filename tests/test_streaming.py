import pytest

from cohortlake.operators.pool import pool
from cohortlake.streaming.incremental import follow, merged


def test_micro_batches_give_the_pooled_table(spark, tmp_path):
    rows = [(str(i), "s", "U" if i % 3 else "B", 1995, float(i + 1), i % 4) for i in range(40)]
    df = spark.createDataFrame(rows, "record_id string, study_no string, sample_type string, sampling_year int, gm_summary double, sample_size int")
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = follow(stream, ["sample_type"], str(tmp_path / "sums"), str(tmp_path / "checkpoint"))
    query.awaitTermination(120)
    got = {r["sample_type"]: r for r in merged(spark.read.parquet(str(tmp_path / "sums")), ["sample_type"]).collect()}
    for r in pool(df, ["sample_type"]).collect():
        assert got[r["sample_type"]]["gm"] == pytest.approx(r["gm"]) and got[r["sample_type"]]["record_count"] == r["record_count"]
