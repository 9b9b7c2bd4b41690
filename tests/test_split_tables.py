"""Quoted tables read in splits of any size, against the csv module."""

import csv
import random

import pytest

from cohortlake.sources.bibliography import read_table
from cohortlake.sources.contract import read_records
from cohortlake.sources.split_tables import numbered_across, read_split_table


@pytest.fixture(scope="module")
def export(tmp_path_factory):
    dice = random.Random(3)
    pieces = ["a", "b c", '"', "\n", ",", "é", "\n\n", '""', "  x", "日本"]
    rows = [[str(i), "".join(dice.choices(pieces, k=dice.randint(0, 9))), dice.choice(["", "plain", 'two\nlines'])] for i in range(400)]
    rows[7][1] = "long\n" * 500
    folder = tmp_path_factory.mktemp("export")
    for name, part in (("a.csv", rows[:300]), ("b.csv", rows[300:])):
        with open(folder / name, "w", encoding="utf-8", newline="") as f:
            f.write("﻿" if name == "a.csv" else "")
            writer = csv.writer(f, lineterminator="\n", quoting=csv.QUOTE_MINIMAL if name == "a.csv" else csv.QUOTE_ALL)
            writer.writerow(["id", " Title ", "note"])
            for k, r in enumerate(part):
                writer.writerow(r)
                f.write("\n" * (k % 50 == 0))  # blank lines between records
    return str(folder), rows


@pytest.mark.parametrize("size", [300, 1 << 27])
def test_any_split_size_gives_the_same_records(spark, export, size):
    folder, rows = export
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in kept:
            spark.conf.set(k, str(size))
        table = read_split_table(spark, folder)
        assert table.columns == ["id", "Title", "note", "_file", "_number"]
        got = sorted(((r["number"], r["id"], r["Title"] or "", r["note"] or "") for r in numbered_across(table).collect()))
        assert got == [(i + 1, *r) for i, r in enumerate(rows)]
        assert size > 1000 or spark.read.text(folder).rdd.getNumPartitions() > 3
        raw = read_table(spark, folder, "S").orderBy("record_id")
        assert [r["record_id"] for r in raw.collect()] == [f"S-{i:05d}" for i in range(1, 401)]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_headers_must_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,title\n1,x\n")
    (tmp_path / "b.csv").write_text("id,name\n1,x\n")
    with pytest.raises(ValueError):
        read_split_table(spark, str(tmp_path))


def test_only_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("record_id,sample_size\n")
    assert read_records(spark, str(tmp_path)).count() == 0
