"""Intervals, signed changes, staleness, components, terms, messages and the clustered table on small cases and by brute force."""

import glob
import json
import math
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from cohortlake import queries, queries_distributed  # noqa: F401  registers its queries
from cohortlake.operators import components, dedup, deltas, derived, intervals, lineage, term_index
from cohortlake.plans import dims
from cohortlake.sources.clustered import write_clustered
from cohortlake.sources.doi_messages import read_doi_messages, shape_findings
from cohortlake.tables import shared_folder


def pairs(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_intervals_against_all_pairs(spark):
    dice = random.Random(1)
    table = [(f"p{i}", float(a := dice.randint(-50, 50)), a + dice.choice([0.0, 1.5, 7.0, 40.0, -1.0])) for i in range(60)]
    rows = [(i, dice.choice([None, dice.uniform(-60, 60), float(dice.randint(-60, 60))])) for i in range(200)]
    periods = spark.createDataFrame(table, "label string, start double, end double")
    values = spark.createDataFrame(rows, "id long, x double")
    want = sorted(((i, x, n) for i, x in rows for n, a, b in table if x is not None and a <= x <= b), key=str)
    for width in (None, 0.5, 1000):
        assert pairs(intervals.interval_join(values, "x", periods, width).select("id", "x", "label")) == want
    left = intervals.interval_join(values, "x", periods, how="left")
    assert left.where("label IS NULL").count() == len(rows) - len({i for i, _, _ in want})
    plan = intervals.interval_join(values, "x", periods)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    several = {r["id"]: r["labels"] for r in intervals.in_several(values, "id", "x", periods).collect()}
    assert several == {i: ";".join(sorted(ns)) for i in {i for i, _, _ in want} if len(ns := [n for j, _, n in want if j == i]) > 1}


def test_bands_hold_their_last_cent(spark, tmp_path):
    """Each value of a band's bounds and beside them, as the query's SQL has it."""
    cents = sorted({c + d for k in range(5) for c in (220000 * k - 100000, 220000 * k + 119999) for d in range(-3, 4)})
    values = [c / 100 for c in cents] + [1199.995, math.nextafter(1199.99, 2000), math.nextafter(3400.0, 0), math.nan, None]
    spark.createDataFrame([(i, v, "AB"[i % 2]) for i, v in enumerate(values)], "c_custkey long, c_acctbal double, c_mktsegment string").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame([(k, f"region {k}") for k in range(5)], "r_regionkey int, r_name string").coalesce(1).write.parquet(str(tmp_path / "region.parquet"))
    sql = duckdb.connect()
    for name in ("customer", "region"):
        sql.sql(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    want = sql.sql(queries.ORACLES["customers_by_band"]).fetchall()
    assert sum(n for *_, n in want) == sum(-100000 <= c <= 999999 for c in cents)
    assert pairs(queries.QUERIES["customers_by_band"](spark, str(tmp_path))) == sorted(want, key=str)


def test_faults_of_intervals(spark):
    table = [("a", 1990, 1999), ("inside", 1992, 1993), ("still", 1995, 1996), ("b", 2000, 2004), ("late", 2007, 2008), ("wrong", 2020, 2010)]
    got = dict(pairs(intervals.interval_faults(spark.createDataFrame(table, "label string, start int, end int"))))
    assert got == {"inside": "overlaps", "still": "overlaps", "late": "gap", "wrong": "ends before it begins"}
    assert intervals.interval_faults(spark.createDataFrame([], "label string, start int, end int")).count() == 0


def test_changes_give_what_pooling_gives(spark):
    dice = random.Random(2)
    row = lambda i: (f"R{i}", dice.choice("UB"), dice.choice(["N", " ", None]), 1996, dice.choice([None, 0.0, *[float(dice.randint(1, 9))] * 5]), dice.choice([0, 3, 4]))
    old = [row(i) for i in range(120)] + [row(3)] * 2
    new = [r if dice.random() < 0.8 else row(i) for i, r in enumerate(old) if dice.random() < 0.9] + [row(200 + i) for i in range(9)]
    schema = "record_id string, sample_type string, region string, sampling_year int, gm_summary double, sample_size int"
    a, b, dims = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), ["sample_type", "region"]
    before, after = ({(r["sample_type"], r["region"]): r for r in deltas.stratum_sums(x, dims).collect()} for x in (a, b))
    changes = deltas.stratum_deltas(deltas.signed_contributions(a, b, dims), dims)
    merged = {(r["sample_type"], r["region"]): r for r in deltas.merged_sums(deltas.stratum_sums(a, dims), changes, dims).collect()}
    assert set(merged) == set(after) and all(merged[k]["swl"] == pytest.approx(after[k]["swl"]) and merged[k]["n"] == after[k]["n"] for k in after)
    for r in deltas.updated_strata(deltas.stratum_sums(a, dims), changes, dims).collect():
        k = (r["sample_type"], r["region"])
        assert r["n_before"] == (before[k]["n"] if k in before else 0) and r["n_after"] == (after[k]["n"] if k in after else 0)
    assert deltas.signed_contributions(a, a, dims).count() == 0


def test_staleness_through_cycles_and_diamonds(spark):
    links = [("s", "t1"), ("s", "t2"), ("t1", "f"), ("t2", "f"), ("f", "g"), ("g", "t1"), ("x", "y"), ("y", "x"), ("s", "t1"), ("f", "f")]
    digests = [(n, "old" if n in ("s", "x") else None if n == "lost" else n) for n in ("s", "t1", "t2", "f", "g", "x", "y", "lost", "fine")]
    current = [(n, n) for n in ("s", "t1", "t2", "f", "g", "x", "y", "lost", "fine")]
    frames = [spark.createDataFrame(rows, schema) for rows, schema in ((digests, "name string, sha256 string"), (links, "source string, made string"), (current, "name string, sha256 string"))]
    assert pairs(lineage.stale_downstream(*frames)) == [("f", 2, "s", 1), ("g", 3, "s", 1), ("lost", 0, "lost", 1), ("s", 0, "s", 1), ("t1", 1, "s", 1), ("t2", 1, "s", 1), ("x", 0, "x", 1), ("y", 1, "x", 1)]


def test_components_of_chains_and_stars(spark):
    dice = random.Random(3)
    names = [f"n{i:03d}" for i in range(300)]
    links = [(names[i], names[i + 1]) for i in range(0, 60)] + [(names[100], n) for n in names[101:160]] + [(dice.choice(names[200:]), dice.choice(names[200:])) for _ in range(60)] + [(names[5], names[5])]
    root = {n: n for n in names}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert dict(pairs(components.connected(spark.createDataFrame(links, "a string, b string")))) == {n: find(n) for n in linked}
    assert components.connected(spark.createDataFrame([], "a string, b string")).collect() == []


def test_a_study_in_three_clusters_is_merged_once(spark):
    rows = [(f"R{i}", f"S{i}", author, city, "p", "Urine", title, 5) for i, (author, city, title) in enumerate([("A", "X", "birth cohort"), ("A", "Y", "t"), ("A", "Z", "t"), ("B", "X", "birth cohort"), ("C", "W", "t"), ("C", "V", "t")])]
    df = spark.createDataFrame(rows, "record_id string, study_no string, author string, city string, province string, sample_type string, title string, sample_size int")
    got = {r["study_no"]: (r["group_id"], r["n_clusters"]) for r in components.cohort_groups(df).collect()}
    assert got == {"S0": ("S0", 2), "S1": ("S0", 1), "S2": ("S0", 1), "S3": ("S0", 1), "S4": ("S4", 0), "S5": ("S5", 0)}
    assert components.merge_groups_impact(df).first().asDict() == {"n_studies": 6, "n_groups": 3, "records_before": 6, "records_after": 3}


def test_terms_against_patterns(spark):
    dice = random.Random(4)
    pool = ["arsenic", "Arsenical", "urine", "blood", "birth", "cohort", "Über", "x-ray", "the"]
    rows = [(i, dice.choice([None, " ".join(dice.choices(pool, k=dice.randint(0, 12)))])) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, text string")
    terms = [("agent", "arsenic*"), ("agent", "über"), ("matrix", "urine"), ("matrix", "whole blood"), ("matrix", "the blood"), ("out", "Birth Cohort"), ("out", "x-ray the*"), ("matrix", " - ")]
    word = lambda t: r"(?<![^\W_])" + r"[\W_]+".join(map(re.escape, re.findall(r"[^\W_]+", t))) + ("" if t.endswith("*") else r"(?![^\W_])")
    holds = lambda text, block: any(re.search(word(t.lower()), (text or "").lower()) for b, t in terms if b == block and re.search(r"\w", t))
    table = spark.createDataFrame(terms, "block string, term string")
    want = [i for i, t in rows if holds(t, "agent") and holds(t, "matrix") and not holds(t, "out")]
    assert 0 < len(want) < len(rows)
    assert sorted(r["id"] for r in term_index.search(df, "id", F.col("text"), table, ["out"]).collect()) == want
    only = table.where("block = 'out'")
    assert sorted(r["id"] for r in term_index.search(df, "id", F.col("text"), only, ["out"]).collect()) == [i for i, t in rows if not holds(t, "out")]


def shuffled(spark, job):
    """What the job gives, and the rows that each of its stages dealt out."""
    sc = spark.sparkContext
    tracker, bus = sc._jsc.sc().statusStore(), sc._jsc.sc().listenerBus()
    none = sc._gateway.new_array(sc._jvm.double, 0)

    def stages():
        bus.waitUntilEmpty(30_000)
        seen = tracker.stageList(None, False, False, none, None)
        return {(s.stageId(), s.attemptId()): s.shuffleWriteRecords() for s in map(seen.apply, range(seen.size()))}

    before = stages()
    out = job()
    return out, [n for stage, n in stages().items() if stage not in before]


def test_a_text_of_many_rows_is_searched_once(spark):
    texts = ["Study of red ring", "study of Blue ring", None, "red", "Study of ring red birth cohort", "red ring"]
    df = spark.range(12000).select("id", F.element_at(F.array(*map(F.lit, texts)), (F.col("id") % 6 + 1).cast("int")).alias("text")).repartition(4).localCheckpoint()
    terms = [("item", f"{colour} ring") for colour in ("red", "green", "old", "new", "hot")] + [("kind", "stud*"), ("out", "birth cohort")]
    table = spark.createDataFrame(terms, "block string, term string")
    got, rows = shuffled(spark, lambda: {r["id"] for r in term_index.search(df, "id", F.col("text"), table, ["out"]).collect()})
    assert got == set(range(0, 12000, 6))
    assert max(rows) < 1000  # before, each row's words
    got, _ = shuffled(spark, lambda: term_index.search(df, "id", F.col("text"), table.where("block = 'out'"), ["out"]).count())
    assert got == 10000


@pytest.mark.parametrize("name", ["term_search", "clustered_studies", "pooled_with_corrections"])
def test_records_are_worked_out_in_parts(spark, monkeypatch, name):
    """Each part's shuffle holds its own records only, and the parts together give what the whole table gives."""
    data = "/root/testdata/sf0.001"
    show = lambda r: tuple(round(x, 4) if isinstance(x, float) else x for x in r)
    whole = sorted(map(show, queries.QUERIES[name](spark, data).collect()), key=str)
    monkeypatch.setattr(dims, "PART", 1500)
    got, rows = shuffled(spark, lambda: sorted(map(show, queries.QUERIES[name](spark, data).collect()), key=str))
    assert got == whole and max(rows) < 3000  # of 6,000
    left = glob.glob(f"{shared_folder(spark)}/versions-*/*")
    assert all(path.endswith("/sums") for path in left)  # no part's versions, state or checkpoint
    parts = dims.record_parts(spark, data, dims.record_count(spark, data))
    ids = [r["record_id"] for part in parts for r in part.select("record_id").collect()]
    assert len(parts) == 4 and sorted(ids) == sorted(r["record_id"] for r in dims.records(spark, data).select("record_id").collect())


def test_messages_of_any_shape(spark, tmp_path):
    said = [{"DOI": "10.1/a", "title": ["T", "U"], "issued": {"date-parts": [[1999]]}}, {"DOI": "10.1/b", "title": "T", "issued": {"date-parts": 2001}, "volume": 3.5}, {"title": []}, [1], "x"]
    (tmp_path / "m.json").write_text("\n".join([*map(json.dumps, said), "{bad", "null"]))
    got = read_doi_messages(spark, str(tmp_path)).collect()
    assert [(r["doi"], r["title"], r["year"], r["volume"], r["readable"]) for r in got] == [("10.1/a", "T", 1999, None, True), ("10.1/b", "T", 2001, "3.5", True), (None, None, None, None, True), (None, None, None, None, True), (None, None, None, None, True), (None, None, None, None, False), (None, None, None, None, True)]
    table = spark.createDataFrame([(0, '{"DOI": {"x": 1}, "title": "t"}'), (1, "nope")], "k int, value string")
    assert ("doi", "object") in {(r["field"], r["kind"]) for r in shape_findings(table, "k").where("k = 0").collect()}
    assert pairs(shape_findings(table, "k").where("k = 1")) == [(1, "message", "unreadable")]


def test_clustered_table_needs_no_exchange(spark, tmp_path):
    rows = [(f"R{i}", f"S{i % 7}", "A; B", "c", "p", "Urine", "t", 5, "Adults", 1990 + i % 3, ["Creatinine", "No"][i % 2]) for i in range(200)]
    df = spark.createDataFrame(rows, "record_id string, study_no string, author string, city string, province string, sample_type string, title string, sample_size int, population_group string, sampling_year int, adjusted string")
    table = write_clustered(df, "clustered_records", ["study_no"], 4, str(tmp_path / "t"))
    try:
        for job in (dedup.build_studies, derived.prefer_basis, lambda t: t.join(dedup.build_studies(t).select("study_no", "total_n"), "study_no")):
            out = job(table)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan.replace("BroadcastExchange", ""), plan
            columns = sorted(out.columns)
            assert pairs(out.select(columns)) == pairs(job(df).select(columns))
        with pytest.raises(Exception, match="already exists"):
            write_clustered(df, "clustered_records", ["study_no"], 4)
    finally:
        spark.sql("DROP TABLE clustered_records")
