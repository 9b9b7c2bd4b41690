"""Hand-computed cases of statistics, pooling, units and intake."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from cohortlake.functions.stats import norm_ppf_sql, trend, with_quantile
from cohortlake.functions.text import citations, journals_match, normalize_doi, numbers, placeholders, sentences, titles_match
from cohortlake.operators import convert, intake, pool
from cohortlake.operators.audit import audit_numbers
from cohortlake.operators.convert import SCALED, convert_units
from cohortlake.operators.references import crosswalk, insert_table, unused
from cohortlake.operators.statistics import derive_flags, to_gm
from cohortlake.plans.dims import period_of


def test_quantiles_of_the_normal_distribution(spark):
    ps = [1e-12, 1e-5, 0.01, 0.3, 0.5, 0.925, 0.99999, 1 - 1e-12]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    rows = with_quantile(df, F.col("p"), "z").withColumn("s", F.expr(norm_ppf_sql("p"))).collect()
    for r in rows:
        want = statistics.NormalDist().inv_cdf(r["p"])
        assert r["z"] == pytest.approx(want, rel=1e-12, abs=1e-12) and r["s"] == pytest.approx(want, rel=1e-12, abs=1e-12)


def records(spark, rows):
    return spark.createDataFrame(rows, "record_id string, study_no string, sample_type string, sampling_year int, gm_summary double, sample_size int")


def test_pooled_means(spark):
    df = records(spark, [("a", "s1", "U", 1995, 10.0, 5), ("b", "s2", "U", 1996, 40.0, 5), ("c", "s1", "U", 1999, 7.0, 3), ("d", "s1", "U", 2010, 9.0, 3), ("e", "s1", "U", 1995, None, 3), ("f", "s1", "U", 1995, 2.0, 0)])
    out = {r["period"]: r for r in pool.pool(df, ["sample_type", "period"]).collect()}
    assert set(out) == {"1995-1996", "1999-2000"}
    first = out["1995-1996"]
    assert first["gm"] == pytest.approx(20) and first["gsd"] == pytest.approx(2) and first["study_count"] == 2
    assert first["note"] == "fewer than 3 records; one record over 30 % of the weight"
    assert out["1999-2000"]["gsd"] == pytest.approx(1) and out["1999-2000"]["ci_low"] is None
    assert pool.exclusions(df).first().asDict() == {"n_records": 6, "n_skipped": 2, "n_out_of_range": 1}
    with pytest.raises(ValueError):
        pool.pool(df, ["period"], out_of_range="guess")


def test_pooled_golden_row(spark):
    df = records(spark, [("a", "s1", "U", 1995, 45.0, 1000), ("b", "s2", "U", 1995, 30.0, 400), ("c", "s3", "U", 1995, 32.0, 400)])
    r = pool.pool(df, ["sample_type"]).first()
    logs = [(1000, math.log(45)), (400, math.log(30)), (400, math.log(32))]
    mu = sum(w * x for w, x in logs) / 1800
    assert r["gm"] == pytest.approx(math.exp(mu)) and r["max_weight_share"] == pytest.approx(0.555556, abs=1e-6)
    assert r["gsd"] == pytest.approx(math.exp(math.sqrt(sum(w * (x - mu) ** 2 for w, x in logs) / 1800)))


def test_quantile_is_an_element(spark):
    df = records(spark, [(str(i), "s", "U", 1995, float(v), 1) for i, v in enumerate([1, 2, 3, 4])])
    r = pool.weighted_quantiles(df, ["sample_type"], [0.5, 0.95]).first()
    assert (r["p50"], r["p95"]) == (2.0, 4.0)
    assert pool.upper_median(df, ["sample_type"], "gm_summary").first()["median"] == 3.0


def test_intake_fixed_points(spark):
    df = spark.createDataFrame([("Urine", "Adults", 32.58), ("Urine", "Minors", 55.33), ("Blood", "Adults", 2.72), ("CordBlood", "Adults", 1.0), ("Urine", "Mixed", 5.0)], "sample_type string, population_group string, gm_summary double")
    a, m, b, c, x = intake.daily_intake(df).collect()
    assert a["edi_primary"] == pytest.approx(1.047214, abs=1e-6) and a["edi_secondary"] == pytest.approx(1.046904, abs=1e-6) and a["edi_status"] == "OK"
    assert m["edi_primary"] == pytest.approx(3.655732, abs=1e-6) and m["cross_check_rel_diff"] == pytest.approx(0.074865, abs=1e-6) and m["edi_status"] == "WARN"
    assert b["edi_primary"] == pytest.approx(7.771429, abs=1e-6) and (b["edi_status"], c["edi_status"], x["edi_status"]) == ("WARN", "SKIP", "SKIP")


def test_units(spark):
    names = "unit_original string, sample_type string, population_group string, gender string, adjusted string, analyte string, analyte_species string"
    rows = [("nmol/L", "Urine", "Adults", "Both", "No", "As", "Total"), ("µg/dL", "Blood", "Adults", "Both", "NotApplicable", "Pb", "Total"), ("ug/g", "Blood", "Adults", "Both", "NotApplicable", "As", "Total"), ("ug/L", "Urine", "Adults", "Both", "SpecificGravity", "As", "Total"), ("ug/g Cr", "Blood", "Adults", "Both", "NotApplicable", "As", "Total")]
    df = spark.createDataFrame(rows, names)
    df = df.withColumns({c: F.lit(1.0) for c in convert.SCALED})
    out = convert.convert_units(df).collect()
    assert out[0]["initial_gm"] == pytest.approx(0.07492 / 0.964) and out[0]["unit_path"] == "nmol/L→ICRP89_Adults→ug/g Cr"
    assert out[1]["initial_gm"] == 10 and [r["unit_status"] for r in out] == ["OK", "OK", "FAILED", "SKIP", "FAILED"]
    with pytest.raises(ValueError):
        convert.convert_units(df, mode="guess")


def test_statistics_fail_where_they_degenerate(spark):
    names = "stat_type string, sample_size int, " + ", ".join(f"initial_{x} double" for x in ("gm", "gsd", "mean", "sd", "median", "p25", "p75", "min", "max"))
    n = None
    rows = [("GM_only", 5, 3.0, n, n, n, n, n, n, n, n), ("AM_SD", 5, n, n, 10.0, 10.0, n, n, n, n, n), ("Min_Max", 5, n, n, 4.0, n, n, n, n, 4.0, 4.0), ("Median_IQR", n, n, n, n, n, 3.0, 2.0, 4.0, n, n), ("Median_only", 5, n, n, n, n, 3.0, n, n, n, n)]
    out = to_gm(spark.createDataFrame(rows, names), median_strategy="via_wan").collect()
    assert [r["stat_status"] for r in out] == ["SKIP", "OK", "FAILED", "OK", "FAILED"]
    assert out[1]["gm_summary"] == pytest.approx(10 / math.sqrt(2)) and out[3]["formula"] == "Wan_S6"


def test_flags_periods_and_trends(spark):
    one = spark.range(1)
    flag = lambda p: one.select(derive_flags(F.lit(p)).alias("f")).first()["f"]
    assert flag("ug/L→ICRP89_Adults→ug/g Cr→reported_GM") == ["unit_converted_creatinine"]
    assert flag("reported_GM") == [] and "no_n_fallback" in flag("Min_Max→Wan_S3→GM")
    row = one.select(period_of(F.lit(1996)).alias("a"), period_of(F.lit(2001)).alias("b"), trend(F.lit(100.0), F.lit(105.0)).alias("c"), trend(F.lit(100.0), F.lit(94.0)).alias("d")).first()
    assert (row["a"], row["b"], row["c"], row["d"]) == ("1995-1996", None, "→", "↓")
    with pytest.raises(ValueError):
        period_of(F.lit(1), [("a", 1, 5), ("b", 5, 9)])


def test_text_functions(spark):
    docs = spark.createDataFrame([(1, "Mean was 3.5 ug/g Cr {{period_GM:Urine:1995-1996}} (Smith et al., 2002a; WHO, 2010). It fell to 2 ug/L!"), (2, None)], "doc_id long, text string")
    assert {r["key"] for r in citations(docs).collect()} == {"smith|2002a", "who|2010"}
    assert [(r["value"], r["unit"]) for r in numbers(sentences(docs)).collect()] == [(3.5, "ug/g Cr"), (2.0, "ug/L")]
    assert placeholders(docs).first()["args"] == ["Urine", "1995-1996"]
    row = spark.range(1).select(
        normalize_doi(F.lit(" https://doi.org/10.1/a. ")).alias("d"), titles_match(F.lit("A b!"), F.lit("a  B")).alias("t"), journals_match(F.lit("Environ Int"), F.lit("Environment International")).alias("j"), journals_match(F.lit("Sci Rep"), F.lit("Nature")).alias("k")
    ).first()
    assert (row["d"], row["t"], row["j"], row["k"]) == ("10.1/a", True, True, False)


def test_audit(spark):
    docs = spark.createDataFrame([(1, "Urinary levels in 1995-1996 were 10.01 ug/L. In the northeast blood had 5 ug/L.")], "doc_id long, text string")
    strata = spark.createDataFrame([("Urine", "period", "1995-1996", 10.0), ("Blood", "region", "Northeast", 9.0)], "matrix string, dim string, stratum string, gm double")
    out = {r["stratum"]: r["status"] for r in audit_numbers(docs, strata, {"northeast": "Northeast", "east": "East"}).collect()}
    assert out == {"1995-1996": "OK", "Northeast": "MISMATCH"}


def test_institutions_match_by_name_and_abbreviation(spark):
    docs = spark.createDataFrame([(1, "As told (WHO, 2010; US EPA 2001a; those who 2010; Li et al., 1999)."), (2, "(United States Environmental Protection Agency, 2001)")], "doc_id long, text string")
    library = spark.createDataFrame([("L1", "World Health Organization", 2010), ("L2", "USEPA", 2001), ("L3", "Li, X.; Who, Y.", 1999), ("L4", "IARC", 2012), ("L5", None, 2000)], "record_id string, authors string, year int").withColumn("title", F.lit("t"))
    cited = citations(docs)
    found = {(r["doc_id"], r["key"]): r["status"] for r in crosswalk(cited, library).collect()}
    assert found == dict.fromkeys([(1, "who|2010"), (1, "us epa|2001a"), (1, "li|1999"), (2, "united states environmental protection agency|2001")], "MATCHED")
    assert {r["record_id"] for r in unused(cited, library).collect()} == {"L4", "L5"}
    placed = insert_table(crosswalk(cited, library), library).collect()
    assert sorted((r["doc_id"], r["key"], r["record_id"]) for r in placed) == [(1, "li|1999", "L3"), (1, "us epa|2001a", "L2"), (1, "who|2010", "L1"), (2, "united states environmental protection agency|2001", "L2")]


def test_unit_parameters(spark):
    names = "record_id string, sample_type string, adjusted string, population_group string, gender string, analyte string, analyte_species string, unit_original string, " + ", ".join(f"{c} double" for c in SCALED)
    rows = [("a", "Urine", "No", "Adults", "Male", "As", "Total", "nmol/L", *[1.0] * 8), ("b", "Blood", "NotApplicable", "Adults", "Male", "As", "Total", "ug/L", *[1.0] * 8), ("c", "Blood", "NotApplicable", "Adults", "Male", "As", "Total", "ug/g", *[1.0] * 8)]
    out = {r["record_id"]: r for r in convert_units(spark.createDataFrame(rows, names)).collect()}
    assert "mode=CC_direct; group=Adult_Male; molar_mass=" in out["a"]["unit_params"]
    assert out["b"]["unit_params"] == "factor=1.0" and out["c"]["unit_params"] is None
