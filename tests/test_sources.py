import pytest
from pyspark.sql import functions as F

from cohortlake.sources import bibliography as b
from cohortlake.sources import contract


def rows(df):
    return [r.asDict() for r in df.orderBy("record_id").collect()]


def test_ris(spark, tmp_path):
    (tmp_path / "a.ris").write_text("TY  - JOUR\nTI  - Arsenic in\n  urine\nAU  - Li, W\nAU  - Wu, X\nPY  - 2001/05\nAN  - 123\nKW  - a\nKW  - b\nER  - \nTY  - JOUR\nT1  - Second\nJO  - J\nER  - \n")
    first, second = rows(b.read_ris(spark, str(tmp_path), "PubMed"))
    assert (first["title"], first["authors"], first["year"], first["pmid"], first["keywords"]) == ("Arsenic in urine", "Li, W; Wu, X", "2001", "123", "a; b")
    assert first["record_id"] == "PubMed-00001" and second["title"] == "Second" and second["journal"] == "J"


def test_bibtex(spark, tmp_path):
    (tmp_path / "a.bib").write_text('@comment{x}\n@article{k1, title = {A {Nested} title}, author = "Li and Wu", year = 2003, journal = {Env} # { Int}}\n@book{k2,\n title="Two", year={2004}\n}\n')
    first, second = rows(b.read_bibtex(spark, str(tmp_path), "Scopus"))
    assert (first["title"], first["authors"], first["year"], first["journal"]) == ("A {Nested} title", "Li; Wu", "2003", "Env Int")
    assert (second["title"], second["year"]) == ("Two", "2004")


def test_table_and_xml(spark, tmp_path):
    (tmp_path / "t.csv").write_text("题名,作者,年份\nOne,Li and Wu,2001\n")
    (row,) = rows(b.read_table(spark, str(tmp_path / "t.csv"), "CNKI"))
    assert (row["title"], row["authors"], row["year"]) == ("One", "Li; Wu", "2001")
    (tmp_path / "x.xml").write_text("<xml><records><record><titles><title>T</title><secondary-title>J</secondary-title></titles><contributors><authors><author>A</author><author>B</author></authors></contributors><dates><year>1999</year></dates></record></records></xml>")
    (row,) = rows(b.read_endnote_xml(spark, str(tmp_path / "x.xml"), "WebOfScience"))
    assert (row["title"], row["journal"], row["authors"], row["year"]) == ("T", "J", "A; B", "1999")


def test_registry(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.txt").write_bytes(b"x")
    found = b.fingerprint_files(spark, str(tmp_path / "f"))
    assert found.first()["sha256"] == "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881"
    for day in (1, 2):
        b.append_registry(found.selectExpr("*", f"{day} AS created_at"), str(tmp_path / "registry"))
    assert b.latest_snapshot(spark.read.parquet(str(tmp_path / "registry"))).first()["created_at"] == 2


def test_ris_tags_and_warnings(spark, tmp_path):
    (tmp_path / "b.ris").write_text("X1  - early\nTY  - JOUR\nTI  - Cut\nTY  - JOUR\nTI  - Kept\nDI  - 10.1/x\nJA  - Env\nJF  - Environment\nUT  - MEDLINE:77\nID  - k1\nK1  - k2\nQQ  - odd\nPY  - n.d.\nPY  - 2004\n continues\nER  - \n")
    (row,) = rows(b.read_ris(spark, str(tmp_path), "Other"))
    assert (row["title"], row["doi"], row["journal"], row["pmid"], row["keywords"], row["year"]) == ("Kept", "10.1/x", "Environment", "77", "k1; k2", "2004")
    found = [(r["line"], r["warning"]) for r in b.ris_warnings(spark, str(tmp_path)).orderBy("line").collect()]
    assert found == [(0, "outside of a record"), (1, "record without its end before the next one"), (2, "outside of a record"), (11, "tag of no field"), (14, "continues nothing")]


def test_bibtex_macros(spark, tmp_path):
    (tmp_path / "m.bib").write_text('@string{env = "Environ Int"}\n@article{a, title={A}, journal = env # " X", year = 2001, summary={S}}\n@article{b, title={B}, journal = jan}\n@string{late = {L}}\n@article{c, title={C}, journal = late}\n')
    assert [(r["journal"], r["abstract"]) for r in rows(b.read_bibtex(spark, str(tmp_path), "Scopus"))] == [("Environ Int X", "S"), ("Jan", ""), ("L", "")]


def test_headers_and_merge(spark, tmp_path):
    found, odd = b.table_header(["﻿Article  Title", "Journal", "Secondary Title", "Volume", "Mood"])
    assert found == {"title": "﻿Article  Title", "journal": "Journal"} and odd == ["Secondary Title", "Mood"]
    (tmp_path / "t.csv").write_text("title\nOne\nTwo\nThree\n")
    t = b.read_table(spark, str(tmp_path / "t.csv"), "CNKI")
    assert [r["record_id"] for r in rows(t)] == ["CNKI-00001", "CNKI-00002", "CNKI-00003"]
    assert b.checked_merge(t, b.read_table(spark, str(tmp_path / "t.csv"), "Scopus")).count() == 6
    assert [r["n"] for r in b.repeated_record_ids(b.merge_sources(t, t)).collect()] == [2, 2, 2]
    with pytest.raises(Exception, match="repeated record_id"):
        b.checked_merge(t, t).collect()
    with pytest.raises(ValueError, match="missing"):
        b.merge_sources(t, t.drop("doi"))


def test_contract_reader(spark, tmp_path):
    (tmp_path / "r.csv").write_text("﻿record_id,title,time,sample_size,verified,gm_summary\nR1, A ,2001,n/a,Yes,1.5\n,,,,,\nR2,未报告,x,12.0,no,-\n")
    out = contract.read_records(spark, str(tmp_path / "r.csv")).orderBy("record_id")
    assert [tuple(r) for r in out.collect()] == [("R1", "A", 2001.0, None, True, 1.5), ("R2", None, None, 12, False, None)]
    contract.write_table(out.withColumn("sample_type", F.lit("Urine")), str(tmp_path / "w"), {"snapshot_tag": "abc"})
    assert {r["snapshot_tag"] for r in spark.read.parquet(str(tmp_path / "w")).collect()} == {"abc"}
    (tmp_path / "l.csv").write_text("record_id,Authors,Year,Title,DOI\n,Li,2001,T,10.1/x\nL2,Wu,2002,U,\n")
    ids = [r["record_id"] for r in contract.read_library(spark, str(tmp_path / "l.csv")).orderBy("title").collect()]
    assert ids[0].startswith("row-") and ids[1] == "L2"
    (tmp_path / "d.json").write_text('{"DOI": "10.1/x", "title": ["T"], "container-title": ["J"], "issued": {"date-parts": [[2001, 5]]}, "volume": "3", "page": "1-2"}\n')
    assert tuple(contract.read_doi_metadata(spark, str(tmp_path / "d.json")).first()) == ("10.1/x", "T", "J", 2001, "3", None, "1-2")


def test_table_fingerprint_ignores_order(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS study")
    a, c, d = (b.fingerprint_table(x, "id", "study").first() for x in (df, df.repartition(3).orderBy(F.desc("id")), df.where("id <> 5")))
    assert a == c and a["sha256"] != d["sha256"] and (a["record_count"], a["study_count"]) == (100, 7)
