"""The pipeline's stages on a small corpus with planted cases, each against a brute-force version of its decisions."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from cohortlake.llm import simhash_dedup
from tests.llm.test_operators import windows_of

corpus_pipeline = pytest.importorskip("corpus_pipeline")
stage = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(21)
    pool = [f"w{i}" for i in range(2000)]
    text = lambda n: "\n".join(" ".join(r.choice(pool) for _ in range(12)) for _ in range(n))
    item = " ".join(r.choice(pool) for _ in range(40))
    good = [(i, text(r.randrange(3, 9))) for i in range(150)]
    toxic = [(200 + i, text(4).replace("w1", "scoundrel w1")) for i in range(40)]
    poor = [(300 + i, " ".join(w + "!!" for w in text(4).split())) for i in range(40)]
    planted = [(400, good[0][1]), (401, good[1][1] + " tail"), (402, text(3) + "\n" + item + "\n" + text(3)), (403, text(2) + "\n" + good[2][1] + "\n" + text(2)), (404, None), (405, ""), (None, text(5)), (None, text(5)), good[5], (406, text(1) * 400)]
    rows = [(i, t, "en", "s", len(t or ""), "r", 1) for i, t in good + toxic + poor + planted]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i, _ in good[20:]] + [(i, 1, 1) for i, _ in toxic[5:]] + [(i, 0, 0) for i, _ in poor[5:]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def pairs(df):
    return sorted((str(r["doc_id"]), str(r["text"])) for r in df.collect())


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    kept = stage["quality classifier"](spark, docs, corpus)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns and not [i for i in ids if i is not None and 200 <= i < 340]
    assert {*range(150)} <= {*ids} and ids.count(None) == 2 and ids.count(5) == 2

    lines = stage["line dedup"](spark, kept, corpus)
    assert lines.columns == docs.columns
    place = lambda i: (i is None, i or 0)
    texts = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=lambda x: (place(x[0]), x[1] or ""))
    seen = {}
    for i, t in texts:
        rows = (t or "").split("\n")
        for s, n in windows_of(rows):
            key = tuple(rows[s : s + n])
            seen[key] = min((place(i), s), seen.get(key, (place(i), s)))
    want = []
    for i, t in texts:
        rows = (t or "").split("\n")
        gone = {s + k for s, n in windows_of(rows) if seen[tuple(rows[s : s + n])] < (place(i), s) for k in range(n)}
        want.append((str(i), str(t) if not gone else "\n".join(x for k, x in enumerate(rows) if k not in gone)))
    assert pairs(lines) == sorted(want) and all(r["n_chars"] == len(r["text"] or "") for r in lines.collect())

    near = stage["SimHash near-dedup"](spark, lines, corpus)
    rows = [(r["doc_id"], r["text"] or "") for r in lines.collect()]
    prints = [simhash_dedup.fingerprint(t) & (2**64 - 1) for _, t in rows]
    group = [*range(len(rows))]
    for _ in rows:
        group = [min(group[j] for j in range(len(rows)) if (prints[i] ^ prints[j]).bit_count() <= 3) for i in range(len(rows))]
    least = {}
    for g, (i, _) in zip(group, rows, strict=True):
        least[g] = min(place(i), least.get(g, place(i)))
    got = near.collect()
    assert near.columns == docs.columns and len(got) == len(least) and sorted(place(r["doc_id"]) for r in got) == sorted(least.values())

    clean = stage["benchmark decontamination"](spark, near, corpus)
    assert clean.columns == docs.columns and {r["doc_id"] for r in near.collect()} - {r["doc_id"] for r in clean.collect()} == {402}

    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for r in clean.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((str(r["doc_id"]), len(ids), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    end = stage["BPE encoding and decoding"](spark, clean, corpus)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["decoded_sha256"]) for r in end.collect()) == sorted(want)
    assert sorted(want) == sorted((str(r["doc_id"]), r["n_tokens"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, corpus).collect())


def test_stages_of_empty_tables(spark, corpus, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{corpus}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, run in corpus_pipeline.STAGES:
        out = run(spark, docs, str(tmp_path))
        assert out.collect() == [] and (out.columns == docs.columns or name == corpus_pipeline.STAGES[-1][0])
    full = spark.read.parquet(f"{corpus}/documents.parquet").where(F.col("doc_id") < 10)
    assert stage["quality classifier"](spark, full, str(tmp_path)).count() == full.count()
    assert re.match("doc_id", stage["BPE encoding and decoding"](spark, full, str(tmp_path)).columns[0])
