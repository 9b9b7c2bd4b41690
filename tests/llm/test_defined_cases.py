"""Null ids, one id with two texts, repeated rows and very long texts against brute force; the classifier's loss, search and scores by plain numpy."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cohortlake.llm import bpe_codec, exact_dedup, line_dedup, quality_classifier, simhash_dedup, substring_dedup, suffix_dedup

SPACE = r"[\x20\x09-\x0D]"


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd_rows():
    """A third without an id, one id with two texts, repeated rows, one very long text."""
    dice = random.Random(9)
    word = lambda: "".join(dice.choices("abcdé", k=3))
    passage = " ".join(word() for _ in range(60))
    text = lambda n: " ".join(word() for _ in range(n))
    rows = [(None if i % 3 == 0 else i, text(20) + " " + passage + " " + text(dice.randint(0, 30)) if i % 2 else text(80)) for i in range(24)]
    long = " ".join(f"w{i}" for i in range(200_000)) + " " + passage
    rows += [(7, text(10) + " " + passage), (7, "short"), rows[4], rows[4], rows[3], (None, ""), (None, None), (50, long), (51, "x " + long[:900])]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, key string, start int").repartition(3)


def place(i):
    return 2**63 - 1 if i is None else i


def test_substrings(spark, odd_rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in odd_rows]
    first = {}
    for (i, _), w in zip(odd_rows, words, strict=True):
        for s in range(len(w) - 49):
            key = hash(tuple(w[s : s + 50]))
            first[key] = min(place(i), first.get(key, place(i)))
    want = []
    for (i, _), w in zip(odd_rows, words, strict=True):
        gone = np.zeros(len(w) + 50, bool)
        for s in range(len(w) - 49):
            if first[hash(tuple(w[s : s + 50]))] < place(i):
                gone[s : s + 50] = True
        kept = " ".join(x for x, g in zip(w, gone.tolist(), strict=False) if not g)
        want.append((i, len(w), int(gone.sum()), sha(kept)))
    got = [(r["doc_id"], r["n_words"], r["n_removed"], sha(r["kept_text"])) for r in substring_dedup.substring_dedup(frame(spark, odd_rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_exact_copies(spark, odd_rows):
    plain = [re.sub(SPACE, "", t or "") for _, t in odd_rows]
    want = []
    for (i, t), p in zip(odd_rows, plain, strict=True):
        group = [(-len(u or ""), place(j), j) for (j, u), q in zip(odd_rows, plain, strict=True) if q == p]
        want.append((i, min(group)[2], len(group), sha(p)))
    got = exact_dedup.exact_dedup(frame(spark, odd_rows)).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == sorted(want, key=str)
    assert sum(r["kept"] for r in got) == len(set(plain))


def test_bytes(spark, odd_rows):
    """Rows of one id and text are one document's copies: what stands in one doesn't remove it in the other."""
    rows = odd_rows[:-2]
    data = [(t or "").encode() for _, t in rows]
    first = {}
    for (i, t), d in zip(rows, data, strict=True):
        for s in range(len(d) - 99):
            key = d[s : s + 100]
            first[key] = min((place(i), s), first.get(key, (place(i), s)))
    want = []
    for (i, t), d in zip(rows, data, strict=True):
        gone = np.zeros(len(d) + 100, bool)
        for s in range(len(d) - 99):
            if first[d[s : s + 100]] < (place(i), s):
                gone[s : s + 100] = True
        gone = gone[: len(d)]
        want.append((i, len(d), int(gone.sum()), sha(np.frombuffer(d, np.uint8)[~gone].tobytes())))
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], sha(bytes(r["kept"]))) for r in suffix_dedup.suffix_dedup(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_tokens_fingerprints_and_lines(spark, odd_rows):
    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    want = sorted(((i, len(ids := library.encode(t or "", add_special_tokens=False).ids), sha(np.array(ids, "<u4").tobytes())) for i, t in odd_rows), key=str)
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in bpe_codec.round_trip(frame(spark, odd_rows)).collect()), key=str) == want
    prints = [(i, simhash_dedup.fingerprint(t or "") % 2**64) for i, t in odd_rows]
    got = simhash_dedup.simhash_groups(frame(spark, odd_rows)).collect()
    assert sorted(((r["doc_id"], r["fingerprint"]) for r in got), key=str) == sorted(((i, f"{p:016x}") for i, p in prints), key=str)
    near = {}
    for i, p in prints:  # components by plain search
        group, todo = set(), [p]
        while todo:
            x = todo.pop()
            new = {q for _, q in prints if q not in group and (q ^ x).bit_count() <= 3}
            group |= new
            todo += new
        near[p] = min((place(j) for j, q in prints if q in group))
    assert sorted((r["fingerprint"], str(r["component_id"])) for r in got) == sorted((f"{p:016x}", str(None if near[p] == 2**63 - 1 else near[p])) for _, p in prints)
    lines = line_dedup.line_dedup(frame(spark, odd_rows)).collect()
    assert sorted(((r["doc_id"], r["n_lines"]) for r in lines), key=str) == sorted(((i, len((t or "").split("\n"))) for i, t in odd_rows), key=str)


def test_loss_and_its_slopes():
    dice = np.random.default_rng(3)
    scores, grades, thresholds = dice.normal(size=50), dice.integers(0, 3, 50), np.array([-0.7, 0.9])
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def plain(s, t):
        at_most = np.column_stack([np.zeros(len(s)), sigmoid(t[0] - s), sigmoid(t[1] - s), np.ones(len(s))])
        return -np.log(at_most[np.arange(len(s)), grades + 1] - at_most[np.arange(len(s)), grades]).sum()

    loss, by_score, by_edge = quality_classifier.partial_loss(scores, grades, thresholds)
    assert loss == pytest.approx(plain(scores, thresholds))
    step = 1e-6
    for k in range(50):
        moved = scores.copy()
        moved[k] += step
        assert by_score[k] == pytest.approx((plain(moved, thresholds) - plain(scores, thresholds)) / step, abs=1e-4)
    for k in range(2):
        moved = thresholds.copy()
        moved[k] += step
        assert by_edge[k] == pytest.approx((plain(scores, moved) - plain(scores, thresholds)) / step, abs=1e-3)


def test_search_finds_the_least_loss():
    dice = np.random.default_rng(4)
    a = dice.normal(size=(30, 6))
    square, target = a.T @ a + np.eye(6), dice.normal(size=6)
    found = quality_classifier.minimise(lambda x: (0.5 * x @ square @ x - target @ x, square @ x - target), np.zeros(6), 60, tolerance=1e-12)
    assert found == pytest.approx(np.linalg.solve(square, target), abs=1e-3)


def test_scores_by_plain_sums(spark):
    dice = random.Random(6)
    pool = [f"word{i}" for i in range(60)]
    said = {0: ["scoundrel", "villain"], 1: ["meh", "blah"], 2: ["fine", "good"]}
    rows = [(i, " ".join(dice.choices(pool + said[i % 3] * 8, k=40))) for i in range(240)]
    docs = spark.createDataFrame(rows + [(900, None), (901, ""), (902, "fine " * 300_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 2), int(i % 3 == 0)) for i, _ in rows if i % 4] + [(1, 1, 0), (None, 1, 0), (5000, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality_classifier.fit(docs, labels)
    thresholds, used, weights = model
    assert thresholds[0] < thresholds[1]
    weight = dict(zip(used.tolist(), np.float32(weights[: len(used)]).tolist(), strict=True))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = {r["row"]["doc_id"]: r for r in quality_classifier.select_quality(docs, labels, least=0.0).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        _, feature, shares = quality_classifier.features(pa.array([text]))
        s = sum(weight.get(f, 0.0) for f in feature.tolist()) + float(shares[0] @ weights[len(used) :])
        above = 1 / (1 + np.exp(-(s - thresholds)))
        assert got[i]["expected_grade"] == pytest.approx(above.sum(), abs=1e-4) and got[i]["tail_probability"] == pytest.approx(above[1], abs=1e-4)
    held = [i for i, _ in rows if i % 4 == 0]
    rank = lambda i: int(got[i]["expected_grade"] > 0.67) + int(got[i]["expected_grade"] > 1.33)
    assert np.mean([rank(i) == i % 3 for i in held]) >= 0.9


@pytest.mark.parametrize("toxic", [0, 1])
def test_labels_of_one_grade(spark, toxic):
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, toxic) for i in range(30)] + [(3, 1, toxic)], "doc_id long, quality int, toxic int")
    kept = quality_classifier.select_quality(docs, labels).count()
    assert kept == (0 if toxic else 30)


def test_words_side_by_side():
    """Many words through the automaton and the merges at once as one by one."""
    import public_tokenizers

    dice = random.Random(1)
    lexicon = bpe_codec.Lexicon(bpe_codec.compiled({"".join(dice.choices("abcé", k=dice.randint(1, 5))).encode(): [dice.randint(0, 9)] * dice.randint(1, 3) for _ in range(200)}))
    words = ["".join(dice.choices("abcdé", k=dice.randint(0, 7))).encode() for _ in range(3000)]
    assert lexicon.get_many(words) == [lexicon.get(w) for w in words] and lexicon.get_many([]) == []
    assert bpe_codec.Lexicon(bpe_codec.compiled({})).get_many([b"a", b""]) == [None, None]
    vocabulary = bpe_codec.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    words = ["".join(dice.choices("abcdehinorstué日", k=dice.randint(1, 40))) for _ in range(2000)] + ["a" * 99, "ab" * 300, "é" * 50, "x"]
    assert vocabulary.merge_many(words) == [np.array(vocabulary.merge(w), "<u4").tobytes() for w in words] and vocabulary.merge_many([]) == []
