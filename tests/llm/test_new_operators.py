"""Operators 11 to 13 against brute force from their contracts, with every defined case."""

import hashlib
import math
import random
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from cohortlake.llm import token_alignment, topk_search
from cohortlake.llm.merkle_manifest import folded, leaf_digest, manifest, verified_manifest
from cohortlake.llm.token_alignment import align_documents, aligned_batches, pair_counts
from cohortlake.llm.topk_search import top_k

# --- 11


def brute_top_k(rows, k, every):
    points = set()
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            points.add((i, tuple(math.floor(256 * x) for x in v)))
    out = []
    for i, v in points:
        if i is not None and i % every == 0:
            others = [p for p in points if p != (i, v) and len(p[1]) == len(v)]
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j is None, j or 0) for j, w in others)[:k]
            out += [(i, rank + 1, None if none else j, -score) for rank, (score, none, j) in enumerate(best)]
    return sorted(out, key=str)


def vectors():
    dice = random.Random(5)
    centers = [[dice.gauss(0, 3) for _ in range(6)] for _ in range(8)]
    rows = [(i, [c + dice.gauss(0, 0.05) for c in centers[i % 8]]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 6) for i in range(200)]  # a third are copies
    rows += [(5000 + i, [float(dice.randint(-1, 1)) for _ in range(6)]) for i in range(100)]  # ties
    odd = [(50, None), (100, [None, 1.0]), (150, [float("nan")] * 6), (200, [float("inf")] * 6), (None, [0.5] * 6), (None, rows[3][1]), (50, [0.25] * 6), (50, [0.25] * 6)]
    return rows + odd + [(2000, []), (2050, []), (2100, [1.0]), (2101, [-2.0]), (2150, [1.0, 2.0])]


@pytest.mark.parametrize(("block", "pivots", "queries"), [(65_536, 256, 4096), (64, 8, 7)])
def test_top_k(spark, monkeypatch, block, pivots, queries):
    for name, value in (("BLOCK", block), ("PIVOTS", pivots), ("QUERIES", queries), ("SMALL_BLOCK", 16)):
        monkeypatch.setattr(topk_search, name, value)
    rows = vectors()
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cell string, rank int")
    got = top_k(table, F.col("id") % 10 == 0, 5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_top_k(rows, 5, 10)


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(0, [1.0]), (1, [2.0]), (50, [-1.0])]])
def test_top_k_of_few(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, top_k(table, F.col("id") % 50 == 0, 5).collect()), key=str) == brute_top_k(rows, 5, 50)


def test_nodes_cover_and_stay_apart():
    import numpy as np

    points = np.random.default_rng(3).normal(size=(900, 4))
    tree = topk_search.CoverTree(points, leaf=16, fan=8)
    assert sorted(tree.order.tolist()) == list(range(900))
    for node in range(len(tree.begin)):
        below = points[tree.order[tree.begin[node] : tree.end[node]]]
        assert np.linalg.norm(below - tree.centers[node], axis=1).max() <= tree.radius[node] + 1e-9
        children = tree.below(np.array([node]))[1]
        assert len(children) != 1 and sum(tree.end[c] - tree.begin[c] for c in children) in (0, len(below))
        for a in children:
            for b in children:
                assert a == b or np.linalg.norm(tree.centers[a] - tree.centers[b]) >= tree.radius[children].max() - 1e-9


# --- 12


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""

    def leaf(r):
        return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in r))

    def climb(nodes):  # the root, and for each leaf its (left, right) siblings from below
        steps = [[] for _ in nodes]
        held = [[i] for i in range(len(nodes))]
        while len(nodes) > 1:
            runs = [range(i, min(i + 8, len(nodes))) for i in range(0, len(nodes), 8)]
            for run in runs:
                for i in run:
                    for x in held[i]:
                        steps[x].append(("".join(nodes[run[0] : i]), "".join(nodes[i + 1 : run[-1] + 1])))
            held = [[x for i in run for x in held[i]] for run in runs]
            nodes = [sha("".join(nodes[run[0] : run[-1] + 1])) for run in runs]
        return nodes[0], steps

    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    own = {x: sorted(trees[x], key=lambda r: (r[0] is None, r[0] or 0, leaf(r))) for x in langs}
    subs = {x: climb([leaf(r) for r in own[x]]) for x in langs}
    root, above = climb([subs[x][0] for x in langs]) if langs else ("", [])
    out = []
    for x, top in zip(langs, above, strict=True):
        for r, steps in zip(own[x], subs[x][1], strict=True):
            steps = steps + top
            digest = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                digest = leaf((*r[:4], "".join(c.lower() if c.isascii() else c for c in r[4])))
            for left, right in steps:
                digest = sha(left + digest + right)
            out.append((r[0], leaf(r), subs[x][0], root, sha("".join(a + b for a, b in steps)), digest, digest == root))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, at int"


def rows_of_manifest():
    dice = random.Random(7)
    words = ["Ärger", "Alpha", "beta", "Straße", "İstanbul", "x"]
    rows = [(i, dice.choice(["a", None, "b"]), dice.choice(["en"] * 6 + ["de", "fr"]), dice.choice([None, i]), " ".join(dice.choices(words, k=dice.randint(0, 5)))) for i in range(700)]
    rows += [(None, "s", "en", 1, "NULL id"), (3, None, None, None, None), (4, "", None, 0, ""), (5, "s", "lone", 9, "Lone"), (6, "s", "", 1, "EMPTY"), (7, "s", "ж", 1, "Ж"), (8, "s", "it", 1, "X" * 300_000)]
    return rows + [rows[0]] * 300 + [(9, "s", "en", 1, "One"), (9, "s", "en", 1, "Two")]


@pytest.mark.parametrize("rows", [[], [(1, "s", "en", 3, "Abc")], [(i, "s", "en", 3, "Abc") for i in range(9)], rows_of_manifest()])
def test_manifest(spark, rows):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = verified_manifest(table)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_manifest(rows)


def test_proof_of_one_document(spark):
    """A leaf and its steps give the root by hand, without the table."""
    rows = rows_of_manifest()[:200]
    r = manifest(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).where("doc_id = 77").first()
    digest = r["leaf"]
    for step in r["steps"]:
        digest = sha(step["left"] + digest + step["right"])
    assert digest == r["root"] and r["shown"] is None
    again = spark.range(1).select(folded(F.lit(r["leaf"]), F.lit(None).cast("array<struct<left:string,right:string>>")).alias("x"), leaf_digest([F.lit("ab"), F.lit("c")]).alias("y"), leaf_digest([F.lit("a"), F.lit("bc")]).alias("z")).first()
    assert again["x"] is None and again["y"] != again["z"]


# --- 13


def brute_alignment(rows):
    a_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    byte_of = {chr(b if b in visible else next(hidden)): b for b in range(256)}
    found, count = [], Counter()
    for i, text in rows:
        a = a_side.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        a_bytes = [bytes(byte_of[c] for c in a_side.id_to_token(x)) for x in a]
        b_bytes = [bytes([int(b_side.id_to_piece(x)[3:5], 16)]) if b_side.is_byte(x) else b_side.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if not text or not (b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode()):
            found.append((i, [], [], [], []))
            continue

        def spans(tokens):
            out, at = [], 0
            for t in tokens:
                out.append((at, at + len(t)))
                at += len(t)
            return out

        a_spans, b_spans = spans(a_bytes), spans(b_bytes)
        ends = sorted({e for _, e in a_spans} & {e for _, e in b_spans})
        groups, low = [], 0
        for end in ends:
            groups.append(([x for x, (s, e) in zip(a, a_spans, strict=True) if low <= s and e <= end], [x for x, (s, e) in zip(b, b_spans, strict=True) if low <= s and e <= end]))
            low = end
        links = [(x, y) for x, (s, e) in zip(a, a_spans, strict=True) for y, (t, f) in zip(b, b_spans, strict=True) if s < f and t < e]
        count.update(links)
        found.append((i, a, b, groups, links))
    most = {}
    for (_, y), n in count.items():
        most[y] = max(most.get(y, 0), n)
    said = lambda groups: hashlib.sha256(";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups).encode()).hexdigest() if groups else ""
    rows = [(i, len(a), len(b), len(groups), len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), said(groups)) for i, a, b, groups, links in found]
    return sorted(rows, key=str), count, most


TEXTS = [
    "", None, "a", " a", "a ", "  two  spaces ", "x▁y z", "tab\there \n new\n\n para \n\nx", "\n \n \nfoo  bar", "naïve café 東京 都 🎉 mixed", "<|endoftext|> <s> </s> <unk> <0x41>",
    "don't can't 'll", "a\x00b \x01", "é ﬁ", "word " * 50, "　   x", "a" * 70 + " " + "b" * 65, "\r\n a", "a\u0085 b", "x\x1c y \x1d z", "ends in a line\n", "one  word\n \nother", "​   x", "'s 's  't",
]


@pytest.mark.parametrize(("batch", "part"), [(8_000_000, 1_000_000), (40, 12)])
def test_alignment(spark, monkeypatch, batch, part):
    monkeypatch.setattr(token_alignment, "BATCH_CHARS", batch)
    rows = [(i if i % 7 else None, t) for i, t in enumerate(TEXTS * 2 + ["one word other"] * 40)]
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, batch int, digest string")
    got = align_documents(table)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want, count, most = brute_alignment(rows)
    assert sorted(map(tuple, got.collect()), key=str) == want
    pairs = {(r["pair"] & 0xFFFFFFFF, r["pair"] >> 32): (r["n"], r["best"]) for r in pair_counts(aligned_batches(table)).collect()}
    assert pairs == {p: (n, n == most[p[1]]) for p, n in count.items()}


def test_parts_of_texts_are_cut_between_units():
    dice = random.Random(2)
    for _ in range(300):
        text = "".join(dice.choices(["ab", " ", "  ", "\n", "▁", "é", " c"], k=30))
        parts = list(token_alignment.parts_of(text, 10))
        assert " ".join(parts) == text
        cut = [u for p in parts for u in token_alignment._between.split(p)]
        assert cut == token_alignment._between.split(text)


def test_alignment_of_long_and_of_no_texts(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert align_documents(empty).count() == 0
    letters, words = "ab" * 300_000, "wide open " * 300_000
    got = {r["doc_id"]: r for r in align_documents(spark.createDataFrame([(1, letters), (2, words), (3, words)], "doc_id long, text string")).collect()}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in ((1, letters), (2, words)):
        assert got[i]["n_a"] == len(tokenizer.encode(" " + text, add_special_tokens=False).ids) and got[i]["n_links"] == got[i]["n_a"] + got[i]["n_b"] - got[i]["n_groups"]
    assert got[2][1:] == got[3][1:]
