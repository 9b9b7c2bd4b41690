"""Each operator against brute force on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortlake.llm import bpe_codec, decontamination, exact_dedup, html_extract, line_dedup, quality_classifier, secret_scan, sequences, simhash_dedup, substring_dedup, suffix_dedup
from cohortlake.llm.sequences import anchors, window_hashes

WORDS = ["the", "of", "and", "arsenic", "urine", "Blood", "café", "x", "naïve", "日本", "level", "mean"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, row string, copy int"


def texts(seed=0, n=40, words=120):
    r = random.Random(seed)
    common = " ".join(r.choice(WORDS) for _ in range(70))
    out = []
    for _ in range(n):
        t = [r.choice(WORDS) + str(r.randrange(40)) for _ in range(r.randrange(1, words))]
        if r.random() < 0.5:
            t.insert(r.randrange(len(t) + 1), common)
        out.append("\n".join(" ".join(t[i : i + 8]) for i in range(0, len(t), 8)))
    out += [out[3], out[3], out[5] + " \t", "", " \n", None, "a", "a " * 3000, "l1\nl2\nl3\nl4\n" + common.replace(" ", "\n"), "z\nl1\nl2\nl3"]
    return out


@pytest.fixture(scope="module")
def rows():
    found = [(i, t, "en", "s", 0, "k", "r", 1) for i, t in enumerate(texts())]
    return found + [found[3]]  # a row that repeats in full


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_empty_tables(spark, empty):
    for f in (exact_dedup.exact_dedup, line_dedup.line_dedup, secret_scan.secret_scan, simhash_dedup.simhash_groups, substring_dedup.substring_dedup, suffix_dedup.suffix_dedup, bpe_codec.round_trip):
        assert f(empty).collect() == []
    assert html_extract.extract_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
    assert decontamination.contaminated(empty, spark.createDataFrame([], "item_id long, text string")).collect() == []
    assert quality_classifier.select_quality(empty, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect() == []


def test_exact_dedup(docs, rows):
    out = exact_dedup.exact_dedup(docs).collect()
    assert len(out) == len(rows)
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i))
    for r in out:
        text = next(k for k, v in groups.items() if any(i == r["doc_id"] for _, i in v))
        assert r["keep_id"] == min(groups[text])[1] and r["group_size"] == len(groups[text]) and r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert sum(r["kept"] for r in out) == len(groups)


def test_a_full_filter_gives_the_same_groups(docs):
    a, b = (sorted(map(tuple, exact_dedup.exact_dedup(docs, max_bits=m).collect())) for m in (1, 2**28))
    assert a == b


def windows_of(lines):
    """Start and length of the windows of line dedup."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in lines]
    return [(s, n) for n in (1, 2, 3) for s in range(len(lines) - n + 1) if n == 3 or sum(size[s : s + n]) >= 50]


def test_line_dedup(spark, rows):
    long, r = [" ".join(f"w{i}" for i in range(k, k + 51)) for k in (0, 100, 200)], random.Random(1)
    more = [(500, long[0]), (501, "own line\n" + long[0]), (502, long[1][:200] + "\n" + long[1][200:]), (503, "x\n" + long[1][:200] + "\n" + long[1][200:] + "\ny"), (None, long[0]), (None, long[2] + "\n" + long[2])]
    more += [(600 + k, "\n".join(r.choice(["a b", long[2], long[0][:180], long[0][180:], "", "\tz"]) for _ in range(9))) for k in range(20)]
    rows = rows + [(i, t, "en", "s", 0, "k", "r", 1) for i, t in more]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    seen, want = {}, {}
    place = lambda i: (i is None, i or 0)
    for i, t in sorted({(i, t or "") for i, t, *_ in rows}, key=lambda x: (place(x[0]), x[1])):
        want[i, t] = lines = t.split("\n")
        for s, n in windows_of(lines):
            seen[tuple(lines[s : s + n])] = min((place(i), s), seen.get(tuple(lines[s : s + n]), (place(i), s)))
    expected = {}
    for (i, t), lines in want.items():
        gone = {s + k for s, n in windows_of(lines) if seen[tuple(lines[s : s + n])] < (place(i), s) for k in range(n)}
        expected[i, t] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone), len(lines))
    got = sorted((str(r["doc_id"]), r["kept_text"], r["n_removed"], r["n_lines"]) for r in line_dedup.line_dedup(docs).collect())
    assert got == sorted((str(i), *expected[i, t or ""]) for i, t, *_ in rows)
    assert any(kept == "own line" for kept, *_ in expected.values())


def test_substring_dedup(docs, rows):
    first, words = {}, {}
    for i, t in sorted({(i, t or "") for i, t, *_ in rows}):
        words[i] = re.findall(r"[^\x20\x09-\x0D]+", t)
        for s in range(len(words[i]) - 49):
            first.setdefault(tuple(words[i][s : s + 50]), i)
    out = by_id(substring_dedup.substring_dedup(docs))
    for i, w in words.items():
        gone = {s + k for s in range(len(w) - 49) if first[tuple(w[s : s + 50])] < i for k in range(50)}
        assert out[i]["kept_text"] == " ".join(x for k, x in enumerate(w) if k not in gone)
    assert sum(r["n_removed"] for r in out.values()) > 500
    where = {}
    for i, w in words.items():
        for n in (50, 100, 200, 400, 800, 1600, 3200):
            for s in range(len(w) - n + 1):
                where.setdefault((n, *w[s : s + n]), set()).add(i)
    longest = {i: max((n for n in (50, 100, 200, 400, 800, 1600, 3200) for s in range(len(w) - n + 1) if len(where[(n, *w[s : s + n])]) > 1), default=0) for i, w in words.items()}
    assert {i: r["longest_repeat"] for i, r in out.items()} == longest


@pytest.mark.parametrize("bucket_size", [0, 20_000])
def test_suffix_dedup(docs, rows, bucket_size):
    seen, whole = {}, {}
    for i, t in sorted({(i, t or "") for i, t, *_ in rows}):
        whole[i] = t.encode()
        for s in range(len(whole[i]) - 99):
            seen.setdefault(whole[i][s : s + 100], (i, s))
    out = by_id(suffix_dedup.suffix_dedup(docs, bucket_size=bucket_size))
    for i, b in whole.items():
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            if seen[b[s : s + 100]] < (i, s):
                gone[s : s + 100] = b"\1" * 100
        assert bytes(out[i]["kept"]) == bytes(x for x, g in zip(b, gone, strict=True) if not g)
        assert out[i]["n_spans"] == len(re.findall(b"\1+", bytes(gone)))


def test_deep_shallow_sort():
    r = random.Random(2)
    data = np.frombuffer(b"".join(r.choice([b"abcabc" * 20, b"q" * 60, b"hello world"]) for _ in range(60)), np.uint8)
    at, group = np.array([r.randrange(len(data) - 100) for _ in range(300)]), np.array([r.randrange(3) for _ in range(300)])
    order, tied = suffix_dedup.deep_shallow(data, at, group, 100)
    keys = [(group[i], data[at[i] : at[i] + 100].tobytes()) for i in order]
    assert keys == sorted(keys) and tied.tolist() == [False] + [a == b for a, b in zip(keys, keys[1:], strict=False)]


def test_equal_runs_share_an_anchor():
    x = np.random.default_rng(0).integers(0, 2**63, 400).astype(np.uint64)
    y = np.r_[x[100:150], x[:7]]
    hx, hy = window_hashes(x, 25), window_hashes(y, 25)
    assert set(hx[anchors(hx, 26)]) & set(hy[anchors(hy, 26)])


def test_repeated_hashes_however_they_are_dealt(spark):
    r = random.Random(11)
    lists = [[r.randrange(2**40) if r.random() < 0.5 else r.randrange(-30, 30) for _ in range(r.randrange(40))] for _ in range(200)] + [[5] * 3000, [], [2**63 - 1, -(2**63), -(2**63)]]
    prints = spark.createDataFrame([(x,) for x in lists], "hashes array<long>").repartition(7)
    count = Counter(h for x in lists for h in x)
    for part_size, fan in [(500_000, 1024), (20, 1024), (20, 8)]:
        got = [x["hash"] for x in sequences.repeated_hashes(prints, part_size, fan).collect()]
        assert sorted(got) == sorted(h for h, n in count.items() if n > 1)


def test_simhash(docs, rows):
    def print_of(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        h = [xxhash.xxh64(" ".join(w[k : k + 3]).encode(), seed=42).intdigest() for k in range(max(1, len(w) - 2))] if w else []
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = {i: print_of(t) for i, t, *_ in rows}
    group = {i: i for i in prints}
    for _ in prints:
        for i in prints:
            group[i] = min(group[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= 3)
    out = by_id(simhash_dedup.simhash_groups(docs))
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in out.items()} == {i: (f"{prints[i]:016x}", group[i]) for i in prints}
    kept = simhash_dedup.simhash_dedup(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted({*group.values()})


def test_simhash_keeps_unlike_texts_without_or_with_one_id(spark):
    r = random.Random(12)
    a, b, c, d, e = (" ".join(r.choice(WORDS) + str(r.randrange(400)) for _ in range(60)) for _ in range(5))
    rows = [(1, a), (None, a), (None, b), (None, c), (None, c), (2, d), (2, e), (2, e), (3, d), (4, None), (None, "")]
    kept = simhash_dedup.simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, [(1, a), (None, b), (None, c), (2, d), (2, e), (4, None)]))


def test_bk_trees_find_all_links():
    rng = np.random.default_rng(1)
    near = rng.integers(0, 2**63, 30).astype(np.uint64)
    prints = np.unique(np.r_[near, near ^ (np.uint64(1) << rng.integers(0, 64, 30).astype(np.uint64)), near ^ np.uint64(0b1111)])
    label = simhash_dedup.local_links(np.zeros(len(prints), np.int64), prints, 3, frontier=50)
    want = np.arange(len(prints))
    for _ in prints:
        want = np.array([min(want[j] for j in range(len(prints)) if int(prints[i] ^ prints[j]).bit_count() <= 3) for i in range(len(prints))])
    assert (label == want).all()


def test_sharded_buckets_lose_no_link(spark):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 2**62))
    prints = sorted({base ^ (1 << int(b)) for b in rng.integers(0, 40, 60)} | {base ^ (7 << 20)})
    df = spark.createDataFrame([(p,) for p in prints], "print long")
    sizes = [{r["component"] for r in simhash_dedup.components(simhash_dedup.links(df, shard_size=s)).collect()} for s in (5, 50_000)]
    assert sizes[0] == sizes[1] == {prints[0]}


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_split_buckets_equal_brute_force(spark, radius):
    rng = np.random.default_rng(radius)
    top = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, 6)]
    flipped = {t ^ sum(1 << int(b) for b in set(rng.integers(0, 63, int(k)))) for t in top for k in rng.integers(0, 9, 40)}
    prints = sorted({*flipped, 0, -1, -(2**63)})
    df = spark.createDataFrame([(p,) for p in prints], "print long")
    label = list(range(len(prints)))
    near = [(i, j) for i in range(len(prints)) for j in range(i) if ((prints[i] ^ prints[j]) & (2**64 - 1)).bit_count() <= radius]
    for _ in prints:
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
    want = {prints[i]: prints[label[i]] for i in range(len(prints)) if label.count(label[i]) > 1}
    for size in (1, 20):
        found = {r["node"]: r["component"] for r in simhash_dedup.components(simhash_dedup.links(df, radius, size)).collect()}
        assert found == want


def test_codec_equals_the_library(docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    shared = bpe_codec.prepare(docs, lexicon_size=20)
    encoded = bpe_codec.encode(docs, shared)
    ids, back = by_id(encoded), by_id(bpe_codec.decode(encoded, shared))
    for i, t, *_ in rows:
        want = library.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(ids[i]["ids"], "<u4").tolist() == want and back[i]["decoded"] == library.decode(want, skip_special_tokens=False)
    codec = bpe_codec.Codec(shared.value[1], bpe_codec.compiled({}))
    r = random.Random(9)
    for n in (90, 101, 150, 5000):
        word = "".join(r.choice("etaonrish") if r.random() < 0.8 else r.choice("aé日zxü") for _ in range(n))
        assert np.frombuffer(codec.encode(word), "<u4").tolist() == library.encode(word, add_special_tokens=False).ids
    for t in ("I'd SAY: it's Σίσυφος' <|endoftext|>x<|startoftext|>", "ﬁ½ Ⅷ ǅ İ \u0085é", "a​b 😀 한국어 don't"):
        assert np.frombuffer(codec.encode(t), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_automaton_shares_suffixes_and_keeps_ids():
    words = {w.encode(): [i, i + 1] for i, w in enumerate(["tap", "taps", "top", "tops", "stop", "é"])}
    lexicon = bpe_codec.Lexicon(bpe_codec.compiled(words))
    assert all(np.frombuffer(lexicon.get(w), "<u4").tolist() == ids for w, ids in words.items())
    assert [lexicon.get(x) for x in (b"", b"ta", b"tapx", b"z")] == [None] * 4
    assert len(lexicon.final) < sum(map(len, words))


def test_secret_scan(spark):
    key, weak = "AKIA" + "Q" * 16, "Zx9" * 8
    found = [(1, f"{key} and {weak} at https://db.example.org/x"), (2, f"only {weak} here"), (3, "Token: 'abcde' secret=token :abcdefgh é password = hunter22"), (4, None), (4, "f" * 24 + " " + "F" * 24), (5, key + " " + "y " * 400 + weak)]
    out = secret_scan.secret_scan(spark.createDataFrame(found, "doc_id long, text string"))
    got = sorted((r["doc_id"], [(s["kind"], s["start"], s["stop"]) for s in r["spans"]], r["n_assign"]) for r in out.collect())
    assert got[0][1] == [("access", 0, 20), ("token", 25, 49), ("endpoint", 53, 77)]
    assert got[1][1] == [] and got[5][1] == [("access", 0, 20)]
    # The first two matches have values of five signs; they are dropped, and what they covered isn't searched again.
    assert [found[2][1][a:b] for _, a, b in got[2][1]] == ["password = hunter22"]
    assert got[3][1] == [] and got[4][1] == [("hex", 0, 24)]


def spans_by_hand(text, scope=256):
    """All spans of secret_scan by plain loops: base ones, and weak ones near their complement."""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    base = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    base += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    base += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    weak = [(m.start(), 3, m.end()) for m in re.finditer(secret_scan.IDENTIFIER, text, re.A)]
    weak += [(m.start(), 4, m.end()) for m in re.finditer(secret_scan.DENSE, text) if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])]
    weak += [(m.start(), 5, m.end()) for m in re.finditer(secret_scan.ENDPOINT, text)]
    weak = [w for w in weak if not any(b[0] <= w[0] and w[2] <= b[2] for b in base)]
    near = lambda w, kinds: any(o[1] in kinds and abs(o[0] - w[0]) <= scope or o[1] in kinds and o[0] // scope == w[0] // scope for o in base + weak)
    needs = {3: [(0, 2, 4)], 4: [(1, 3)], 5: [(1, 3), (0, 2, 4)]}
    linked = [w for w in weak if all(near(w, kinds) for kinds in needs[w[1]])]
    return sorted(base), sorted(base + linked)


def test_secret_scan_equals_brute_force(spark, docs):
    r = random.Random(11)
    bits = ["token: abcdef9", "Secret='x'", "AKIA" + "Q9" * 9, "ab12" * 7, "https://h.example/p?q=1", "client_id=me.you", "login: bob", "Zx9_" * 6, "password=Zx9Zx9Zx9Zx9Zx9Zx9", "é日 " * 20, "word " * 40, "\n"]
    rows = [(1000 + k, " ".join(r.choice(bits) for _ in range(r.randrange(30)))) for k in range(60)] + [(None, bits[0]), (2000, None), (2001, "")]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    out = secret_scan.secret_scan(spark.createDataFrame(more, "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("base", F.lit("x")))
    show = lambda spans: ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)
    want = []
    for i, text in more:
        base, every = spans_by_hand(text or "")
        want.append((str(i), *[sum(k == n for _, k, _ in base) for n in range(3)], show(base), show(every)))
    got = out.select("doc_id", "n_assign", "n_access", "n_hex", secret_scan.spans_string("base").alias("b"), secret_scan.spans_string("spans").alias("s")).collect()
    assert sorted(want) == sorted((str(x[0]), *x[1:]) for x in got)
    assert any(s != b for *_, b, s in want)


def test_secret_scan_of_many_matches(spark):
    (r,) = secret_scan.secret_scan(spark.createDataFrame([(1, "token=abcdef1 " * 100_000)], "doc_id long, text string")).collect()
    assert r["n_assign"] == 100_000 and (r["spans"][-1]["start"], r["spans"][-1]["stop"]) == (1_399_986, 1_399_999)


def test_html(spark):
    page = lambda body: f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li>Menu</li></ul></nav><header>Head</header>{body}<div class='cookie-notice'>We use cookies</div><aside>Side</aside><form>Name</form><section id=comments><p>Nice!</p></section><footer>Foot</footer></body></html>"
    rows = [
        (1, "http://a.org/x/1", page("<article><h1>One &amp; two</h1><p>First  <b>par</b>agraph<br>line<p>Second<script>x='</p>'</script></article>")),
        (2, "http://a.org/x/2", page("<div>Shared slogan</div><div>Own text</div>")),
        (3, "http://a.org/x/3", page("<div>Shared slogan</div><div>Other text</div>")),
        (4, "http://b.org/", None), (5, None, ""), (6, "http://c.org/a", "<p>Alone<p>Still"),
    ]
    out = html_extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {r["page_id"]: r["text"] for r in out.collect()}
    assert got == {1: "One & two\n\nFirst paragraph line\n\nSecond", 2: "Own text", 3: "Other text", 4: "", 5: "", 6: "Alone\n\nStill"}


def test_shared_lines_are_a_longest_common_subsequence():
    r = random.Random(5)
    for _ in range(100):
        a, b = ([r.randrange(6) for _ in range(r.randrange(12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert sum(html_extract.shared(a, b)) == sum(html_extract.shared(a, b, 0)) == best[-1][-1] == decontamination.common_length(a, b)


def test_html_is_the_same_however_it_is_cut(spark):
    """Pages of one host against brute force over sorted neighbours, for several partition counts; copies, repeated rows, null ids and urls, clashing columns and one very long page."""
    r = random.Random(7)
    line = lambda: "".join(r.choice("abcde ") for _ in range(12)).strip() or "x"
    shared = [line() for _ in range(8)]

    def page(k):
        body = [line() + f" {k}" for _ in range(r.randrange(1, 6))]
        for x in r.sample(shared, 5):
            body.insert(r.randrange(len(body) + 1), x)
        return "".join(f"<div>{x}</div>" for x in body)

    rows = [(k, f"http://h.org/{r.choice('abc')}/{r.choice('xyz')}/{k}", page(k)) for k in range(300)]
    rows += [(900, rows[5][1] + "0", rows[5][2]), rows[7], rows[7], (None, "http://h.org/a", page(1)), (None, None, page(2)), (901, None, None), (902, "http://h.org/b/long", "".join(f"<p>{i % 50} line</p>" for i in range(20_000)))]
    cells = [(i, u, h, 1, True, "x") for i, u, h in rows]
    df = spark.createDataFrame(cells, "page_id long, url string, html string, block int, guest boolean, texts string").repartition(5)
    found = []
    for n in ("4", "61"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted((str(x["page_id"]), str(x["url"]), x["text"]) for x in html_extract.extract_text(df).collect()))
        spark.conf.set("spark.sql.shuffle.partitions", before)
    place = lambda x: (*html_extract.split_url(x[1]), x[0] is None, x[0] or 0)
    order = sorted(rows, key=place)
    lines = [[t for t, _ in html_extract.lines(h or "")] for *_, h in order]
    want = []
    for k, (i, u, _) in enumerate(order):
        near = [j for j in (k - 1, k + 1) if 0 <= j < len(order) and place(order[j])[0] == place(order[k])[0]]
        common = lambda j: len([1 for _ in itertools.takewhile(lambda ab: ab[0] == ab[1], zip(place(order[j])[1], place(order[k])[1], strict=False))])
        gone, best = [False] * len(lines[k]), None
        for j in sorted(near, key=lambda j: -common(j)):
            if best is not None and common(j) < best:
                break
            same = html_extract.shared(lines[k], lines[j])
            if not lines[k] or not all(same):
                gone, best = [a or b for a, b in zip(gone, same, strict=True)], common(j)
        want.append((str(i), str(u), "\n\n".join(t for t, g in zip(lines[k], gone, strict=True) if not g)))
    assert found[0] == found[1] == sorted(want)


def test_decontamination(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 6)))
    pool = [word() for _ in range(600)]
    text = lambda n: " ".join(r.choice(pool) for _ in range(n))
    items = [(k, text(30)) for k in range(8)]
    docs = [(i, text(200)) for i in range(60)]
    docs += [(100 + k, text(70) + " " + t + " " + text(40)) for k, t in items]
    changed = [(200 + k, text(40) + " " + " ".join(w if n % 6 else "new" for n, w in enumerate(t.split())) + " " + text(40)) for k, t in items]
    docs += [*changed, (300, None), (301, ""), docs[60]]
    out = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([*items, (9, None), (10, "two words")], "item_id long, text string"), cosine=0.5)
    got = {(x["doc_id"], x["item_id"]) for x in out.collect()}
    assert {(100 + k, k) for k in range(8)} <= got <= {(100 + k, k) for k in range(8)} | {(200 + k, k) for k in range(8)}
    assert len(got) >= 14


def test_decontamination_defined_cases(spark):
    """Clashing columns, repeated rows, null ids, ties of items and long texts in parts; decontaminate drops the rows that are found and no other."""
    words = [f"w{i}" for i in range(400)]
    item = words[:40]
    rows = [(1, " ".join(item)), (1, " ".join(item)), (2, " ".join(words[100:300])), (None, " ".join(item)), (None, "clean text"), (3, None), (4, ""), (5, " ".join(words[100:] * 300 + item + words[50:]))]
    docs = spark.createDataFrame([(*x, "k", 1, "r") for x in rows], "doc_id long, text string, key string, item_id int, row string")
    bench = spark.createDataFrame([(7, " ".join(item), "x"), (8, " ".join(item).upper() + ".", "x"), (None, None, "x")], "item_id long, text string, doc_id string")
    got = sorted((x["doc_id"] or 0, x["item_id"]) for x in decontamination.contaminated(docs, bench).collect())
    assert got == [(0, 7), (0, 8), (1, 7), (1, 7), (1, 8), (1, 8), (5, 7), (5, 8)]
    left = decontamination.decontaminate(docs, bench)
    assert left.columns == docs.columns and sorted(str(x["doc_id"]) for x in left.collect()) == ["2", "3", "4", "None"]
    assert decontamination.decontaminate(docs, bench.where("false")).count() == len(rows)


def planted(spark, lengths, offsets, share, seed):
    """Recall of items of the lengths whose words are exchanged in ``share`` of all places and which a search by common subsequence accepts; at the production defaults."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(3, 7)))
    pool = [*{word() for _ in range(3000)}]
    words = lambda n: r.choices(pool, k=n)
    items = [(k, words(n)) for k, n in enumerate(lengths)]
    docs, wanted = [(i, " ".join(words(300))) for i in range(200)], set()
    for k, item in items:
        for o in offsets:
            new = [w if r.random() >= share else r.choice(pool) for w in item]
            if decontamination.common_length(item, new) >= 0.6 * len(item) and decontamination.common_length(item[-8:], new) >= 0.5 * len(item[-8:]):
                wanted.add((1000 + 100 * k + o, k))
                docs.append((1000 + 100 * k + o, " ".join(words(48 + o) + new + words(40))))
    out = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(k, " ".join(t)) for k, t in items], "item_id long, text string"))
    got = {(x["doc_id"], x["item_id"]) for x in out.collect()}
    assert len(wanted) > 20 and got <= wanted
    return len(got) / len(wanted)


def test_decontamination_recall_of_paraphrases(spark):
    assert planted(spark, range(32, 60, 3), range(0, 8, 2), 0.25, 8) >= 0.9


def test_decontamination_of_short_items(spark):
    assert planted(spark, range(8, 32, 3), range(8), 0, 9) == 1
    assert planted(spark, range(16, 32, 2), range(8), 0.2, 10) >= 0.9


def test_decontamination_looks_only_at_windows_that_may_hold_an_item(spark):
    """Few windows get a latent vector, yet with every cosine allowed all places on the grid come out that a brute force over windows finds; heads with a repeated word too."""
    r = np.random.default_rng(5)
    common, words = [f"c{k}" for k in range(12)], [f"w{k}" for k in range(400)]
    item = lambda n: [str(r.choice(common if r.random() < 0.5 else words)) for _ in range(n)]
    items = [item(int(n)) for n in r.integers(8, 70, 300)]  # more than TELLING_ITEMS of several shapes
    docs = []
    for k in range(36):
        text = item(int(r.integers(0, 120)))
        if k % 4:
            new = [w if r.random() < 0.75 else str(r.choice(words)) for w in items[int(r.integers(len(items)))]]
            at = int(r.integers(len(text) + 1))
            text[at:at] = new
        docs.append((k, " ".join(text)))
    texts, passages = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x["at_word"] for x in decontamination.contaminated(texts, passages, cosine=-1.5).collect()}
    want: dict[tuple[int, int], set] = {}
    for d, text in docs:
        words_of = text.split()
        for k, t in enumerate(items):
            n, step = decontamination._shape(len(t))
            spans = [(at, at + 2 * n, False) for at in range(0, len(words_of), 2 * step)]
            spans += [(at, at + len(t), True) for at in range(len(words_of)) if words_of[at : at + 8] == t[:8]]
            for a, b, head in spans:
                window = words_of[max(0, a - 8) : b + 8]
                if sum(map(set(window).__contains__, t)) >= 0.6 * len(t) and decontamination.common_length(t, window) >= 0.6 * len(t) and decontamination.common_length(t[-8:], window) >= 4:
                    want.setdefault((d, k), set()).add(a)
                    if not head:
                        break
    assert got.keys() == want.keys() and len(got) > 18
    assert all(at in want[k] for k, at in got.items())
    # The window search can't find anything at this limit: what is left is found by its first words.
    repeated = "one two one two three one four five six seven eight nine ten eleven twelve".split()
    found = decontamination.contaminated(spark.createDataFrame([(1, "before it " + " ".join(repeated))], "doc_id long, text string"), spark.createDataFrame([(7, " ".join(repeated))], "item_id long, text string"), cosine=2.0)
    assert [(x["doc_id"], x["item_id"], x["at_word"]) for x in found.collect()] == [(1, 7, 2)]


def test_telling_words_leave_few_windows():
    """A text that often holds rare words of many items, but never enough of any one, gets no window; before, one mark for all items let such windows through."""
    r = np.random.default_rng(6)
    items = [r.choice(1 << 32, 40, replace=False).astype("<u4") for _ in range(20)]
    idf = np.ones(1 << decontamination.FEATURE_BITS, np.float32)
    telling = decontamination._telling(items, idf, 0.6)
    mixed = np.concatenate([np.array([i[k] for i in items], "<u4") for k in range(40)])
    runs = lambda words: decontamination._runs(words, words & decontamination.MARKS, telling, np.full(20, 56))
    assert all(len(x) == 0 for x in runs(mixed))
    item, first, last = runs(np.r_[mixed, items[3]])
    assert set(item) == {3} and first.min() >= len(mixed) - 56 and last.max() < len(mixed) + 40


def test_latent_vectors_are_fitted_on_every_passage(spark):
    """More passages than the 200,000 that once were a sample: 440 texts of 500 passages, a rare one among them, against a sum by brute force."""
    r = np.random.default_rng(3)
    texts = [r.integers(0, 1 << 32, 16_000, dtype=np.uint64).astype("<u4") % np.uint32(3000 + 40 * k) for k in range(40)]
    texts[7] = np.r_[texts[7], np.repeat(np.uint32(8191), 5)]  # a passage of fewer words
    often = [1 if k == 7 else 11 for k in range(40)]
    rows = [(k, 100 * k + j, t.tobytes()) for k, t in enumerate(texts) for j in range(often[k])]
    words = spark.createDataFrame(rows, "doc_id long, key long, ids binary").repartition(9)
    idf, total = decontamination.inverse_frequencies(words)
    assert total == sum(n * -(-len(t) // 32) for n, t in zip(often, texts, strict=True)) > 200_000
    basis = np.linalg.qr(np.random.default_rng(1).standard_normal((8192, 64)))[0]
    for k in range(2):
        sketch = np.zeros(basis.shape)
        for n, t in zip(often, texts, strict=True):
            for i in range(0, len(t), 32 * 100):
                part = t[i : i + 32 * 100]
                a = np.zeros((-(-len(part) // 32), 8192))
                np.add.at(a, (np.arange(len(part)) // 32, part), idf[part].astype(float))
                size = np.bincount(np.arange(len(part)) // 32, idf[part].astype(float) ** 2)
                sketch += n * (a.T @ (a @ basis / size[:, None]))
        if k == 0:
            basis = np.linalg.qr(sketch)[0]
    values, inner = np.linalg.eigh(basis.T @ sketch)
    want = idf[:, None] * (basis @ (inner / np.sqrt(values)))
    got = decontamination.latent_vectors(words, idf, total)
    assert np.array_equal(got, decontamination.latent_vectors(words, idf, total))
    some = np.r_[0:4600:50, 8191]  # the vectors themselves may turn
    assert np.abs(got[some] @ got[some].T - want[some] @ want[some].T).max() < 1e-3 * np.abs(want[some] @ want[some].T).max()


def test_decontamination_of_few_words_and_unspaced_scripts(spark):
    passage = "人体尿液中砷的浓度与饮用水中砷的含量有关并且随年龄增加"
    items = [(1, "Arsenic trioxide"), (2, passage), (3, "血中铅"), (4, "..."), (5, "")]
    docs = [(10, "of arsenic, trioxide"), (11, "on (arsenic trioxide)."), (12, "arsenic trioxides"), (13, "我们发现" + passage + "。结论"), (14, "血中的铅"), (15, "测血中铅值"), (16, "..."), (None, "ARSENIC TRIOXIDE arsenic trioxide")]
    out = decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(((x["doc_id"] or 0, x["item_id"]) for x in out.collect())) == [(0, 1), (10, 1), (11, 1), (13, 2), (15, 3)]


def test_quality(spark):
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 6)))
    pool = [word() for _ in range(300)]

    def row(i):
        w = [r.choice(pool) for _ in range(r.randrange(20, 200))]
        kind = i % 5
        if kind == 0:
            w[r.randrange(len(w))] = "scoundrel"
        elif kind == 1:
            w = [x + "$$$" for x in w]
        return i, " ".join(w), int(kind != 1), int(kind == 0)

    rows = [row(i) for i in range(400)]
    labels = spark.createDataFrame([(i, q, t) for i, _, q, t in rows[:250]] + [(None, 1, 1), (9999, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows] + [(5000, None), (5001, "")], "doc_id long, text string")
    kept = {x["row"]["doc_id"] for x in quality_classifier.select_quality(docs, labels).collect()}
    held = rows[250:]
    right = sum((i in kept) == (q == 1 and t == 0) for i, _, q, t in held)
    assert right >= 0.95 * len(held)
    assert quality_classifier.select_quality(docs, labels.where("false")).count() == docs.count()
    # Repeated rows, ids that several rows share, null ids and clashing columns are scored like any other row.
    more = docs.where("doc_id < 260").unionByName(docs.where("doc_id < 20")).withColumns({"row": F.lit("r"), "score": F.lit(0), "grade": F.lit(9)})
    more = more.unionByName(more.where("doc_id BETWEEN 250 AND 259").withColumn("doc_id", F.lit(None).cast("long")))
    out = quality_classifier.select_quality(more, labels, max_rows=100)
    kept = [x["row"]["doc_id"] for x in out.collect()]
    assert out.select("row.*").columns == more.columns
    assert all(kept.count(i) == 2 * (i in kept) for i in range(20)) and kept.count(None) == sum(250 <= i < 260 for i in kept if i is not None)


def test_near_dedup_reads_documents_twice(spark, docs, rows, tmp_path):
    path = str(tmp_path / "docs")
    docs.write.parquet(path)
    out = simhash_dedup.simhash_dedup(spark.read.parquet(path))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lang#") and plan.count("n_chars#") and len(re.findall(r"Relation \[doc_id#\d+L?,text#", plan)) == 2
    assert out.columns == docs.columns and out.count() <= len(rows)


def test_intermediate_tables_go(spark, docs):
    import os

    from cohortlake.llm import common

    folder = common.shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with common.intermediate(spark) as keep:
        keep.append(common.written(simhash_dedup.simhash_dedup(docs), "result"))
    left = set(os.listdir(folder)) - before
    assert len(left) == 1 and keep[0].count() > 0
    common.dropped(keep[0])
    assert set(os.listdir(folder)) == before


def test_a_session_without_a_shared_folder(tmp_path):
    """Spark's own settings on a machine alone: the folder is ours, on a cluster it must be named."""
    import os
    import subprocess
    import sys

    code = (
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "from cohortlake.llm.common import shared_folder, written\n"
        "a, b = written(spark.range(5), 'x'), written(spark.range(3), 'x')\n"
        "print('rows', a.count() + b.count(), shared_folder(spark) == shared_folder(spark))"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_SUBMIT_ARGS"} | {"SPARK_CONF_DIR": str(tmp_path)}
    said = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120, cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    assert "rows 8 True" in said.stdout, said.stderr[-2000:]


def test_blocks_of_benchmark_items_give_the_same(spark):
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 6)))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([5, 9, 20, 40, 60, 80, 12])]
    texts = [" ".join([*(word() for _ in range(30)), items[k % 7][1], *(word() for _ in range(30))]) for k in range(14)] + [" ".join(word() for _ in range(100))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = [sorted((x["doc_id"], x["item_id"], x["at_word"]) for x in decontamination.contaminated(docs, benchmark, block_items=n).collect()) for n in (20_000, 2)]
    assert found[0] == found[1] and {(d, i) for d, i, _ in found[0]} >= {(k, k % 7) for k in range(14)}
