"""Benchmark decontamination by latent semantic retrieval.

Texts become arrays of hashed words, written once. Document frequencies count every passage of every
document. A randomised singular value decomposition of the TF-IDF passages gives each word a latent vector;
it is fitted on every passage of every document, and search covers every window of every document. A window's latent vector is a difference of running sums over blocks of ``FINE`` words, so one scan
compares windows with all benchmark passages of like length by cosine. Windows start at every ``STRIDE``-th
word, for items of fewer than ``SHORT`` words at every ``FINE``-th. Places that hold the first ``HEAD`` words of
an item are candidates too, whatever their cosine, so that no verbatim passage depends on where it starts.
Candidates are then checked: the longest common subsequence of words must cover ``least_common`` of the passage,
and ``least_answer`` of its answer, the last ``ANSWER`` words. The first window of a document that passes stands
for the item. Items of fewer than ``least_words`` words are found where all their words follow each other.

Vectors are only made for windows that can pass: a subsequence of ``least_common`` of an item misses a known
number of its words, so of any larger set of its words, such as its rarest, some must stand in the window. They are
counted for each item by itself, in runs of places of its rarest words.

A document of more than ``most_words`` words is searched in overlapping parts, so that memory is bounded.

A character of a script without spaces counts as a word.

Benchmark passages are broadcast in blocks of ``block_items``, whose size is fixed; a larger benchmark takes
more scans of the word arrays. No pairs are made beyond candidates, and nothing of the documents goes to the
driver but counts for each of the 2**FEATURE_BITS hashed words and the sketch, a row of RANK numbers for each of them.

Defined cases: null texts are empty and match nothing; null items too; items without a letter
or digit too; null ids and repeated rows each give their own rows;
empty tables give an empty result; other columns are left out.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import dropped, keyed, light_join, released, text_of, written
from cohortlake.llm.tokens import Words, pieces, raw, words_of

FEATURE_BITS = 13
RANK = 64
STRIDE = 8
SHORT = 32
FINE = 2
HEAD = 8
PASSAGE = 32
ANSWER = 8


# Thai to Myanmar, Khmer, kana and the ideographs; a character takes its marks along.
_UNSPACED = [(0x0E00, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF)]
_MARKS = "".join(chr(c) for a, b in _UNSPACED[:4] for c in range(a, b + 1) if unicodedata.category(chr(c))[0] == "M")
_unspaced = re.compile(f"[{''.join(f'{chr(a)}-{chr(b)}' for a, b in _UNSPACED)}][{_MARKS}]*")


_may_be_unspaced = np.isin(np.arange(256), [0xE0, 0xE1, *range(0xE3, 0xEA), 0xEF, 0xF0, 0xF1, 0xF2, 0xF3])  # first bytes


def words_in(column: pa.Array, back: int = 0) -> Iterator[tuple[int, pa.Array, Words, int]]:
    """First row, lower-cased texts and words of the parts of a column, and the words already seen; a character of a script without spaces is a word."""
    for begin, part, seen in pieces(column, back=back):
        again = int(word_ids(pa.array([raw(part)[0][:seen].tobytes()]).cast(pa.string()))[1][0]) if seen else 0
        if _may_be_unspaced[raw(part)[0]].any():
            part = pa.array([_unspaced.sub(r" \g<0> ", t) for t in part.to_pylist()], pa.large_string())
        part = pc.utf8_lower(part)
        yield begin, part, words_of(part), again


def word_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """32 bits of each bare word's hash, and how many words each row has."""
    ids, counts = [np.empty(0, "<u4")], np.zeros(len(column), np.int64)
    for begin, part, w, _ in words_in(column):
        ids.append((w.hash >> np.uint64(32)).astype("<u4"))
        counts[begin : begin + len(part)] += np.bincount(w.row, minlength=len(part))
    return np.concatenate(ids), counts


def packed_ids(column: pa.Array) -> pa.Array:
    ids, counts = word_ids(column)
    return pa.Array.from_buffers(pa.large_binary(), len(column), [None, pa.py_buffer(np.r_[0, np.cumsum(4 * counts)].astype(np.int64)), pa.py_buffer(ids)]).cast(pa.binary())


def _id_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), packed_ids(batch.column("text"))], ["doc_id", "key", "ids"])
        released()


def _features(ids: np.ndarray) -> np.ndarray:
    return ids & (1 << FEATURE_BITS) - 1


def _passages(column: pa.Array, most: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, numbers and features of passages of PASSAGE consecutive words, filled up by -1, in parts."""
    for begin, part, _ in pieces(column, most, 4 * PASSAGE):
        data, rows = raw(part)
        ids, rows = data.view("<u4"), rows // 4
        sizes = np.diff(rows)
        n = -(-sizes // PASSAGE)
        row = np.repeat(np.arange(len(sizes)), n)
        number = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        at = (rows[:-1][row] + number * PASSAGE)[:, None] + np.arange(PASSAGE)
        inside = at < rows[1:][row][:, None]
        found = np.where(inside, _features(ids)[np.minimum(at, max(len(ids) - 1, 0))].astype(np.int16) if len(ids) else 0, np.int16(-1))
        yield row + begin, number, found


def _frequency_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen, total = np.zeros(1 << FEATURE_BITS, np.int64), 0
    for batch in batches:
        for _, _, found in _passages(batch.column("ids")):
            found = np.sort(found, axis=1)
            once = np.c_[found[:, :1] >= 0, (found[:, 1:] != found[:, :-1]) & (found[:, 1:] >= 0)]
            seen += np.bincount(found[once], minlength=1 << FEATURE_BITS)
            total += len(found)
    some = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, some]), pa.array(np.r_[total, seen[some]])], ["feature", "n"])


def inverse_frequencies(words: DataFrame) -> tuple[np.ndarray, int]:
    """Over the passages of all documents; and how many these are."""
    counts = words.select("ids").mapInArrow(_frequency_batches, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()  # 2**FEATURE_BITS + 1 rows at most
    by = {r["feature"]: r["n"] for r in counts}
    total = by.pop(-1, 0)
    n = np.zeros(1 << FEATURE_BITS)
    n[[*by]] = [*by.values()]
    return np.log((total + 1) / (n + 1)).astype(np.float32) + np.float32(0.1), total


OFTEN = 64
TOGETHER = 4096
NEAR_ROWS, NEAR_FEATURES = 512, 1024  # rows of RANK numbers that a core's cache holds
SKETCH_PASSAGES = 400_000
SLICE = 128


def _summed_by_passage(weighted: np.ndarray, f: np.ndarray) -> np.ndarray:
    """For each passage the sum of its features' rows of ``weighted``."""
    out = np.empty((len(f), weighted.shape[1]), np.float32)
    more = np.empty((NEAR_ROWS, weighted.shape[1]), np.float32)
    for i in range(0, len(f), NEAR_ROWS):
        by_place = np.ascontiguousarray(f[i : i + NEAR_ROWS].T)
        sums = np.take(weighted, by_place[0], axis=0, out=out[i : i + NEAR_ROWS], mode="clip")
        for place in by_place[1:]:
            sums += np.take(weighted, place, axis=0, out=more[: len(sums)], mode="clip")
    return out


def _summed_by_feature(out: np.ndarray, f: np.ndarray, y: np.ndarray) -> None:
    """Adds to each feature's row of ``out`` the rows of ``y`` of the passages that hold it, as often as they hold it."""
    order = np.argsort(f.ravel().astype(np.int16), kind="stable")
    cells, row = f.ravel()[order], order // PASSAGE
    first = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    counts = np.diff(np.r_[first, len(cells)])
    feature = cells[first]
    real = feature < len(out) - 1  # the last is what fills up
    often = np.flatnonzero((counts > OFTEN) & real)
    if len(often):
        n = counts[often]
        at = np.arange(n.sum()) + np.repeat(first[often] - (np.cumsum(n) - n), n)
        held = np.bincount(row[at] * len(often) + np.repeat(np.arange(len(often)), n), minlength=len(f) * len(often)).astype(np.float32)
        out[feature[often]] += held.reshape(len(f), -1).T @ y
    few = np.flatnonzero((counts <= OFTEN) & real)
    few = few[np.argsort(-counts[few].astype(np.int16), kind="stable")]
    more = np.empty((NEAR_FEATURES, y.shape[1]), np.float32)
    for i in range(0, len(few), NEAR_FEATURES):
        some = few[i : i + NEAR_FEATURES]
        at, times = first[some], counts[some]
        sums = np.take(y, row[at], axis=0, mode="clip")
        for k, n in enumerate(np.searchsorted(-times, -np.arange(1, times[0])).tolist(), 1):  # n features come a k-th time more
            sums[:n] += np.take(y, row[at[:n] + k], axis=0, out=more[:n], mode="clip")
        out[feature[some]] += sums


def _sketch_batches(idf: np.ndarray, basis: np.ndarray):
    """slice, part: sum over all passages a of a' (a basis), each scaled to unit length, in slices of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((basis.shape[0] + 1, basis.shape[1]))
        square = np.r_[idf, np.float32(0)] ** 2
        weighted = np.r_[idf[:, None] * basis, np.zeros((1, basis.shape[1]))].astype(np.float32)
        for batch in batches:
            for _, _, found in _passages(batch.column("ids"), TOGETHER * PASSAGE * 4):
                for i in range(0, len(found), TOGETHER):
                    f = np.where(found[i : i + TOGETHER] < 0, len(idf), found[i : i + TOGETHER]).astype(np.int64)
                    y = _summed_by_passage(weighted, f)
                    y /= np.maximum(np.take(square, f).sum(axis=1), np.float32(1e-9))[:, None]
                    _summed_by_feature(out, f, y)
        parts = (idf[:, None] * out[:-1]).reshape(-1, SLICE * basis.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts))), pa.array([x.tobytes() for x in parts.astype(np.float32)], pa.binary())], ["slice", "part"])

    return run


def _added_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of the parts of each slice."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, part in zip(batch.column("slice").to_pylist(), batch.column("part").to_pylist(), strict=True):
            sums[k] = sums.get(k, 0.0) + np.frombuffer(part, np.float32).astype(np.float64)
    yield pa.RecordBatch.from_arrays([pa.array([*sums], pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["slice", "part"])


def sketched(words: DataFrame, idf: np.ndarray, basis: np.ndarray, total: int) -> np.ndarray:
    """Sum over the ``total`` passages a of all documents of a' (a basis). A task takes about SKETCH_PASSAGES, so that few sums of the sketch's size shuffle."""
    tasks = words.select("ids").coalesce(max(12, -(-total // SKETCH_PASSAGES)))
    parts = tasks.mapInArrow(_sketch_batches(idf, basis), "slice long, part binary").withColumn("task", F.spark_partition_id())
    parts = parts.repartition("slice").sortWithinPartitions("slice", "task").select("slice", "part")  # in order: the same sums each time
    out = np.zeros((len(basis) // SLICE, SLICE * basis.shape[1]))
    for r in parts.mapInArrow(_added_batches, "slice long, part binary").collect():  # one row for each slice
        out[r["slice"]] = np.frombuffer(r["part"])
    return out.reshape(basis.shape)


def latent_vectors(words: DataFrame, idf: np.ndarray, total: int, rounds: int = 2) -> np.ndarray:
    """Weighted latent vector of each feature: rows of diag(idf) V S**-1 for the leading singular values S and right singular vectors V of all passages."""
    basis = np.linalg.qr(np.random.default_rng(1).standard_normal((1 << FEATURE_BITS, RANK)))[0]
    for k in range(rounds):
        sketch = sketched(words, idf, basis, total)
        if k == rounds - 1:
            values, inner = np.linalg.eigh(basis.T @ sketch)
            # Scaled to unit variance: else the few leading directions, shared by all texts of a language, make any two passages alike.
            basis = basis @ (inner / np.sqrt(np.maximum(values, 1e-6 * max(values.max(), 1e-9))))
        else:
            basis = np.linalg.qr(sketch)[0]
        del sketch
        released()  # the driver's memory too
    return (idf[:, None] * basis).astype(np.float32)


def common_length(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by bits of one long integer."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    row = (1 << len(a)) - 1
    full = row
    for x in b:
        hit = row & where.get(x, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _shape(n_words: int) -> tuple[int, int]:
    """Blocks of a window and from one window to the next."""
    width, step = (4, FINE) if n_words < SHORT else (STRIDE, STRIDE)
    return max(1, round(n_words / width)) * width // FINE, step // FINE


SIGN_BITS = 256


def _signs(ids: np.ndarray, cuts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """For each block of words the set of its words' last eight bits, packed."""
    seen = np.zeros((len(cuts), SIGN_BITS), bool)
    for k in range(FINE):
        more = np.flatnonzero(cuts + k < stops)
        seen[more, ids[cuts[more] + k] & SIGN_BITS - 1] = True
    return np.packbits(seen, axis=1, bitorder="little")


def _block_sums(vectors: np.ndarray, ids: np.ndarray, cuts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Sum of the vectors of the words of blocks, of which only the last one of a text may be short."""
    f = _features(ids)
    out = vectors[f[cuts]]
    for k in range(1, FINE):
        more = np.flatnonzero(cuts + k < stops)
        if len(more) == len(cuts):
            out += vectors[f[cuts + k]]
        else:
            out[more] += vectors[f[cuts[more] + k]]
    return out


def _around(signs: np.ndarray, n: int) -> np.ndarray:
    """The union of the signs of the n blocks from each block on and of STRIDE words on both sides of them."""
    side = STRIDE // FINE
    whole = n + 2 * side
    none = np.zeros_like(signs[:1])
    out = np.concatenate([none.repeat(side, axis=0), signs, none.repeat(whole - 1 - side, axis=0)])
    done = 1
    while done < whole:
        step = min(done, whole - done)
        out = out[:-step] | out[step:]
        done += step
    return out


def _may_share(signs: np.ndarray, where: np.ndarray, which: np.ndarray, slots: np.ndarray, masks: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Of the candidates those whose signs hold ``least`` words of the item: a bound from above, so that none is lost."""
    out = np.empty(len(where), bool)
    for i in range(0, len(where), 1 << 14):
        w, k = where[i : i + (1 << 14)], which[i : i + (1 << 14)]
        out[i : i + (1 << 14)] = np.count_nonzero(signs[w[:, None], slots[k]] & masks[k], axis=1) >= least[k]
    return out


def _packed_items(items: list[np.ndarray], least_common: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte and bit of each word of an item, padded by bits that never match, and the least number of words."""
    slots = np.zeros((len(items), max(map(len, items))), np.int64)
    masks = np.zeros(slots.shape, np.uint8)
    for k, ids in enumerate(items):
        slots[k, : len(ids)] = (ids & SIGN_BITS - 1) >> 3
        masks[k, : len(ids)] = 1 << (ids & 7)
    return slots, masks, np.array([least_common * len(ids) for ids in items])


MARK_BITS = 18
MARKS = np.uint32((1 << MARK_BITS) - 1)
TELLING_ITEMS = 256
HEAD_PLACES = (1 << np.arange(HEAD)).astype(np.uint8)


def _telling(items: Sequence[np.ndarray], idf: np.ndarray, least_common: float) -> tuple:
    """The rarest words of TELLING_ITEMS items or fewer: marks of them, the words in order, the items of each, and how many of an item's any window that passes it must hold."""
    words, owner, need = [], [], []
    for k, ids in enumerate(items):
        missed = len(ids) - int(np.ceil(least_common * len(ids) - 1e-9))
        rare = np.unique(ids[np.argsort(-idf[_features(ids)], kind="stable")[: missed + 1 + len(ids) // 8]])
        words.append(rare)
        owner.append(np.full(len(rare), k, np.uint8))
        need.append(max(1, int(np.isin(ids, rare).sum()) - missed))
    every, owner = np.concatenate(words), np.concatenate(owner)
    order = np.argsort(every, kind="stable")
    known, first = np.unique(every[order], return_index=True)
    marks = np.zeros(1 << MARK_BITS, bool)
    marks[known & MARKS] = True
    return marks, known, np.r_[first, len(every)], owner[order], np.array(need)


def _runs(joined: np.ndarray, low: np.ndarray, telling: tuple, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Items, ascending, and the first and last place of as many of an item's telling words in a row as its windows must hold, less than ``widths`` apart."""
    marks, known, first, owner, need = telling
    at = np.flatnonzero(marks[low])
    slot = np.minimum(np.searchsorted(known, joined[at]), len(known) - 1)
    same = known[slot] == joined[at]
    at, slot = at[same], slot[same]
    times = first[slot + 1] - first[slot]
    place = np.repeat(at, times)
    item = owner[np.arange(len(place)) + np.repeat(first[slot] - (np.cumsum(times) - times), times)]
    order = np.argsort(item, kind="stable")
    item, place = item[order], place[order]
    last = np.arange(len(item)) + need[item] - 1
    begin = np.flatnonzero(last < len(item))
    last = last[begin]
    some = (item[last] == item[begin]) & (place[last] - place[begin] < widths[item[begin]])
    return item[begin[some]].astype(np.int64), place[begin[some]], place[last[some]]


def _parts(rows: list[tuple], most_words: int, overlap: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """Row, first word and words of texts or overlapping parts of long texts, about ``most_words`` words together."""
    held, size = [], 0
    for k, row in enumerate(rows):
        ids = np.frombuffer(row[2], "<u4")
        for begin in range(0, max(1, len(ids) - overlap), most_words):
            part = ids[begin : begin + most_words + overlap]
            held.append((k, begin, part))
            size += len(part)
            if size > most_words:
                yield held
                held, size = [], 0
    if held:
        yield held


def _search_batches(shared, cosine: float, least_common: float, least_answer: float, most_words: int = 1 << 16):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, idf, items = shared.value
        by_shape: dict[tuple[int, int], list] = {}
        for item in items:
            by_shape.setdefault(_shape(len(item[1])), []).append(item)
        groups, ordered = [], []
        for n, found in by_shape.items():
            ids = [i for _, i in found]
            groups.append((n, [(item, i.tolist()) for item, i in found], _unit(np.stack([vectors[_features(i)].sum(axis=0) for i in ids])).T, _packed_items(ids, least_common)))
            ordered += [(i, n[0] * FINE + 2 * STRIDE) for i in ids]
        telling = []
        for k in range(0, len(ordered), TELLING_ITEMS):
            ids, widths = zip(*ordered[k : k + TELLING_ITEMS], strict=True)
            telling.append((_telling(ids, idf, least_common), np.array(widths)))
        heads: dict[bytes, list] = {}
        head_words = np.zeros(1 << MARK_BITS, np.uint8)  # a bit for each of the HEAD places
        for item, ids in items:
            if len(ids) >= HEAD:
                heads.setdefault(ids[:HEAD].tobytes(), []).append((item, ids))
                np.bitwise_or.at(head_words, ids[:HEAD] & MARKS, HEAD_PLACES)  # a word may come twice
        # Parts start where windows do.
        overlap = -(-(max(len(i) for _, i in items) + 4 * STRIDE) // STRIDE) * STRIDE
        for batch in batches:
            rows = [*zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True)]
            found: dict[tuple[int, int], tuple] = {}
            for parts in _parts(rows, most_words, overlap):
                begins = np.cumsum([0, *(len(p[2]) for p in parts)])
                joined = np.concatenate([p[2] for p in parts])
                low = joined & MARKS
                _search(rows, parts, begins, joined, low, found, vectors, groups, telling)
                _search_heads(rows, parts, begins, joined, low, found, vectors, heads, head_words)
            yield _found_batch([*found.values()])

    def _checked(part: list[int], window: list[int]) -> tuple[float, float] | None:
        """Shares of the item and of its answer in the window, if they suffice."""
        common = common_length(part, window) / len(part)
        if common < least_common:
            return None
        answer = common_length(part[-ANSWER:], window) / len(part[-ANSWER:])
        return (common, answer) if answer >= least_answer else None

    def _hopeful(begins: np.ndarray, joined: np.ndarray, low: np.ndarray, groups: list, telling: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each group part and first word of the windows that hold enough telling words of an item, the words around them included."""
        runs = [_runs(joined, low, *t) for t in telling]
        item, begin, last = (np.concatenate(x) for x in zip(*runs, strict=True))
        item += np.repeat(np.arange(len(runs)) * TELLING_ITEMS, [len(r[0]) for r in runs])
        part = np.searchsorted(begins, begin, side="right") - 1
        whole = np.flatnonzero(last < begins[part + 1])
        item, part = item[whole], part[whole]
        begin, last = begin[whole] - begins[part], last[whole] - begins[part]
        stops = np.searchsorted(item, np.cumsum([0, *(len(g[1]) for g in groups)])).tolist()
        for ((n, step), *_), a, b in zip(groups, stops[:-1], stops[1:], strict=True):
            grid = step * FINE
            counts = -(-np.diff(begins) // grid)
            base = np.r_[0, np.cumsum(counts)]
            lowest = -(-np.maximum(last[a:b] + 1 - n * FINE - STRIDE, 0) // grid)
            highest = np.minimum((begin[a:b] + STRIDE) // grid, counts[part[a:b]] - 1)
            some = lowest <= highest
            at = base[part[a:b]][some]
            changes = np.bincount(at + lowest[some], minlength=base[-1] + 1) - np.bincount(at + highest[some] + 1, minlength=base[-1] + 1)
            window = np.flatnonzero(np.cumsum(changes[:-1]) > 0)
            where = np.searchsorted(base, window, side="right") - 1
            yield where, (window - base[where]) * grid

    def _search(rows: list[tuple], parts: list[tuple], begins: np.ndarray, joined: np.ndarray, low: np.ndarray, found: dict, vectors: np.ndarray, groups: list, telling: list) -> None:
        windows = [*_hopeful(begins, joined, low, groups, telling)]
        if not any(len(part) for part, _ in windows):
            return
        first = np.r_[0, np.cumsum(-(-np.diff(begins) // FINE))]
        # Running sums and signs of the blocks of such windows and of those around them only.
        changes = np.zeros(first[-1] + 1, np.int64)
        placed = []
        for ((n, _), *_), (part, at) in zip(groups, windows, strict=True):
            starts = first[part] + at // FINE
            stops = np.minimum(starts + n, first[part + 1])
            placed.append((starts, stops))
            changes += np.bincount(np.maximum(starts - STRIDE // FINE, first[part]), minlength=len(changes))
            changes -= np.bincount(np.minimum(stops + STRIDE // FINE, first[part + 1]), minlength=len(changes))
        inside = np.cumsum(changes[:-1]) > 0
        rank = np.r_[0, np.cumsum(inside)]
        block = np.flatnonzero(inside)
        text = np.searchsorted(first, block, side="right") - 1
        cuts = begins[text] + (block - first[text]) * FINE
        ends = np.minimum(cuts + FINE, begins[text + 1])
        sums = np.zeros((len(block) + 1, vectors.shape[1]), np.float64)
        np.cumsum(_block_sums(vectors, joined, cuts, ends), axis=0, out=sums[1:])
        signs = _signs(joined, cuts, ends)
        for ((n, _), items, against, packed), (part, at), (starts, stops) in zip(groups, windows, placed, strict=True):
            if not len(part):
                continue
            latent = (sums[rank[stops]] - sums[rank[starts]]).astype(np.float32)
            size = np.maximum(np.sqrt(np.einsum("ij,ij->i", latent, latent)), 1e-9)
            near = latent @ against
            where, which = np.divmod(np.flatnonzero(near >= np.float32(cosine) * size[:, None]), len(items))
            may = _may_share(_around(signs, n), rank[starts[where]], which, *packed)
            where, which = where[may], which[may]
            last, window, held = -1, [], frozenset()
            for i, k in zip(where.tolist(), which.tolist(), strict=True):
                if i != last:
                    last = i
                    row, offset, words_of_part = parts[int(part[i])]
                    begin = int(at[i])
                    window = words_of_part[max(0, begin - STRIDE) : begin + n * FINE + STRIDE].tolist()
                    held = frozenset(window)
                item, words = items[k]
                # The words that occur at all bound the common subsequence.
                if (row, item) in found or sum(map(held.__contains__, words)) < least_common * len(words):
                    continue
                shares = _checked(words, window)
                if shares:
                    found[row, item] = (*rows[row][:2], item, float(near[i, k] / size[i]), *shares, offset + begin)

    def _search_heads(rows: list[tuple], parts: list[tuple], begins: np.ndarray, joined: np.ndarray, low: np.ndarray, found: dict, vectors: np.ndarray, heads: dict, head_words: np.ndarray) -> None:
        if len(joined) < HEAD:
            return
        places = head_words[low]
        begin = np.flatnonzero(places[: 1 - HEAD] & HEAD_PLACES[0])
        for k in range(HEAD - 1, 0, -1):
            begin = begin[(places[begin + k] & HEAD_PLACES[k]) > 0]
        for at in begin.tolist():
            for item, ids in heads.get(joined[at : at + HEAD].tobytes(), ()):
                row, offset, text = parts[int(np.searchsorted(begins, at, side="right")) - 1]
                if (row, item) in found:
                    continue
                begin = at - int(begins[np.searchsorted(begins, at, side="right") - 1])
                words = ids.tolist()
                shares = _checked(words, text[max(0, begin - STRIDE) : begin + len(words) + STRIDE].tolist())
                if shares:
                    a, b = _unit(np.stack([vectors[_features(x)].sum(axis=0) for x in (text[begin : begin + len(words)], ids)]))
                    found[row, item] = (*rows[row][:2], item, float(a @ b), *shares, offset + begin)

    return run


def _found_batch(found: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
    parts = zip(*found, strict=True) if found else [()] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(parts, kinds, strict=True)], ["doc_id", "key", "item_id", "cosine", "common", "answer", "at_word"])


def _bare_words(part: pa.Array, w: Words, at: slice) -> list[bytes]:
    data = raw(part)[0]
    return [data[a : a + n].tobytes() for a, n in zip(w.first[at].tolist(), w.bare[at].tolist(), strict=True)]


def _verbatim_batches(shared):
    """Places where all words of a short item follow each other, by the words themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_first: dict[int, list] = {}
        ids, texts = zip(*shared.value, strict=True)
        for begin, part, w, _ in words_in(pa.array(texts, pa.string())):
            for k in range(len(part)):
                at = slice(int(np.searchsorted(w.row, k)), int(np.searchsorted(w.row, k + 1)))
                if w.bare[at].any():
                    by_first.setdefault(int(w.hash[at.start]), []).append((ids[begin + k], _bare_words(part, w, at)))
        firsts = np.array([*by_first], np.uint64)
        for batch in batches:
            doc_ids, keys = batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()
            found: dict[tuple[int, int], tuple] = {}
            before = np.zeros(batch.num_rows, np.int64)  # words of a long text in earlier parts
            for begin, part, w, again in words_in(batch.column("text"), back=2 * max(len(t.encode()) for t in texts) + 64):
                starts = np.searchsorted(w.row, np.arange(len(part)))
                before[begin] -= again
                for at in np.flatnonzero(np.isin(w.hash, firsts)).tolist():
                    row = int(w.row[at])
                    for item, words in by_first[int(w.hash[at])]:
                        if (begin + row, item) not in found and at + len(words) <= len(w.row) and w.row[at + len(words) - 1] == row and _bare_words(part, w, slice(at, at + len(words))) == words:
                            found[begin + row, item] = (doc_ids[begin + row], keys[begin + row], item, 1.0, 1.0, 1.0, int(before[begin + row]) + at - int(starts[row]))
                before[begin : begin + len(part)] += np.bincount(w.row, minlength=len(part))
            yield _found_batch([*found.values()])

    return run


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), packed_ids(batch.column("text")), batch.column("text")], ["item_id", "ids", "text"])


def _cut(items: DataFrame, block_items: int) -> Iterator[list]:
    """The rows in blocks, whose size is bounded by block_items; they are cut by a hash of the item."""
    blocks = -(-items.count() // block_items)
    for block in range(blocks):
        yield items.where(F.pmod(F.xxhash64(*items.columns), F.lit(blocks)) == block).collect()


def contaminated(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.4, least_common: float = 0.6, least_answer: float = 0.5, least_words: int = 8, block_items: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key, item_id, cosine, common, answer, at_word: documents that hold a benchmark item, once for each item."""
    spark = docs.sparkSession
    kind = "doc_id long, key long, item_id long, cosine double, common double, answer double, at_word long"
    words = written(keyed(docs, id_col, text_col).mapInArrow(_id_batches, "doc_id long, key long, ids binary"), "word-ids")
    idf, total = inverse_frequencies(words)
    vectors = latent_vectors(words, idf, total)
    items = written(benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text")).mapInArrow(_item_batches, "item_id long, ids binary, text string"), "benchmark-ids")
    found = [spark.createDataFrame([], kind)]

    def searched(rows: DataFrame, search, what) -> None:
        """One block of items: its places are written and its broadcast goes before the next one's is sent."""
        shared = spark.sparkContext.broadcast(what)
        found.append(written(rows.mapInArrow(search(shared), kind), "benchmark-places"))
        shared.destroy()

    for part in _cut(items.where(F.length("ids") >= 4 * least_words).select("item_id", "ids"), block_items):
        held = [(r["item_id"], np.frombuffer(bytes(r["ids"]), "<u4")) for r in part]
        searched(words, lambda shared: _search_batches(shared, cosine, least_common, least_answer), (vectors, idf, held))
    dropped(words)
    for part in _cut(items.where(F.length("ids").between(1, 4 * least_words - 1)).select("item_id", "text"), block_items):
        searched(keyed(docs, id_col, text_col), _verbatim_batches, [(r["item_id"], r["text"]) for r in part])
    return reduce(DataFrame.unionByName, found)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item."""
    dirty = written(contaminated(docs, benchmark, id_col=id_col, text_col=text_col, **limits).select("doc_id", "key").distinct(), "contaminated")
    packed = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col), text_of(text_col)).alias("key"))
    return light_join(packed, dirty, "left_anti").select("row.*")
