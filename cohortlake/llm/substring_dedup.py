"""Substring dedup by level-wise doubling.

The first level looks at windows of half the target length. Of these only anchors are compared: any run of
the target length holds an anchor, chosen by its words alone, so a run that repeats has an anchor that
repeats. Windows at repeated anchors alone are extended to the target length, compared by a 128-bit hash,
and those that a document with a smaller id also holds mark their words. Windows that repeat in two documents
alone are extended to twice the length, whose hash joins those of the two halves, and so on until no
candidates survive; that gives each document the longest level at which it still repeats.

Documents with the same text are settled as a whole: all but the first are copies, which hold nothing that
the first doesn't. Windows are judged on the input, not on what is left.

Defined cases: a null text has no words; texts shorter than the target stay whole; null ids count as the
largest (2**63 - 1); rows that agree in id do not remove each other's words; an empty table gives an empty result; other
columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import dropped, keyed, light_join, released, written
from cohortlake.llm.sequences import BASES, anchors, copies, covered, mixed, repeated_anchors, starts_around, window_hashes
from cohortlake.llm.tokens import hashes_of, pieces, raw, word_places

MIN_WORDS = 50


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()  # splits at \x20 \x09-\x0D only


def word_units(column: pa.Array) -> Iterator[np.ndarray]:
    """The hashes of each row's words, in order, without an object for each word; a long text in parts."""
    open_: list[np.ndarray] = []
    row = 0
    for begin, part, _ in pieces(column, 1 << 20):
        data, rows = raw(part)
        starts, stops = word_places(data, rows)
        found = hashes_of(data, starts, stops)
        cuts = np.searchsorted(starts, rows).tolist()
        for k, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if begin + k > row:
                yield np.concatenate(open_)
                open_, row = [], begin + k
            open_.append(found[low:high])
    if open_:
        yield np.concatenate(open_)


def _print_batches(min_words: int):
    half = min_words // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, ats = [], []
            for units in word_units(batch.column("text")):
                found = window_hashes(units, half) if len(units) >= min_words else np.empty(0, np.uint64)
                at = anchors(found, min_words - half + 1)
                hashes.append(found[at].view(np.int64))
                ats.append(at.astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(hashes, pa.list_(pa.int64())), pa.array(ats, pa.list_(pa.int32()))], ["doc_id", "key", "hashes", "ats"])
            released()

    return run


def _window_batches(min_words: int):
    half = min_words // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, key, units, seeds in zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), word_units(batch.column("text")), batch.column("seeds").to_pylist(), strict=True):
                at = starts_around(np.array(seeds), min_words - half, len(units) - min_words)
                w1, w2 = (window_hashes(units if k == 0 else units ^ (units >> np.uint64(29)), min_words, BASES[k])[at].view(np.int64) for k in (0, 1))
                for low in range(0, len(at), 65_536):
                    some = slice(low, low + 65_536)
                    n = len(at[some])
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(doc_id, pa.int64()), n), pa.repeat(pa.scalar(key, pa.int64()), n), pa.array(at[some].astype(np.int32)), pa.array(w1[some]), pa.array(w2[some])], ["doc_id", "key", "start", "w1", "w2"])
            released()

    return run


def _keep_batches(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, copy, whole, longest, starts in zip(*(batch.column(c).to_pylist() for c in ("text", "copy", "whole", "longest", "starts")), strict=True):
                words = _words(text)
                kept = words
                if whole and len(words) >= min_words:  # a copy repeats in all its length
                    longest = min_words << (len(words) // min_words).bit_length() - 1
                if copy and len(words) >= min_words:
                    kept = []
                elif starts:
                    gone = covered(np.array(starts), np.array(starts) + min_words, len(words))
                    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                rows.append((len(words), len(words) - len(kept), longest, b" ".join(kept).decode("utf-8", "surrogatepass")))
            n, gone, longest, kept = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(longest, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "longest_repeat", "kept_text"])

    return run


ORDER = f"coalesce(doc_id, {2**63 - 1}L)"  # null ids last


def _repeated(windows: DataFrame) -> DataFrame:
    """w1, w2, first: window contents that occur in two documents or more."""
    groups = windows.groupBy("w1", "w2").agg(F.min(F.expr(ORDER)).alias("first"), F.max(F.expr(ORDER)).alias("last")).where("first < last").drop("last")
    return written(groups, "repeated-windows")


PACKED = "doc_id long, key long, later array<int>, starts array<int>, w1 array<long>, w2 array<long>"


def _doubled_batches(length: int):
    """Of each document's windows, which come together and in order: the starts to remove, and the windows of twice the length."""

    def packed(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        start, a, b, later = (table.column(c).to_numpy() for c in ("start", "w1", "w2", "later"))
        start, first = np.unique(start, return_index=True)  # rows that agree in id and text give the same windows
        a, b, later = a[first].view(np.uint64), b[first].view(np.uint64), later[first]
        ahead = np.searchsorted(start, start + length)
        has = np.flatnonzero((ahead < len(start)) & (start[np.minimum(ahead, len(start) - 1)] == start + length))
        to = ahead[has]
        w1 = mixed(a[has] * np.uint64(BASES[0]) + a[to])
        w2 = mixed((b[to] ^ (b[to] >> np.uint64(29))) * np.uint64(BASES[1]) + b[has])
        cells = [start[later], start[has], w1.view(np.int64), w2.view(np.int64)]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([rows[0].column("doc_id")[:1], rows[0].column("key")[:1], *(pa.array([c.astype(k.to_pandas_dtype())], pa.list_(k)) for c, k in zip(cells, kinds, strict=True))], [c.split()[0] for c in PACKED.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys, ids = batch.column("key").to_numpy(), batch.column("doc_id").fill_null(-(2**63)).to_numpy()
            nulls = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1]) | (nulls[1:] != nulls[:-1])) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
                if low == high:
                    continue
                part = batch.slice(low, high - low)
                if held and any(held[0].column(c)[0].as_py() != part.column(c)[0].as_py() for c in ("key", "doc_id")):
                    yield packed(held)
                    held = []
                held.append(part)
        if held:
            yield packed(held)

    return run


def levels(windows: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Doubling from the windows at the target length, a written table that goes here: doc_id, key, starts to remove; and doc_id, key, longest.

    A document's live windows come together in one row, which holds those that follow each other as windows of twice the length.
    """
    marks, reached = None, []
    while True:
        repeated = _repeated(windows)
        found = windows.join(repeated, ["w1", "w2"]).select("doc_id", "key", "start", "w1", "w2", (F.expr(ORDER) > F.col("first")).alias("later"))
        ordered = found.repartition("doc_id", "key").sortWithinPartitions("key", "doc_id", "start")
        alive = written(ordered.mapInArrow(_doubled_batches(length), PACKED), "live-windows")
        dropped(repeated, windows)
        marks = alive if marks is None else marks
        reached.append(alive.select("doc_id", "key", F.lit(length).alias("longest")))
        length *= 2
        if not alive.where(F.size("starts") > 0).take(1):
            break
        windows = written(alive.select("doc_id", "key", F.expr("inline(arrays_zip(starts, w1, w2))")).withColumnRenamed("starts", "start"), "doubled-windows")
    longest = reduce(DataFrame.unionByName, reached)
    return marks.where(F.size("later") > 0).select("doc_id", "key", F.col("later").alias("starts")), longest.groupBy("doc_id", "key").agg(F.max("longest").alias("longest"))


def substring_dedup(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, longest_repeat (the longest level of doubling at which a window of it also stands in another document; 0: none), kept_text."""
    base = keyed(docs, id_col, text_col)
    whole = copies(base)
    again = whole.where("later").select("doc_id", "key")
    prints = written(light_join(base, again, "left_anti").mapInArrow(_print_batches(min_words), "doc_id long, key long, hashes array<long>, ats array<int>"), "word-anchors")
    seeds = repeated_anchors(prints)
    dropped(prints)
    windows = written(light_join(base, seeds, "inner").mapInArrow(_window_batches(min_words), "doc_id long, key long, start int, w1 long, w2 long"), "word-windows")
    dropped(seeds)
    starts, longest = levels(windows, min_words)
    marks = whole.select("doc_id", "key", F.col("later").alias("copy"), F.lit(True).alias("whole"))
    notes = starts.unionByName(longest, allowMissingColumns=True).unionByName(marks, allowMissingColumns=True)
    notes = written(notes.groupBy("doc_id", "key").agg(F.first("starts", True).alias("starts"), F.max("longest").alias("longest"), F.max("copy").alias("copy"), F.max("whole").alias("whole")), "word-notes")
    yes = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    joined = light_join(base, notes, "left").select("doc_id", "text", "starts", F.coalesce("longest", F.lit(0)).cast("long").alias("longest"), yes("copy"), yes("whole"))
    return joined.mapInArrow(_keep_batches(min_words), "doc_id long, n_words long, n_removed long, longest_repeat long, kept_text string")
