"""Suffix-array dedup with deep-shallow sorting.

A sparse suffix array: only suffixes that can begin a repeat of ``min_bytes`` are sorted. Any such run holds
an anchor, a window of half the length chosen by its bytes alone; runs whose anchor occurs once can't repeat.
The remaining runs go to one bucket for each anchor and place of it in the run's context, and each bucket's
suffixes are sorted: multikey quicksort, eight bytes at a time, to a shallow depth, then blind tries for the
groups that are still tied. Neighbours in that order with a common prefix of ``min_bytes`` are one repeat,
and all its places but the first are removed.

Texts that agree as a whole are settled beforehand: all but the first are copies. Contexts that agree as a
whole are settled by an aggregation, so that buckets hold different contexts only. A bucket that is still
over ``bucket_size`` (a very common passage in many surroundings) is not sorted in one task: its runs are
compared by the same rule in a plain distributed aggregation.

Defined cases: a null text counts as empty; texts shorter than ``min_bytes`` stay whole unless the bytes
are covered by a longer run, which they can't be; null ids count as the largest; rows that agree in id are
one document, by start; an empty table gives an empty result; a cut through a character leaves bytes that
are not UTF-8, so the result holds bytes; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import dropped, keyed, light_join, place, written
from cohortlake.llm.sequences import anchors, copies, covered, repeated_anchors, starts_around, window_hashes

MIN_BYTES = 100
SHALLOW = 32


def _units(data: bytes) -> np.ndarray:
    return (np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * np.uint64(0xA24BAED4963EE407)


def _print_batches(min_bytes: int):
    half = min_bytes // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, ats = [], []
            for data in batch.column("text").cast(pa.binary()).to_pylist():
                found = window_hashes(_units(data), half) if len(data) >= min_bytes else np.empty(0, np.uint64)
                at = anchors(found, min_bytes - half + 1)
                hashes.append(found[at].view(np.int64))
                ats.append(at.astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(hashes, pa.list_(pa.int64())), pa.array(ats, pa.list_(pa.int32()))], ["doc_id", "key", "hashes", "ats"])

    return run


def _contexts(data: bytes, seeds: list[int], min_bytes: int) -> Iterator[tuple[int, int, int, int]]:
    """anchor hash, anchor position, first start, count: the candidate runs of a document by the anchor that is the first smallest in them."""
    half = min_bytes // 2
    found = window_hashes(_units(data), half)
    starts = starts_around(np.array(seeds), min_bytes - half, len(data) - min_bytes)
    if not len(starts):
        return
    view = np.lib.stride_tricks.sliding_window_view(found, min_bytes - half + 1)
    best = np.concatenate([starts[i : i + 65536] + view[starts[i : i + 65536]].argmin(axis=1) for i in range(0, len(starts), 65536)])
    cuts = np.flatnonzero(np.r_[True, (best[1:] != best[:-1]) | (starts[1:] != starts[:-1] + 1)])
    counts = np.diff(np.r_[cuts, len(starts)])
    yield from zip(found[best[cuts]].view(np.int64).tolist(), best[cuts].tolist(), starts[cuts].tolist(), counts.tolist(), strict=True)


def _context_batches(min_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "key", "anchor", "at", "start", "count", "bytes"]
        for batch in batches:
            rows: list[tuple] = []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for doc_id, key, data, seeds in zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), texts, batch.column("seeds").to_pylist(), strict=True):
                rows += [(doc_id, key, anchor, at - start, start, count, data[start : start + count - 1 + min_bytes]) for anchor, at, start, count in _contexts(data, seeds, min_bytes)]
                if len(rows) > 50_000:
                    yield _batch(rows, names)
                    rows = []
            yield _batch(rows, names)

    def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 7, kinds, strict=True)], names)

    return run


def blind_trie(texts: list[bytes]) -> list[list[int]]:
    """Indices of ``texts`` (of equal length) in sorted order, equal ones together.

    A node is [depth, {byte: node or leaf}], a leaf a list of indices. A search looks at the branching bytes
    only; one comparison with the leaf that it ends in then gives the depth at which the text belongs.
    """
    width = len(texts[0])
    root: list | None = None
    whole = [int.from_bytes(t, "big") for t in texts]

    def is_leaf(x) -> bool:
        return not isinstance(x[-1], dict)

    def any_leaf(x):
        while not is_leaf(x):
            x = next(iter(x[1].values()))
        return x

    for i, text in enumerate(texts):
        if root is None:
            root = [i]
            continue
        node = root
        while not is_leaf(node):
            node = node[1].get(text[node[0]]) or any_leaf(node)
        differ = whole[i] ^ whole[node[0]]
        if not differ:
            node.append(i)
            continue
        common = width - (differ.bit_length() + 7) // 8
        parent, node = None, root
        while not is_leaf(node) and node[0] < common:
            parent, node = node, node[1][text[node[0]]]
        if not is_leaf(node) and node[0] == common:
            node[1][text[common]] = [i]
            continue
        other = texts[any_leaf(node)[0]][common]
        branch = [common, {other: node, text[common]: [i]}]
        if parent is None:
            root = branch
        else:
            parent[1][text[parent[0]]] = branch
    out: list[list[int]] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if is_leaf(node):
            out.append(node)
        else:
            stack += [node[1][b] for b in sorted(node[1], reverse=True)]
    return out


def deep_shallow(data: np.ndarray, at: np.ndarray, group: np.ndarray, width: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes data[at:at + width] within their groups, and for each place in that order whether it equals the one before."""
    order = np.argsort(group, kind="stable")
    tied = np.r_[False, group[order][1:] == group[order][:-1]]
    eights = np.ndarray(max(0, len(data) - 7), ">u8", data, strides=(1,))  # the eight bytes at each place
    for depth in range(0, min(shallow, width) // 8 * 8, 8):
        block = np.cumsum(~tied)
        some = np.flatnonzero(tied | np.r_[tied[1:], False])
        if not len(some):
            break
        chars = eights[at[order[some]] + depth].astype(np.uint64)
        by = np.lexsort((chars, block[some]))
        order[some], chars = order[some][by], chars[by]
        tied[some[1:]] &= (chars[1:] == chars[:-1]) & (np.diff(some) == 1)
    # A group whose members all equal the one before them is in order already; tries sort the others.
    deep = np.lib.stride_tricks.sliding_window_view(data, width - shallow) if width > shallow else None
    ties, block, open_ = np.flatnonzero(tied), np.cumsum(~tied), set()
    for i in range(0, len(ties) if deep is not None else 0, 65536):
        some = ties[i : i + 65536]
        differ = (deep[at[order[some]] + shallow] != deep[at[order[some - 1]] + shallow]).any(axis=1)
        open_.update(np.unique(block[some[differ]]).tolist())
    begins = np.flatnonzero(~tied)
    ends = np.r_[begins[1:], len(tied)]
    for k in sorted(open_):
        begin, end = int(begins[k - 1]), int(ends[k - 1])
        members = order[begin:end].copy()
        raw = data[at[members][:, None] + np.arange(shallow, width)]
        to = begin
        for same in blind_trie([r.tobytes() for r in raw]):
            order[to : to + len(same)] = members[same]
            tied[to] = False
            tied[to + 1 : to + len(same)] = True
            to += len(same)
    return order, tied


def _sort_batches(min_bytes: int, most: int = 20_000):
    def repeats(rows: dict[str, list]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(rows["bytes"]), np.uint8)
        size, count = np.array([*map(len, rows["bytes"])]), np.array(rows["count"])
        row = np.repeat(np.arange(len(count)), count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        at = (np.cumsum(size) - size)[row] + step
        # Equal runs have their anchor at the same offset.
        offset = np.array(rows["at"])[row] - step
        bucket = np.unique(np.array(rows["anchor"]), return_inverse=True)[1][row] * (min_bytes + 1) + offset
        order, tied = deep_shallow(data, at, bucket, min_bytes)
        ids = np.array([2**63 - 1 if i is None else i for i in rows["doc_id"]])
        null = np.array([i is None for i in rows["doc_id"]])
        start = np.array(rows["start"])[row] + step
        equal = np.empty(len(order), np.int64)
        equal[order] = np.cumsum(~tied)
        some = order[tied | np.r_[tied[1:], False]]
        rank = some[np.lexsort((start[some], ids[row[some]], null[row[some]], equal[some]))]
        head = np.r_[True, equal[rank][1:] != equal[rank][:-1]][: len(rank)]
        first = rank[np.maximum.accumulate(np.where(head, np.arange(len(rank)), 0))]
        # Places are sorted, so those that differ from the first come after it.
        later = np.sort(rank[(null[row[rank]] != null[row[first]]) | (ids[row[rank]] != ids[row[first]]) | (start[rank] != start[first])])
        # Places that follow each other in a document leave as one run.
        cuts = np.flatnonzero(np.r_[True, (np.diff(later) != 1) | (np.diff(row[later]) != 0)][: len(later)])
        which = later[cuts]
        doc_id, key = (pa.array(rows[c], pa.int64()).take(pa.array(row[which])) for c in ("doc_id", "key"))
        return pa.RecordBatch.from_arrays([doc_id, key, pa.array(start[which], pa.int32()), pa.array(np.diff(np.r_[cuts, len(later)]), pa.int32())], ["doc_id", "key", "start", "count"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[str, list] = {}
        for batch in batches:
            for name in batch.schema.names:
                rows.setdefault(name, []).extend(batch.column(name).to_pylist())
            if rows and len(rows["anchor"]) > most:
                whole = len(rows["anchor"]) - 1  # rows come by anchor; the last anchor may go on in the next batch
                while whole and rows["anchor"][whole - 1] == rows["anchor"][-1]:
                    whole -= 1
                if whole:
                    yield repeats({k: v[:whole] for k, v in rows.items()})
                    rows = {k: v[whole:] for k, v in rows.items()}
        if rows and rows["anchor"]:
            yield repeats(rows)

    return run


def _keep_batches(min_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            spans = batch.column("spans")
            flat, sizes = spans.flatten(), pc.list_value_length(spans).fill_null(0).to_numpy()
            start, stop = flat.field("start").to_numpy(), flat.field("start").to_numpy() + flat.field("count").to_numpy() - 1 + min_bytes
            ends = np.cumsum(sizes)
            for data, copy, begin, end in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("copy").to_pylist(), (ends - sizes).tolist(), ends.tolist(), strict=True):
                if copy and len(data) >= min_bytes:
                    rows.append((len(data), len(data), 1, b""))
                elif begin < end:
                    gone = covered(start[begin:end], stop[begin:end], len(data))
                    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    rows.append((len(data), int(gone.sum()), runs, np.frombuffer(data, np.uint8)[~gone].tobytes()))
                else:
                    rows.append((len(data), 0, 0, data))
            parts = zip(*rows, strict=True) if rows else [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(parts, kinds, strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def repeated_runs(contexts: DataFrame, min_bytes: int, bucket_size: int) -> DataFrame:
    """doc_id, key, start, count: runs that start earlier elsewhere. ``contexts`` is a written table, which goes here."""
    given, contexts = contexts, contexts.withColumns({"c1": F.xxhash64("anchor", "at", "count", "bytes"), "c2": F.xxhash64("bytes", "count", "at", "anchor")})
    first = written(contexts.groupBy("c1", "c2").agg(F.min(place("start")).alias("first")), "first-contexts")
    marked = written(contexts.join(first, ["c1", "c2"]).withColumn("later", place("start") > F.col("first")).drop("first", "c1", "c2"), "contexts")
    dropped(given, first)
    settled = marked.where("later").select("doc_id", "key", "start", "count")
    # Rows that agree in id and text repeat a context at the same place; one is enough.
    firsts = marked.where("NOT later").dropDuplicates(["doc_id", "key", "start"])
    sizes = written(firsts.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "bucket-sizes")
    open_runs = firsts.join(sizes, "anchor").drop("later")
    sortable = open_runs.where(F.col("n") <= bucket_size).select("anchor", "doc_id", "key", "at", "start", "count", "bytes")
    found = sortable.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_sort_batches(min_bytes), "doc_id long, key long, start int, count int")
    common = open_runs.where(F.col("n") > bucket_size).select("doc_id", "key", F.expr(f"explode(transform(sequence(0, count - 1), i -> struct(start + i AS start, substring(bytes, i + 1, {min_bytes}) AS run)))").alias("r"))
    common = written(common.select("doc_id", "key", "r.start", F.xxhash64("r.run").alias("c1"), F.xxhash64(F.lit(1), "r.run").alias("c2")), "common-runs")
    earliest = written(common.groupBy("c1", "c2").agg(F.min(place("start")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "first-runs")
    rest = common.join(earliest, ["c1", "c2"]).where(place("start") > F.col("first")).select("doc_id", "key", "start", F.lit(1).alias("count"))
    return settled.unionByName(found).unionByName(rest)


def suffix_dedup(docs: DataFrame, min_bytes: int = MIN_BYTES, bucket_size: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept (bytes)."""
    base = keyed(docs, id_col, text_col)
    again = copies(base).where("later").select("doc_id", "key")
    prints = written(light_join(base, again, "left_anti").mapInArrow(_print_batches(min_bytes), "doc_id long, key long, hashes array<long>, ats array<int>"), "byte-anchors")
    seeds = repeated_anchors(prints)
    dropped(prints)
    contexts = light_join(base, seeds, "inner").mapInArrow(_context_batches(min_bytes), "doc_id long, key long, anchor long, at int, start int, count int, bytes binary")
    contexts = written(contexts, "contexts")
    dropped(seeds)
    runs = repeated_runs(contexts, min_bytes, bucket_size)
    spans = runs.groupBy("doc_id", "key").agg(F.collect_set(F.struct("start", "count")).alias("spans"))
    copied = again.withColumn("copy", F.lit(True))
    notes = written(spans.withColumn("copy", F.lit(False)).unionByName(copied, allowMissingColumns=True), "byte-notes")
    joined = light_join(base, notes, "left").select("doc_id", "text", F.coalesce("copy", F.lit(False)).alias("copy"), "spans")
    return joined.mapInArrow(_keep_batches(min_bytes), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
