"""SimHash near-dedup with BK-trees.

A document's fingerprint has a bit for every bit that is set in over half of its shingle hashes. Two
fingerprints link at ``radius`` differing bits or fewer. Fingerprints that link agree on at least one of
``radius + 1`` blocks of bits, so each distinct fingerprint goes to one bucket for each block. A bucket over
``shard_size`` is split in the same way by ``radius + 1`` pieces of its other bits. In a bucket
the fingerprints form a BK-tree: a node's children are keyed by their integer Hamming distance to it, and a
search follows only the edges within the radius of the distance found. Split buckets that are still over
``shard_size`` are cut into shards, and a task takes two shards of a bucket and builds their trees, so that none
holds more. The trees are not broadcast: together they hold all fingerprints, which grow with the input and would
have to pass the driver. Copies collapse before this: the trees hold distinct fingerprints only, and a bucket gives
back a link from each fingerprint to the smallest one of its local group, never all pairs.

Links join to components by star contraction over written tables. Fingerprints, links and components stay
distributed; the driver sees counts and checksums.

Defined cases: a null or blank text has fingerprint zero and links like any other; null ids get the
smallest id of their component, or null if there is none; repeated rows each give a row; an empty table
gives an empty result; other columns are left out. ``simhash_dedup`` tells rows by id and text: rows without
an id, or with one id, that have different texts stay or go each by its own component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import dropped, join_rows, keyed, light_split, place, text_of, written

SEED = 42
BITS = 64


def fingerprint(text: str, shingle: int = 3) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only \x20 \x09-\x0D split
    if not words:
        return 0
    joined = b" ".join(words)
    stops = np.cumsum([len(w) + 1 for w in words]) - 1
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        starts = [0, *(stops[:-shingle] + 1).tolist()]
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops[shingle - 1 :].tolist(), strict=True)]
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[i : i + (1 << 16)], np.uint64)
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = pa.array([fingerprint(t) for t in batch.column("text").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), prints], ["doc_id", "key", "print"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key, print (signed 64-bit) for each row."""
    return keyed(docs, id_col, text_col).mapInArrow(_fingerprint_batches, "doc_id long, key long, print long")


def bk_trees(group: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """root of each item's tree; child[node, distance] or -1. Items are sorted by group and distinct in it; all trees grow a level at a time."""
    n = len(prints)
    child = np.full((n, BITS + 1), -1, np.int32)
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    root = np.repeat(first, np.diff(np.r_[first, n]))
    at, left = root.copy(), np.flatnonzero(root != np.arange(n))
    while len(left):
        edge = at[left] * (BITS + 1) + np.bitwise_count(prints[left] ^ prints[at[left]])
        edges, chosen = np.unique(edge, return_index=True)
        child.reshape(-1)[edges] = left[chosen]
        at[left] = child.reshape(-1)[edge]
        left = np.delete(left, chosen)
    return root, child


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each group, after the links a-b."""
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            return label
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while (label[label] != label).any():
            label = label[label]


def local_links(group: np.ndarray, prints: np.ndarray, radius: int, frontier: int = 2_000_000) -> np.ndarray:
    """For each item the index of the first item of its local group."""
    root, child = bk_trees(group, prints)
    size = np.bincount(root, minlength=len(root))[root]
    label, begin = np.arange(len(prints)), 0
    total = np.cumsum(size)
    near = np.arange(-radius, radius + 1)
    while begin < len(prints):
        end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + frontier)))
        query, node = np.arange(begin, end), root[begin:end]
        while len(query):
            away = np.bitwise_count(prints[query] ^ prints[node]).astype(np.int64)
            hit = (away <= radius) & (query != node)
            if hit.any():
                label = join_labels(label, query[hit], node[hit])
            reach = away[:, None] + near
            found = np.where((reach > 0) & (reach <= BITS), child[node[:, None], np.clip(reach, 0, BITS)], -1)
            which, k = np.nonzero(found >= 0)
            query, node = query[which], found[which, k]
        begin = end
    return label


def _link_batches(radius: int, most: int = 100_000):
    def links(group: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        label = local_links(group, prints, radius)
        some = label != np.arange(len(label))
        a, b = prints[some].view(np.int64), prints[label[some]].view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, prints, last = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for batch in batches:
            bucket = np.column_stack([batch.column(c).to_numpy() for c in ("block", "piece", "pair")])
            if not len(bucket):
                continue
            begins = (bucket != np.vstack([bucket[:1] if last is None else last, bucket[:-1]])).any(axis=1)
            group, last = np.r_[group, (group[-1] if len(group) else 0) + np.cumsum(begins)], bucket[-1:]  # numbered in their order
            prints = np.r_[prints, batch.column("print").to_numpy().view(np.uint64)]
            whole = int(np.searchsorted(group, group[-1])) if len(group) else 0  # the last bucket may go on in the next batch
            if whole >= most or len(group) - whole > most and whole:
                yield links(group[:whole], prints[:whole])
                group, prints = group[whole:], prints[whole:]
        if len(group):
            yield links(group, prints)

    return run


def links(prints: DataFrame, radius: int = 3, shard_size: int = 50_000) -> DataFrame:
    """a, b with a > b: links between distinct fingerprints that join all that are within the radius. ``prints``: one column, distinct."""
    width = BITS // (radius + 1)
    fine = (BITS - width) // (radius + 1)
    spots = []
    for j in range(radius + 1):
        block = f"{j} * {2**width}L + (shiftrightunsigned(print, {j * width}) & {2**width - 1}L)"
        rest = f"shiftleft(shiftrightunsigned(shiftrightunsigned(print, {j * width}), {width}), {j * width}) | (print & {2 ** (j * width) - 1}L)"
        spots.append(f"struct({block} AS block, {rest} AS rest)")
    placed = prints.select("print", F.expr(f"inline(array({', '.join(spots)}))"))
    # At most (radius + 1) * 2**width rows, whatever the input: 262,144 for radius 3.
    large = placed.groupBy("block").agg((F.count("*") > shard_size).alias("large")).where("large")
    # Two fingerprints of one block differ at radius bits or fewer in the rest, so they agree on one of radius + 1 pieces of it.
    pieces = ", ".join(f"{i} * {2**fine}L + (shiftrightunsigned(rest, {i * fine}) & {2**fine - 1}L)" for i in range(radius + 1))
    split = placed.join(F.broadcast(large), "block", "left").select("print", "block", F.expr(f"explode(CASE WHEN large THEN array({pieces}) ELSE array(-1L) END)").alias("piece"))
    # These grow with the input: no hint, adaptive execution broadcasts them where they are small.
    sizes = split.where("piece >= 0").groupBy("block", "piece").agg(F.ceil(F.count("*") / shard_size).cast("int").alias("shards")).where("shards > 1")
    cut = split.join(sizes, ["block", "piece"], "left").withColumn("shards", F.coalesce("shards", F.lit(1))).withColumn("own", F.expr("cast(pmod(xxhash64(print), shards) as int)"))
    sent = cut.select("print", "block", "piece", F.expr("explode(transform(sequence(0, shards - 1), k -> least(k, own) * 4294967296L + greatest(k, own)))").alias("pair"))
    bucket = ["block", "piece", "pair"]
    return sent.repartition(*bucket).sortWithinPartitions(*bucket, "print").mapInArrow(_link_batches(radius), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``edges`` (a > b), by alternating large and small stars."""
    edges, before = written(edges, "links"), None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("sum")).first()
        if state == before or state["n"] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(smallest, "a")
        small = small.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(smallest.select("a", F.col("least").alias("b")))
        old, edges = edges, written(small.distinct(), "links")
        dropped(old)


def _groups(docs: DataFrame, radius: int, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: doc_id, key, print and ``least``, the place of its component's first row by id (null ids last) and key."""
    rows = written(fingerprints(docs, id_col, text_col), "fingerprints")
    each = written(rows.groupBy("print").agg(F.min(place("key")).alias("least")), "distinct-fingerprints")
    parts = components(links(each.select("print"), radius)).withColumnRenamed("node", "print")
    labelled = each.join(parts, "print", "left").withColumn("component", F.coalesce("component", "print"))
    least = labelled.groupBy("component").agg(F.min("least").alias("first"))
    # Written, with one row for each fingerprint, so that adaptive execution can split a fingerprint that very many rows share.
    by_print = written(labelled.join(least, "component").select("print", F.col("first").alias("least")), "fingerprint-components")
    return rows.join(by_print, "print")


def simhash_groups(docs: DataFrame, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint, component_id."""
    return _groups(docs, radius, id_col, text_col).select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.col("least.id").alias("component_id"))


def simhash_dedup(docs: DataFrame, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: of each component the one with the smallest id, and of several with this id one."""
    groups = written(_groups(docs, radius, id_col, text_col).select("doc_id", "key", (place("key") == F.col("least")).alias("stays")), "simhash-groups")
    # What is to do with a row: ``once`` rows stay once, others go; all without a mark stay.
    marks = groups.groupBy("doc_id", "key").agg(F.max("stays").alias("once"), F.count("*").alias("n")).where("NOT once OR n > 1").drop("n")
    packed = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col), text_of(text_col)).alias("key"))
    there, apart = light_split(packed, marks := written(marks, "near-copies"))
    met = join_rows(there, marks, "left").where("once IS NULL OR once")
    # Rows without a mark get a number of their own; copies of a marked one collapse before they shuffle.
    met = met.withColumn("tie", F.when(F.col("once"), 0).otherwise(F.monotonically_increasing_id() + 1)).dropDuplicates(["doc_id", "key", "tie"])
    return met.select("row").unionByName(apart.select("row")).select("row.*")
