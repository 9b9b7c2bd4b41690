"""Window hashes over words or bytes, and the sampled windows (anchors) that any longer repeat must share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import PAGE_BITS, dropped, filter_bits, hash_filter, place, written

# Odd multipliers of the two rolling hashes, and their inverses.
BASES = [0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i < n at least."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = 1 << max(12, n.bit_length())
        _powers[base] = tuple(np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)]) for b in (base, pow(base, -1, 2**64)))
    return _powers[base]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)


def window_hashes(units: np.ndarray, width: int, base: int = BASES[0]) -> np.ndarray:
    """The hash of each run of ``width`` units; empty if there is none."""
    n = len(units)
    if n < width:
        return np.empty(0, np.uint64)
    up, down = powers(base, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(units * up[:n], out=sums[1:])
    return mixed((sums[width:] - sums[:-width]) * down[: n - width + 1])


def _sliding(values: np.ndarray, span: int, op: np.ufunc) -> np.ndarray:
    done = 1
    while done < span:
        step = min(done, span - done)
        values = op(values[:-step], values[step:])
        done += step
    return values


def anchors(hashes: np.ndarray, span: int) -> np.ndarray:
    """Positions that hold the smallest hash of some ``span`` consecutive ones (ties all count)."""
    if len(hashes) < span:
        return np.empty(0, np.int64)
    low = _sliding(hashes, span, np.minimum)
    padded = np.r_[np.zeros(span - 1, np.uint64), low, np.zeros(span - 1, np.uint64)]
    return np.flatnonzero(_sliding(padded, span, np.maximum) == hashes)


def starts_around(at: np.ndarray, before: int, last: int) -> np.ndarray:
    """All starts from ``before`` below each position up to it, within 0..last, once each in order."""
    marks = np.zeros(last + 2, np.int32)
    low, high = np.clip(at - before, 0, last + 1), np.clip(at + 1, 0, last + 1)
    np.add.at(marks, low, 1)
    np.add.at(marks, high, -1)
    return np.flatnonzero(np.cumsum(marks[:-1]) > 0)


def covered(starts: np.ndarray, stops: np.ndarray, n: int) -> np.ndarray:
    """Which of n units lie between one of ``starts`` and its stop."""
    marks = np.zeros(n + 1, np.int32)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(stops, n), -1)
    return np.cumsum(marks[:-1]) > 0


def copies(base: DataFrame) -> DataFrame:
    """doc_id, key, later of the documents whose whole text another one has; ``later`` where one of these has a smaller id. Reads digests only, and makes no pairs."""
    digests = written(base.select("doc_id", "key", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2")), "text-digests")
    first = written(digests.groupBy("t1", "t2").agg(F.min(place()).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "first-copies")
    out = written(digests.join(first, ["t1", "t2"]).select("doc_id", "key", (place() > F.col("first")).alias("later")).distinct(), "copies")
    dropped(digests, first)
    return out


# Anchors are the smallest hashes around, so their values crowd at the low end; times this they are even again.
SPREAD = 0xD1342543DE82EF95
HELD = 4_000_000  # hashes in memory at once


def _at_most_twice(held: list[np.ndarray]) -> np.ndarray:
    """Sorted; twice is as good as more."""
    hashes = np.sort(np.concatenate(held)) if held else np.empty(0, np.uint64)
    keep = np.ones(len(hashes), bool)
    keep[2:] = hashes[2:] != hashes[:-2]
    return hashes[keep]


def _deal_batches(parts: int):
    """The hashes of a task, spread, sorted and dealt to ``parts`` by their value, as a few long rows instead of one for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def dealt() -> pa.RecordBatch:
            hashes = _at_most_twice(held)
            held.clear()
            part = ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
            cuts = np.flatnonzero(np.diff(part)) + 1
            some = [x.tobytes() for x in np.split(hashes, cuts)] if len(hashes) else []
            return pa.RecordBatch.from_arrays([pa.array(part[np.r_[0, cuts]] if some else part), pa.array(some, pa.binary())], ["part", "sorted"])

        for batch in batches:
            if "sorted" in batch.schema.names:  # dealt before, to fewer parts
                held.append(np.frombuffer(b"".join(batch.column("sorted").to_pylist()), np.uint64))
            else:
                held.append(batch.column("hashes").flatten().to_numpy().view(np.uint64) * np.uint64(SPREAD))
            if sum(map(len, held)) > HELD:
                yield dealt()
        yield dealt()

    return run


def _twice_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes that occur twice or more in a part; the rows of a part come together."""
    held: list[np.ndarray] = []
    part, size = None, 0

    def twice() -> pa.RecordBatch:
        hashes = _at_most_twice(held)
        held.clear()
        hashes = hashes[1:][hashes[1:] == hashes[:-1]] * np.uint64(pow(SPREAD, -1, 2**64))
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], ["hash"])

    for batch in batches:
        for k, raw in zip(batch.column("part").to_pylist(), batch.column("sorted").to_pylist(), strict=True):
            if k != part:
                yield twice()
                part, size = k, 0
            held.append(np.frombuffer(raw, np.uint64))
            size += len(held[-1])
            if size > HELD:
                held[:] = [_at_most_twice(held)]
                size = 0  # at least as many new ones come before the next sort
    yield twice()


def repeated_hashes(prints: DataFrame, part_size: int = 500_000, fan: int = 1024) -> DataFrame:
    """hash: of the anchors' hashes those that occur twice or more. A task deals to ``fan`` parts at most, which are dealt again where more are needed, so that its rows stay long at any size."""
    total = prints.agg(F.sum(F.size("hashes")).alias("n")).first()["n"] or 0
    # Equal hashes sort together and collapse to two, so that a part holds about ``part_size`` different ones however common some are.
    parts = max(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // part_size))
    dealt, coarse = prints.select("hashes"), fan
    while coarse < parts:
        dealt = dealt.mapInArrow(_deal_batches(coarse), "part int, sorted binary").repartition(coarse, "part")
        coarse *= fan
    dealt = dealt.mapInArrow(_deal_batches(parts), "part int, sorted binary")
    return written(dealt.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_twice_batches, "hash long"), "repeated-hashes")


def _seed_batches(shared, bits: int):
    """Rows for the anchors that the filter of repeated hashes lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            hashes = batch.column("hashes").flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("hashes").offsets.to_numpy()))
            u = hashes.view(np.uint64)
            keep = np.ones(len(u), bool)
            for slot in (u & np.uint64(bits - 1), (u >> np.uint64(32)) & np.uint64(bits - 1)):
                keep &= (packed[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            which = pa.array(row[keep])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(which), batch.column("key").take(which), pa.array(hashes[keep]), pa.array(batch.column("ats").flatten().to_numpy()[keep])], ["doc_id", "key", "hash", "at"])

    return run


def repeated_anchors(prints: DataFrame) -> DataFrame:
    """doc_id, key, seeds: positions of the anchors whose hash occurs twice or more. ``prints`` has hashes and ats."""
    twice = repeated_hashes(prints)
    bits = filter_bits(twice.count())
    packed = np.zeros(bits // 8, np.uint8)
    for r in hash_filter(twice, "hash", bits).collect():  # MAX_FILTER_BITS at most
        packed[r["page"] * (PAGE_BITS // 8) :][: PAGE_BITS // 8] = np.frombuffer(bytes(r["bitmap"]), np.uint8)
    shared = prints.sparkSession.sparkContext.broadcast(packed.tobytes())
    # The filter spares the shuffle; the join is what decides, and splits where a hash is very common.
    some = prints.select("doc_id", "key", "hashes", "ats").mapInArrow(_seed_batches(shared, bits), "doc_id long, key long, hash long, at int")
    seeds = written(some.join(twice, "hash", "left_semi").groupBy("doc_id", "key").agg(F.collect_set("at").alias("seeds")), "seeds")
    shared.unpersist()
    dropped(twice)
    return seeds
