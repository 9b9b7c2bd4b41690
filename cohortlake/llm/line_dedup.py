"""Line dedup: winnowing over line hashes, native.

A window is a run of ``min_lines`` consecutive lines, or a shorter one of ``min_words`` words or more: a single line or,
for three lines, two. In every window the smallest line hash is its fingerprint, so any two equal windows share a
fingerprint. Fingerprints that occur once are dropped; around each of the others the match is extended both ways,
to all windows that hold it. A window whose lines also start earlier (smaller id, or the same document further
up) marks its lines; overlapping marks join to runs, and the runs are deleted. Windows are judged on the input,
not on what is left.

Joins are on hashes with one row per hash on one side, so that no pairs arise within a group, and adaptive
execution splits the other side where a line is very common.

Defined cases: a null text counts as empty, that is one empty line; texts without a window stay whole; null ids
count as the largest; rows that agree in id and text do not delete each other's lines; an empty table gives an
empty result; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import join_rows, keyed, light_join, place, written

MIN_LINES = 3
MIN_WORDS = 50


def _fingerprints(min_lines: int, min_words: int) -> str:
    """Of each window the smallest hash with its first position; neighbours mostly share it."""
    none = "cast(array() AS array<struct<hash:bigint,at:int>>)"
    least = lambda n: f"array_min(transform(sequence(s, s + {n - 1}), i -> struct(hashes[i] AS hash, i AS at)))"
    parts = [f"CASE WHEN size(hashes) >= {min_lines} THEN transform(sequence(0, size(hashes) - {min_lines}), s -> {least(min_lines)}) ELSE {none} END"]
    for n in range(1, min_lines):
        long = " + ".join(f"words[s + {k}]" for k in range(n)) + f" >= {min_words}"
        parts.append(f"CASE WHEN size(hashes) >= {n} AND total >= {min_words} THEN transform(filter(sequence(0, size(hashes) - {n}), s -> {long}), s -> {least(n)}) ELSE {none} END")
    return f"array_distinct(concat({', '.join(parts)}))"


def _windows(min_lines: int, min_words: int) -> str:
    """Starts and lengths of the windows that hold one of the seeds."""
    parts = []
    for n in range(1, min_lines + 1):
        starts = f"flatten(transform(filter(seeds, p -> size(hashes) >= {n}), p -> sequence(greatest(p - {n - 1}, 0), least(p, size(hashes) - {n}))))"
        if n < min_lines:
            starts = f"filter({starts}, s -> " + " + ".join(f"words[s + {k}]" for k in range(n)) + f" >= {min_words})"
        parts.append(f"transform(array_distinct({starts}), s -> struct(s AS start, {n} AS n))")
    return f"concat({', '.join(parts)})"


def repeated_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key, removed: the numbers, from 0, of the lines to delete; only rows that have some."""
    base = keyed(docs, id_col, text_col)
    lines = base.select("doc_id", "key", F.expr("split(text, '\\n', -1)").alias("lines"))
    hashed = lines.select("doc_id", "key", F.expr("transform(lines, x -> xxhash64(x))").alias("hashes"), F.expr(r"transform(lines, x -> regexp_count(x, '[^\\x20\\x09-\\x0D]+'))").alias("words"))
    hashed = hashed.withColumn("total", F.expr("aggregate(words, 0, (a, x) -> a + x)"))
    hashed = written(hashed.where((F.size("hashes") >= min_lines) | (F.col("total") >= min_words)), "line-hashes")
    prints = hashed.select("doc_id", "key", F.explode(F.expr(_fingerprints(min_lines, min_words))).alias("p")).select("doc_id", "key", "p.hash", "p.at")
    twice = written(prints.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "repeated-prints")
    seeds = prints.join(twice, "hash", "left_semi").groupBy("doc_id", "key").agg(F.collect_set("at").alias("seeds"))
    both = join_rows(hashed, seeds)
    windows = both.select("doc_id", "key", "hashes", F.explode(F.expr(_windows(min_lines, min_words))).alias("w")).select("doc_id", "key", "hashes", "w.start", "w.n")
    run = "slice(hashes, start + 1, n)"
    windows = written(windows.select("doc_id", "key", "start", "n", F.expr(f"xxhash64(n, {run})").alias("w1"), F.expr(f"xxhash64({run}, n)").alias("w2")), "line-windows")
    first = written(windows.groupBy("w1", "w2").agg(F.min(place("start")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "first-windows")
    later = windows.join(first, ["w1", "w2"]).where(place("start") > F.col("first"))
    marks = later.select("doc_id", "key", F.explode(F.expr("sequence(start, start + n - 1)")).alias("line"))
    return written(marks.groupBy("doc_id", "key").agg(F.collect_set("line").alias("removed")), "repeated-lines")


def line_dedup(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_lines, n_removed, kept_text."""
    base = keyed(docs, id_col, text_col)
    joined = light_join(base, repeated_lines(docs, min_lines, min_words, id_col, text_col), "left")
    # A map keeps the test of each line short in documents with very many lines.
    gone = F.expr("map_from_entries(transform(removed, i -> struct(i, true)))")
    return joined.select(
        "doc_id",
        F.expr("size(split(text, '\\n', -1))").cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(F.filter(F.split("text", "\n", -1), lambda _, i: F.element_at(gone, i).isNull()), "\n")).alias("kept_text"),
    )
