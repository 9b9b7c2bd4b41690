"""Exact dedup: two-pass Bloom filtering, native.

The texts are read once, into a written table of digests. The first pass over the digests counts the slots
of a Bloom filter and keeps the bits of slots that two rows or more have hit; the second pass tests each
digest against these bits. A digest with a slot of its own is certainly alone: its row passes straight
through. Only possibly repeated rows shuffle.

The filter's size follows the row count up to ``max_bits`` (default 2**28 bits, 32 MiB to broadcast). Beyond
that the filter lets more rows through to the shuffle, and the result stays the same.

Defined cases: a null text counts as empty; all empty or blank texts are equal; a null id counts as larger
than any other; of rows that agree in id and text one stays; an empty table gives an empty result; other
columns are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import SPACES, text_of, written

PAGE_BITS = 32768  # of one bitmap_construct_agg
HASHES = 3


def _filter_bits(rows: int, bits_per_row: int, max_bits: int) -> int:
    bits = PAGE_BITS
    while bits < rows * bits_per_row and bits < max_bits:
        bits *= 2
    return bits


def _slots(bits: int) -> list:
    return [F.pmod(F.xxhash64(F.col("sha"), F.lit(j)), F.lit(bits)) for j in range(HASHES)]


def repeated_slots(digests: DataFrame, bits: int) -> DataFrame:
    """First pass: page and bitmap of the slots that at least two rows hit; at most ``bits / 32768`` rows of 4 KiB."""
    hit_twice = digests.select(F.explode(F.array_distinct(F.array(*_slots(bits)))).alias("slot")).groupBy("slot").agg(F.count("*").alias("n")).where("n > 1")
    return hit_twice.groupBy(F.expr(f"slot div {PAGE_BITS}").alias("page")).agg(F.bitmap_construct_agg(F.expr(f"slot % {PAGE_BITS}")).alias("bitmap"))


def possibly_repeated(digests: DataFrame, pages: DataFrame, bits: int) -> DataFrame:
    """Second pass: adds ``maybe``."""
    out = digests.withColumns({f"slot{j}": slot for j, slot in enumerate(_slots(bits))})
    for j in range(HASHES):
        page = F.broadcast(pages.select(F.col("page").alias(f"page{j}"), F.col("bitmap").alias(f"bitmap{j}")))
        out = out.join(page, F.expr(f"slot{j} div {PAGE_BITS}") == F.col(f"page{j}"), "left")
    hit = " AND ".join(f"coalesce(shiftright(cast(conv(hex(substring(bitmap{j}, cast((slot{j} % {PAGE_BITS}) div 8 as int) + 1, 1)), 16, 10) as int), cast(slot{j} % 8 as int)) & 1, 0) = 1" for j in range(HASHES))
    return out.select(*digests.columns, F.expr(hit).alias("maybe"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_per_row: int = 16, max_bits: int = 2**28) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    text = text_of(text_col)
    digests = written(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).select("doc_id", F.unhex(F.sha2(F.regexp_replace("text", SPACES + "+", ""), 256)).alias("sha"), F.char_length("text").alias("length"), F.monotonically_increasing_id().alias("row")),
        "exact-digests",
    )
    bits = _filter_bits(digests.count(), bits_per_row, max_bits)
    pages = written(repeated_slots(digests, bits), "exact-filter")
    tested = possibly_repeated(digests, pages, bits)
    sha = F.lower(F.hex("sha")).alias("text_sha256")
    alone = tested.where("NOT maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha)
    some = tested.where("maybe").drop("maybe")
    best = F.struct((-F.col("length")).alias("shortness"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    # A hot digest has one row in groups. Written, so that the join deals both sides anew and adaptive execution can split the hot rows.
    groups = written(some.groupBy("sha").agg(F.min(best).alias("best"), F.count("*").alias("group_size")), "exact-groups")
    back = some.join(groups, "sha").select("doc_id", F.col("best.id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), sha)
    return alone.unionByName(back)
