"""What the training-data operators share: table access, written cut points and row keys."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.tables import dropped, intermediate, shared_folder, written  # noqa: F401  the operators take them from here

SPACES = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``key``, ``text``: the columns an operator works on, whatever else ``docs`` holds.

    ``key`` hashes the id and the text, so that rows which repeat an id are only taken for one document
    if their texts agree as well.
    """
    text = text_of(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col), text).alias("key"), text.alias("text"))


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc


def released() -> None:
    """Give what Arrow's pool and the heap hold but don't use back to the system: workers are used again by later stages."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


class Memo(dict):
    """Remembers what ``make`` gave for a key, at most ``most`` of the newest keys and as many before them; keys longer than ``longest`` aren't kept."""

    def __init__(self, make, most: int, longest: int = 64):
        super().__init__()
        self.make, self.most, self.longest, self.before = make, most, longest, {}

    def __missing__(self, key):
        if len(key) > self.longest:
            return self.make(key)
        found = self.before.get(key)
        return self.keep(key, self.make(key) if found is None else found)

    def keep(self, key, found):
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[key] = found
        return found


def join_rows(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on doc_id and key, null ids included; the columns of ``left`` and what ``right`` adds."""
    right = right.withColumnsRenamed({"doc_id": "right_id", "key": "right_key"})
    return left.join(right, (F.col("key") == F.col("right_key")) & F.col("doc_id").eqNullSafe(F.col("right_id")), how).drop("right_id", "right_key")


PAGE_BITS = 32768  # of one bitmap_construct_agg
MAX_FILTER_BITS = 2**27  # 16 MiB to broadcast, however many keys there are


def filter_bits(rows: int, per_row: int = 16, most: int = MAX_FILTER_BITS) -> int:
    bits = PAGE_BITS
    while bits < rows * per_row and bits < most:
        bits *= 2
    return bits


def _slots(column: str, bits: int) -> list[str]:
    """Two slots of a 64-bit hash."""
    return [f"({column} & {bits - 1}L)", f"(shiftrightunsigned({column}, 32) & {bits - 1}L)"]


def hash_filter(rows: DataFrame, column: str, bits: int) -> DataFrame:
    """page, bitmap: a Bloom filter of the 64-bit hashes in ``column``, in at most ``bits / 32768`` rows of 4 KiB."""
    slots = rows.select(F.explode(F.expr(f"array({', '.join(_slots(column, bits))})")).alias("slot"))
    return slots.groupBy(F.expr(f"slot div {PAGE_BITS}").alias("page")).agg(F.bitmap_construct_agg(F.expr(f"slot % {PAGE_BITS}")).alias("bitmap"))


def _in_filter(rows: DataFrame, pages: DataFrame, bits: int) -> DataFrame:
    """Adds ``maybe``: false if the row's key is certainly not in the filter."""
    out = rows
    for j, slot in enumerate(_slots("key", bits)):
        page = F.broadcast(pages.select(F.col("page").alias(f"page{j}"), F.col("bitmap").alias(f"bitmap{j}")))
        out = out.join(page, F.expr(f"{slot} div {PAGE_BITS}") == F.col(f"page{j}"), "left")
    hit = " AND ".join(f"coalesce(shiftright(cast(conv(hex(substring(bitmap{j}, cast(({slot} % {PAGE_BITS}) div 8 as int) + 1, 1)), 16, 10) as int), cast({slot} % 8 as int)) & 1, 0) = 1" for j, slot in enumerate(_slots("key", bits)))
    return out.select(*rows.columns, F.expr(hit).alias("maybe"))


def light_split(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``left`` that a Bloom filter of the right's keys lets through, and those that certainly have no partner."""
    bits = filter_bits(right.count())
    pages = written(hash_filter(right, "key", bits), "key-filter")
    tested = _in_filter(left, pages, bits)
    return tested.where("maybe").drop("maybe"), tested.where("NOT maybe").drop("maybe")


def light_join(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """join_rows (left, inner or left_anti) with texts on the left, of which only those shuffle that a Bloom filter of the right's keys lets through."""
    there, apart = light_split(left, right)
    if how == "inner":
        return join_rows(there, right)
    if how == "left_anti":
        return join_rows(there, right.select("doc_id", "key").distinct().withColumn("there", F.lit(True)), "left").where("there IS NULL").drop("there").unionByName(apart)
    return join_rows(there, right, "left").unionByName(apart, allowMissingColumns=True)


def place(*more: str) -> Column:
    """Order of documents: by id, null ids last, then by ``more``."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), *[F.col(c) for c in more])
