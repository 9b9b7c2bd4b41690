"""Search terms as data: a positional index of texts, joined with a table of terms.

Thousands of terms are matched in one pass over the texts. A term is a word, a phrase, or either with ``*`` behind
its last word for any ending; it belongs to a block. A text matches if it holds a term of each block
and none of a block to exclude. Words are runs of letters and digits in lower case; a phrase is words at adjacent positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.tables import intermediate, written

WORDS = r"[\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORDS), F.lit(0))


def compiled_terms(terms: DataFrame) -> DataFrame:
    """block, term, size, place, entry: the words of each term (block, term), the last one marked if any ending will do. A term without words is left out."""
    words = words_of(F.col("term"))
    marked = F.transform(words, lambda w, i: F.when((i == F.size(words) - 1) & F.trim("term").endswith("*"), F.concat(w, F.lit("*"))).otherwise(w))
    return terms.select("block", "term").distinct().select("block", "term", F.size(words).alias("size"), F.posexplode(marked).alias("place", "entry"))


def term_hits(df: DataFrame, key: str, text: Column, terms: DataFrame) -> DataFrame:
    """key, block, term of every term that a text holds, once.

    Only words that some term has go on from the scan; phrases are put together by text, term and first position.
    """
    entries = compiled_terms(terms)
    endings = [r["n"] for r in entries.where("endswith(entry, '*')").select((F.length("entry") - 1).alias("n")).distinct().orderBy("n").collect()]  # lengths of words
    tokens = df.select(F.col(key).alias("_key"), F.posexplode(words_of(text)).alias("at", "word"))
    cut = [F.when(F.length("word") >= n, F.concat(F.substring("word", 1, n), F.lit("*"))) for n in endings]
    tokens = tokens.select("_key", "at", F.explode(F.array_compact(F.array(F.col("word"), *cut))).alias("entry"))
    met = tokens.join(entries, "entry")
    single = met.where("size = 1").select("_key", "block", "term")
    phrases = met.where("size > 1").groupBy("_key", "block", "term", "size", (F.col("at") - F.col("place")).alias("begin")).agg(F.countDistinct("place").alias("n")).where("n = size").select("_key", "block", "term")
    return single.unionByName(phrases).distinct().select(F.col("_key").alias(key), "block", "term")


def search(df: DataFrame, key: str, text: Column, terms: DataFrame, exclude: list[str] = ()) -> DataFrame:
    """The rows of ``df`` that hold a term of each block of ``terms`` and none of the blocks to exclude. Without other blocks all rows that hold none of these.

    Each text is searched once, however many rows have it: their words would else cross the shuffle again for each row, those
    of phrases once for each term that has them. ``df`` is read twice; rows of one ``key`` are judged each by its own text.
    """
    said = F.coalesce(text, F.lit(""))
    with intermediate(df.sparkSession) as kept:
        texts = written(df.select(said.alias("_text")).distinct().select(F.monotonically_increasing_id().alias("_id"), "_text"), "texts")
        hits = term_hits(texts, "_id", F.col("_text"), terms).select(F.col("_id").alias("_hit"), "block").distinct()
        out = F.col("block").isin(*exclude) if exclude else F.lit(False)
        needed = terms.where(~out).agg(F.countDistinct("block").alias("n")).first()["n"]
        found = hits.groupBy("_hit").agg(F.count_if(~out).alias("n"), F.count_if(out).alias("out"))
        joined = texts.join(found, F.col("_id") == F.col("_hit"), "left" if not needed else "inner")
        matched = written(joined.where((F.coalesce("n", F.lit(0)) == needed) & (F.coalesce("out", F.lit(0)) == 0)).select("_text"), "matched-texts")
        kept.append(matched)
    return df.join(matched, said == F.col("_text"), "left_semi")
