"""Citations against a library, and references against DOI metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.functions.text import institution, journals_match, normalize_doi, titles_match, valid_doi


def suffixed(library: DataFrame, order: str = "record_id") -> DataFrame:
    """Adds key (surname|year) and suffix: a-z within equal keys, none where a key is alone or beyond z."""
    surname = F.lower(F.regexp_extract(F.split("authors", "[;；]")[0], r"[A-Za-z\x{4e00}-\x{9fff}\-']+", 0))
    out = library.withColumn("key", F.concat_ws("|", surname, F.col("year").cast("string")))
    counts = out.groupBy("key").agg(F.count("*").alias("_n"))
    out = out.join(counts, "key").withColumn("_rn", F.row_number().over(Window.partitionBy("key").orderBy(order)))
    suffix = F.when((F.col("_n") > 1) & (F.col("_rn") <= 26), F.chr(96 + F.col("_rn"))).otherwise("")
    return out.withColumn("suffix", suffix).drop("_n", "_rn")


def _sought(key: Column) -> Column:
    """The key under which the library has a cited one: an institution's full name instead of its abbreviation."""
    return F.coalesce(F.concat(institution(F.substring_index(key, "|", 1)), F.lit("|"), F.substring_index(key, "|", -1)), key)


def _institution_key() -> Column:
    return F.concat(institution(F.split("authors", "[;；]")[0]), F.lit("|"), F.col("year").cast("string"))


def _entries(library: DataFrame) -> DataFrame:
    """record_id, key: every key of each entry, with its suffix and without, and its institution's."""
    return suffixed(library).select("record_id", F.explode(F.array_distinct(F.array_compact(F.array("key", F.concat("key", "suffix"), _institution_key())))).alias("key"))


def crosswalk(cited: DataFrame, library: DataFrame) -> DataFrame:
    """doc_id, key, status, n_matches: MATCHED, AMBIGUOUS or MISSING; a suffixed key falls back to its base."""
    keys = _entries(library).groupBy("key").agg(F.count("*").alias("n")).withColumnRenamed("key", "sought")
    base = keys.withColumnsRenamed({"sought": "base", "n": "base_n"})
    out = cited.withColumn("sought", _sought(F.col("key"))).join(keys, "sought", "left").withColumn("base", F.regexp_replace("sought", "[a-z]$", "")).join(base, "base", "left")
    n = F.coalesce("n", "base_n", F.lit(0))
    return out.select("doc_id", "key", F.when(n == 0, "MISSING").when(n == 1, "MATCHED").otherwise("AMBIGUOUS").alias("status"), n.alias("n_matches"))


def unused(cited: DataFrame, library: DataFrame) -> DataFrame:
    """Library rows that no citation names."""
    bases = cited.select(F.regexp_replace(_sought(F.col("key")), "[a-z]$", "").alias("key")).distinct()
    left = suffixed(library).join(bases, "key", "left_anti").withColumn("_body", _institution_key())
    return left.join(bases.withColumnRenamed("key", "_body"), "_body", "left_anti").drop("_body")


def verify_references(references: DataFrame, metadata: DataFrame) -> DataFrame:
    """key, status, fields: the fields in which a reference differs from what is registered for its DOI. Volume, issue and pages count where both sides have them."""
    names = ("title", "journal", "year", "volume", "issue", "pages")
    text = lambda df, c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in df.columns else F.lit("")
    local = references.select(*[c for c in references.columns if c not in names], *[text(references, c).alias(c) for c in names]).withColumn("doi", normalize_doi(F.col("doi")))
    there = metadata.select(normalize_doi(F.col("doi")).alias("doi"), F.lit(True).alias("there"), *[text(metadata, c).alias(f"r_{c}") for c in names])
    joined = local.join(there, "doi", "left")
    other = lambda c: (F.col(c) != "") & (F.col(f"r_{c}") != "") & (F.col(c) != F.col(f"r_{c}"))
    tests = {"title": ~titles_match(F.col("title"), F.col("r_title")), "journal": ~journals_match(F.col("journal"), F.col("r_journal")), "year": (F.col("year") != "") & (F.col("year") != F.col("r_year"))}
    tests |= {c: other(c) for c in ("volume", "issue", "pages")}
    fields = F.concat_ws(";", *[F.when(t, c) for c, t in tests.items()])
    none = F.upper("doi").isin("", "NO_DOI")
    status = F.when(none, "NO_DOI").when(~valid_doi(F.col("doi")) | F.col("there").isNull(), "DOI_INVALID").when(fields != "", "MISMATCH").otherwise("VERIFIED")
    return joined.select("key", status.alias("status"), F.when(status.isin("MISMATCH"), fields).otherwise("").alias("fields"))


def crosswalk_actions(found: DataFrame) -> DataFrame:
    """Adds note and search_term to ``crosswalk``'s rows: what is to be done, and what to look for in the library."""
    suffix = F.col("key").rlike("[a-z]$")
    note = F.when((F.col("status") == "MISSING"), "add to the library").when((F.col("status") == "AMBIGUOUS") & suffix, "give the library's entries a suffix").when(F.col("status") == "AMBIGUOUS", "add a suffix in the text").otherwise("")
    return found.withColumns({"note": note, "search_term": F.regexp_replace("key", r"\|", " ")})


def insert_table(found: DataFrame, library: DataFrame) -> DataFrame:
    """doc_id, key, record_id, place: the library's entries of each matched citation, numbered by document in the order of keys."""
    keys = _entries(library).withColumnRenamed("key", "lib_key")
    wanted = found.where("status = 'MATCHED'").select("doc_id", "key", _sought(F.col("key")).alias("sought"))
    direct = wanted.join(keys, wanted["sought"] == keys["lib_key"], "left").drop("lib_key")
    base = direct.where("record_id IS NULL").select("doc_id", "key", F.regexp_replace("sought", "[a-z]$", "").alias("lib_key")).join(keys, "lib_key").select("doc_id", "key", "record_id")
    out = direct.where("record_id IS NOT NULL").drop("sought").unionByName(base)
    return out.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy("key", "record_id")))


def library_duplicates(library: DataFrame) -> DataFrame:
    """Groups of references with the same DOI, or without one the same surname, year and title beginning."""
    doi = normalize_doi(F.col("doi"))
    other = F.concat_ws("|", F.lower(F.regexp_extract("authors", "[A-Za-z]+", 0)), F.col("year").cast("string"), F.substring(F.lower("title"), 1, 30))
    return library.withColumn("group_key", F.when(valid_doi(doi), F.lower(doi)).otherwise(other)).groupBy("group_key").agg(F.count("*").alias("n")).where("n > 1")
