"""Raw bibliographic records: source names, their own rules, and the reconciliation with the search log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.functions.text import any_of, norm_text, row_hash
from cohortlake.plans.dims import lookup

# Sources, the names they go by (lower case), and the note of a source that the search log lacks.
SOURCES = ["PubMed", "WebOfScience", "Scopus", "Embase", "CNKI", "Wanfang", "Other"]
ALIASES = {"pubmed": "PubMed", "pm": "PubMed", "wos": "WebOfScience", "webofscience": "WebOfScience", "web of science": "WebOfScience", "scopus": "Scopus", "embase": "Embase", "cnki": "CNKI", "wanfang": "Wanfang", "other": "Other"}
PENDING = "search string and hit count are to be filled in"


def normalize_source(c: Column) -> Column:
    """The canonical source; null for a name that isn't known, which is an error of the row (see ``unknown_sources``)."""
    return lookup(F.lower(F.trim(c)), ALIASES)


def unknown_sources(df: DataFrame, column: str = "source_database") -> DataFrame:
    """Names that stand for no source, with their rows' number."""
    return df.where(normalize_source(F.col(column)).isNull()).groupBy(column).agg(F.count("*").alias("n"))


def check_header(df: DataFrame, expected: list[str]) -> None:
    """Raises unless the columns are the expected ones in their order; nothing is rearranged silently."""
    missing, extra = [c for c in expected if c not in df.columns], [c for c in df.columns if c not in expected]
    if missing or extra:
        raise ValueError(f"missing columns {missing}, surplus columns {extra}")
    if df.columns != expected:
        raise ValueError(f"columns in another order: {df.columns}")


def raw_findings(raw: DataFrame) -> DataFrame:
    """record_id, rule: blank or repeated ids, blank titles, years that aren't YYYY, unknown sources, hashes that are blank or not those of title and abstract.

    Repeated texts under different ids are suspects for the deduplication, not findings. Of a repeated id every row but the first by hash is one.
    """
    clean = {c: norm_text(F.col(c)) for c in ("record_id", "title", "year", "source_database", "raw_row_hash")}
    rid, title, year, source, digest = clean.values()
    again = F.row_number().over(Window.partitionBy(rid).orderBy("raw_row_hash", "title")) > 1
    # Blank ids may be any share of the rows: they need no numbering.
    named, unnamed = raw.where(rid != "").withColumn("_again", again), raw.where(rid == "").withColumn("_again", F.lit(False))
    tests = {
        "id_blank": rid == "",
        "id_repeated": F.col("_again"),
        "title_blank": title == "",
        "year_format": (year != "") & ~year.rlike(r"^(19|20)\d{2}$"),
        "source_unknown": (source != "") & ~source.isin(*SOURCES),
        "hash_blank": digest == "",
        "hash_differs": (digest != "") & (digest != row_hash(F.col("title"), F.col("abstract"))),
    }
    found = F.filter(F.array(*[F.when(t, rule) for rule, t in tests.items()]), lambda x: x.isNotNull())
    return named.unionByName(unnamed).select("record_id", F.explode(found).alias("rule"))


def source_summary(df: DataFrame, source: str, text: str) -> DataFrame:
    """The source column, exported_count and n_blank, the records without text."""
    return df.groupBy(source).agg(F.count("*").alias("exported_count"), F.count_if(F.trim(F.coalesce(F.col(text), F.lit(""))) == "").alias("n_blank"))


def exclusion_groups(df: DataFrame, text: Column, groups: dict[str, list[str]], fewest: int = 30, most: int = 50_000) -> DataFrame:
    """name, n_all, n_lost, n_left, size: what each group of words would exclude, in one pass; ``size`` tells of too few or too many left."""
    counts = df.agg(F.count("*").alias("n_all"), *[F.count_if(any_of(F.coalesce(text, F.lit("")), terms)).alias(f"lost_{i}") for i, terms in enumerate(groups.values())])
    each = F.inline(F.array(*[F.struct(F.lit(name).alias("name"), F.col(f"lost_{i}").alias("n_lost")) for i, name in enumerate(groups)]))
    left = F.col("n_all") - F.col("n_lost")
    return counts.select("n_all", each).select("name", "n_all", "n_lost", left.alias("n_left"), F.when(left < fewest, "few").when(left > most, "many").otherwise("fine").alias("size"))


def reconcile(raw: DataFrame, log: DataFrame) -> DataFrame:
    """source_database, search_string, search_date, hit_count, exported_count, not_exported, note: exported records against the search log (one row for each source)."""
    counts = raw.groupBy("source_database").agg(F.count("*").alias("exported_count"))
    joined = counts.join(log.select("source_database", "search_string", "search_date", "hit_count"), "source_database", "left")
    hits = F.expr("try_cast(hit_count AS long)")
    filled = (F.coalesce("search_string", F.lit("")) != "") | hits.isNotNull()
    return joined.select("source_database", "search_string", "search_date", hits.alias("hit_count"), "exported_count", (hits - F.col("exported_count")).alias("not_exported"), F.when(filled, "").otherwise(PENDING).alias("note"))


def selection_flow(df: DataFrame, text: str, decision: str) -> DataFrame:
    """One row: identified, duplicates, screened, excluded, pending, included, and whether they add up. ``decision`` holds Include, Exclude or anything else for pending.

    Of records with one text the first decided one counts (Include before Exclude before pending); the digest is the key, so texts don't cross.
    """
    rank = F.when(F.col(decision) == "Include", 0).when(F.col(decision) == "Exclude", 1).otherwise(2)
    digest = F.sha2(F.lower(norm_text(F.col(text))), 256).alias("digest")
    unique = df.select(digest, rank.alias("rank")).groupBy("digest").agg(F.count("*").alias("k"), F.min("rank").alias("rank"))
    out = unique.agg(F.sum("k").alias("identified"), F.count("*").alias("screened"), *[F.count_if(F.col("rank") == i).alias(n) for i, n in enumerate(("included", "excluded", "pending"))])
    return out.select("identified", (F.col("identified") - F.col("screened")).alias("duplicates"), "screened", "excluded", "pending", "included", (F.col("screened") == F.col("excluded") + F.col("pending") + F.col("included")).alias("balanced"))
