"""Audit of the numbers in manuscripts against the current pooled means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.text import PLACEHOLDER, numbers, sentences, tells_change
from cohortlake.operators.intake import daily_intake
from cohortlake.operators.pool import pool_sets
from cohortlake.plans.dims import PERIODS, lookup
from cohortlake.tables import written

# The words that name a matrix or population, and the tolerance of each type of number.
MATRIX = {"cordblood": "CordBlood", "cord blood": "CordBlood", "cord": "CordBlood", "umbilical": "CordBlood", "脐带血": "CordBlood", "脐": "CordBlood", "urine": "Urine", "urinary": "Urine", "尿": "Urine", "blood": "Blood", "血": "Blood", "serum": "Blood", "plasma": "Blood"}
POPULATION = {"adults": "Adults", "adult": "Adults", "成人": "Adults", "elderly": "Elderly", "minors": "Minors", "minor": "Minors", "children": "Minors", "child": "Minors", "儿童": "Minors", "pregnant": "Pregnant", "pregnancy": "Pregnant", "孕": "Pregnant"}
RELATIVE = {"period_GM": 0.005, "region_GM": 0.005, "province_GM": 0.005, "population_GM": 0.005, "edi": 0.01}
ABSOLUTE = {"correlation": 0.001, "percentage": 0.005, "count": 0.0}
DIMS = {"period_GM": "period", "region_GM": "region", "province_GM": "province", "population_GM": "population_group", "edi": "edi", "count": "count"}


YEAR = "(?:19|20)[0-9][0-9]"
JOINERS = ["-", "--", "–", "—", "~", "to", "until", "through"]  # what may stand between the years of a range


def named(text: Column, words: dict[str, str]) -> Column:
    """What the longest word found stands for; Latin words match whole."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for word in sorted(words, key=len, reverse=True):
        whole = word.isascii() and " " not in word
        out = out.when(text.rlike(f"(?<![a-z]){word}(?![a-z])") if whole else text.contains(word), words[word])
    return out


def infer_stratum(df: DataFrame, regions: dict[str, str], periods=PERIODS) -> DataFrame:
    """Adds matrix, dim and stratum: period before region before population."""
    low = F.lower("sentence")
    period = F.when(F.lit(False), F.lit(None).cast("string"))
    years = F.regexp_extract_all("sentence", F.lit(rf"{YEAR}\s*(?:{'|'.join(JOINERS)})\s*{YEAR}"), F.lit(0))
    ends = lambda i: F.expr(f"transform(y, s -> int(regexp_extract_all(s, '{YEAR}', 0)[{i}]))")
    df = df.withColumn("y", years).withColumns({"y0": ends(0), "y1": ends(1)})
    for label, start, end in periods:
        inside = F.exists(F.arrays_zip("y0", "y1"), lambda p: (p["y0"] >= start) & (p["y0"] <= end) & (p["y1"] >= start) & (p["y1"] <= end))
        period = period.when(inside, label)
    df = df.withColumns({"matrix": named(low, MATRIX), "_p": period, "_r": named(low, regions), "_g": named(low, POPULATION)})
    dim = F.when(F.col("_p").isNotNull(), "period").when(F.col("_r").isNotNull(), "region").when(F.col("_g").isNotNull(), "population_group")
    return df.withColumns({"dim": F.when(F.col("matrix").isNotNull(), dim), "stratum": F.when(F.col("matrix").isNotNull(), F.coalesce("_p", "_r", "_g"))}).drop("y", "y0", "y1", "_p", "_r", "_g")


def placeholder_items(docs: DataFrame) -> DataFrame:
    """doc_id, n, type, matrix, dim, stratum, value, sentence: what stands as {{type:matrix:stratum}}, with the number that follows it in its sentence, if one does."""
    masked = F.regexp_replace("text", PLACEHOLDER, "\u0001$1:$2\u0002")
    parts = F.split(masked, r"(?<=[.!?。！？])\s+|\n+")
    sentences_ = docs.select("doc_id", F.posexplode(parts).alias("n", "sentence"))
    each = sentences_.select("doc_id", "n", "sentence", F.explode(F.slice(F.split("sentence", "\u0001"), 2, 1 << 30)).alias("piece"))
    head, rest = F.split("piece", "\u0002"), F.split("piece", "\u0002")[1]
    args = F.transform(F.split(head[0], ":"), lambda x: F.trim(x))
    value = F.expr("try_cast(regexp_extract(rest, '[0-9]+(?:[.][0-9]+)?', 0) AS double)")
    out = each.withColumns({"args": args, "rest": rest}).withColumn("value", value)
    kind = F.col("args")[0]
    return out.select("doc_id", "n", kind.alias("type"), F.get("args", F.lit(1)).alias("matrix"), lookup(kind, DIMS).alias("dim"), F.get("args", F.lit(2)).alias("stratum"), "value", "sentence")


def text_items(docs: DataFrame, regions: dict[str, str], periods=PERIODS) -> DataFrame:
    """The same columns for plain numbers with a unit; sentences that hold a placeholder are covered by it, those with a percent sign stay unresolved."""
    plain = docs.withColumn("text", F.regexp_replace("text", PLACEHOLDER, "\u0001"))
    items = infer_stratum(numbers(sentences(plain)).where(~F.col("sentence").contains("\u0001")), regions, periods)
    percent = F.col("sentence").contains("%") | F.col("dim").isNull()
    names = {v: k for k, v in DIMS.items() if k.endswith("_GM")}
    kept = lambda c: F.when(~percent, F.col(c)).alias(c)
    return items.select("doc_id", "n", F.when(percent, "unresolved").otherwise(lookup(F.col("dim"), names)).alias("type"), kept("matrix"), kept("dim"), kept("stratum"), "value", "sentence")


def classified(items: DataFrame, strata: DataFrame, stale: Column | None = None) -> DataFrame:
    """All items join one table of strata (matrix, dim, stratum, recomputed). Adds recomputed, diff, rel, status and linked_change.

    OK and MISMATCH by the type's tolerance, STALE for either where the manuscript's snapshot isn't the current one, NO_SOURCE where nothing can be recomputed.
    """
    joined = items.join(strata, ["matrix", "dim", "stratum"], "left")
    now, value = F.col("recomputed"), F.col("value")
    diff = value - now
    rel = F.when(now != 0, F.abs(diff) / F.abs(now)).when(diff == 0, 0.0)
    ok = F.when(F.col("type").isin(*ABSOLUTE), F.abs(diff) <= lookup(F.col("type"), ABSOLUTE)).otherwise(rel <= lookup(F.col("type"), RELATIVE))
    known = now.isNotNull() & value.isNotNull() & ok.isNotNull()
    old = F.coalesce(stale, F.lit(False)) if stale is not None else F.lit(False)
    status = F.when(~known, "NO_SOURCE").when(old, "STALE").when(ok, "OK").otherwise("MISMATCH")
    out = joined.withColumns({"diff": diff, "rel": rel, "status": status})
    return out.withColumn("linked_change", F.col("status").isin("MISMATCH", "STALE") & tells_change(F.col("sentence")))


def audit_items(docs: DataFrame, strata: DataFrame, regions: dict[str, str], current_tag: str | None = None, periods=PERIODS) -> DataFrame:
    """doc_id, n, type, matrix, dim, stratum, value, recomputed, diff, rel, status, linked_change for placeholders and plain numbers.

    Documents may have a snapshot_tag; with ``current_tag`` given, items of another tag are stale.
    """
    items = placeholder_items(docs).unionByName(text_items(docs, regions, periods))
    stale = None
    if current_tag is not None and "snapshot_tag" in docs.columns:
        tags = docs.groupBy("doc_id").agg(F.max("snapshot_tag").alias("_tag"))
        items = items.join(tags, "doc_id", "left")
        stale = ~F.col("_tag").eqNullSafe(F.lit(current_tag))
    return classified(items, strata, stale).select("doc_id", "n", "type", "matrix", "dim", "stratum", "value", "recomputed", "diff", "rel", "status", "linked_change")


def strata_of(df: DataFrame, value: str = "gm_summary", periods=PERIODS, edi: bool = True) -> DataFrame:
    """matrix, dim, stratum, recomputed: means by period, region, province and population, urine intake by population, and the number of records; one long table."""
    dims = ["period", "region", "province", "population_group"]
    df = written(df.select("sample_type", "sampling_year", *dims[1:], value, "sample_size"), "audited-records")  # read for each kind of stratum
    means = pool_sets(df, "sample_type", [[d] for d in dims], value, periods=periods).where("stratum <> ''")
    out = means.select(F.col("sample_type").alias("matrix"), F.col("stratum").alias("dim"), F.coalesce(*dims).alias("stratum"), F.col("gm").alias("recomputed"))
    if edi:
        rows = daily_intake(df, value).where("route = 'urine' AND edi_primary > 0 AND sample_size > 0")
        mean = rows.groupBy("population_group").agg(F.exp(F.sum(F.col("sample_size") * F.ln("edi_primary")) / F.sum("sample_size")).alias("recomputed"))
        out = out.unionByName(mean.select(F.lit("Urine").alias("matrix"), F.lit("edi").alias("dim"), F.col("population_group").alias("stratum"), "recomputed"))
    count = df.agg(F.count("*").cast("double").alias("recomputed"))
    return out.unionByName(count.select(F.lit("records").alias("matrix"), F.lit("count").alias("dim"), F.lit("all").alias("stratum"), "recomputed"))


def audit_numbers(docs: DataFrame, strata: DataFrame, regions: dict[str, str]) -> DataFrame:
    """doc_id, matrix, dim, stratum, value, recomputed, status, linked_change of the plain numbers whose stratum is known; strata: matrix, dim, stratum, gm."""
    items = text_items(docs, regions).where("type <> 'unresolved'")
    return classified(items, strata.withColumnRenamed("gm", "recomputed")).select("doc_id", "matrix", "dim", "stratum", "value", "recomputed", "status", "linked_change")
