"""Bulk readers of bibliographic exports and of files as such; all give the same columns of raw records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortlake.functions.text import norm_text, record_id, row_hash
from cohortlake.operators.raw_records import check_header
from cohortlake.plans.dims import lookup
from cohortlake.sources.split_tables import numbered_across, read_split_table

COLUMNS = ["record_id", "source_database", "title", "abstract", "authors", "year", "doi", "pmid", "journal", "keywords", "raw_row_hash"]
# The tags of each field, best first; table headers of each field, and headers known to be of no use; month macros.
RIS_TAGS = {"title": ["TI", "T1"], "abstract": ["AB", "N2"], "authors": ["AU", "A1"], "year": ["PY", "Y1"], "doi": ["DO", "DI"], "pmid": ["AN", "UT"], "journal": ["JO", "JF", "JA", "T2"], "keywords": ["KW", "ID", "K1"]}
LISTS = ("authors", "keywords")
CONTINUED = ("TI", "T1", "AB", "N2")
TABLE_ALIASES = {
    "title": ["title", "article title", "标题", "题名"], "abstract": ["abstract", "摘要"], "authors": ["author", "authors", "作者"], "year": ["year", "publication year", "出版年", "年份"], "doi": ["doi"],
    "journal": ["journal", "journal title", "secondary title", "periodical", "期刊", "期刊名", "刊名"], "keywords": ["keywords", "keyword", "关键词"], "pmid": ["pmid", "accession number", "accession num", "存取号", "登录号"],
}
TABLE_IGNORED = ["ref type", "reference type", "reference id", "rec number", "pages", "volume", "number", "issue", "publisher", "place published", "date", "url", "notes", "call number", "label", "custom 1", "custom 2", "custom 3", "custom 4"]
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def place() -> list[Column]:
    """Where a row stands: its file, the split's first byte in it, and the row's place among those of the split."""
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("rec")]


def numbered(df: DataFrame, name: str = "number") -> DataFrame:
    """Adds numbers from 1 in the order of files, splits and places: places within each split, plus how many rows the splits before hold. No task sorts more than a split."""
    counts = df.groupBy("file", "block").agg(F.count("*").alias("_k"))
    before = F.sum("_k").over(Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1))  # one row for each split
    ahead = counts.select(F.col("file").alias("_f"), F.col("block").alias("_b"), F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("file", "block").orderBy("rec"))
    out = df.withColumn("_n", within).join(ahead, (F.col("file") == F.col("_f")) & (F.col("block") == F.col("_b")))
    return out.withColumn(name, F.col("_before") + F.col("_n")).drop("_n", "_f", "_b", "_before")


def finish(df: DataFrame, source: str) -> DataFrame:
    """Adds ids in the order of the export, and hashes."""
    out = df.withColumn("year", F.regexp_extract(F.coalesce("year", F.lit("")), r"\d{4}", 0))
    out = out.withColumns({c: norm_text(F.col(c)) for c in ("title", "abstract", "authors", "doi", "pmid", "journal", "keywords")})
    out = (numbered_across(out) if "_number" in out.columns else numbered(out)).withColumn("source_database", F.lit(source)).withColumn("record_id", record_id(F.lit(source), F.col("number")))
    return out.withColumn("raw_row_hash", row_hash(F.col("title"), F.col("abstract"))).select(*COLUMNS)


def pmid_of(c: Column) -> Column:
    """Digits alone, or the last digits of a text that speaks of PMID or MEDLINE; else null, never guessed."""
    text = norm_text(c)
    runs = F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1))
    return F.when(text.rlike(r"^\d+$"), text).when(F.upper(text).rlike("PMID|MEDLINE"), F.get(runs, F.size(runs) - 1))


def _ris_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, block, rec, line, tag, field, starts, value: records split at the ER line while reading; lines without a tag continue the field before."""
    text = spark.read.option("lineSep", "\nER").text(paths).select("value", *place())
    lines = text.select("file", "block", "rec", F.posexplode(F.split("value", r"\r?\n")).alias("line", "raw"))
    pattern = r"^([A-Z0-9]{2})\s*-\s?(.*)$"
    # The rest of an ER line opens the next piece.
    rest = (F.col("line") == 0) & F.col("raw").rlike(r"^\s*-\s*$")
    tag = F.regexp_extract("raw", pattern, 1)
    value = F.when(tag != "", F.regexp_extract("raw", pattern, 2)).otherwise(F.col("raw"))
    w = Window.partitionBy("file", "block", "rec").orderBy("line")
    tagged = lines.where(~rest & (F.trim("raw") != "")).select("file", "block", "rec", "line", F.last(F.when(tag != "", tag), ignorenulls=True).over(w).alias("tag"), F.sum(F.when(tag != "", 1).otherwise(0)).over(w).alias("field"), (tag != "").alias("starts"), F.trim(value).alias("value"))
    # A record begins at its last TY; what stands before it lies outside of records.
    begin = F.max(F.when(F.col("starts") & (F.col("tag") == "TY"), F.col("line"))).over(Window.partitionBy("file", "block", "rec"))
    return tagged.withColumn("begin", begin)


def read_ris(spark: SparkSession, paths: str | list[str], source: str) -> DataFrame:
    """Malformed places never stop the reading; ``ris_warnings`` lists them."""
    lines = _ris_lines(spark, paths).where("line >= begin AND tag IS NOT NULL AND value <> ''").where(F.col("starts") | F.col("tag").isin(*CONTINUED))
    fields = lines.groupBy("file", "block", "rec", "tag", "field").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "value"))), lambda s: s["value"]), " ").alias("value"))
    by = fields.groupBy("file", "block", "rec").agg(F.sort_array(F.collect_list(F.struct("field", "tag", "value"))).alias("f"))

    def of(tags: list[str], made=lambda c: c):
        tagged = lambda t: F.filter(F.transform(F.filter("f", lambda s: s["tag"] == t), lambda s: made(s["value"])), lambda x: x.isNotNull() & (x != ""))
        return F.coalesce(*[F.get(tagged(t), F.lit(0)) for t in tags])

    every = lambda tags: F.array_join(F.transform(F.filter("f", lambda s: s["tag"].isin(*tags)), lambda s: s["value"]), "; ")
    made = {"year": lambda c: F.regexp_extract(c, r"\d{4}", 0), "pmid": pmid_of}
    out = by.where(F.exists("f", lambda s: s["tag"] == "TY") | (F.size("f") > 0)).select("file", "block", "rec", *[(every(t) if c in LISTS else of(t, made.get(c, lambda c: c))).alias(c) for c, t in RIS_TAGS.items()])
    return finish(out, source)


def ris_warnings(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, rec, line, warning: lines outside of a record, records cut short by the next one, lines that continue nothing, tags of no field."""
    lines = _ris_lines(spark, paths)
    used = ["TY", "ER", *[t for tags in RIS_TAGS.values() for t in tags]]
    early = F.col("begin").isNull() | (F.col("line") < F.col("begin"))
    warning = (
        F.when(F.col("starts") & (F.col("tag") == "TY") & early, "record without its end before the next one")
        .when(early, "outside of a record")
        .when(~F.col("starts") & (F.col("tag").isNull() | ~F.col("tag").isin(*CONTINUED)), "continues nothing")
        .when(F.col("starts") & ~F.col("tag").isin(*used), "tag of no field")
    )
    return lines.select("file", "rec", "line", warning.alias("warning")).where("warning IS NOT NULL")


def read_endnote_xml(spark: SparkSession, paths: str, source: str) -> DataFrame:
    titles = "titles struct<title:string,`secondary-title`:string>, contributors struct<authors:struct<author:array<string>>>, dates struct<year:string>, abstract string, keywords struct<keyword:array<string>>, `electronic-resource-num` string, `accession-num` string, periodical struct<`full-title`:string>"
    raw = spark.read.format("xml").option("rowTag", "record").schema(titles).load(paths).select("*", *place())
    out = raw.select("file", "block", "rec", F.col("titles.title").alias("title"), "abstract", F.array_join("contributors.authors.author", "; ").alias("authors"), F.col("dates.year").alias("year"), F.col("`electronic-resource-num`").alias("doi"), F.col("`accession-num`").alias("pmid"), F.coalesce(F.col("periodical.`full-title`"), F.col("titles.`secondary-title`")).alias("journal"), F.array_join("keywords.keyword", "; ").alias("keywords"))
    return finish(out, source)


def table_header(names: list[str]) -> tuple[dict[str, str], list[str]]:
    """The column of each field, the first that goes by one of its names, and columns that are neither of a field nor known to be of no use."""
    clean = {c: " ".join(c.lstrip("\ufeff").split()).lower() for c in names}
    found: dict[str, str] = {}
    for c, name in clean.items():
        field = next((f for f, aliases in TABLE_ALIASES.items() if name in aliases and f not in found), None)
        if field:
            found[field] = c
    if "title" not in found:
        raise ValueError(f"no title column in {names}")
    return found, [c for c, name in clean.items() if name and c not in found.values() and name not in TABLE_IGNORED]


def read_table(spark: SparkSession, paths: str, source: str, sep: str = ",") -> DataFrame:
    """Exports with one of the known headers for each field (``table_header`` tells what else they have); a missing title column is an error."""
    raw = read_split_table(spark, paths, sep)
    found, _ = table_header(raw.columns[:-2])
    out = raw.select(*[F.col(f"`{found[f]}`").alias(f) if f in found else F.lit(None).cast("string").alias(f) for f in TABLE_ALIASES], "_file", "_number")
    joined = {"authors": r"\s*;\s*|\s+and\s+", "keywords": r"\s*;\s*"}
    out = out.withColumns({c: F.array_join(F.filter(F.split(F.col(c), sep_), lambda x: x != ""), "; ") for c, sep_ in joined.items()})
    return finish(out.withColumn("pmid", F.when(F.trim("pmid").rlike(r"^\d+$"), F.col("pmid"))), source)


def _bibtex_fields(entry: str) -> dict[str, list[dict]]:
    """Parts of the fields of one entry: braces nest, quotes enclose, # joins, and bare words, which may be macros, are marked."""
    begin = entry.find("{") if entry.lstrip()[:6].lower() == "string" else entry.find(",")
    fields, i, n = {}, begin + 1, len(entry)
    while 0 < i < n:
        eq = entry.find("=", i)
        if eq < 0:
            break
        name, i, value = entry[i:eq].strip(" \t\r\n,").lower(), eq + 1, []
        while i < n:
            c = entry[i]
            if c in "{\"":
                depth, begin, i = int(c == "{"), i + 1, i + 1
                while i < n and (depth if c == "{" else entry[i] != '"' or depth):
                    depth += {"{": 1, "}": -1}.get(entry[i], 0)
                    i += 1
                    if c == "{" and not depth:
                        break
                value.append({"bare": False, "text": entry[begin : i - (c == "{")]})
                i += c == '"'
            elif c in ",}":
                break
            elif c == "#" or c.isspace():
                i += 1
            else:
                begin = i
                while i < n and entry[i] not in ",}# \t\r\n":
                    i += 1
                value.append({"bare": True, "text": entry[begin:i]})
        fields[name] = value
        i += 1
    return fields


def _bibtex_batches(batches):
    for df in batches:
        yield df.assign(f=[_bibtex_fields(e) for e in df.pop("entry")])


def read_bibtex(spark: SparkSession, paths: str | list[str], source: str) -> DataFrame:
    """Entries split by Spark; only the scan for nested braces inside an entry is Python. A macro counts where its file defines it further up."""
    text = spark.read.option("lineSep", "\n@").text(paths).select(F.regexp_replace("value", r"^\x{FEFF}?\s*@", "").alias("entry"), *place())
    text = text.where(~F.lower("entry").rlike(r"^\s*(comment|preamble)\b") & F.col("entry").contains("{"))
    text = text.withColumn("macro", F.lower("entry").rlike(r"^\s*string\b")).select("file", "block", "rec", "macro", "entry")
    parsed = text.mapInPandas(_bibtex_batches, "file string, block long, rec long, macro boolean, f map<string,array<struct<bare:boolean,text:string>>>")
    whole = lambda parts: F.array_join(F.transform(parts, lambda p: p["text"]), "")
    macros = parsed.where("macro").select("file", F.struct("block", "rec").alias("at"), F.explode("f").alias("name", "parts"))
    macros = macros.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("at", "name", whole(F.col("parts")).alias("value")))).alias("macros"))
    months = {m.lower(): m for m in MONTHS}

    def said(part):
        defined = F.filter("macros", lambda m: (m["at"] < F.struct("block", "rec")) & (m["name"] == F.lower(part["text"])))
        last = F.get(defined, F.size(defined) - 1)["value"]
        return F.when(part["bare"], F.coalesce(last, lookup(F.lower(part["text"]), months), part["text"])).otherwise(part["text"])

    out = parsed.where("NOT macro").join(macros, "file", "left").withColumn("macros", F.coalesce("macros", F.array().cast(macros.schema["macros"].dataType)))
    out = out.withColumn("f", F.transform_values("f", lambda _, parts: F.array_join(F.transform(parts, said), "")))
    get = lambda *names: F.coalesce(*[F.when(F.col("f")[n] != "", F.col("f")[n]) for n in names])
    out = out.select("file", "block", "rec", get("title").alias("title"), get("abstract", "summary", "annotation", "annote").alias("abstract"), F.regexp_replace(get("author"), r"\s+and\s+", "; ").alias("authors"), get("year").alias("year"), get("doi").alias("doi"), get("pmid").alias("pmid"), get("journal", "journaltitle", "booktitle").alias("journal"), get("keywords").alias("keywords"))
    return finish(out, source)


def merge_sources(*tables: DataFrame) -> DataFrame:
    """Union of raw records; columns that are more, fewer or in another order are an error."""
    out = tables[0]
    check_header(out, COLUMNS)
    for t in tables[1:]:
        check_header(t, COLUMNS)
        out = out.unionByName(t)
    return out


def repeated_record_ids(merged: DataFrame) -> DataFrame:
    """record_id, n, sources: ids that occur twice or more after a merge, which is an error of the merge."""
    return merged.groupBy("record_id").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("source_database")), ";").alias("sources")).where("n > 1")


def checked_merge(*tables: DataFrame) -> DataFrame:
    """``merge_sources``, which fails when it is run if an id repeats."""
    merged = merge_sources(*tables)
    repeated = repeated_record_ids(merged).select(F.col("record_id").alias("_id"), "n")
    joined = merged.join(repeated, F.col("record_id") == F.col("_id"), "left")
    checked = F.when(F.col("_id").isNotNull(), F.raise_error(F.concat(F.lit("repeated record_id "), "record_id"))).otherwise(F.col("record_id"))
    return joined.select(checked.alias("record_id"), *COLUMNS[1:])


def suspect_duplicates(raw: DataFrame) -> DataFrame:
    """Hashes that occur twice or more, across or within sources."""
    g = raw.groupBy("raw_row_hash").agg(F.count("*").alias("n"), F.countDistinct("source_database").alias("n_sources")).where("n > 1")
    return g.withColumn("kind", F.when(F.col("n_sources") > 1, "cross_source").otherwise("within_source"))


def fingerprint_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, sha256, tag, length of whole files, for small ones such as configurations; a cell holds a file, which ends at 2 GB. Tables: ``fingerprint_table``."""
    raw = spark.read.format("binaryFile").load(paths)
    return raw.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), F.sha2("content", 256).alias("sha256"), "length").withColumn("tag", F.substring("sha256", 1, 12))


def fingerprint_table(df: DataFrame, key: str | None = None, study: str | None = None) -> DataFrame:
    """One row: sha256, tag, record_count, study_count of a table of any size.

    Rows hash apart, and their hashes combine whatever the order: by the sums of four pieces of each, which a row more or less changes.
    """
    digest = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"}), 256)
    pieces = [F.sum(F.conv(F.substring("_h", 1 + 14 * i, 14), 16, 10).cast("decimal(38,0)")).alias(f"_s{i}") for i in range(4)]
    rows = df.select(digest.alias("_h"), *[F.col(c) for c in {key, study} - {None}])
    records = F.count(key) if key else F.count("*")
    out = rows.agg(*pieces, F.count("*").alias("_n"), records.alias("record_count"), (F.countDistinct(study) if study else F.lit(None).cast("long")).alias("study_count"))
    sha = F.sha2(F.concat_ws("|", "_n", *[F.col(f"_s{i}").cast("string") for i in range(4)]), 256)
    return out.select(sha.alias("sha256"), F.substring(sha, 1, 12).alias("tag"), "record_count", "study_count")


def append_registry(snapshot: DataFrame, path: str) -> None:
    snapshot.write.mode("append").partitionBy("tag").parquet(path)


def latest_snapshot(registry: DataFrame) -> DataFrame:
    return registry.agg(F.max_by(F.struct("*"), "created_at").alias("s")).select("s.*")
