"""DOI metadata of any shape: messages whose fields are missing, single, lists or nested, read without a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The place of each field and the kinds that are read: a text, a number, a list's first entry, a list of lists' first.
TEXTS = {"doi": "DOI", "title": "title", "journal": "container-title", "volume": "volume", "issue": "issue", "pages": "page"}


def _kind(message: Column, path: str) -> Column:
    """text, number, list, object or other; null where the field is missing or null."""
    shape = F.schema_of_variant(F.try_variant_get(message, path, "variant"))
    kind = F.when(shape == "STRING", "text").when(shape.rlike("^(BIGINT|DECIMAL|DOUBLE)"), "number").when(shape.startswith("ARRAY"), "list").when(shape.startswith("OBJECT"), "object")
    return F.when(shape.isNotNull() & (shape != "VOID"), F.coalesce(kind, F.lit("other")))


def _single(message: Column, path: str) -> Column:
    """The value as text if it is a text or a number, else null."""
    return F.when(_kind(message, path).isin("text", "number"), F.try_variant_get(message, path, "string"))


def _field(message: Column, name: str) -> Column:
    """The text or number at a field, or the first entry of its list."""
    return F.coalesce(_single(message, f"$['{name}']"), _single(message, f"$['{name}'][0]"))


def _year(message: Column) -> Column:
    """Of date parts in a list of lists or a list, or of a date as text."""
    parts = F.coalesce(_single(message, "$.issued['date-parts'][0][0]"), _single(message, "$.issued['date-parts'][0]"), _single(message, "$.issued['date-parts']"), _single(message, "$.issued"))
    return F.try_to_number(F.nullif(F.regexp_extract(parts, r"^(\d{4})", 1), F.lit("")), F.lit("9999")).cast("int")


def doi_fields(messages: DataFrame, column: str = "value") -> DataFrame:
    """readable, doi, title, journal, volume, issue, pages, year of each message (a JSON text); other columns stay."""
    parsed = messages.withColumn("_m", F.try_parse_json(column))
    m = F.col("_m")
    return parsed.select(*[c for c in messages.columns if c != column], m.isNotNull().alias("readable"), *[_field(m, at).alias(name) for name, at in TEXTS.items()], _year(m).alias("year"))


def shape_findings(messages: DataFrame, key: str, column: str = "value") -> DataFrame:
    """key, field, kind: fields that are missing or neither text, number nor list, and messages that aren't JSON objects."""
    parsed = messages.withColumn("_m", F.try_parse_json(column))
    m = F.col("_m")
    whole = F.coalesce(_kind(m, "$"), F.lit("unreadable"))
    fields = {**TEXTS, "year": "issued"}
    found = [F.when((whole == "object") & ~F.coalesce(_kind(m, f"$['{at}']"), F.lit("missing")).isin("text", "number", "list", *(["object"] if name == "year" else [])), F.struct(F.lit(name).alias("field"), F.coalesce(_kind(m, f"$['{at}']"), F.lit("missing")).alias("kind"))) for name, at in fields.items()]
    found.append(F.when(whole != "object", F.struct(F.lit("message").alias("field"), whole.alias("kind"))))
    return parsed.select(key, F.explode(F.array_compact(F.array(*found))).alias("f")).select(key, "f.*")


def read_doi_messages(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``doi_fields`` of a dump of one message a line."""
    return doi_fields(spark.read.text(paths))
