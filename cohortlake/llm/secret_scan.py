"""Secret scans: multipart credential linking, native.

Base spans come from three patterns. The method adds the parts of a credential that are too weak to report
alone: account identifiers, dense tokens and endpoints. A weak part is only reported where its complement
lies within ``scope`` code points: a token needs an identifier, an identifier a token or base secret, an
endpoint both. A weak part that a base span holds whole is left out beforehand. This interval join runs on buckets of ``scope`` code points: for each document, bucket and
role the smallest and largest start are kept, and a part looks into its own bucket and the two beside it,
so the work is linear in the parts and no pairs arise.

Defined cases: a null text counts as empty; a text without secrets has zero counts and empty strings (the
digest is that of the empty string); null ids and repeated rows are scanned like any other row; an empty
table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm.common import text_of, written

# The base patterns and their least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a run of 24 or more, as [0-9a-f]+ kept at that length
LEAST = {"assign": 6, "access": 20}
# Weak parts, reported only when linked.
IDENTIFIER = r"""(?i)(?:access_key_id|client_id|account_id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
DENSE = r"[A-Za-z0-9+/_-]{20,}"
ENDPOINT = r"""https?://[^\s"'<>|]+"""
KINDS = ["assign", "access", "hex", "identifier", "token", "endpoint"]
SCOPE = 256


STEP = 128


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _spans(pattern: str, kind: str, keep: str = "true") -> str:
    """SQL of the matches as structs in text order; positions are sums of the lengths of matches and of what lies between.

    The sums run within steps of STEP matches on top of the sum at each step's begin, so that the work stays about linear.
    """
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    none = "cast(array() AS array<struct<start:int,kind:int,stop:int>>)"
    sizes = f"zip_with(slice(split(text, '{quoted}', -1), 1, size(hits)), hits, (gap, hit) -> char_length(gap) + char_length(hit))"
    bases = f"""aggregate(sequence(0, (size(hits) - 1) div {STEP}), array(0), (sums, k) -> concat(sums, array(element_at(sums, -1)
        + aggregate(slice(sizes, cast(k * {STEP} + 1 AS int), {STEP}), 0, (x, y) -> x + y))))"""
    stop = f"bases[i div {STEP}] + aggregate(slice(sizes, cast(i - i % {STEP} + 1 AS int), cast(i % {STEP} + 1 AS int)), 0, (x, y) -> x + y)"
    every = f"transform(hits, (hit, i) -> struct(hit, {stop} AS stop))"
    found = f"transform(filter({every}, g -> {keep}), g -> struct(cast(g.stop - char_length(g.hit) AS int) AS start, {KINDS.index(kind)} AS kind, cast(g.stop AS int) AS stop))"
    return _let("hits", f"regexp_extract_all(text, '{quoted}', 0)", f"CASE WHEN size(hits) = 0 THEN {none} ELSE {_let('sizes', sizes, _let('bases', bases, found))} END")


def _value_kept() -> str:
    quoted = ASSIGN.replace("\\", "\\\\").replace("'", "\\'")
    return f"char_length(regexp_extract(g.hit, '{quoted}', 2)) >= {LEAST['assign']}"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row, base, weak: spans as arrays of (start, kind, stop) for each input row."""
    mixed = "g.hit RLIKE '[0-9]' AND g.hit RLIKE '[A-Za-z]'"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.expr(_spans(ASSIGN, "assign", _value_kept())).alias("assign"),
        F.expr(_spans(ACCESS, "access", f"char_length(g.hit) >= {LEAST['access']}")).alias("access"),
        F.expr(_spans(HEX, "hex")).alias("hex"),
        F.expr(_spans(IDENTIFIER, "identifier")).alias("identifier"),
        F.expr(_spans(DENSE, "token", mixed)).alias("token"),
        F.expr(_spans(ENDPOINT, "endpoint")).alias("endpoint"),
    )


def linked_parts(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """row, linked: the weak spans whose complement lies within ``scope``; only rows that have some."""
    weak = "size(identifier) + size(token) + size(endpoint) > 0"
    roles = "size(access) + size(identifier) > 0 AND size(assign) + size(hex) + size(token) > 0"
    parts = found.where(f"{weak} AND {roles}").select("row", F.explode(F.concat("assign", "access", "hex", "identifier", "token", "endpoint")).alias("s"))
    # A weak part within a base span adds nothing: that is one that starts at or before it and reaches as far.
    before = Window.partitionBy("row").orderBy("s.start").rangeBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("reach", F.max(F.expr("CASE WHEN s.kind < 3 THEN s.stop END")).over(before)).where("s.kind < 3 OR reach IS NULL OR reach < s.stop")
    parts = parts.select("row", "s", F.expr(f"s.start div {scope}").alias("bucket"), F.expr("CASE WHEN s.kind IN (1, 3) THEN 'id' WHEN s.kind IN (0, 2, 4) THEN 'secret' ELSE 'endpoint' END").alias("role"))
    ends = parts.where("role <> 'endpoint'").groupBy("row", "bucket", "role").agg(F.min("s.start").alias("low"), F.max("s.start").alias("high"))
    seen = ends.select("row", "role", F.explode(F.array(F.struct((F.col("bucket") - 1).alias("bucket"), F.lit("next").alias("side")), F.struct(F.col("bucket"), F.lit("same").alias("side")), F.struct((F.col("bucket") + 1).alias("bucket"), F.lit("last").alias("side")))).alias("b"), "low", "high")
    near = seen.groupBy("row", F.col("b.bucket").alias("bucket")).agg(*[F.max(F.expr(f"CASE WHEN role = '{role}' AND b.side = '{side}' THEN {'low' if side == 'next' else 'high'} END")).alias(f"{role}_{side}") for role in ("id", "secret") for side in ("last", "same", "next")])
    joined = parts.where("s.kind >= 3").join(near, ["row", "bucket"])
    has = lambda role: f"({role}_same IS NOT NULL OR coalesce(s.start - {role}_last <= {scope}, false) OR coalesce({role}_next - s.start <= {scope}, false))"
    need = f"CASE s.kind WHEN 3 THEN {has('secret')} WHEN 4 THEN {has('id')} ELSE {has('id')} AND {has('secret')} END"
    return joined.where(need).groupBy("row").agg(F.collect_list("s").alias("linked"))


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base, spans (arrays by start, then kind)."""
    found = written(scan(docs, id_col, text_col), "secret-spans")
    linked = linked_parts(found, scope)
    base = F.concat("assign", "access", "hex")
    named = lambda c: F.transform(F.array_sort(c), lambda s: F.struct(F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    return found.join(linked, "row", "left").select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        named(base).alias("base"),
        named(F.concat(base, F.coalesce("linked", F.expr("cast(array() AS array<struct<start:int,kind:int,stop:int>>)")))).alias("spans"),
    )


def spans_string(column: str) -> Column:
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
