"""The registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm.bpe_codec import round_trip
from cohortlake.llm.common import table
from cohortlake.llm.decontamination import contaminated
from cohortlake.llm.exact_dedup import exact_dedup
from cohortlake.llm.html_extract import extract_text
from cohortlake.llm.line_dedup import line_dedup
from cohortlake.llm.merkle_manifest import verified_manifest
from cohortlake.llm.quality_classifier import select_quality
from cohortlake.llm.secret_scan import secret_scan, spans_string
from cohortlake.llm.simhash_dedup import simhash_groups
from cohortlake.llm.substring_dedup import substring_dedup
from cohortlake.llm.suffix_dedup import suffix_dedup
from cohortlake.llm.token_alignment import align_documents
from cohortlake.llm.topk_search import top_k


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op3_bpe_encoding_and_decoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = select_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("row.doc_id", "expected_grade", "tail_probability")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), "longest_repeat")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(spans_string("base"), 256).alias("base_sha256"), spans_string("spans").alias("spans"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_exact_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op12_merkle_dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_manifest(table(spark, sf_dir, "documents"))


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_html_extraction, op2_simhash_near_dedup, op3_bpe_encoding_and_decoding, op4_benchmark_decontamination, op5_quality_classifier, op6_substring_dedup, op7_exact_dedup, op8_suffix_array_dedup, op9_secret_scans, op10_line_dedup, op11_exact_top_k_search, op12_merkle_dataset_manifest, op13_cross_tokenizer_alignment)}

ORACLES = {
    "op7_exact_dedup": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
h AS (SELECT doc_id, length(t) AS n, sha256(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM d)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER w = 1 AS kept, text_sha256
FROM h WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
""",
    "op10_line_dedup": r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS s, lines FROM d),
c AS (SELECT *, len(regexp_extract_all(lines[s], '[^\x20\x09-\x0D]+')) AS words FROM p),
t AS (SELECT *, lead(words) OVER (PARTITION BY doc_id ORDER BY s) AS next FROM c),
w AS (SELECT doc_id, s, 3 AS n, lines[s] AS a, lines[s + 1] AS b, lines[s + 2] AS c FROM t WHERE s + 2 <= len(lines)
  UNION ALL SELECT doc_id, s, 1, lines[s], NULL, NULL FROM t WHERE words >= 50
  UNION ALL SELECT doc_id, s, 2, lines[s], lines[s + 1], NULL FROM t WHERE words + next >= 50),
v AS (SELECT doc_id, s, n, row_number() OVER (PARTITION BY n, a, b, c ORDER BY doc_id, s) AS rn FROM w),
r AS (SELECT DISTINCT doc_id, s + k AS i FROM v, (SELECT unnest(range(3)) AS k) WHERE rn > 1 AND k < n),
g AS (SELECT doc_id, list(i) AS gone FROM r GROUP BY doc_id)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(list_transform(list_filter(range(1, len(lines) + 1), lambda i: NOT coalesce(list_contains(gone, i), false)), lambda i: lines[i]), chr(10)), '')) AS kept_sha256
FROM d LEFT JOIN g USING (doc_id)
""",
    "op11_exact_top_k_search": r"""
WITH f AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, q.v, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM f q JOIN f c ON len(q.v) = len(c.v) AND NOT (q.vec_id IS NOT DISTINCT FROM c.vec_id AND q.v = c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id, v ORDER BY score DESC, vec_id NULLS LAST) QUALIFY row_number() OVER w <= 5
""",
    "op12_merkle_dataset_manifest": r"""
WITH RECURSIVE v AS (SELECT doc_id, lang, text,
    concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head,
    -- crc32 of the decimal id: each letter, then eight steps of a bit (-1)
    list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS crc
  FROM documents),
h AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS low, xor(crc, 4294967295) % 3 = 0 AS tampered FROM v),
p AS (SELECT *, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM h WINDOW w AS (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf)),
nodes AS (SELECT 0 AS lvl, lang, pos, n, leaf AS digest FROM p
  UNION ALL SELECT lvl + 1, lang, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY lvl, lang, pos // 8, n),
subs AS (SELECT lang, digest, lvl AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (SELECT 0 AS lvl, pos, n, digest FROM subs
  UNION ALL SELECT lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY lvl, pos // 8, n),
root AS (SELECT digest AS root FROM tops WHERE n = 1),
runs AS (SELECT lvl, lang, pos // 8 AS run, false AS top, list(digest ORDER BY pos) AS d FROM nodes WHERE n > 1 GROUP BY ALL
  UNION ALL SELECT lvl, NULL, pos // 8, true, list(digest ORDER BY pos) FROM tops WHERE n > 1 GROUP BY ALL),
up AS (SELECT p.doc_id, p.leaf, p.lang, p.pos, false AS top, 0 AS lvl, CASE WHEN tampered THEN low ELSE leaf END AS fold, '' AS proof, s.digest AS subroot, s.height, s.pos AS place
    FROM p JOIN subs s ON p.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT u.doc_id, u.leaf, u.lang, CASE WHEN u.turn THEN u.place ELSE u.pos // 8 END, u.top OR u.turn, CASE WHEN u.turn THEN 0 ELSE u.lvl + 1 END,
    CASE WHEN u.turn THEN u.fold ELSE sha256(array_to_string(r.d[:u.pos % 8], '') || u.fold || array_to_string(r.d[u.pos % 8 + 2:], '')) END,
    CASE WHEN u.turn THEN u.proof ELSE u.proof || array_to_string(r.d[:u.pos % 8], '') || array_to_string(r.d[u.pos % 8 + 2:], '') END, u.subroot, u.height, u.place
  FROM (SELECT *, NOT top AND lvl = height AS turn FROM up) u
    LEFT JOIN runs r ON NOT u.turn AND r.top = u.top AND r.lvl = u.lvl AND r.run = u.pos // 8 AND (u.top OR r.lang IS NOT DISTINCT FROM u.lang)
  WHERE u.turn OR r.d IS NOT NULL)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified
FROM up, root WHERE top AND lvl = (SELECT max(lvl) FROM tops)
""",
}
