"""One query per corpus operator, over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import alignment, bpe, fingerprint, lm, packing, quality
from clickloom.llm import secret_scan, sharding, simhash, substring, toxicity
from clickloom.llm import warc, whitening
from clickloom.llm.common import documents, labels


def op1_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(documents(spark, sf_dir))


def op2_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op3_indexed_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digests(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.judge(docs, quality.fit(docs, labels(spark, sf_dir)))


def op5_ball_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op6_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score_documents(docs, toxicity.fit(docs, labels(spark, sf_dir)))


def op7_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(documents(spark, sf_dir))


def op8_minimum_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(documents(spark, sf_dir), words)


def op9_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(documents(spark, sf_dir))


def op10_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def op11_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return whitening.project(vectors, whitening.fit(vectors))


def op12_text_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
        public_tokenizers.path("piece_bpe_32k.model"),
    )


def op13_ownership_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(documents(spark, sf_dir))


QUERIES = {
    "op1_scaled_sketch": op1_scaled_sketch,
    "op2_merge_replay": op2_merge_replay,
    "op3_indexed_warc": op3_indexed_warc,
    "op4_decision_list": op4_decision_list,
    "op5_ball_hashing": op5_ball_hashing,
    "op6_weak_supervision": op6_weak_supervision,
    "op7_super_kmers": op7_super_kmers,
    "op8_minimum_bin_slack": op8_minimum_bin_slack,
    "op9_log_bilinear": op9_log_bilinear,
    "op10_virtual_slots": op10_virtual_slots,
    "op11_feast_whitening": op11_feast_whitening,
    "op12_text_alignment": op12_text_alignment,
    "op13_ownership_frequency": op13_ownership_frequency,
}

ORACLE_SQL: dict[str, str] = {
    "op3_indexed_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    upper(sha1(encode(coalesce(html, '')))) AS hex
  FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS least FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
      (CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT)
        >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> least THEN least END AS refers_to
FROM f""",
    "op7_super_kmers": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), k AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM w
), s AS (
  SELECT doc_id, word, i, count(*) OVER o AS n, string_agg(word, ' ') OVER o AS passage
  FROM k WINDOW o AS (PARTITION BY doc_id ORDER BY i
    ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)
), m AS (
  SELECT *, n = 13 AND min(doc_id) OVER (PARTITION BY n, passage) < doc_id AS again
  FROM s
), c AS (
  SELECT doc_id, word, i, bool_or(again) OVER (PARTITION BY doc_id ORDER BY i
    ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS gone
  FROM m
)
SELECT w.doc_id, CAST(len(any_value(w.ws)) AS BIGINT) AS n_words,
  count(*) FILTER (c.gone) AS n_removed,
  sha256(coalesce(string_agg(c.word, ' ' ORDER BY c.i) FILTER (NOT c.gone), ''))
    AS kept_sha256
FROM w LEFT JOIN c ON w.doc_id = c.doc_id GROUP BY w.doc_id""",
    "op13_ownership_frequency": r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text, source
  FROM documents
), p(kind, name, pattern, part, least) AS (VALUES
  (0, 'assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|'
    || '[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])'
    || '["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  (1, 'access', 'AKIA[A-Z0-9]+', 0, 20),
  (2, 'hex', '[0-9a-f]{24,}', 0, 24),
  (3, 'owned', '[A-Za-z0-9+/_=-]{20,}', 0, 20)
), m AS (
  SELECT row, source, kind, least, string_split_regex(text, pattern) AS gaps,
    regexp_extract_all(text, pattern) AS hits,
    CASE WHEN part = 2 THEN regexp_extract_all(text, pattern, 2)
      ELSE regexp_extract_all(text, pattern) END AS found
  FROM d, p WHERE regexp_matches(text, pattern)
), e AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m), s AS (
  SELECT row, source, kind, found[i] AS value, length(hits[i]) AS size, CAST(
    list_sum(list_transform(gaps[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0)
    AS BIGINT) AS start
  FROM e WHERE length(found[i]) >= least
), b AS (SELECT * FROM s WHERE kind < 3), w AS (
  SELECT * FROM s WHERE kind = 3 AND regexp_matches(value, '[a-z]')
    AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[0-9]')
    AND NOT EXISTS (SELECT 1 FROM b WHERE b.row = s.row
      AND b.start < s.start + s.size AND s.start < b.start + b.size)
), c AS (SELECT * FROM b UNION ALL SELECT * FROM w), o AS (
  SELECT value, count(DISTINCT source) + max(CAST(source IS NULL AS INT)) <= 8 AS live
  FROM c GROUP BY value
), t AS (
  SELECT row, c.kind, c.start, live,
    name || ':' || c.start || ':' || (c.start + c.size) AS span
  FROM c JOIN o USING (value) JOIN p ON p.kind = c.kind WHERE live OR c.kind < 3
), g AS (
  SELECT row, count(*) FILTER (kind = 0) AS n_assign,
    count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
    count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_shared,
    string_agg(span, ',' ORDER BY start, kind) FILTER (live) AS live_spans,
    string_agg(span, ',' ORDER BY start, kind) AS spans
  FROM t GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(n_live, 0) AS n_live, coalesce(n_shared, 0) AS n_shared,
  coalesce(live_spans, '') AS live_spans, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (row)""",
}
