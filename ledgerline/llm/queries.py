"""The queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    alignment, block_ann, bpe, exact_dedup, fingerprints, line_dedup, merkle, packing, quality_pu, secret_scan, sharding, simhash,
    warc,
)
from ledgerline.llm.common import table

SHARDS = 24


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_classes(table(spark, sf_dir, "documents"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(table(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), digest_all=True).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_pu.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.assign_shards(table(spark, sf_dir, "documents"), SHARDS)
    return shards.withColumn("law", F.lit("key")).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(table(spark, sf_dir, "documents"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_ann.nearest(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_document_fingerprints, op2_line_dedup, op3_secret_scans, op4_simhash_near_dedup, op5_exact_dedup,
             op6_best_fit_packing, op7_quality_classifier, op8_bpe_encode_decode, op9_sharding, op10_warc,
             op11_cross_tokenizer_alignment, op12_merkle_manifest, op13_nearest_neighbours, pipeline)
    return {f.__name__: f for f in every}


# Operators without SQL (sketches, edit joins, spans, SimHash bits, packing,
# training, merges, CRCs) are tested against brute force in tests/llm.
_EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER g = 1 AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id NULLS LAST)
"""

_WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
t AS (
  SELECT page_id, strlen(html) AS payload_bytes, h, first_value(page_id) OVER w AS first, row_number() OVER w > 1 AS again
  FROM p WINDOW w AS (PARTITION BY h ORDER BY page_id NULLS LAST))
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to
FROM t
"""


# CRC-32 by its table, digests level by level, proofs as lists of siblings.
_MERKLE = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY i) AS t
  FROM range(256) r(i)),
d AS (
  SELECT *, replace(text, chr(10), '') AS cut, doc_id IS NOT NULL AND xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 2 = 0 AS hit
  FROM documents, crc_table),
h AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(CASE WHEN hit THEN strlen(cut) || ':' || cut ELSE strlen(text) || ':' || text END, '-')) AS changed
  FROM (SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
          || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM d)),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source) AS n
  FROM h),
below AS (
  SELECT tree, 0 AS level, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY pos))
  FROM below WHERE n > 1 GROUP BY tree, level, pos // 3),
subroots AS (SELECT tree, digest FROM below WHERE n = 1),
above AS (
  SELECT 0 AS level, tree AS pos, (SELECT count(*) FROM subroots) AS n, digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY pos))
  FROM above WHERE n > 1 GROUP BY level, pos // 3),
heights AS (SELECT tree, max(level) AS height FROM below GROUP BY tree),
every AS (
  SELECT tree, level, pos, digest FROM below
  UNION ALL
  SELECT -1, level, pos, digest FROM above),
steps AS (
  SELECT l.tree, l.pos, s.level, l.pos // (3 ** s.level)::BIGINT AS at, l.tree AS inside
  FROM leaves l JOIN heights h USING (tree), LATERAL (SELECT unnest(range(h.height)) AS level) s
  UNION ALL
  SELECT l.tree, l.pos, h.height + s.level, l.tree // (3 ** s.level)::BIGINT, -1
  FROM leaves l JOIN heights h USING (tree), (SELECT unnest(range((SELECT max(level) FROM above))) AS level) s),
proofs AS (
  SELECT p.tree, p.pos, p.level, coalesce(string_agg(e.digest, '' ORDER BY e.pos) FILTER (e.pos < p.at), '') AS lhs,
         coalesce(string_agg(e.digest, '' ORDER BY e.pos) FILTER (e.pos > p.at), '') AS rhs
  FROM steps p JOIN heights h USING (tree)
  JOIN every e ON e.tree = p.inside AND e.level = CASE WHEN p.inside < 0 THEN p.level - h.height ELSE p.level END AND e.pos // 3 = p.at // 3
  GROUP BY p.tree, p.pos, p.level),
folds AS (
  SELECT tree, pos, 0::BIGINT AS level, changed AS digest FROM leaves
  UNION ALL
  SELECT f.tree, f.pos, f.level + 1, sha256(p.lhs || f.digest || p.rhs)
  FROM folds f JOIN proofs p ON p.tree = f.tree AND p.pos = f.pos AND p.level = f.level),
told AS (SELECT tree, pos, arg_max(digest, level) AS folded_root FROM folds GROUP BY tree, pos),
whole AS (SELECT tree, pos, sha256(string_agg(lhs || rhs, '' ORDER BY level)) AS proof_sha256 FROM proofs GROUP BY tree, pos),
top AS (SELECT digest AS root FROM above WHERE n = 1)
SELECT l.doc_id, l.leaf, s.digest AS subroot, root, coalesce(w.proof_sha256, sha256('')) AS proof_sha256, t.folded_root,
       t.folded_root = root AS verified
FROM leaves l JOIN subroots s ON s.tree = l.tree JOIN told t ON t.tree = l.tree AND t.pos = l.pos
LEFT JOIN whole w ON w.tree = l.tree AND w.pos = l.pos, top
"""

_NEAREST = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER w AS rank, vec_id, score
FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_exact_dedup": _EXACT_DEDUP, "op10_warc": _WARC, "op12_merkle_manifest": _MERKLE, "op13_nearest_neighbours": _NEAREST}
