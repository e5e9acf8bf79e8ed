"""The registered queries of this subpackage, with SQL for DuckDB where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontam, langid_crf, license_scan, lm_bloom, minhash, packing, quality, suffix_dedup, topk_bsi, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_bloom.score(_table(spark, sf_dir, "documents"), "crc32(cast(doc_id as string)) % 10 <> 0")


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_bsi.top_k(_table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid_crf.classify(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_packing, op3_minhash, op4_quality, op5_license, op6_toxicity, op7_lm_score, op8_decontam, op9_topk, op10_langid)}

_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

#: Every 100-byte string of every text; a string that is not the first of its kind covers its bytes.
_REPEATS = """
WITH d AS (SELECT doc_id, coalesce(encode(text), ''::BLOB) AS b FROM documents),
w AS (SELECT doc_id, i, b[i:i + 99] AS s FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 98)) AS i FROM d WHERE octet_length(b) >= 100)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w) WHERE k > 1),
cut AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER o + 100 THEN 1 ELSE 0 END AS new FROM again WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 99 AS z FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM cut) GROUP BY doc_id, g),
gaps AS (SELECT doc_id, coalesce(lag(z) OVER o, 0) + 1 AS a, r.a - 1 AS z FROM runs r WINDOW o AS (PARTITION BY doc_id ORDER BY r.a)
  UNION ALL SELECT doc_id, max(z) + 1, 2147483647 FROM runs GROUP BY doc_id),
kept AS (SELECT doc_id, coalesce(string_agg(hex(b[gaps.a:gaps.z]), '' ORDER BY gaps.a) FILTER (gaps.z >= gaps.a), '') AS h FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
n AS (SELECT doc_id, CAST(sum(z - a + 1) AS BIGINT) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT d.doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(coalesce(unhex(h), b)) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

#: All pairs of documents that share a shingle, then all documents that are reachable over links.
_NEAR = """
WITH RECURSIVE t AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS sh FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS doc_id, b AS other FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, least(t.doc_id, coalesce(m.least, t.doc_id)) AS component_id, t.doc_id = least(t.doc_id, coalesce(m.least, t.doc_id)) AS kept
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS least FROM r GROUP BY doc_id) m USING (doc_id)
"""

ORACLE = {"op1_suffix_dedup": _REPEATS, "op3_minhash": _NEAR, "op5_license": license_scan.oracle(), "op9_topk": _TOP_K}
