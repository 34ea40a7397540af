"""The queries of this package, and their SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from folioforge.llm import (
    bpe_codec,
    chat,
    mixing,
    pairwise,
    periodic_runs,
    pivot_clusters,
    quality_rules,
    secret_scan,
    simhash,
    suffix_dedup,
    token_counts,
    token_files,
    topk,
)
from folioforge.llm.common import table
from folioforge.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicate_classes(table(spark, folder, "documents"))


def op2_bit_sliced_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_neighbours(table(spark, folder, "embeddings"))


def op3_tree_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_codec.encoding_digests(table(spark, folder, "documents"))


def op4_role_repair(spark: SparkSession, folder: str) -> DataFrame:
    return chat.repaired_turns(table(spark, folder, "conversations"))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    trusted = quality_rules.trusted_by_labels(table(spark, folder, "labels"))
    return quality_rules.judged(table(spark, folder, "documents"), trusted, leave_out=True).selectExpr(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op6_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.span_digests(secret_scan.secret_spans(table(spark, folder, "documents")))


def op7_pairwise_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return pairwise.quality_scores(docs, pairwise.learn(docs, table(spark, folder, "labels")))


def op8_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).drop("source", "copies")


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"))


def op11_laesa_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_clusters.cluster_digests(pivot_clusters.cluster(table(spark, folder, "embeddings")))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = periodic_runs.with_cycles(table(spark, folder, "documents"))
    return periodic_runs.run_digests(periodic_runs.collapse_runs(docs))


def op13_elias_fano_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark)
    token_files.write_token_files(table(spark, folder, "documents"), path)
    return token_files.document_digests(token_files.read_token_files(spark, path))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


_QUERIES: list[Query] = [
    op1_simhash_near_dedup,
    op2_bit_sliced_top_k,
    op3_tree_bpe,
    op4_role_repair,
    op5_quality_rules,
    op6_secret_scans,
    op7_pairwise_quality,
    op8_source_mixing,
    op9_suffix_dedup,
    op10_token_counts,
    op11_laesa_clusters,
    op12_periodic_runs,
    op13_elias_fano_files,
    pipeline,
]

_OP2 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_OP8 = """
WITH d AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
    coalesce(greatest(0.05, CAST(length(regexp_replace(coalesce(text, ''), '[#*$%&|<>0-9]+', '', 'g')) AS DOUBLE)
      / nullif(length(text), 0)), 1.0) AS w,
    (CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5)
      / 4503599627370496.0 AS u
  FROM documents
), k AS (
  SELECT doc_id, source, size, -ln(u) / w AS key FROM d
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM k GROUP BY source
), w AS (
  SELECT source, source_size,
    CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS DOUBLE) AS weight
  FROM s
), o AS (
  SELECT *, 3 * source_size / weight AS bound FROM w
), l AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (ORDER BY bound, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY bound, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM o
), t AS (
  SELECT source, source_size, least(3.0 * source_size,
    coalesce(weight * (SELECT level FROM l WHERE level < bound ORDER BY bound, source NULLS LAST LIMIT 1),
      3.0 * source_size)) AS target
  FROM l
), p AS (
  SELECT *, least(3, coalesce(floor(target / nullif(source_size, 0) + 1e-9), 0)) AS epochs FROM t
), r AS (
  SELECT k.*, source_size, target, epochs, greatest(target - epochs * source_size, 0) AS rest,
    sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size / 2 AS middle
  FROM k JOIN p ON k.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
  CAST((epochs + CASE WHEN rest > 0 AND middle < rest THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM r
"""

#: Rounds of assignment and floored means, written out; x // y of DuckDB cuts towards zero.
_NEAREST = """
a{k} AS (
  SELECT row_id, q, arg_min(c, d * 16 + c) AS c, min(d) AS d FROM (
    SELECT v.row_id, v.q, m.c,
      CAST(list_sum(list_transform(list_zip(v.q, m.q), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM v, m{k} m) GROUP BY row_id, q
)"""
_MEANS = """,
s{k} AS (
  SELECT c, i, CAST(sum(q[i]) AS BIGINT) AS s, count(*) AS n
  FROM a{k}, range(1, 65) r(i) GROUP BY c, i
), m{j} AS (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS q FROM s{k} GROUP BY c
  UNION ALL SELECT c, q FROM m{k} WHERE c NOT IN (SELECT c FROM s{k})
),"""
_OP11 = (
    """
WITH v AS (
  SELECT row_number() OVER () AS row_id, vec_id,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), m0 AS (
  SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q
  FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, q FROM v ORDER BY h, q LIMIT 16)
),"""
    + "".join(_NEAREST.format(k=k) + _MEANS.format(k=k, j=k + 1) for k in range(3))
    + _NEAREST.format(k=3)
    + """, t AS (
  SELECT c, CAST(sum(d) AS BIGINT) AS cluster_inertia, CAST(sum(sum(d)) OVER () AS BIGINT) AS inertia FROM a3 GROUP BY c
)
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, cluster_inertia, inertia,
  sha256(array_to_string(m.q, ',')) AS centroid_sha256
FROM a3 a JOIN v ON v.row_id = a.row_id JOIN m3 m ON m.c = a.c JOIN t ON t.c = a.c
"""
)


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op2_bit_sliced_top_k": _OP2, "op8_source_mixing": _OP8, "op11_laesa_clusters": _OP11}
