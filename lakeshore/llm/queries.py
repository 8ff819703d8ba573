"""The queries of this package, as the driver registers them: name -> builder(spark, sf_dir), and DuckDB twins."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, decontam, langid, lm, negatives, orchard, scaled_sketch, secrets, simhash, substrings, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(_table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.archive_pages(_table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digest(_table(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), size=3, most=2)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_language(_table(spark, sf_dir, "documents"))


def op11_orchard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.cluster_vectors(_table(spark, sf_dir, "embeddings"))


def op12_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled_sketch.fingerprint_documents(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.select("vec_id", label.alias("label"), "embedding"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_secret_scan, op2_warc, op3_byte_bpe, op4_nearest_neighbours, op5_substrings, op6_simhash, op7_toxicity, op8_language_model, op9_decontamination, op10_language_id,
                          op11_orchard_clusters, op12_scaled_sketch, op13_hard_negatives)
}

#: DuckDB has no SHA-1 in base32: its hex digest's bytes are spelt out in groups of 5 bits.
OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload) AS payload_bytes, payload, sha1(payload) AS hex,
             row_number() OVER (PARTITION BY payload ORDER BY page_id NULLS LAST) AS nth,
             first_value(page_id) OVER (PARTITION BY payload ORDER BY page_id NULLS LAST) AS first_id FROM p),
b AS (SELECT *, list_transform(range(8), lambda g: ('0x' || hex[g * 5 + 1:g * 5 + 5])::BIGINT) AS quints FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i:
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(quints[i // 4 + 1] >> (15 - 5 * (i % 4))) % 32 + 1]), 'string_agg', '') AS payload_digest,
       CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN nth > 1 THEN first_id END AS refers_to
FROM b
"""

_FINITE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _op11_sql(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """Plain k-means: every vector against every centroid, one pair of steps a round."""
    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR) NULLS LAST, embedding) AS r, vec_id,
         list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {dims} AND {_FINITE})""",
             f"c0 AS MATERIALIZED (SELECT r - 1 AS cluster, v AS c FROM kept WHERE r <= {k})"]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(v) AS v, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d FROM (
    SELECT r, vec_id, v, cluster, list_sum(list_transform(range(1, {dims + 1}), lambda j: (v[j] - c[j]) * (v[j] - c[j])))::BIGINT AS d FROM kept, c{i})
  GROUP BY r)""")
        if i < rounds:
            steps.append(f"""s{i} AS (
  SELECT cluster, j, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, {dims + 1})) AS j FROM a{i}) GROUP BY cluster, j),
m{i} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY j)::BIGINT[] AS c FROM s{i} GROUP BY cluster),
c{i + 1} AS MATERIALIZED (SELECT c{i}.cluster, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (cluster))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, a{rounds}.cluster::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a{rounds}.cluster))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)"""


#: Every anchor against every row.
OP13_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND {_FINITE}),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
         list_sum(list_transform(range(1, len(a.v) + 1), lambda j: a.v[j] * b.v[j]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

ORACLE_SQL: dict[str, str] = {"op2_warc": OP2_SQL, "op11_orchard_clusters": _op11_sql(), "op13_hard_negatives": OP13_SQL}
