"""Queries over embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.llm import topk as K
from pagewright.llm import whitening as W
from pagewright.llm.common import read

EVERY = 20


def op3_exact_topk(spark, sf_dir):
    """The 20 best other vectors of each vector whose id is divisible by 20."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", K.whole(F.col("embedding")).alias("vec"))
    return K.search(rows, rows.where(F.col("vec_id") % EVERY == 0), k=20)


def op12_embedding_whitening(spark, sf_dir):
    """All embeddings on the first components of their covariance, whitened."""
    return W.whiten(read(spark, sf_dir, "embeddings"))


QUERIES = {"op3_exact_topk": op3_exact_topk, "op12_embedding_whitening": op12_embedding_whitening}
ORACLE = {"op3_exact_topk": f"""
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.vec::DOUBLE[], c.vec::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.vec) = len(q.vec) WHERE q.vec_id % {EVERY} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20"""}
