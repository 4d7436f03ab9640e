"""Queries of the vector search and of the mining of negatives."""

from __future__ import annotations

from pyspark.sql import functions as F

from paralex.llm import hard_negatives, topk
from paralex.llm.common import table

SCALE, K, EVERY = 64.0, 20, 20


def op9_topk(spark, sf_dir):
    vectors = topk.whole_numbers(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), SCALE)
    return topk.top_k(vectors, F.col("vec_id") % EVERY == 0, K)


FINE = 256.0


def op13_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.usable(vectors, F.col("vec_id"), label, F.col("embedding"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0, FINE)


QUERIES = {"op9_topk": op9_topk, "op13_hard_negatives": op13_hard_negatives}
ORACLE = {
    "op9_topk": """
      WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
      SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op13_hard_negatives": """
      WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
            CAST(list_inner_product(a.e, r.e) AS BIGINT) AS score FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, CAST(row_number() OVER
              (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
          FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
      SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
}
