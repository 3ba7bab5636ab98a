"""op6: near-duplicate embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pvspark.llm import embeddings
from pvspark.llm.scratch import read_table


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"), cosine=0.9)


SQL = """
WITH RECURSIVE vec AS (
  SELECT vec_id, CASE WHEN embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN embedding::DOUBLE[] END AS e
  FROM embeddings
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vec a, vec b
  WHERE a.vec_id <> b.vec_id AND a.e IS NOT NULL AND b.e IS NOT NULL AND len(a.e) = len(b.e)
    AND list_cosine_similarity(a.e, b.e) >= 0.9
), reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM vec
  UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON r.other = l.a
), n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN n USING (vec_id)
"""
