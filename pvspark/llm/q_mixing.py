"""op4: all documents mixed to the weights of their sources, in training order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pvspark.llm import mixing
from pvspark.llm.scratch import read_table


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    first = mixed.select(
        "doc_id", "size", "source_size", "target", "taken", "n_passes",
        F.get("positions", F.lit(0)).alias("position"),
    )
    return first.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


SQL = r"""
WITH base AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS place,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY encode(source) NULLS LAST) AS source_rank FROM base GROUP BY source
), weighted AS (
  SELECT *, [5, 2, 1][(source_rank - 1) % 3 + 1]::BIGINT AS weight, 2 * source_size AS cap FROM sources
), levels AS (
  SELECT *,
    3 * sum(source_size) OVER () - 2 * coalesce(sum(cap) OVER earlier, 0) AS level_num,
    2 * (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level_den
  FROM weighted
  WINDOW earlier AS (ORDER BY cap / weight, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT level_num, level_den FROM levels
  WHERE cap * level_den >= level_num * weight ORDER BY cap / weight, source_rank LIMIT 1
), targets AS (
  SELECT w.source, w.source_size, w.source_rank,
    CASE WHEN l.level_num IS NULL OR w.cap * l.level_den < l.level_num * w.weight THEN w.cap::DOUBLE
      ELSE (l.level_num * w.weight)::DOUBLE / l.level_den::DOUBLE END AS target
  FROM weighted w LEFT JOIN level l ON TRUE
), placed AS (
  SELECT b.doc_id, b.size, t.source_size::BIGINT AS source_size, t.target, round(t.target)::BIGINT AS words,
    [0.5, 0.0, -0.5][(t.source_rank - 1) % 3 + 1]::DOUBLE AS slope,
    coalesce(sum(b.size) OVER (PARTITION BY b.source ORDER BY b.place, b.doc_id, b.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM base b JOIN targets t ON b.source IS NOT DISTINCT FROM t.source
), passes AS (
  SELECT *, greatest(0, least(size, words - before)) AS first_pass,
    greatest(0, least(size, words - source_size - before)) AS second_pass, before / target AS fraction
  FROM placed
)
SELECT doc_id, size, source_size, target, (first_pass + second_pass)::BIGINT AS taken,
  ((first_pass > 0)::INTEGER + (second_pass > 0)::INTEGER)::INTEGER AS n_passes,
  CASE WHEN first_pass > 0 THEN 2.0::DOUBLE * fraction / ((1.0::DOUBLE - slope) + sqrt(greatest(
    (1.0::DOUBLE - slope) * (1.0::DOUBLE - slope) + 4.0::DOUBLE * slope * fraction, 0.0::DOUBLE))) END AS position
FROM passes
"""
