"""op3: benchmark contamination of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pvspark.llm import decontamination
from pvspark.llm.scratch import read_table, small_batches


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = decontamination.contamination(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        decontamination.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


SQL = r"""
WITH doc AS (
  SELECT doc_id, row_number() OVER () AS row_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), item AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), item_window AS (
  SELECT DISTINCT item_id, len, array_to_string(words[i:i + len - 1], ' ') AS win FROM (
    SELECT item_id, words, least(13, len(words)) AS len,
      unnest(generate_series(1, greatest(len(words) - 12, 1))) AS i FROM item WHERE len(words) > 0)
), lens AS (SELECT DISTINCT len FROM item_window),
doc_window AS (
  SELECT row_id, i, len, array_to_string(words[i:i + len - 1], ' ') AS win FROM (
    SELECT row_id, words, len, unnest(generate_series(1, len(words) - len + 1)) AS i
    FROM doc, lens WHERE len(words) >= len)
), matched AS (
  SELECT d.row_id, d.i, d.len, w.item_id FROM doc_window d JOIN item_window w USING (len, win)
), hit AS (
  SELECT row_id, count(DISTINCT w) AS n_hit FROM (
    SELECT row_id, unnest(generate_series(i, i + len - 1)) AS w FROM (SELECT DISTINCT row_id, i, len FROM matched))
  GROUP BY row_id
), items AS (
  SELECT row_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM matched GROUP BY row_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM doc LEFT JOIN hit USING (row_id) LEFT JOIN items USING (row_id)
"""
