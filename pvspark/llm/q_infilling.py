"""op13: fill-in-the-middle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pvspark.llm import infilling
from pvspark.llm.scratch import read_table, small_batches


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    made = infilling.fill_in_middle(read_table(spark, sf_dir, "documents"))
    restored = infilling.restore(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"),
    )


SQL = """
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), num AS (
  SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS c1, ('0x' || h[9:16])::BIGINT % (n + 1) AS c2,
    ('0x' || h[17:24])::BIGINT % 100 AS h3, ('0x' || h[25:32])::BIGINT % 100 AS h4 FROM doc
), cut AS (
  SELECT *, least(c1, c2) AS lo, greatest(c1, c2) AS hi,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
         WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM num
), part AS (
  SELECT *, substring(t, 1, lo) AS p, substring(t, lo + 1, hi - lo) AS m, substring(t, hi + 1) AS s FROM cut
)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN lo END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN hi - lo END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM part
"""
