"""op5: quality of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pvspark.llm import quality
from pvspark.llm.scratch import read_table, small_batches


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.score(docs, forest)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")
