"""op11: spelling variants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pvspark.llm import variants
from pvspark.llm.scratch import read_table, small_batches


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return variants.spelling_variants(read_table(spark, sf_dir, "documents"), slip=31)
