"""op8: near-duplicate documents by SimHash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pvspark.llm import simhash
from pvspark.llm.scratch import read_table


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")
