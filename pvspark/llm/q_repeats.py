"""op2: repeated strings of 400 bytes removed from all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pvspark.llm import repeats
from pvspark.llm.scratch import read_table, small_batches


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    kept = repeats.remove_repeats(read_table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
