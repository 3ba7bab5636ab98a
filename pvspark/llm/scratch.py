"""Intermediate tables in the shared folder, and row identity.

A written table cuts the lineage and survives the loss of any executor.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pvspark.session import scratch_path

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXT_ROWS = 500
NUMBER_ROWS = 20_000


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder (``spark.checkpoint.dir``)."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key() -> Column:
    """128 bits that stand for the text of a row; null and empty texts share one key."""
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))



def small_batches(spark: SparkSession, rows: int = TEXT_ROWS) -> None:
    """Few rows per Arrow batch, as texts can be long; holds for the plans of this session."""
    spark.conf.set(BATCH_ROWS, str(rows))


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Another batch size for what is computed inside: more for numbers, fewer for texts."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)
