"""A corpus made ready for training: judged, deduplicated, decontaminated, mixed and sharded.

Each stage takes the documents that the one before kept, written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pvspark.llm import decontamination, mixing, quality, sharding, simhash
from pvspark.llm.scratch import read_table, small_batches, written

SHARDS = [f"shard-{k:03d}" for k in range(64)]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labels of these documents."""
    small_batches(spark)
    forest = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, forest)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    The stage follows op8's link rule (SimHash of 3-word shingles, at most 2 of 64 bits differ) instead of
    similarity 0.8 on 5-word shingles.  Most near copies at that similarity stay, each as a document of its
    own; the README has the measured share that is found.
    """
    small_batches(spark)
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without contamination by the benchmark."""
    small_batches(spark)
    return decontamination.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixing.mixed_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their slot and shard."""
    return sharding.assign_shards(docs, SHARDS)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: A trained classifier and SimHash components have no SQL form; tests/llm/test_pipeline.py checks the rows.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
