"""Archived logs: events, messages, replay from an instant, PV list files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pvspark import schemas
from pvspark.session import materialise
from pvspark.sizing import checked_broadcast


def read_events(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Archived events in the canonical schema; filters and columns reach the files."""
    return spark.read.schema(schemas.PV_EVENTS).format(fmt).load(path)


def read_messages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Archived messages in the canonical schema (bodies are JSON text)."""
    return spark.read.schema(schemas.MESSAGES).format(fmt).load(path)


def read_pv_list(spark: SparkSession, path: str) -> DataFrame:
    """Addresses from a text file, one per line, trimmed, blank lines dropped."""
    line = F.regexp_replace("value", r"^\s+|\s+$", "")
    return spark.read.text(path).select(line.alias("uri")).where(F.col("uri") != "")


def start_offsets(messages: DataFrame, instant: Column) -> DataFrame:
    """Per topic and partition, the first offset whose time is at or after the instant."""
    return (
        messages.where(F.col("ts") >= instant)
        .groupBy("topic", "partition")
        .agg(F.min("offset").alias("start_offset"))
    )


def replay_from(messages: DataFrame, instant: Column) -> DataFrame:
    """Messages of each partition from its start offset on; none if it has no such offset.

    The starts are one row per partition of the log: computed once, kept in the shared
    folder, and broadcast only when measured small.
    """
    starts = materialise(start_offsets(messages, instant))
    return messages.join(checked_broadcast(starts), ["topic", "partition"]).where(
        F.col("offset") >= F.col("start_offset")
    )
