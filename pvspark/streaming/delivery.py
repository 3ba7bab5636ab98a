"""Running streams: delivery to user code, append and update tables."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pvspark.session import scratch_path


def deliver_rows(
    stream: DataFrame,
    handler: Callable[[str, Any], None],
    checkpoint: str,
    name: str = "pv_name",
    value: str = "value",
    **trigger: Any,
) -> StreamingQuery:
    """Call ``handler(name, value)`` on the executors for each row.

    At least once: a restarted task repeats its rows.  Order holds only within one key.
    """

    def call(row: Row) -> None:
        handler(row[name], row[value])

    return (
        stream.select(name, value)
        .writeStream.foreach(call)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )


def deliver_batches(
    stream: DataFrame,
    handler: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
    **trigger: Any,
) -> StreamingQuery:
    """Call ``handler(batch, batch_id)`` once per micro-batch; the batch stays distributed."""
    return (
        stream.writeStream.foreachBatch(handler)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()


def run_append(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """Process all available input once into a new table of the shared folder; return it."""
    base = scratch_path(spark, label)
    _finish(
        stream.writeStream.format("parquet")
        .option("path", f"{base}/table")
        .option("checkpointLocation", f"{base}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    return spark.read.schema(stream.schema).parquet(f"{base}/table")


def run_update(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """The same for update mode.  ``batch_id`` tells which of a key's rows is newest.

    A batch overwrites only its own folder, so a repeated batch leaves no second copy.
    """
    base = scratch_path(spark, label)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/table/batch_id={batch_id}")

    _finish(
        deliver_batches(stream, write, f"{base}/checkpoint", "update", availableNow=True)
    )
    return spark.read.parquet(f"{base}/table").withColumn(
        "batch_id", F.col("batch_id").cast("bigint")
    )
