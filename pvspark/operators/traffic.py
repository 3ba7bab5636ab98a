"""Traffic report over the message log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from pvspark.functions.timing import epoch_ms, floor_div


def traffic_report(
    messages: DataFrame,
    bucket_ms: int,
    keys: Sequence[str] = ("topic",),
    body: str = "value",
) -> DataFrame:
    """Messages and body bytes per key and time bucket."""
    size = F.octet_length(F.col(body)).cast("bigint")
    start = floor_div(epoch_ms(F.col("ts")), F.lit(bucket_ms).cast("bigint")) * bucket_ms
    return (
        messages.select(*keys, start.alias("bucket_start_ms"), size.alias("message_size"))
        .groupBy(*keys, "bucket_start_ms")
        .agg(
            F.count(F.lit(1)).alias("n_messages"),
            F.sum("message_size").alias("n_bytes"),
            F.max("message_size").alias("max_bytes"),
        )
    )
