"""Live message and event streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pvspark import schemas

# --- fixed values: header that names the body's codec ------------------------------
SER_TYPE_HEADER_SUFFIX = "-ser-type"
# -----------------------------------------------------------------------------------


def ser_type_of(headers: Column) -> Column:
    """Codec named by the first matching header; null when there is none."""
    matching = F.filter(headers, lambda header: header["key"].endswith(SER_TYPE_HEADER_SUFFIX))
    return F.get(matching, F.lit(0))["value"].cast("string")


def from_kafka_rows(rows: DataFrame) -> DataFrame:
    """Connector rows (read with headers) as canonical messages."""
    return rows.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("ts"),
        ser_type_of(F.col("headers")).alias("ser_type"),
        F.col("value").cast("string").alias("value"),
    )


def live_messages(
    spark: SparkSession, servers: str, topics: list[str], since_ms: int | None = None, **options: str
) -> DataFrame:
    """Messages of the topics from their end on, or from an instant if one is given.

    Partitions without a message at or after the instant start at their end.  Needs the
    Kafka connector on the session's class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("includeHeaders", "true")
    )
    if since_ms is None:
        reader = reader.option("startingOffsets", "latest")
    else:
        reader = reader.option("startingTimestamp", str(since_ms)).option(
            "startingOffsetsByTimestampStrategy", "latest"
        )
    return from_kafka_rows(reader.options(**options).load())


def file_stream(
    spark: SparkSession, folder: str, schema, fmt: str = "parquet", pattern: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Files of a folder as a stream, in order of arrival."""
    reader = spark.readStream.schema(schema).format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def event_stream(spark: SparkSession, folder: str, fmt: str = "parquet", **options) -> DataFrame:
    """Archived events replayed as a stream; ``ts`` becomes an event-time TIMESTAMP."""
    stream = file_stream(spark, folder, schemas.PV_EVENTS, fmt, **options)
    return as_event_time(stream)


def as_event_time(stream: DataFrame, column: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP; the session zone is UTC, so the instant is unchanged."""
    return stream.withColumn(column, F.col(column).cast("timestamp"))
