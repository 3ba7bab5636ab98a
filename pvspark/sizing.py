"""Broadcasts behind a measured size bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def _cell_bytes(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 32
    return F.lit(8)


def fits_broadcast(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """Measure a side with one distributed aggregate; only two numbers reach the driver."""
    width: Column = F.lit(0)
    for field in df.schema.fields:
        width = width + _cell_bytes(field)
    measured = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("bytes"),
    ).first()
    return measured["rows"] <= max_rows and measured["bytes"] <= max_bytes


def checked_broadcast(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Hint a broadcast when ``df`` is measured small, else leave it to a shuffled join.

    The shuffled join is safe for hot keys through adaptive skew-join splitting.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df
