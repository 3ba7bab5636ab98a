"""Recurring snapshots on a live event stream.

Streams use event time: a window is emitted once, when the watermark passes its end.
Windows without any event never fire by themselves; the batch twins fill them in.
One call serves the snapshots that share window parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pvspark.functions import windows
from pvspark.operators.snapshots import assign_iterations, with_timestamps
from pvspark.operators.specs import NORMAL, TIMED_BUFFERED
from pvspark.sizing import checked_broadcast


def _listed(events: DataFrame, members: DataFrame) -> DataFrame:
    names = members.select("snapshot_name", "pv_name")
    return events.join(checked_broadcast(names), "pv_name")


def _bigint(value: int) -> Column:
    return F.lit(value).cast("bigint")


def recurring_stream(
    events: DataFrame,
    members: DataFrame,
    origin_ms: int,
    time_window: int,
    repeat_delay: int = 0,
    kind: str = NORMAL,
    lateness_ms: int = 0,
) -> DataFrame:
    """Last value (normal) or all values (timed buffered) per listed PV per window.

    The gap is filtered out first, so a period-long tumbling window holds one window's
    events and its start is the header timestamp.
    """
    if kind not in (NORMAL, TIMED_BUFFERED):
        raise ValueError(f"unknown snapshot type {kind!r}")
    period = time_window + repeat_delay
    if period <= 0:
        raise ValueError("time_window + repeat_delay must be positive")
    at = F.unix_millis("ts")
    kept = events.where(
        (at >= origin_ms)
        & (windows.position_in_period(at, _bigint(origin_ms), _bigint(period)) < time_window)
    )
    span = f"{period} milliseconds"
    window = F.window("ts", span, span, f"{origin_ms % period} milliseconds")
    order = F.struct("ts", "seq")
    if kind == NORMAL:
        result = F.max_by("value", order).alias("value")
    else:
        result = F.sort_array(F.collect_list(F.struct("ts", "seq", "value"))).alias("__items")
    grouped = (
        _listed(kept.withWatermark("ts", f"{lateness_ms} milliseconds"), members)
        .groupBy("snapshot_name", window, "pv_name")
        .agg(result, F.count(F.lit(1)).alias("n_events"))
    )
    if kind == TIMED_BUFFERED:
        grouped = grouped.withColumn(
            "values", F.transform("__items", lambda item: item["value"])
        ).drop("__items")
    header = F.unix_millis(F.col("window.start"))
    return grouped.select(
        "snapshot_name",
        windows.iteration_of(header, _bigint(origin_ms), _bigint(period)).alias("iteration"),
        "pv_name",
        header.alias("header_timestamp"),
        (header + time_window).alias("tail_timestamp"),
        (header + time_window).alias("timestamp"),
        *[name for name in grouped.columns if name not in ("snapshot_name", "window", "pv_name")],
    )


def recurring_members_stream(
    events: DataFrame, members: DataFrame, origin_ms: int, lateness_ms: int = 0
) -> DataFrame:
    """Last value per listed PV per window of its own member, so snapshots with any windows and gaps share a stream.

    The end of an event's window is computed per member and is the event-time column.  A window may end
    as far ahead of its events as the longest of the members is, so the watermark allows for that and the
    lateness: an event in time is never dropped, and a window is emitted at most that much later.
    """
    longest = members.agg(F.coalesce(F.max("time_window"), _bigint(0)).alias("longest")).first()["longest"]
    placed = with_timestamps(assign_iterations(events, members, origin_ms), origin_ms)
    order = F.struct("ts", "seq")
    return (
        placed.withColumn("window_end", F.timestamp_millis("tail_timestamp"))
        .withWatermark("window_end", f"{lateness_ms + longest} milliseconds")
        .groupBy("snapshot_name", "iteration", "pv_name", "header_timestamp", "tail_timestamp", "window_end")
        .agg(
            F.max_by("value", order).alias("value"),
            F.max_by("seq", order).alias("value_seq"),
            F.count(F.lit(1)).alias("n_events"),
        )
        .withColumn("timestamp", F.col("tail_timestamp"))
        .drop("window_end")
    )


def sub_push_stream(
    events: DataFrame,
    members: DataFrame,
    origin_ms: int,
    time_window: int,
    sub_push: int,
    repeat_delay: int = 0,
    lateness_ms: int = 0,
) -> DataFrame:
    """Partial pushes, each emitted when its own end passes, long before the window's.

    A push ends at a computed instant (the last one of a window may be short), which is
    the event-time column here; its watermark allows for the length of a push.
    """
    if sub_push <= 0:
        raise ValueError("sub_push must be positive")
    period = _bigint(time_window + repeat_delay)
    origin = _bigint(origin_ms)
    at = F.unix_millis("ts")
    position = windows.position_in_period(at, origin, period)
    header = windows.header_timestamp(F.col("iteration"), origin, period)
    push_end = F.least(header + (F.col("push_index") + 1) * sub_push, header + time_window)
    pushes = (
        events.where((at >= origin_ms) & (position < time_window))
        .withColumns(
            {
                "iteration": windows.iteration_of(at, origin, period),
                "push_index": windows.push_index_of(position, _bigint(sub_push)),
            }
        )
        .withColumn("push_end", F.timestamp_millis(push_end))
        .withWatermark("push_end", f"{lateness_ms + sub_push} milliseconds")
    )
    items = F.sort_array(F.collect_list(F.struct("ts", "seq", "value")))
    return (
        _listed(pushes, members)
        .groupBy("snapshot_name", "iteration", "push_index", "push_end", "pv_name")
        .agg(items.alias("__items"))
        .select(
            "snapshot_name",
            "iteration",
            "push_index",
            "pv_name",
            F.unix_millis("push_end").alias("push_end_ms"),
            F.transform("__items", lambda item: item["value"]).alias("values"),
        )
    )


def buffered_stream(events: DataFrame, members: DataFrame, origin_ms: int) -> DataFrame:
    """All values per listed PV per window, one row per value, as they arrive.

    Stateless: a window is placed by arithmetic alone, so nothing is held back and no PV is
    too hot.  Partition the sink by iteration, or wait for the watermark downstream, where
    a closed window is wanted.
    """
    placed = assign_iterations(events, members, origin_ms)
    return with_timestamps(placed, origin_ms).drop("in_gap")


def traffic_stream(
    messages: DataFrame, bucket_ms: int, keys: Sequence[str] = ("topic",), lateness_ms: int = 0
) -> DataFrame:
    """Messages and body bytes per key and time bucket of a live log, once a bucket closes."""
    size = F.octet_length("value").cast("bigint")
    return (
        messages.withWatermark("ts", f"{lateness_ms} milliseconds")
        .groupBy(*keys, F.window("ts", f"{bucket_ms} milliseconds"))
        .agg(
            F.count(F.lit(1)).alias("n_messages"),
            F.sum(size).alias("n_bytes"),
            F.max(size).alias("max_bytes"),
        )
        .select(
            *keys,
            F.unix_millis("window.start").alias("bucket_start_ms"),
            "n_messages",
            "n_bytes",
            "max_bytes",
        )
    )
