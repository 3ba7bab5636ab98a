"""Recurring windowed snapshots: normal, buffered, sub-push, repeat delay, completion.

Members (one row per snapshot and PV, with the window parameters) come from
``specs.snapshot_members``.  An event belongs to the half-open window
``[header_timestamp, tail_timestamp)`` of one iteration, or to the gap after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pvspark.functions import windows
from pvspark.operators.segments import LIST_VALUES, ordered_lists, running_last, segment_of
from pvspark.sizing import checked_broadcast

DAY_MS = 86_400_000
# Iterations of one PV that one task carries values through.
CARRY_ITERATIONS = 100_000
_BLOCK = 4096
# Spine entries one task makes and groups.
SPINE_ROWS = 500_000
_KEY = ["snapshot_name", "iteration", "pv_name"]


def _period() -> Column:
    return windows.period_of(F.col("time_window"), F.col("repeat_delay"))


def assign_iterations(
    events: DataFrame, members: DataFrame, origin_ms: int, include_gap: bool = False
) -> DataFrame:
    """Events of listed PVs with ``iteration`` and ``push_index``; gap events are left out."""
    origin = F.lit(origin_ms).cast("bigint")
    period = _period()
    position = windows.position_in_period(F.col("ts_ms"), origin, period)
    placed = (
        events.where(F.col("ts_ms") >= origin_ms)
        .join(checked_broadcast(members), "pv_name")
        .withColumns(
            {
                "iteration": windows.iteration_of(F.col("ts_ms"), origin, period),
                "push_index": windows.push_index_of(position, F.col("sub_push_delay_msec")),
                "in_gap": position >= F.col("time_window"),
            }
        )
    )
    return placed if include_gap else placed.where(~F.col("in_gap"))


def iteration_spine(members: DataFrame, events: DataFrame, origin_ms: int) -> DataFrame:
    """Every (snapshot, iteration, listed PV) up to the iteration of the log's last event.

    The last instant is one number.  Iterations are generated in two steps, blocks first, so that an array
    does not grow with the length of the log.  Blocks are few bytes but many rows, so adaptive execution
    would put them all into one task: the number of tasks follows from the number of entries.
    """
    origin = F.lit(origin_ms).cast("bigint")
    last_ms = F.lit(events.agg(F.max("ts_ms")).first()[0]).cast("bigint")
    listed = members.withColumn("last_iteration", windows.iteration_of(last_ms, origin, _period())).where(
        F.col("last_iteration") > 0
    )
    entries = listed.agg(F.sum("last_iteration")).first()[0] or 0
    tasks = max(members.sparkSession.sparkContext.defaultParallelism, -(-entries // SPINE_ROWS))
    blocks = listed.withColumn(
        "block",
        F.explode(
            F.sequence(
                F.lit(0).cast("bigint"),
                F.call_function("div", F.col("last_iteration") - 1, F.lit(_BLOCK)),
            )
        ),
    ).repartition(tasks, "snapshot_name", "pv_name", "block")
    start = F.col("block") * _BLOCK + 1
    stop = F.least(start + (_BLOCK - 1), F.col("last_iteration"))
    return blocks.withColumn("iteration", F.explode(F.sequence(start, stop))).drop(
        "block", "last_iteration"
    )


def with_timestamps(iterations: DataFrame, origin_ms: int) -> DataFrame:
    """Replace the window parameters by header, tail and snapshot timestamps."""
    header = windows.header_timestamp(
        F.col("iteration"), F.lit(origin_ms).cast("bigint"), _period()
    )
    tail = header + F.col("time_window")
    return iterations.withColumns(
        {"header_timestamp": header, "tail_timestamp": tail, "timestamp": tail}
    ).drop("time_window", "repeat_delay", "sub_push_delay_msec")


def _values_and_spine(
    events: DataFrame, members: DataFrame, origin_ms: int, complete: bool
) -> DataFrame:
    """Windowed events, plus (for completion) one row without ``seq`` per spine entry.

    Grouping this union completes the PV list in the same shuffle that aggregates it.
    """
    params = ["time_window", "repeat_delay", "sub_push_delay_msec"]
    values = assign_iterations(events, members, origin_ms).select(
        *_KEY, *params, "push_index", "ts", "ts_ms", "seq", "value"
    )
    if not complete:
        return values
    spine = iteration_spine(members, events, origin_ms).select(*_KEY, *params)
    return values.unionByName(spine, allowMissingColumns=True)


def _group_key() -> list[str]:
    return [*_KEY, "time_window", "repeat_delay", "sub_push_delay_msec"]


def recurring_normal(
    events: DataFrame,
    members: DataFrame,
    origin_ms: int,
    complete: bool = True,
    carry_forward: bool = False,
) -> DataFrame:
    """Last value per PV per window, with its ``value_seq``; both are null where there is none.

    ``carry_forward`` repeats the PV's last known value through windows without data; the
    rows it orders are one per PV and iteration, whatever the event rate, and are cut into segments
    of iterations, so a PV with very many of them is many tasks.
    """
    happened = F.when(F.col("seq").isNotNull(), F.struct("ts", "seq"))
    result = (
        _values_and_spine(events, members, origin_ms, complete)
        .groupBy(*_group_key())
        .agg(
            F.max_by("value", happened).alias("value"),
            F.max_by("seq", happened).alias("value_seq"),
            F.count("seq").alias("n_events"),
        )
    )
    if carry_forward:
        in_segments = result.withColumn("__segment", segment_of(F.col("iteration"), CARRY_ITERATIONS))
        result = running_last(
            in_segments, ["snapshot_name", "pv_name"], "__segment", ["iteration"], "value", "__carried_value"
        ).withColumn("value", F.col("__carried_value")).drop("__segment", "__carried_value")
    return with_timestamps(result, origin_ms)


def _silent(events: DataFrame, members: DataFrame, origin_ms: int) -> DataFrame:
    """Spine entries without an event."""
    return (
        _values_and_spine(events, members, origin_ms, True)
        .groupBy(*_group_key())
        .agg(F.count("seq").alias("__n"))
        .where(F.col("__n") == 0)
        .drop("__n")
    )


def recurring_buffered(
    events: DataFrame, members: DataFrame, origin_ms: int, complete: bool = True
) -> DataFrame:
    """All values per PV per window, one row per value; order is (ts, seq).

    The values never shuffle, so the size of a window or the heat of a PV does not matter.
    With ``complete``, a listed PV without data has one row whose ``seq`` is null.
    """
    values = assign_iterations(events, members, origin_ms)
    columns = [*_group_key(), "push_index", "ts", "seq", "value"]
    rows = values.select(*columns)
    if complete:
        rows = rows.unionByName(_silent(events, members, origin_ms), allowMissingColumns=True)
    return with_timestamps(rows, origin_ms)


def _value_lists(rows: DataFrame, keys: list[str], max_values: int) -> DataFrame:
    lists = ordered_lists(
        rows, keys, F.col("ts_ms"), DAY_MS, ["ts", "seq"], ["value"], "__items", max_values
    )
    return lists.withColumn("values", F.transform("__items", lambda item: item["value"])).drop(
        "__items"
    )


def buffered_lists(
    events: DataFrame,
    members: DataFrame,
    origin_ms: int,
    complete: bool = True,
    max_values: int = LIST_VALUES,
) -> DataFrame:
    """All values per PV per window as ordered lists; a list over ``max_values`` in parts.

    With ``complete``, a listed PV without data has one empty list.
    """
    rows = _values_and_spine(events, members, origin_ms, False)
    lists = _value_lists(rows, _group_key(), max_values)
    if complete:
        empty = _silent(events, members, origin_ms).withColumns(
            {
                "part": F.lit(0).cast("bigint"),
                "first_position": F.lit(0).cast("bigint"),
                "values": F.array().cast("array<double>"),
            }
        )
        lists = lists.unionByName(empty)
    return with_timestamps(lists, origin_ms)


def sub_push_summary(events: DataFrame, members: DataFrame, origin_ms: int) -> DataFrame:
    """Per partial push: how many values it holds and its first and last value."""
    order = F.struct("ts", "seq")
    grouped = (
        _values_and_spine(events, members, origin_ms, False)
        .groupBy(*_group_key(), "push_index")
        .agg(
            F.count(F.lit(1)).alias("n_values"),
            F.min_by("value", order).alias("first_value"),
            F.max_by("value", order).alias("last_value"),
        )
    )
    return with_timestamps(grouped, origin_ms)


def sub_push_batches(
    events: DataFrame, members: DataFrame, origin_ms: int, max_values: int = LIST_VALUES
) -> DataFrame:
    """Partial pushes: the ordered values of each sub-interval, over ``max_values`` in parts."""
    rows = _values_and_spine(events, members, origin_ms, False)
    return with_timestamps(
        _value_lists(rows, [*_group_key(), "push_index"], max_values), origin_ms
    )


def merge_pushes(batches: DataFrame) -> DataFrame:
    """The final result of a window: its pushes concatenated in order, one row per value.

    Positions come from the sizes of the earlier parts of pushes (a few numbers per window), so the
    lists are never brought together in one cell.
    """
    earlier = (
        Window.partitionBy(*_KEY)
        .orderBy("push_index", "part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum(F.size("values")).over(earlier), F.lit(0))
    stamps = ["header_timestamp", "tail_timestamp", "timestamp"]
    # The window goes in a step of its own: next to a generator it would see exploded rows.
    placed = batches.withColumn("__before", before)
    return placed.select(
        *_KEY, *stamps, "__before", F.posexplode("values").alias("__pos", "value")
    ).select(*_KEY, *stamps, (F.col("__before") + F.col("__pos")).alias("pos"), "value")


def complete_pv_counts(events: DataFrame, members: DataFrame, origin_ms: int) -> DataFrame:
    """Every listed PV of every iteration with its number of values (0 when silent)."""
    grouped = (
        _values_and_spine(events, members, origin_ms, True)
        .groupBy(*_group_key())
        .agg(F.count("seq").alias("n_values"))
    )
    return with_timestamps(grouped, origin_ms)


def snapshot_counters(events: DataFrame, members: DataFrame, origin_ms: int) -> DataFrame:
    """Per iteration: PVs listed, PVs with data, values.  Counts per PV are reduced first."""
    return (
        complete_pv_counts(events, members, origin_ms)
        .groupBy("snapshot_name", "iteration", "header_timestamp", "tail_timestamp")
        .agg(
            F.count(F.lit(1)).alias("n_listed"),
            F.count_if(F.col("n_values") > 0).alias("n_pvs"),
            F.sum("n_values").alias("n_values"),
        )
    )
