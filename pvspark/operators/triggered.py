"""Manually triggered snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pvspark.functions.timing import epoch_ms, epoch_us, floor_div
from pvspark.operators.segments import fitting_width, running_last, running_number, segment_of
from pvspark.operators.subscriptions import DAY_MS, monitor
from pvspark.session import materialise
from pvspark.sizing import checked_broadcast


def _in_segments(df: DataFrame, keys: list[str], segment_ms: int | None) -> DataFrame:
    """Add ``__segment`` along ``ts``; its width is measured unless given."""
    at = epoch_ms(F.col("ts"))
    width = segment_ms or fitting_width(df, keys, at, DAY_MS)
    return df.withColumn("__segment", segment_of(at, width))


def number_triggers(triggers: DataFrame, segment_ms: int | None = None) -> DataFrame:
    """Add ``iteration``: the rank of the trigger within its snapshot, from 1."""
    placed = _in_segments(triggers, ["snapshot_name"], segment_ms)
    return running_number(
        placed, ["snapshot_name"], "__segment", ["ts", "trigger_id"], "iteration"
    ).drop("__segment")


def triggers_while_started(commands: DataFrame, segment_ms: int | None = None) -> DataFrame:
    """Triggers of started snapshots, with the start they belong to.

    ``commands`` has snapshot_name, command (start, trigger, stop), trigger_id and ts.  A
    start always begins afresh; ``iteration`` counts the triggers since it.
    """
    turns = F.when(
        F.col("command").isin("start", "stop"), F.struct("command", F.col("ts").alias("since"))
    )
    placed = _in_segments(commands, ["snapshot_name"], segment_ms).withColumn("__turn", turns)
    followed = running_last(
        placed, ["snapshot_name"], "__segment", ["ts", "trigger_id"], "__turn", "__state"
    )
    started = followed.where(
        (F.col("command") == "trigger") & (F.col("__state.command") == "start")
    ).select("snapshot_name", "trigger_id", "ts", F.col("__state.since").alias("since"), "__segment")
    return running_number(
        started, ["snapshot_name", "since"], "__segment", ["ts", "trigger_id"], "iteration"
    ).drop("__segment")


def triggered_life_cycle(
    commands: DataFrame, members: DataFrame, events: DataFrame, segment_ms: int | None = None
) -> DataFrame:
    """Triggered snapshots between start and stop; values from before the start are gone.

    An event at the instant of the start precedes it, as it does at a trigger.
    """
    numbered = triggers_while_started(commands, segment_ms)
    rows = _last_values(numbered, members, events, segment_ms)
    kept = F.col("value_ts") > F.col("since")
    return rows.withColumns(
        {
            "value": F.when(kept, F.col("value")),
            "value_seq": F.when(kept, F.col("value_seq")),
        }
    ).drop("since", "value_ts")


def triggered_normal(
    triggers: DataFrame, members: DataFrame, events: DataFrame, segment_ms: int | None = None
) -> DataFrame:
    """Per trigger and listed PV, the last value at or before the trigger (null if none).

    An as-of join without trigger-event pairs: triggers and events of a PV share one time
    line, cut into segments, along which the last value runs forward.
    """
    rows = _last_values(number_triggers(triggers, segment_ms), members, events, segment_ms)
    return rows.drop("value_ts")


def _last_values(
    numbered: DataFrame, members: DataFrame, events: DataFrame, segment_ms: int | None
) -> DataFrame:
    listed = checked_broadcast(members.select("snapshot_name", "pv_name"))
    # The timeline below is read several times; triggers are few, so number them once.
    asked = materialise(numbered).join(listed, "snapshot_name").withColumn("__asks", F.lit(1))
    seen = monitor(events, members).select(
        "pv_name",
        "ts",
        "seq",
        F.lit(0).alias("__asks"),
        F.struct("value", "seq", F.col("ts").alias("at")).alias("__seen"),
    )
    line = _in_segments(
        seen.unionByName(asked, allowMissingColumns=True), ["pv_name"], segment_ms
    )
    filled = running_last(
        line, ["pv_name"], "__segment", ["ts", "__asks", "seq"], "__seen", "__last"
    )
    kept = [name for name in asked.columns if name not in ("ts", "__asks")]
    return filled.where(F.col("__asks") == 1).select(
        *kept,
        F.col("ts").alias("trigger_ts"),
        F.col("__last.value").alias("value"),
        F.col("__last.seq").alias("value_seq"),
        F.col("__last.at").alias("value_ts"),
    )


def triggered_buffered(
    triggers: DataFrame, members: DataFrame, events: DataFrame, segment_ms: int | None = None
) -> DataFrame:
    """Per trigger and listed PV, all values in ``(trigger - time_window, trigger]``.

    One row per value, ordered by (ts, seq); a listed PV without a value has one row whose ``seq``
    is null.  Both sides carry a time bucket as wide as the
    window, so the equi-join reads at most two buckets per trigger before the exact range.
    """
    window_us = F.col("time_window") * 1000
    listed = members.select("snapshot_name", "pv_name", "time_window").where(
        F.col("time_window") > 0
    )
    numbered = materialise(number_triggers(triggers, segment_ms))
    asked = (
        numbered.join(checked_broadcast(listed), "snapshot_name")
        .withColumn("__at", epoch_us(F.col("ts")))
        .select(
            "snapshot_name",
            "trigger_id",
            "iteration",
            "pv_name",
            F.col("ts").alias("trigger_ts"),
            "__at",
            F.explode(
                F.sequence(
                    floor_div(F.col("__at") - window_us + 1, window_us),
                    floor_div(F.col("__at"), window_us),
                )
            ).alias("__bucket"),
        )
    )
    seen = (
        events.select("pv_name", "ts", "seq", "value")
        .join(checked_broadcast(listed), "pv_name")
        .withColumn("__seen_at", epoch_us(F.col("ts")))
        .withColumn("__bucket", floor_div(F.col("__seen_at"), window_us))
    )
    in_window = (F.col("__seen_at") <= F.col("__at")) & (
        F.col("__seen_at") > F.col("__at") - window_us
    )
    entry = ["snapshot_name", "trigger_id", "iteration", "pv_name", "trigger_ts"]
    values = (
        asked.join(seen, ["snapshot_name", "pv_name", "__bucket"])
        .where(in_window)
        .select(*entry, "ts", "seq", "value")
    )
    # Entries and values are counted in one grouping: those that have no value are silent.
    every = numbered.join(checked_broadcast(members.select("snapshot_name", "pv_name")), "snapshot_name").select(
        *[F.col("ts").alias(name) if name == "trigger_ts" else F.col(name) for name in entry]
    )
    silent = (
        every.withColumn("__n", F.lit(0))
        .unionByName(values.select(*entry).withColumn("__n", F.lit(1)))
        .groupBy(*entry)
        .agg(F.max("__n").alias("__n"))
        .where(F.col("__n") == 0)
        .drop("__n")
    )
    return values.unionByName(silent, allowMissingColumns=True)
