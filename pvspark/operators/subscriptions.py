"""Monitors: filtering to subscriptions, new subscriptions, delivery while active."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pvspark.functions.timing import epoch_ms
from pvspark.operators.segments import fitting_width, running_last, segment_of
from pvspark.sizing import checked_broadcast

DAY_MS = 86_400_000


def monitor(events: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Events of the subscribed PVs.  A small subscription list needs no shuffle at all."""
    names = subscriptions.select("pv_name").distinct()
    return events.join(checked_broadcast(names), "pv_name", "left_semi")


def new_subscriptions(requested: DataFrame, active: DataFrame) -> DataFrame:
    """Requested PVs, each once, that are not active yet."""
    return (
        requested.select("pv_name")
        .distinct()
        .join(active.select("pv_name").distinct(), "pv_name", "left_anti")
    )


def _monitor_timeline(
    events: DataFrame, commands: DataFrame, segment_ms: int | None
) -> DataFrame:
    """Events and start/stop commands of each PV with the command in force before each row."""
    rows = events.withColumn("command", F.lit(None).cast("string")).unionByName(
        commands.select("pv_name", "ts", "seq", "command"), allowMissingColumns=True
    )
    at = epoch_ms(F.col("ts"))
    width = segment_ms or fitting_width(rows, ["pv_name"], at, DAY_MS)
    rows = rows.withColumn("__segment", segment_of(at, width))
    return running_last(
        rows,
        keys=["pv_name"],
        segment="__segment",
        order=["ts", "seq"],
        state="command",
        out="active_command",
        inclusive=False,
    ).drop("__segment")


def deliver_while_active(
    events: DataFrame, commands: DataFrame, segment_ms: int | None = None
) -> DataFrame:
    """Events that arrive, in (ts, seq) order, while their PV's monitor is started.

    ``commands`` has pv_name, ts, seq and command (``start`` or ``stop``).  The width of a
    time segment is measured unless ``segment_ms`` gives it.
    """
    timeline = _monitor_timeline(events, commands, segment_ms)
    return timeline.where(
        F.col("command").isNull() & (F.col("active_command") == "start")
    ).select(*events.columns)


def command_outcomes(commands: DataFrame, segment_ms: int | None = None) -> DataFrame:
    """Each command with its effect: started, already_active, stopped or orphan_stop."""
    no_events = commands.select("pv_name", "ts", "seq").where(F.lit(False))
    timeline = _monitor_timeline(no_events, commands, segment_ms)
    was_active = F.coalesce(F.col("active_command") == "start", F.lit(False))
    outcome = (
        F.when((F.col("command") == "start") & was_active, "already_active")
        .when(F.col("command") == "start", "started")
        .when(was_active, "stopped")
        .otherwise("orphan_stop")
    )
    return timeline.select("pv_name", "ts", "seq", "command", outcome.alias("outcome"))
