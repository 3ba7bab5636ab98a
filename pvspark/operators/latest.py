"""Latest value, snapshot at an instant, last-write-wins state.

All three are one ``max_by`` per key: partial aggregation reduces a hot key map-side, so
no task ever sees more than one candidate row per key and input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pvspark.sizing import checked_broadcast


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The ``keep`` columns of the row with the greatest ``order`` per key."""
    picked = F.max_by(F.struct(*keep), F.struct(*order))
    return df.groupBy(*keys).agg(picked.alias("__row")).select(*keys, "__row.*")


def latest_values(events: DataFrame) -> DataFrame:
    """Current value of every PV."""
    return newest(events, ["pv_name"], ["ts", "seq"], ["ts", "seq", "value"])


def bulk_get(requests: DataFrame, events: DataFrame) -> DataFrame:
    """Current value for each requested PV; an unknown PV is an error row, not an empty one."""
    return requests.join(latest_values(events), "pv_name", "left").withColumn(
        "status", F.when(F.col("seq").isNull(), "not_found").otherwise("ok")
    )


def snapshot_at(events: DataFrame, pv_list: DataFrame, instant: Column) -> DataFrame:
    """Value of each listed PV at one instant, from the last event at or before it."""
    names = checked_broadcast(pv_list.select("pv_name").distinct())
    past = events.where(F.col("ts") <= instant).join(names, "pv_name", "left_semi")
    return latest_values(past).withColumn("error", F.lit(0))


def put_state(writes: DataFrame) -> DataFrame:
    """State after all writes: the last value per (pv_name, field)."""
    return newest(writes, ["pv_name", "field"], ["ts", "seq"], ["ts", "seq", "value"])


def put_state_wide(writes: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The same state with one column per named field."""
    last = [
        F.max_by("value", F.when(F.col("field") == name, F.struct("ts", "seq"))).alias(name)
        for name in fields
    ]
    return writes.where(F.col("field").isin(*fields)).groupBy("pv_name").agg(*last)
