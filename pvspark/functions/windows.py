"""Recurring-window arithmetic: window, gap, sub-push, all on epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def period_of(time_window: Column, repeat_delay: Column) -> Column:
    period = time_window + repeat_delay
    return F.when(period > 0, period).otherwise(
        F.raise_error(F.lit("time_window + repeat_delay must be positive")).cast("bigint")
    )


def iteration_of(ts_ms: Column, origin_ms: Column, period: Column) -> Column:
    """1-based number of the window-plus-gap period an instant falls in."""
    return _div(ts_ms - origin_ms, period) + 1


def position_in_period(ts_ms: Column, origin_ms: Column, period: Column) -> Column:
    return (ts_ms - origin_ms) % period


def push_index_of(position: Column, sub_push: Column) -> Column:
    """Number of the partial push inside the window; 0 when sub-push is off."""
    return F.when(sub_push > 0, _div(position, sub_push)).otherwise(F.lit(0).cast("bigint"))


def header_timestamp(iteration: Column, origin_ms: Column, period: Column) -> Column:
    return origin_ms + (iteration - 1) * period
