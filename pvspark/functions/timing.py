"""Zone-free epoch arithmetic on TIMESTAMP_NTZ columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def epoch_ms(ts: Column) -> Column:
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), ts)


def epoch_us(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ts)


def floor_div(a: Column, b: Column) -> Column:
    """Exact BIGINT division rounding down, for negative ``a`` too."""
    return F.call_function("div", a - F.pmod(a, b), b)
