"""Running values along an ordered key, split so that a hot key is many tasks.

A plain window over the key would put all rows of a hot PV or topic into one task.
Here the key's order axis is cut into segments.  One map-side-combined aggregate gives
each (key, segment) its summary, a window over those few summaries gives the value carried
into each segment, and the carried value joins the data as one extra first row.  The rows
themselves shuffle once, by (key, segment).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pvspark.functions.timing import floor_div

_CARRIED = "__carried"


def segment_of(position: Column, width: int) -> Column:
    return floor_div(position, F.lit(width).cast("bigint"))


# Rows one task sorts at most for one key.
SEGMENT_ROWS = 2_000_000
# Values one list cell holds at most; longer lists come in parts.
LIST_VALUES = 100_000


def fitting_width(
    df: DataFrame,
    keys: Sequence[str],
    position: Column,
    widest: int,
    max_rows: int = SEGMENT_ROWS,
) -> int:
    """The segment width at which the busiest key has at most about ``max_rows`` per segment.

    Counts per key and widest segment are one map-side-combined aggregate over two columns;
    only the largest count reaches the driver.  The width only decides how work is split,
    never the result.
    """
    busiest = (
        df.groupBy(*keys, segment_of(position, widest).alias("__segment"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .agg(F.max("__n").alias("n"))
        .first()["n"]
    )
    return max(1, widest // max(1, -(-(busiest or 0) // max_rows)))


def _with_carry_rows(df: DataFrame, carry: DataFrame) -> DataFrame:
    marked = df.withColumn(_CARRIED, F.lit(False))
    return marked.unionByName(
        carry.withColumn(_CARRIED, F.lit(True)), allowMissingColumns=True
    )


def running_last(
    df: DataFrame,
    keys: Sequence[str],
    segment: str,
    order: Sequence[str],
    state: str,
    out: str,
    inclusive: bool = True,
) -> DataFrame:
    """Add ``out``: the last non-null ``state`` at or before each row (before, if not inclusive).

    ``order`` must be a total order within ``keys`` and agree with ``segment``.
    """
    group = [*keys, segment]
    has_state = F.col(state).isNotNull()
    latest = df.groupBy(*group).agg(
        F.max_by(F.when(has_state, F.col(state)), F.when(has_state, F.struct(*order))).alias(state)
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(segment)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = latest.withColumn(state, F.last(state, ignorenulls=True).over(earlier)).where(
        F.col(state).isNotNull()
    )
    upto = (
        Window.partitionBy(*group)
        .orderBy(F.col(_CARRIED).desc(), *order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    return (
        _with_carry_rows(df, carry)
        .withColumn(out, F.last(state, ignorenulls=True).over(upto))
        .where(~F.col(_CARRIED))
        .drop(_CARRIED)
    )


def running_number(
    df: DataFrame, keys: Sequence[str], segment: str, order: Sequence[str], out: str
) -> DataFrame:
    """Add ``out``: the 1-based rank of each row within ``keys`` along ``order``."""
    group = [*keys, segment]
    weight = "__weight"
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias(weight))
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(segment)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = counts.withColumn(weight, F.sum(weight).over(earlier)).where(
        F.col(weight).isNotNull()
    )
    upto = (
        Window.partitionBy(*group)
        .orderBy(F.col(_CARRIED).desc(), *order)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        _with_carry_rows(df.withColumn(weight, F.lit(1).cast("bigint")), carry)
        .withColumn(out, F.sum(weight).over(upto))
        .where(~F.col(_CARRIED))
        .drop(_CARRIED, weight)
    )


def ordered_lists(
    df: DataFrame,
    keys: Sequence[str],
    position: Column,
    widest: int,
    order: Sequence[str],
    values: Sequence[str],
    out: str,
    max_values: int = LIST_VALUES,
) -> DataFrame:
    """The rows of each key as lists of structs, ordered by ``order``, in numbered parts.

    Every result has ``part`` (from 0) and ``first_position``, the place within the key of the
    part's first row.  No list is longer than ``max_values``, so a key with more rows has
    several, whose concatenation is the whole; the form is the same for every size.  Rows are
    numbered along segments, so that neither a task nor a cell grows with the size of a key.
    ``position`` is the order's BIGINT axis and ``widest`` the segment width to start from.
    """
    width = fitting_width(df, keys, position, widest)
    bound = F.lit(max_values).cast("bigint")
    numbered = running_number(
        df.withColumn("__segment", segment_of(position, width)), keys, "__segment", order, "__number"
    ).withColumn("part", floor_div(F.col("__number") - 1, bound))
    rest = [name for name in values if name not in order]
    lists = numbered.groupBy(*keys, "part").agg(
        F.sort_array(F.collect_list(F.struct(*order, *rest))).alias(out)
    )
    return lists.withColumn("first_position", F.col("part") * bound)
