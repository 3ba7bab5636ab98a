"""Monitor, latest-value and request-reply streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from pvspark.operators.subscriptions import monitor
from pvspark.streaming.outcomes import OUTCOMES, REPLY, REQUEST, first_replies


def monitor_stream(events: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Live events of the subscribed PVs (a static table): stateless, append."""
    return monitor(events, subscriptions)


def latest_stream(events: DataFrame) -> DataFrame:
    """Current value of every PV, in update mode; state is one row per PV."""
    return (
        events.groupBy("pv_name")
        .agg(F.max_by(F.struct("ts", "seq", "value"), F.struct("ts", "seq")).alias("__row"))
        .select("pv_name", "__row.*")
    )


def state_stream(writes: DataFrame) -> DataFrame:
    """Last written value per (pv_name, field), in update mode."""
    return (
        writes.groupBy("pv_name", "field")
        .agg(F.max_by(F.struct("ts", "seq", "value"), F.struct("ts", "seq")).alias("__row"))
        .select("pv_name", "field", "__row.*")
    )


# Groups of requests that share a row of the state.  More of them suit more requests open at once.
REQUEST_GROUPS = 1024


# Frames count nanoseconds in 64 bits, which end soon after this instant (in the year 2255).
FRAMES_END_US = 9 * 10**15


def _waiting(rows: DataFrame, what: int, text: str, number: Column, groups: int) -> DataFrame:
    """Rows as ``outcomes`` keeps them, dealt by the request they belong to, and ``ts`` for the watermark.

    The watermark has passed what is before 1970 from the start.  An instant that frames cannot hold is null in
    ``ts``, which Spark takes as not late.
    """
    at = F.unix_micros("ts")
    in_frames = F.when(at < FRAMES_END_US, F.col("ts")).alias("ts", metadata=rows.schema["ts"].metadata)
    # A request without an id has no reply, so any group will do.
    by = F.when(F.col("reply_id").isNull(), F.xxhash64(text, at)).otherwise(F.xxhash64("reply_id"))
    return rows.where(at > 0).select(
        F.pmod(by, F.lit(groups)).alias("dealt"),
        in_frames,
        F.col("reply_id").cast("string").cast("binary").alias("id"),
        F.col(text).cast("string").cast("binary").alias("text"),
        at.alias("at"),
        F.coalesce(number, F.lit(0)).cast("bigint").alias("number"),
        number.isNotNull().alias("known"),
        F.lit(what).cast("tinyint").alias("what"),
    )


def correlate_stream(
    requests: DataFrame, replies: DataFrame, max_timeout_ms: int, lateness_ms: int = 0, groups: int = REQUEST_GROUPS
) -> DataFrame:
    """Outcome of each live request: ok or error from its first reply, else timeout.

    ``max_timeout_ms`` bounds the state; each row's own ``timeout_ms`` decides, and one
    beyond the bound fails the query rather than being cut to it.  A row appears when the
    watermark of both inputs passes the request's bound.  A request that set no timeout and has
    no reply by then is ``pending``: the batch twin ``correlate`` tells what becomes of it.
    Requests and replies are dealt into ``groups`` by a hash of reply_id, and a group is one state row and one
    call in a micro-batch; a running query keeps its number.
    """
    delay = f"{lateness_ms} milliseconds"
    too_long = F.raise_error(F.concat(F.lit("timeout beyond max_timeout_ms: "), F.col("timeout_ms").cast("string")))
    checked = F.when(F.col("timeout_ms") > max_timeout_ms, too_long.cast("bigint")).otherwise(F.col("timeout_ms"))
    asked, answered = requests.withWatermark("ts", delay), replies.withWatermark("ts", delay)
    # Each input has its own watermark, and the earlier one counts.
    waiting = _waiting(asked, REQUEST, "pv_name", checked, groups).unionByName(
        _waiting(answered.where(F.col("reply_id").isNotNull()), REPLY, "message", F.col("error"), groups)
    )
    first = (
        waiting.groupBy("dealt")
        .applyInPandasWithState(
            first_replies(max_timeout_ms), OUTCOMES, "rows BINARY", "append", GroupStateTimeout.EventTimeTimeout
        )
        .select(
            F.col("id").cast("string").alias("reply_id"),
            F.col("pv_name").cast("string").alias("pv_name"),
            F.timestamp_micros("requested").alias("requested_at"),
            "timeout_ms",
            F.when(
                F.col("replied").isNotNull(),
                F.struct(
                    F.timestamp_micros("replied").alias("replied_at"),
                    F.col("error").cast(replies.schema["error"].dataType).alias("__error"),
                    F.col("message").cast("string").alias("__message"),
                ),
            ).alias("reply"),
        )
    )
    status = (
        F.when(F.col("reply").isNull() & F.col("timeout_ms").isNull(), "pending")
        .when(F.col("reply").isNull(), "timeout")
        .when(F.coalesce(F.col("reply.__error"), F.lit(0)) != 0, "error")
        .otherwise("ok")
    )
    return first.select(
        "reply_id",
        "pv_name",
        "requested_at",
        status.alias("status"),
        F.when(F.col("reply").isNotNull(), F.coalesce("reply.__error", F.lit(0))).alias("error"),
        F.col("reply.__message").alias("message"),
        (F.unix_millis("reply.replied_at") - F.unix_millis("requested_at")).alias("latency_ms"),
    )
