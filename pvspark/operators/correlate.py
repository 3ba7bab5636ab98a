"""Request-reply correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pvspark.functions.timing import epoch_ms, epoch_us


def outcome_columns(
    requested_at: Column, timeout_ms: Column, replied_at: Column, error: Column
) -> dict[str, Column]:
    """Status and timing of a request from its first reply (null when there is none)."""
    in_time = replied_at.isNotNull() & (
        timeout_ms.isNull()
        | (epoch_us(replied_at) <= epoch_us(requested_at) + timeout_ms * 1000)
    )
    failed = F.coalesce(error, F.lit(0)) != 0
    status = (
        F.when(in_time & failed, "error")
        .when(in_time, "ok")
        .when(timeout_ms.isNull(), "pending")
        .otherwise("timeout")
    )
    return {
        "status": status,
        "error": F.when(in_time, F.coalesce(error, F.lit(0))),
        "latency_ms": F.when(in_time, epoch_ms(replied_at) - epoch_ms(requested_at)),
        "late_reply_ts": F.when(~in_time, replied_at),
    }


def correlate(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """One row per request: ok, error, timeout, or pending when it may wait for ever.

    The first reply at or after the request counts; a reply after the deadline shows as
    ``late_reply_ts``.  The inner join lets skew-join splitting work on either side, and the
    first reply is reduced map-side before requests without one are added back.
    """
    asked = requests.select("reply_id", F.col("ts").alias("requested_at"))
    answered = replies.select("reply_id", F.struct("ts", "error", "message", "value").alias("reply"))
    first = (
        answered.join(asked, "reply_id")
        .where(F.col("reply.ts") >= F.col("requested_at"))
        .groupBy("reply_id", "requested_at")
        .agg(F.min("reply").alias("reply"))
    )
    joined = requests.withColumnRenamed("ts", "requested_at").join(
        first, ["reply_id", "requested_at"], "left"
    )
    outcome = outcome_columns(
        F.col("requested_at"), F.col("timeout_ms"), F.col("reply.ts"), F.col("reply.error")
    )
    answered_in_time = outcome["status"].isin("ok", "error")
    return joined.select(
        "reply_id",
        "pv_name",
        outcome["status"].alias("status"),
        outcome["error"].alias("error"),
        F.when(answered_in_time, F.col("reply.message")).alias("message"),
        F.when(outcome["status"] == "ok", F.col("reply.value")).alias("value"),
        outcome["latency_ms"].alias("latency_ms"),
        outcome["late_reply_ts"].alias("late_reply_ts"),
    )
