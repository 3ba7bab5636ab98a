"""Demultiplexing of the message log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from pvspark.sizing import checked_broadcast

# --- fixed values: envelope keys and the codec this log is stored in ---------------
REPLY_ID = "reply_id"
SNAPSHOT_NAME = "snapshot_name"
MESSAGE_TYPE = "message_type"
LOG_CODEC = "json"
# -----------------------------------------------------------------------------------

ROUTES = ("reply", "monitor", "snapshot", "recurring")
_NULL_KEY_SPREAD = 1024


def _from_body(messages: DataFrame, fields: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Add columns computed from the body, a map from key to text in message order.

    Going through a one-element array makes the parsed map a bound value of a generator: the
    body is parsed once, however many columns and later filters use it.
    """
    parsed = F.array(F.from_json("value", "map<string,string>"))
    rows = F.transform(
        parsed, lambda body: F.struct(*[make(body).alias(name) for name, make in fields.items()])
    )
    return messages.select("*", F.inline(rows))


def _message_id(body: Column) -> Column:
    """The reply id if that key is present, else the snapshot name, else the first key."""
    return (
        F.when(F.map_contains_key(body, REPLY_ID), F.try_element_at(body, F.lit(REPLY_ID)))
        .when(F.map_contains_key(body, SNAPSHOT_NAME), F.try_element_at(body, F.lit(SNAPSHOT_NAME)))
        .otherwise(F.get(F.map_keys(body), F.lit(0)))
    )


def decode(messages: DataFrame) -> DataFrame:
    """Add ``msg_id``, ``message_size`` and ``reject`` (why a message has no id, else null)."""
    reject = (
        F.when(F.col("ser_type").isNull(), "no_header")
        .when(F.lower("ser_type") != LOG_CODEC, "bad_ser_type")
        .when(~F.col("__is_map"), "not_a_map")
        .when(F.col("__id").isNull(), "no_id")
    )
    return (
        _from_body(
            messages,
            {
                "__is_map": lambda body: body.isNotNull(),
                "__id": _message_id,
                "is_typed": lambda body: F.try_element_at(body, F.lit(MESSAGE_TYPE)).isNotNull(),
            },
        )
        .withColumn("reject", reject)
        .withColumns(
            {
                "msg_id": F.when(F.col("reject").isNull(), F.col("__id")),
                "message_size": F.octet_length("value").cast("bigint"),
            }
        )
        .drop("__is_map", "__id")
    )


def _registry(pending: DataFrame, monitors: DataFrame, snapshots: DataFrame) -> DataFrame:
    """The three tables that are looked up by id, as one row of flags per id."""

    def flagged(df: DataFrame, column: str, flag: str) -> DataFrame:
        return df.select(F.col(column).alias("msg_id"), F.lit(flag).alias("kind"))

    all_ids = (
        flagged(pending, "reply_id", "reply")
        .unionByName(flagged(monitors, "pv_name", "monitor"))
        .unionByName(flagged(snapshots, "reply_id", "snapshot"))
    )
    return all_ids.groupBy("msg_id").agg(
        *[
            F.max(F.col("kind") == kind).alias(f"is_{kind}")
            for kind in ("reply", "monitor", "snapshot")
        ]
    )


def _join_key(column: Column) -> Column:
    """Rejected messages have no id; spread them instead of sending all to one task."""
    spread = F.pmod(F.hash("topic", "partition", "offset"), F.lit(_NULL_KEY_SPREAD))
    return F.coalesce(column, F.concat(F.lit("\u0000"), spread.cast("string")))


def route(
    messages: DataFrame,
    pending: DataFrame,
    monitors: DataFrame,
    snapshots: DataFrame,
    recurring: DataFrame,
) -> DataFrame:
    """Add ``route``: first match of reply, monitor, snapshot (by id), recurring (by topic).

    ``pending`` and ``snapshots`` have reply_id, ``monitors`` pv_name, ``recurring`` topic.
    Messages nothing waits for are ``dropped``; the other routes name why they were.
    """
    ids = checked_broadcast(
        _registry(pending, monitors, snapshots).withColumnRenamed("msg_id", "__key")
    )
    topics = checked_broadcast(
        recurring.select("topic").distinct().withColumn("is_recurring", F.lit(True))
    )
    chosen = (
        F.when(F.col("reject").isNotNull(), F.col("reject"))
        .when(F.col("is_reply"), "reply")
        .when(F.col("is_monitor"), "monitor")
        .when(F.col("is_snapshot"), "snapshot")
        .when(F.col("is_recurring") & F.col("is_typed"), "recurring")
        .otherwise("dropped")
    )
    return (
        decode(messages)
        .withColumn("__key", _join_key(F.col("msg_id")))
        .join(ids, "__key", "left")
        .join(topics, "topic", "left")
        .select(*messages.columns, "msg_id", "message_size", chosen.alias("route"))
    )


def monitor_values(routed: DataFrame) -> DataFrame:
    """PV name and value of the messages routed to monitors."""
    body = F.from_json("value", "map<string,string>")
    return routed.where(F.col("route") == "monitor").select(
        F.col("msg_id").alias("pv_name"),
        "topic",
        "partition",
        "offset",
        "ts",
        F.try_element_at(body, F.col("msg_id")).alias("value"),
    )


def acknowledged_topics(routed: DataFrame) -> DataFrame:
    """Topics that accepted recurring snapshots publish on, from their replies."""
    topic = F.get_json_object("value", "$.publishing_topic")
    return (
        routed.where(F.col("route") == "reply")
        .select(F.col("msg_id").alias("reply_id"), topic.alias("topic"))
        .where(F.col("topic").isNotNull())
    )


def get_results(routed: DataFrame, requests: DataFrame) -> DataFrame:
    """What each reply to a get returns: the PV's member of the reply, or the whole reply.

    ``requests`` has reply_id and pv_name.  A reply with an error returns nothing.
    """
    replies = routed.where(F.col("route") == "reply").select(
        F.col("msg_id").alias("reply_id"), "offset", "value"
    )
    body = F.from_json("value", "map<string,string>")
    code = F.coalesce(F.get_json_object("value", "$.error").try_cast("bigint"), F.lit(0))
    member = F.coalesce(F.try_element_at(body, F.col("pv_name")), F.col("value"))
    return replies.join(requests.select("reply_id", "pv_name"), "reply_id").select(
        "reply_id",
        "pv_name",
        "offset",
        F.when(code == 0, member).alias("result"),
        code.alias("error"),
        F.get_json_object("value", "$.message").alias("message"),
    )


def get_outcomes(routed: DataFrame, requests: DataFrame) -> DataFrame:
    """One row per get: ``ok``, ``error`` or ``unanswered``, by the reply that came first.

    Later replies to the same id are ignored.  Adds offset, result, error and message of the reply.
    """
    reply = F.struct("offset", "result", "error", "message")
    first = get_results(routed, requests).groupBy("reply_id").agg(F.min_by(reply, "offset").alias("reply"))
    status = (
        F.when(F.col("reply").isNull(), "unanswered").when(F.col("reply.error") != 0, "error").otherwise("ok")
    )
    return requests.select("reply_id", "pv_name").join(first, "reply_id", "left").select(
        "reply_id", "pv_name", status.alias("status"), "reply.*"
    )


def parse_one_shot(messages: DataFrame) -> DataFrame:
    """``completes`` (a non-zero error) and the single PV and value of each snapshot message.

    A body must hold exactly one key besides error and reply id, else ``pv_name`` is null.
    """

    def completes(body: Column) -> Column:
        is_zero = F.try_element_at(body, F.lit("error")).try_cast("double") == 0
        return F.map_contains_key(body, "error") & ~F.coalesce(is_zero, F.lit(False))

    def entries(body: Column) -> Column:
        return F.map_entries(F.map_filter(body, lambda key, _: ~key.isin("error", REPLY_ID)))

    parsed = _from_body(
        messages.select("msg_id", "offset", "value"),
        {"completes": completes, "entries": entries},
    )
    single = F.when(F.size("entries") == 1, F.col("entries")[0])
    return parsed.select(
        "msg_id",
        "offset",
        F.coalesce("completes", F.lit(False)).alias("completes"),
        single["key"].alias("pv_name"),
        single["value"].alias("value"),
    )


def assemble_snapshots(messages: DataFrame) -> DataFrame:
    """One-shot snapshots: the values of each completed snapshot, one row per value.

    ``messages`` are those routed to snapshots: msg_id, offset, value.  The first message
    with a non-zero error completes a snapshot; later ones are ignored and unfinished
    snapshots are not emitted.  The last row of a snapshot has the completing message's offset
    and a null ``pv_name``, so a snapshot without values shows too.
    """
    parsed = parse_one_shot(messages)
    ends = parsed.where("completes").groupBy("msg_id").agg(F.min("offset").alias("completed_at"))
    values = parsed.where(~F.col("completes") & F.col("pv_name").isNotNull())
    kept = values.drop("completes").join(ends, "msg_id").where(F.col("offset") < F.col("completed_at"))
    closing = ends.withColumn("offset", F.col("completed_at"))
    return kept.unionByName(closing, allowMissingColumns=True)
