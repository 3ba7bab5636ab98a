"""Bulk command export: a table of requests becomes one JSON command each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pvspark.functions.uri import topic_of, uri_pv_name
from pvspark.operators.specs import with_defaults

# --- fixed values: command names and the extra fields of each ----------------------
SERIALIZATION = "msgpack"
REPLY_TOPIC_SUFFIX = "-reply"
COMMAND_FIELDS = {
    "get": ["pv_name"],
    "monitor": ["pv_name", "activate", "monitor_dest_topic"],
    "multi-monitor": ["activate", "pv_name_list"],
    "put": ["pv_name", "value"],
    "snapshot": ["pv_name_list"],
    "repeating_snapshot": [
        "snapshot_name",
        "pv_name_list",
        "repeat_delay_msec",
        "time_window_msec",
        "sub_push_delay_msec",
        "respect_push_order",
        "triggered",
        "type",
        "pv_field_filter_list",
    ],
    "repeating_snapshot_trigger": ["snapshot_name"],
    "repeating_snapshot_stop": ["snapshot_name"],
}
# -----------------------------------------------------------------------------------


#: Fields a command may do without.
OPTIONAL_FIELDS = {"pv_field_filter_list"}


def request_id(*parts: Column) -> Column:
    """A reply id derived from the request, so a re-executed task sends the same one."""
    return F.md5(F.concat_ws("|", *[part.cast("string") for part in parts]))


def _fields(requests: DataFrame, command: str) -> DataFrame:
    """Bring a request table's columns to the names the command carries."""
    renamed = {"pv_uri": "pv_name", "pv_uri_list": "pv_name_list"}
    if command == "repeating_snapshot":
        requests = with_defaults(requests)
        renamed |= {"repeat_delay": "repeat_delay_msec", "time_window": "time_window_msec"}
        if "pv_field_filter_list" in requests.columns:
            chosen = F.col("pv_field_filter_list")
            requests = requests.withColumn(
                "pv_field_filter_list", F.when(F.size(chosen) > 0, chosen)
            )
    extra = {}
    if command in ("monitor", "multi-monitor"):
        extra["activate"] = F.lit(True)
    if command == "monitor":
        extra["monitor_dest_topic"] = topic_of(uri_pv_name(F.col("pv_uri")))
    if command == "put":
        extra["value"] = F.col("value").cast("string")
    renamed = {old: new for old, new in renamed.items() if old in requests.columns}
    return requests.withColumns(extra).drop(*renamed.values()).withColumnsRenamed(renamed)


def export_commands(requests: DataFrame, command: str, app_name: str) -> DataFrame:
    """``key`` (the reply id) and ``value`` (the JSON command), ready for a topic sink.

    ``requests`` has ``reply_id`` and the command's own columns: ``pv_uri`` or
    ``pv_uri_list``, ``value`` for a put, the spec columns for a repeating snapshot.
    ``to_json`` leaves null fields out, which drops an absent field filter.
    """
    prepared = _fields(requests, command)
    names = [name for name in COMMAND_FIELDS[command] if name in prepared.columns]
    missing = set(COMMAND_FIELDS[command]) - set(names) - OPTIONAL_FIELDS
    if missing:
        raise ValueError(f"{command} needs columns for {sorted(missing)}")
    body = F.struct(
        F.lit(command).alias("command"),
        F.lit(SERIALIZATION).alias("serialization"),
        F.lit(app_name + REPLY_TOPIC_SUFFIX).alias("reply_topic"),
        F.col("reply_id"),
        *[F.col(name) for name in names],
    )
    return prepared.select(F.col("reply_id").alias("key"), F.to_json(body).alias("value"))


def write_commands(commands: DataFrame, fmt: str, **options: str) -> None:
    """Append exported commands to a sink: ``kafka`` with a topic option, or files."""
    commands.write.format(fmt).options(**options).mode("append").save()
