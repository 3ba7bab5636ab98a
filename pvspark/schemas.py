"""Schemas of the canonical tables."""

from __future__ import annotations

PV_EVENTS = (
    "seq BIGINT, pv_name STRING, protocol STRING, ts TIMESTAMP_NTZ, ts_ms BIGINT, "
    "value DOUBLE, fields STRING"
)

MESSAGES = (
    "topic STRING, partition INT, offset BIGINT, ts TIMESTAMP_NTZ, ser_type STRING, value STRING"
)

SNAPSHOT_RECORDS = (
    "topic STRING, offset BIGINT, message_type INT, iter_index BIGINT, timestamp_ms BIGINT, "
    "pv_name STRING, value DOUBLE"
)

SNAPSHOT_SPECS = (
    "snapshot_name STRING, pv_uri_list ARRAY<STRING>, time_window BIGINT, repeat_delay BIGINT, "
    "sub_push_delay_msec BIGINT, respect_push_order BOOLEAN, triggered BOOLEAN, type STRING, "
    "pv_field_filter_list ARRAY<STRING>"
)

REQUESTS = "reply_id STRING, pv_name STRING, ts TIMESTAMP_NTZ, timeout_ms BIGINT"

REPLIES = "reply_id STRING, ts TIMESTAMP_NTZ, error INT, message STRING, value DOUBLE"

TRIGGERS = "snapshot_name STRING, trigger_id BIGINT, ts TIMESTAMP_NTZ"

COMMANDS = (
    "command STRING, pv_name STRING, reply_id STRING, reply_topic STRING, ts TIMESTAMP_NTZ"
)
