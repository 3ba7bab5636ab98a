"""Envelopes, one-shot snapshots, reassembly, sources, commands, size checks."""

import json
from collections import defaultdict

import pytest
from helpers import at, events, members, rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from pvspark import schemas, sizing
from pvspark.operators import reassembly, routing
from pvspark.sources import commands, event_log, live

common = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def message_log(spark, items):
    """items: (topic, ser_type, body)"""
    return spark.createDataFrame(
        [(topic, 0, i, at(i), ser, body) for i, (topic, ser, body) in enumerate(items)], schemas.MESSAGES
    )


ROUTES = [
    # topic, codec, body, id, route
    ("x", None, '{"reply_id":"r1"}', None, "no_header"),
    ("x", "msgpack-compact", '{"reply_id":"r1"}', None, "bad_ser_type"),
    ("x", "JSON", '{"reply_id":"r1"}', "r1", "reply"),
    ("x", "json", "[1]", None, "not_a_map"),
    ("x", "json", "7", None, "not_a_map"),
    ("x", "json", "not json", None, "not_a_map"),
    ("x", "json", None, None, "not_a_map"),
    ("x", "json", "{}", None, "no_id"),
    ("x", "json", '{"reply_id":null,"a":1}', None, "no_id"),
    ("x", "json", '{"a":1,"snapshot_name":"s"}', "s", "dropped"),
    ("x", "json", '{"snapshot_name":"s","reply_id":"r1"}', "r1", "reply"),
    ("x", "json", '{"m:1":{"value":1},"other":2}', "m:1", "monitor"),
    ("x", "json", '{"other":2,"m:1":1}', "other", "dropped"),
    ("x", "json", '{"reply_id":"shot","a":1}', "shot", "snapshot"),
    ("rec", "json", '{"message_type":1,"a":1}', "message_type", "recurring"),
    ("rec", "json", '{"a":1}', "a", "dropped"),
    ("rec", "json", '{"m:1":1,"message_type":1}', "m:1", "monitor"),
    ("x", "json", '{"message_type":1,"a":1}', "message_type", "dropped"),
    ("x", "json", '{"reply_id":"both"}', "both", "reply"),
]


@pytest.mark.parametrize("limit", [sizing.MAX_BROADCAST_ROWS, 0])
def test_routes(spark, monkeypatch, limit):
    monkeypatch.setattr(sizing.fits_broadcast, "__defaults__", (limit, sizing.MAX_BROADCAST_BYTES))
    monkeypatch.setattr(sizing.checked_broadcast, "__defaults__", (limit, sizing.MAX_BROADCAST_BYTES))
    log = message_log(spark, [row[:3] for row in ROUTES])
    ids = lambda *names: spark.createDataFrame([(n,) for n in names], "reply_id STRING")
    routed = routing.route(
        log,
        pending=ids("r1", "both"),
        monitors=spark.createDataFrame([("m:1",)], "pv_name STRING"),
        snapshots=ids("shot", "both"),
        recurring=spark.createDataFrame([("rec",)], "topic STRING"),
    )
    got = {r["offset"]: (r["msg_id"], r["route"]) for r in routed.collect()}
    assert got == {i: (row[3], row[4]) for i, row in enumerate(ROUTES)}
    assert routed.where("offset = 0").first()["message_size"] == len(ROUTES[0][2])
    values = rows(routing.monitor_values(routed).select("pv_name", "value"))
    assert values == [("m:1", "1"), ("m:1", '{"value":1}')]


def test_one_shot_assembly(spark):
    log = spark.createDataFrame(
        [
            ("s", 1, '{"reply_id":"s","error":0,"a":1}'),
            ("s", 2, '{"reply_id":"s","a":2}'),
            ("s", 3, '{"reply_id":"s","a":3,"b":3}'),
            ("s", 4, '{"reply_id":"s"}'),
            ("s", 5, '{"reply_id":"s","error":1,"a":9}'),
            ("s", 6, '{"reply_id":"s","a":4}'),
            ("s", 7, '{"reply_id":"s","error":2}'),
            ("open", 1, '{"reply_id":"open","a":1}'),
            ("null", 1, '{"reply_id":"null","a":1}'),
            ("null", 2, '{"reply_id":"null","error":null}'),
        ],
        "msg_id STRING, offset BIGINT, value STRING",
    )
    got = routing.assemble_snapshots(log).select("msg_id", "offset", "pv_name", "value")
    assert rows(got.where("pv_name IS NOT NULL")) == [("null", 1, "a", "1"), ("s", 1, "a", "1"), ("s", 2, "a", "2")]
    assert rows(got.where("pv_name IS NULL").select("msg_id", "offset")) == [("null", 2), ("s", 5)]


def record_table(spark, items):
    """items: (topic, message_type, iteration, pv_name), offsets in order"""
    return spark.createDataFrame(
        [(topic, i, kind, it, 100 + i, pv, float(i) if pv else None)
         for i, (topic, kind, it, pv) in enumerate(items)],
        schemas.SNAPSHOT_RECORDS,
    )


def by_hand(items, strict):
    """{(topic, header offset, tail offset): [data offsets]} by reading each topic in order."""
    out = {}
    for topic in {t for t, *_ in items}:
        opened, data = None, []
        for i, (t, kind, it, pv) in enumerate(items):
            it = it or 0
            if t != topic or kind is None:
                continue
            if kind == 0:
                if opened is None or not strict:
                    opened, data = (i, it), []
            elif opened is not None and it == opened[1]:
                if kind == 1:
                    data.extend([i] if pv else [])
                else:
                    out[topic, opened[0], i] = data
                    opened = None
    return out


record_items = st.lists(
    st.tuples(
        st.sampled_from(["t", "t", "t", "u"]), st.sampled_from([0, 1, 1, 2, 2, None]),
        st.sampled_from([None, 1, 2]), st.sampled_from(["a", "b", None]),
    ),
    min_size=1, max_size=40,
)


@common
@given(items=record_items, mode=st.sampled_from(["robust", "exact"]), width=st.sampled_from([None, 3, 10]))
def test_reassembly_of_any_log(spark, items, mode, width):
    records = record_table(spark, items)
    expected = by_hand(items, mode == "exact")
    epochs = reassembly.robust_epochs(records, width) if mode == "robust" else reassembly.exact_epochs(records)
    closed = {(r.topic, r.header_offset, r.tail_offset) for r in epochs.collect() if r.tail_offset is not None}
    assert closed == set(expected)
    got = defaultdict(list)
    for r in reassembly.reassemble(records, mode, width).orderBy("offset").collect():
        got[r.topic, r.header_offset].append(r.offset)
    assert dict(got) == {key[:2]: [*data, key[2]] for key, data in expected.items()}


def well_formed(n):
    return [row for i in range(1, n + 1) for row in (("t", 0, i, None), ("t", 1, i, "a"), ("t", 1, i, "b"), ("t", 2, i, None))]


def test_modes_agree_without_faults_and_differ_on_a_lost_tail(spark):
    clean = record_table(spark, well_formed(5))
    assert rows(reassembly.reassemble(clean, "robust")) == rows(reassembly.reassemble(clean, "exact"))
    lost = clean.where(~((F.col("message_type") == 2) & (F.col("iter_index") == 2)))
    iterations = lambda mode: {r.iteration for r in reassembly.reassemble(lost, mode).collect()}
    assert iterations("robust") == {1, 3, 4, 5} and iterations("exact") == {1}


def test_completion_lists_every_pv(spark):
    records = record_table(spark, [("t", 0, 1, None), ("t", 1, 1, "a"), ("t", 1, 1, "zz"), ("t", 2, 1, None),
                                   ("t", 0, 2, None), ("t", 2, 2, None)])
    epochs = reassembly.robust_epochs(records)
    listed = spark.createDataFrame([("t", "a"), ("t", "b"), ("t", "a")], "topic STRING, pv_name STRING")
    got = reassembly.completed_iterations(epochs, reassembly.place_data(records, epochs), listed)
    assert rows(got.select("iteration", "pv_name", "n_values")) == [
        (1, "a", 1), (1, "b", 0), (2, "a", 0), (2, "b", 0)]


def test_replay_starts_at_the_first_late_enough_offset(spark):
    log = spark.createDataFrame(
        [("t", 0, 0, at(0)), ("t", 0, 1, at(10)), ("t", 0, 2, at(5)), ("t", 1, 0, at(3)), ("u", 0, 9, at(20))],
        "topic STRING, partition INT, offset BIGINT, ts TIMESTAMP_NTZ",
    )
    got = event_log.replay_from(log, F.lit(at(8)).cast("timestamp_ntz"))
    assert rows(got.select("topic", "partition", "offset")) == [("t", 0, 1), ("t", 0, 2), ("u", 0, 9)]


def test_pv_list_file(spark, tmp_path):
    (tmp_path / "pvs.txt").write_text("  pva://a \n\n\t\nca://b\n")
    assert rows(event_log.read_pv_list(spark, str(tmp_path))) == [("ca://b",), ("pva://a",)]


def test_archived_logs_round_trip(spark, tmp_path):
    log = events(spark, [(1, "a", 0, 1)]).select(
        "seq", "pv_name", F.lit("pva").alias("protocol"), "ts", "ts_ms", "value", F.lit("{}").alias("fields"))
    for fmt in ("parquet", "json", "orc"):
        log.write.format(fmt).save(str(tmp_path / fmt))
        assert rows(event_log.read_events(spark, str(tmp_path / fmt), fmt)) == rows(log)
    messages = message_log(spark, [("t", "json", "{}")])
    messages.write.parquet(str(tmp_path / "messages"))
    assert rows(event_log.read_messages(spark, str(tmp_path / "messages"))) == rows(messages)


def test_connector_rows_name_their_codec(spark):
    df = spark.sql(
        "SELECT 't' AS topic, 0 AS partition, 1L AS offset, timestamp'2024-01-01' AS timestamp, binary('{}') AS value, "
        "array(named_struct('key', 'other', 'value', binary('x')), named_struct('key', 'gw-ser-type', 'value', binary('JSON'))) AS headers "
        "UNION ALL SELECT 't', 0, 2L, timestamp'2024-01-01', binary('{}'), null"
    )
    got = rows(live.from_kafka_rows(df).select("offset", "ser_type", "value"))
    assert got == [(1, "JSON", "{}"), (2, None, "{}")]


def exported(df, kind):
    return [json.loads(r["value"]) for r in commands.export_commands(df, kind, "app").collect()]


def test_commands(spark):
    common_part = {"serialization": "msgpack", "reply_topic": "app-reply", "reply_id": "r"}
    single = spark.sql("SELECT 'r' AS reply_id, 'pva://a:b.c' AS pv_uri, 4 AS value")
    many = spark.sql("SELECT 'r' AS reply_id, array('pva://a', 'ca://b') AS pv_uri_list")
    named = spark.sql("SELECT 'r' AS reply_id, 's' AS snapshot_name, array('pva://a') AS pv_uri_list, cast(array() as array<string>) AS pv_field_filter_list")
    assert exported(single, "get") == [common_part | {"command": "get", "pv_name": "pva://a:b.c"}]
    assert exported(single, "monitor") == [common_part | {
        "command": "monitor", "pv_name": "pva://a:b.c", "activate": True, "monitor_dest_topic": "a_b.c"}]
    assert exported(single, "put") == [common_part | {"command": "put", "pv_name": "pva://a:b.c", "value": "4"}]
    assert exported(many, "multi-monitor") == [common_part | {
        "command": "multi-monitor", "activate": True, "pv_name_list": ["pva://a", "ca://b"]}]
    assert exported(many, "snapshot") == [common_part | {"command": "snapshot", "pv_name_list": ["pva://a", "ca://b"]}]
    recurring = common_part | {
        "command": "repeating_snapshot", "snapshot_name": "s", "pv_name_list": ["pva://a"], "repeat_delay_msec": 0,
        "time_window_msec": 1000, "sub_push_delay_msec": 0, "respect_push_order": True, "triggered": False,
        "type": "normal"}
    assert exported(named, "repeating_snapshot") == [recurring]
    filtered = named.withColumn("pv_field_filter_list", F.array(F.lit("value")))
    assert exported(filtered, "repeating_snapshot") == [recurring | {"pv_field_filter_list": ["value"]}]
    for kind in ("repeating_snapshot_trigger", "repeating_snapshot_stop"):
        assert exported(named, kind) == [common_part | {"command": kind, "snapshot_name": "s"}]


def test_commands_reach_a_sink(spark, tmp_path):
    single = spark.sql("SELECT 'r' AS reply_id, 'pva://a' AS pv_uri")
    commands.write_commands(
        commands.export_commands(single, "get", "app"), "json", path=str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1


def test_broadcast_needs_a_measured_bound(spark):
    df = spark.range(100).select(F.col("id"), F.lit("x" * 100).alias("s"), F.array("id").alias("a"))
    assert sizing.fits_broadcast(df)
    assert not sizing.fits_broadcast(df, max_rows=99)
    assert not sizing.fits_broadcast(df, max_bytes=1000)
    assert sizing.fits_broadcast(df.where("id < 0"))
    assert sizing.checked_broadcast(df, max_rows=1) is df


def test_members_of_a_bigger_list_still_match(spark, monkeypatch):
    from pvspark.operators import subscriptions

    monkeypatch.setattr(subscriptions, "checked_broadcast", lambda df: df)
    log = events(spark, [(1, "a", 0, 1), (2, "b", 1, 2)])
    assert rows(subscriptions.monitor(log, members(spark, ["a"], 1)).select("seq")) == [(1,)]
