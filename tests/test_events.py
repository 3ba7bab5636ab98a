"""Monitors, latest values, correlation, projection, traffic, tables."""

import pytest
from helpers import at, events, rows
from pyspark.sql import functions as F

from pvspark.functions.timing import epoch_ms, epoch_us
from pvspark.operators import correlate, latest, projection, subscriptions as subs, tables, traffic


def names(spark, *pvs):
    return spark.createDataFrame([(pv,) for pv in pvs], "pv_name STRING")


def test_monitor_delivers_only_subscribed_pvs(spark):
    log = events(spark, [(1, "a", 0, 1), (2, "b", 1, 2), (3, "c", 2, 3)])
    assert rows(subs.monitor(log, names(spark, "a", "b", "a")).select("seq")) == [(1,), (2,)]
    assert rows(subs.monitor(log, names(spark, "missing"))) == []


def test_new_subscriptions_once_each(spark):
    assert rows(subs.new_subscriptions(names(spark, "a", "b", "b"), names(spark, "a"))) == [("b",)]


def commands(spark, items):
    return spark.createDataFrame(
        [(pv, at(ms), seq, kind) for pv, ms, seq, kind in items],
        "pv_name STRING, ts TIMESTAMP_NTZ, seq BIGINT, command STRING",
    )


@pytest.mark.parametrize("segment", [None, 3, 1000])
def test_delivery_while_active(spark, segment):
    log = events(spark, [(i, "a", i, i) for i in range(0, 20, 2)] + [(100, "b", 5, 1)])
    orders = commands(
        spark, [("a", 1, 1, "stop"), ("a", 3, 3, "start"), ("a", 5, 5, "start"), ("a", 9, 9, "stop"),
                ("a", 11, 11, "stop"), ("a", 15, 15, "start")]
    )
    got = rows(subs.deliver_while_active(log, orders, segment).select("seq"))
    assert got == [(16,), (18,), (4,), (6,), (8,)]
    outcome = {r["seq"]: r["outcome"] for r in subs.command_outcomes(orders, segment).collect()}
    assert outcome == {1: "orphan_stop", 3: "started", 5: "already_active", 9: "stopped",
                       11: "orphan_stop", 15: "started"}


def test_delivery_breaks_ties_by_sequence(spark):
    log = events(spark, [(1, "a", 5, 0), (3, "a", 5, 0)])
    orders = commands(spark, [("a", 5, 2, "start")])
    assert rows(subs.deliver_while_active(log, orders).select("seq")) == [(3,)]


def test_latest_value_and_unknown_pv(spark):
    log = events(spark, [(1, "a", 5, 1), (2, "a", 5, 2), (3, "a", 1, 3), (4, "b", 0, 4)])
    got = latest.bulk_get(names(spark, "a", "b", "zz"), log)
    assert rows(got.select("pv_name", "value", "status")) == [
        ("a", 2.0, "ok"), ("b", 4.0, "ok"), ("zz", None, "not_found")]


def test_snapshot_includes_the_instant(spark):
    log = events(spark, [(1, "a", 0, 1), (2, "a", 10, 2), (3, "a", 11, 3), (4, "c", 1, 4)])
    got = latest.snapshot_at(log, names(spark, "a", "b"), F.lit(at(10)).cast("timestamp_ntz"))
    assert rows(got.select("pv_name", "value", "error")) == [("a", 2.0, 0)]


def test_put_state_last_write_wins(spark):
    writes = spark.createDataFrame(
        [("a", "x", at(1), 1, 1.0), ("a", "x", at(2), 2, 2.0), ("a", "y", at(0), 3, 3.0), ("a", "x", at(2), 1, 9.0)],
        "pv_name STRING, field STRING, ts TIMESTAMP_NTZ, seq BIGINT, value DOUBLE",
    )
    assert rows(latest.put_state(writes).select("pv_name", "field", "value")) == [("a", "x", 2.0), ("a", "y", 3.0)]
    assert rows(latest.put_state_wide(writes, ["x", "y", "z"])) == [("a", 2.0, 3.0, None)]


def test_request_outcomes(spark):
    requests = spark.createDataFrame(
        [("ok", "p", at(0), 100), ("err", "p", at(0), 100), ("late", "p", at(0), 100), ("none", "p", at(0), 100),
         ("wait", "p", at(0), None), ("ever", "p", at(0), None), ("early", "p", at(50), 100),
         ("edge", "p", at(0), 100), ("null", "p", at(0), 100)],
        "reply_id STRING, pv_name STRING, ts TIMESTAMP_NTZ, timeout_ms BIGINT",
    )
    replies = spark.createDataFrame(
        [("ok", at(30), 0, None, 1.0), ("ok", at(10), 0, None, 7.0), ("err", at(5), 3, "bad", None),
         ("err", at(6), 0, None, 1.0), ("late", at(101), 0, None, 1.0), ("ever", at(10**6), 0, None, 2.0),
         ("early", at(49), 0, None, 1.0), ("edge", at(100), 0, None, 4.0), ("other", at(1), 0, None, 0.0),
         ("null", at(1), None, None, 5.0)],
        "reply_id STRING, ts TIMESTAMP_NTZ, error INT, message STRING, value DOUBLE",
    )
    got = {r["reply_id"]: r for r in correlate.correlate(requests, replies).collect()}
    assert {k: r["status"] for k, r in got.items()} == {
        "ok": "ok", "err": "error", "late": "timeout", "none": "timeout", "wait": "pending", "ever": "ok",
        "early": "timeout", "edge": "ok", "null": "ok"}
    assert (got["ok"]["value"], got["ok"]["latency_ms"]) == (7.0, 10)
    assert (got["err"]["error"], got["err"]["message"]) == (3, "bad")
    assert got["late"]["late_reply_ts"] == at(101) and got["none"]["late_reply_ts"] is None
    assert got["null"]["error"] == 0


def test_field_projection_kinds(spark):
    df = spark.sql(
        "SELECT named_struct('value', 1.5D, 'timeStamp', 7, 'alarm', 0) AS s, map('value', 'x', 'b', 'y') AS m, "
        "'{\"value\":1,\"other\":2}' AS j, parse_json('{\"value\":1,\"other\":2}') AS v"
    )
    assert rows(projection.project_fields(df, ["value", "timeStamp"], "s").select("s.*")) == [(1.5, 7)]
    assert projection.project_fields(df, ["value"], "s").schema["s"].dataType.names == ["value"]
    assert projection.project_fields(df, ["value", "zz"], "m").first()["m"] == {"value": "x"}
    assert projection.project_fields(df, ["value"], "j").first()["j"] == '{"value":1}'
    kept = projection.project_fields(df, ["value", "zz"], "v").select(F.to_json("v").alias("v"))
    assert kept.first()["v"] == '{"value":1}'
    odd = spark.createDataFrame(
        [('{"k":5,"z":[1,2],"b":true,"n":null,"o":{"a":1}}',), ("[1]",), (None,), ("no json",)], "j STRING")
    fields = ["k", "z", "b", "n", "zz"]
    assert [r.j for r in projection.project_fields(odd, fields, "j").collect()] == [
        '{"b":true,"k":5,"n":null,"z":[1,2]}', None, None, None]
    assert projection.project_fields(df, [], "s") is df
    with pytest.raises(Exception, match="zz"):
        projection.project_fields(df, ["zz"], "s").collect()
    with pytest.raises(Exception, match="missing field: zz"):
        projection.extract_field(df, "zz", column="j", strict=True).collect()
    assert projection.extract_field(df, "zz", column="j").first()["zz"] is None


def test_traffic(spark):
    log = spark.createDataFrame(
        [("t", at(0), "abc"), ("t", at(999), "é"), ("t", at(1000), "z"), ("u", at(0), "")],
        "topic STRING, ts TIMESTAMP_NTZ, value STRING",
    )
    got = rows(traffic.traffic_report(log, 1000).drop("bucket_start_ms"))
    assert got == [("t", 1, 1, 1), ("t", 2, 5, 3), ("u", 1, 0, 0)]


COLUMNS = ["ord", "s", "z"]


def table_rows(spark):
    return spark.createDataFrame(
        [("t1", 2, "b", 2.0), ("t1", 1, "a", 1.0), ("t1", 3, "c", None), ("t2", 1, "x", 9.0)],
        "pv_name STRING, ord BIGINT, s STRING, z DOUBLE",
    )


@pytest.mark.parametrize("longest", [100, 2, 1])
def test_unpack_undoes_pack(spark, longest):
    packed = tables.pack_tables(
        table_rows(spark), ["pv_name"], COLUMNS, ["ord"], F.col("ord"), 10, max_rows=longest
    )
    assert packed.first()["labels"] == COLUMNS
    back = tables.unpack_tables(packed, ["pv_name"], COLUMNS)
    assert rows(back.select("pv_name", *COLUMNS)) == rows(table_rows(spark))
    assert rows(back.select("pv_name", "row_index", "s")) == [
        ("t1", 0, "a"), ("t1", 1, "b"), ("t1", 2, "c"), ("t2", 0, "x")]
    assert {r["status"] for r in back.collect()} == {"ok"}


def test_ragged_table_is_flagged(spark):
    df = spark.sql("SELECT 'p' AS pv_name, named_struct('a', array(1, 2), 'b', array(5)) AS payload")
    got = tables.unpack_tables(df, ["pv_name"], ["a", "b"])
    assert rows(got) == [("p", "ragged", 0, 1, 5), ("p", "ragged", 1, 2, None)]


def test_set_column(spark):
    packed = tables.pack_tables(table_rows(spark), ["pv_name"], COLUMNS, ["ord"], F.col("ord"), 10)
    changes = spark.createDataFrame(
        [("t1", 1, "z", ["7", "8", "9"]), ("t1", 2, "z", ["4", "5", "6"]), ("t2", 1, "nope", ["1"])],
        "pv_name STRING, seq INT, label STRING, data ARRAY<STRING>",
    )
    got = {r["pv_name"]: r for r in tables.set_columns(packed, changes, ["pv_name"], COLUMNS).collect()}
    assert got["t1"]["payload"]["z"] == [4.0, 5.0, 6.0] and got["t1"]["payload"]["s"] == ["a", "b", "c"]
    assert got["t1"]["status"] == "replaced"
    assert got["t2"]["payload"]["z"] == [9.0] and got["t2"]["status"] == "undefined_label"


def test_epoch_does_not_depend_on_the_session_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-07-01 00:00:00.123456' AS ts")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = df.select(epoch_ms(F.col("ts")).alias("ms"), epoch_us(F.col("ts")).alias("us")).first()
            assert (got.ms, got.us) == (1719792000123, 1719792000123456)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
