"""Snapshots driven by specs: typed values, fields of their own event, pushes, faulty types."""

from helpers import ORIGIN_MS, at, rows
from pyspark.sql import functions as F

from pvspark.operators import specs
from pvspark.operators.spec_snapshots import snapshots_from_specs

SPECS = (
    "snapshot_name STRING, pv_uri_list ARRAY<STRING>, time_window BIGINT, repeat_delay BIGINT, "
    "sub_push_delay_msec BIGINT, triggered BOOLEAN, type STRING, pv_field_filter_list ARRAY<STRING>"
)
PVS = ["pva://a", "pva://b", "pva://quiet"]


def spec_table(spark):
    return spark.createDataFrame(
        [("n", PVS, 100, 0, 0, False, "normal", ["k"]), ("t", PVS, 100, 0, 30, False, "timedbuffered", None),
         ("m", PVS, 1000, 0, 0, True, "normal", None), ("w", PVS, 1000, 0, 0, True, "timedbuffered", ["x"]),
         ("odd", PVS, 100, 0, 0, False, "sometimes", None)], SPECS)


def events(spark, kind="DOUBLE", value=float, fields="string"):
    log = spark.createDataFrame(
        [(seq, pv, at(ms), ORIGIN_MS + ms, value(seq), f'{{"k":{ms},"x":"{pv}"}}') for seq, pv, ms in
         # Both PVs count their events from one.
         [(1, "a", 10), (1, "b", 20), (2, "a", 70), (2, "b", 150)]],
        f"seq BIGINT, pv_name STRING, ts TIMESTAMP_NTZ, ts_ms BIGINT, value {kind}, fields STRING")
    return log if fields == "string" else log.withColumn("fields", F.parse_json("fields"))


def triggers(spark):
    return spark.createDataFrame(
        [("m", 1, at(100)), ("w", 2, at(100))], "snapshot_name STRING, trigger_id BIGINT, ts TIMESTAMP_NTZ")


def test_equal_seqs_of_two_pvs_keep_their_own_fields(spark):
    got = snapshots_from_specs(events(spark), spec_table(spark), triggers(spark), ORIGIN_MS)
    of = lambda name, *columns: rows(got.where(F.col("snapshot_name") == name).select(*columns))
    assert of("n", "iteration", "pv_name", "seq", "value", "fields") == sorted(
        [(1, "a", 2, 2.0, '{"k":70}'), (1, "b", 1, 1.0, '{"k":20}'), (1, "quiet", None, None, None),
         (2, "a", None, None, None), (2, "b", 2, 2.0, '{"k":150}'), (2, "quiet", None, None, None)], key=repr)
    assert of("t", "iteration", "push_index", "pv_name", "seq", "fields") == sorted(
        [(1, 0, "a", 1, '{"k":10,"x":"a"}'), (1, 2, "a", 2, '{"k":70,"x":"a"}'), (1, 0, "b", 1, '{"k":20,"x":"b"}'),
         (2, 1, "b", 2, '{"k":150,"x":"b"}'), (1, None, "quiet", None, None), (2, None, "a", None, None),
         (2, None, "quiet", None, None)], key=repr)
    assert of("m", "pv_name", "seq", "fields") == [
        ("a", 2, '{"k":70,"x":"a"}'), ("b", 1, '{"k":20,"x":"b"}'), ("quiet", None, None)]
    assert of("w", "pv_name", "seq", "fields") == sorted(
        [("a", 1, '{"x":"a"}'), ("a", 2, '{"x":"a"}'), ("b", 1, '{"x":"b"}'), ("quiet", None, None)], key=repr)
    assert of("odd", "pv_name") == []


def test_waveforms_tables_and_variants_stay_what_they_are(spark):
    wave = events(spark, "ARRAY<DOUBLE>", lambda seq: [float(seq)] * 3)
    got = snapshots_from_specs(wave, spec_table(spark), triggers(spark), ORIGIN_MS)
    assert got.schema["value"].dataType == wave.schema["value"].dataType
    assert rows(got.where("snapshot_name = 'm' AND pv_name = 'a'").select("value")) == [([2.0, 2.0, 2.0],)]

    table = events(spark, "STRUCT<labels: ARRAY<STRING>, n: BIGINT>", lambda seq: (["x", "y"], seq), "variant")
    got = snapshots_from_specs(table, spec_table(spark), triggers(spark), ORIGIN_MS)
    kept = got.where("snapshot_name = 'n' AND pv_name = 'b' AND iteration = 1").select(
        "value.labels", "value.n", F.map_keys("fields").alias("names"), F.col("fields")["k"].cast("int").alias("k"))
    assert [tuple(r) for r in kept.collect()] == [(["x", "y"], 1, ["k"], 20)]


def test_fields_shuffle_no_events_again(spark):
    plan = snapshots_from_specs(events(spark), spec_table(spark), triggers(spark), ORIGIN_MS)._jdf.queryExecution().analyzed().toString()
    assert "Join LeftOuter, (seq" not in plan


def test_an_unknown_type_is_a_fault(spark):
    got = {r.snapshot_name: r.error for r in specs.validate_specs(spec_table(spark)).collect()}
    assert got == {"n": None, "t": None, "m": None, "w": None, "odd": "unknown_type"}
