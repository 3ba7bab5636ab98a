import pytest
from helpers import rows

from pvspark.operators import catalog, specs


def parsed(spark, *uris):
    df = spark.createDataFrame([(uri,) for uri in uris], "uri STRING")
    return {r["uri"]: (r["protocol"], r["pv_name"], r["status"]) for r in catalog.parse_uris(df).collect()}


@pytest.mark.parametrize(
    "uri, expected",
    [
        ("pva://ioa:a.attribute", ("pva", "ioa:a.attribute", "ok")),
        ("pva://ioa:a.attribute.sub-attribute", ("pva", "ioa:a.attribute.sub-attribute", "ok")),
        ("pva://ioa:a", ("pva", "ioa:a", "ok")),
        ("ca://VGXX-L3B-1602-PLOG", ("ca", "VGXX-L3B-1602-PLOG", "ok")),
        ("pv://a", ("pv", "a", "bad_protocol")),
    ],
)
def test_well_formed_addresses(spark, uri, expected):
    assert parsed(spark, uri)[uri] == expected


def test_malformed_addresses(spark):
    bad = ["//bad:pv:name", "pva://", "unkonwn://", "PVA://a", "pva://.a", "pva://a.", "pva://a.b:c",
           "pva://a\n", "pva://a\u0085", "pva://a b", "xpva://a", ""]
    assert {value[2] for value in parsed(spark, *bad).values()} == {"malformed"}


def test_null_address_is_malformed(spark):
    df = spark.createDataFrame([(None,)], "uri STRING")
    assert catalog.parse_uris(df).first()["status"] == "malformed"


def test_catalog_merges_protocols_of_one_pv(spark):
    df = spark.createDataFrame([("pva://x",), ("ca://x",), ("ca://y",), ("pv://z",)], "uri STRING")
    assert rows(catalog.pv_catalog(df)) == [("x", ["ca", "pva"]), ("y", ["ca"])]


def test_one_bad_address_rejects_the_list(spark):
    df = spark.createDataFrame(
        [(1, "pva://x"), (1, "ca://y"), (2, "pva://x"), (2, "pv://y"), (3, "x")], "list_id INT, uri STRING"
    )
    assert rows(catalog.list_report(df)) == [(1, 2, 0, 0, True), (2, 2, 0, 1, False), (3, 1, 1, 0, False)]


def test_topics_collide(spark):
    df = spark.createDataFrame([("a:b",), ("a_b",), ("a:b",), ("c:d",)], "pv_name STRING")
    assert rows(catalog.topic_collisions(df)) == [("a_b", 2, "a:b", "a_b")]


def test_silent_pvs(spark):
    names = spark.createDataFrame([("a",), ("b",)], "pv_name STRING")
    heard = spark.createDataFrame([("a",), ("a",), ("c",)], "pv_name STRING")
    assert rows(catalog.silent_pvs(names, heard)) == [("b",)]


SPEC = "snapshot_name STRING, pv_uri_list ARRAY<STRING>, time_window BIGINT, repeat_delay BIGINT, triggered BOOLEAN"


@pytest.mark.parametrize(
    "spec, error",
    [
        (("snap_1", ["pva://a", "ca://b"], 1000, 0, False), None),
        (("snap-1", ["pva://a"], 0, 0, True), None),
        (("", ["pva://a"], 1000, 0, False), "empty_name"),
        ((None, ["pva://a"], 1000, 0, False), "empty_name"),
        (("a b", ["pva://a"], 1000, 0, False), "invalid_name"),
        (("a\n", ["pva://a"], 1000, 0, False), "invalid_name"),
        (("a", [], 1000, 0, False), "empty_pv_list"),
        (("a", None, 1000, 0, False), "empty_pv_list"),
        (("a", ["pva://a", None], 1000, 0, False), "non_text_uri"),
        (("a", ["pva://a"], -1, 0, False), "negative_time_window"),
        (("a", ["pva://a"], 1, -1, False), "negative_repeat_delay"),
        (("a", ["pva://a"], None, None, None), None),
        (("", ["bad"], -1, -1, None), "malformed_uri"),
        (("", ["pv://a"], -1, -1, None), "bad_protocol"),
        (("", [], -1, -1, None), "empty_name"),
    ],
)
def test_first_failing_rule(spark, spec, error):
    df = spark.createDataFrame([spec], SPEC)
    assert specs.validate_specs(df).first()["error"] == error


def test_defaults_and_membership(spark):
    df = spark.createDataFrame(
        [("s", ["pva://a", "ca://a", "ca://b"]), ("half", ["pva://a", "bad"]), ("bad name!", ["pva://a"])], "snapshot_name STRING, pv_uri_list ARRAY<STRING>"
    )
    filled = specs.with_defaults(df).first()
    assert (filled.time_window, filled.repeat_delay, filled.sub_push_delay_msec) == (1000, 0, 0)
    assert (filled.respect_push_order, filled.triggered, filled.type) == (True, False, "normal")
    assert rows(specs.snapshot_members(df)) == [("s", "a", 1000, 0, 0), ("s", "b", 1000, 0, 0)]
