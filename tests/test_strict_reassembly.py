"""Strict reassembly by segments against a plain walk over the log."""

import random

import pytest
from helpers import rows

from pvspark.operators import reassembly

SCHEMA = "topic STRING, offset BIGINT, message_type INT, iter_index BIGINT, timestamp_ms BIGINT, pv_name STRING, value DOUBLE"


def walk(items):
    """Accept a header when none is open; close it at the first tail of its iteration."""
    out, opened = [], {}
    for topic, offset, kind, iteration, when, _, _ in sorted(items, key=lambda r: r[:2]):
        iteration = iteration or 0
        if kind == reassembly.HEADER:
            opened.setdefault(topic, (topic, offset, iteration, when))
        elif kind == reassembly.TAIL and topic in opened and opened[topic][2] == iteration:
            out.append((*opened.pop(topic), offset, when))
    return sorted(out, key=repr)


def log(seed, n, topics, iterations):
    """Records in which any kind follows any other, with iterations that come back."""
    rng = random.Random(seed)
    items, offset = [], 0
    for _ in range(n):
        offset += rng.randint(1, 5)
        kind = rng.choice([0, 0, 1, 2, 2, None])
        iteration = rng.choice([None, *range(1, iterations + 1)])
        items.append((rng.choice(topics), offset, kind, iteration, offset + 1000, None, None))
    return items


@pytest.mark.parametrize(
    "seed, topics, iterations, width",
    [(1, ["t"], 3, 7), (2, ["t"], 40, 50), (3, ["t", "u", "v"], 5, 20), (4, ["t"], 400, 30), (5, ["t", "u"], 1, None), (6, ["t"], 2, 1)],
)
def test_segments_equal_the_walk_under_random_faults(spark, seed, topics, iterations, width):
    items = log(seed, 600, topics, iterations)
    records = spark.createDataFrame(items, SCHEMA).repartition(3)
    assert rows(reassembly.exact_epochs(records, width)) == walk(items)


def test_regular_log_with_lost_tails(spark):
    items = []
    for k in range(1, 200):
        items.append(("t", 10 * k, 0, k, k, None, None))
        if k % 17:
            items.append(("t", 10 * k + 9, 2, k, k, None, None))
    items.append(("t", 5000, 2, 17, 1, None, None))
    items.append(("t", 5001, 0, 7, 1, None, None))
    items.append(("t", 5002, 2, 7, 1, None, None))
    got = rows(reassembly.exact_epochs(spark.createDataFrame(items, SCHEMA), 100))
    assert got == walk(items) and len(got) == 18


def test_one_topic_is_many_tasks(spark):
    items = [("t", k, 0 if k % 2 == 0 else 2, k // 2, k, None, None) for k in range(4000)]
    records = spark.createDataFrame(items, SCHEMA)
    headers = reassembly._headers_with_tails(reassembly._control(records), 500)
    assert headers.select("__segment").distinct().count() == 8
    left = headers.groupBy("topic", "__segment").applyInPandas(reassembly._left_to, "topic STRING, header_offset BIGINT")
    # A segment hands on one row, not its headers.
    assert left.count() == 7


def test_no_records_and_no_headers(spark):
    assert rows(reassembly.exact_epochs(spark.createDataFrame([], SCHEMA))) == []
    tails = spark.createDataFrame([("t", 1, 2, 1, 1, None, None)], SCHEMA)
    assert rows(reassembly.exact_epochs(tails)) == []


@pytest.mark.parametrize("mode", ["robust", "exact"])
def test_listed_pvs_only_and_a_row_for_each_silent_one(spark, mode):
    items = [
        ("t", 1, 0, 1, 10, None, None), ("t", 2, 1, 1, 11, "a", 1.0), ("t", 3, 1, 1, 12, "other", 2.0), ("t", 4, 1, 1, 13, "a", 3.0),
        ("t", 5, 2, 1, 14, None, None), ("t", 6, 0, 2, 20, None, None), ("t", 7, 2, 2, 21, None, None),
        ("u", 1, 0, 1, 10, None, None), ("u", 2, 1, 1, 11, "a", 1.0), ("u", 3, 2, 1, 12, None, None),
        ("t", 8, 0, 3, 30, None, None), ("t", 9, 1, 3, 31, "a", 9.0),
    ]
    listed = spark.createDataFrame([("t", "a"), ("t", "quiet"), ("t", "a"), ("never", "a")], "topic STRING, pv_name STRING")
    got = reassembly.reassemble(spark.createDataFrame(items, SCHEMA), mode, pv_list=listed)
    assert rows(got.select("topic", "iteration", "offset", "pv_name", "value", "timestamp")) == sorted(
        [("t", 1, 2, "a", 1.0, 14), ("t", 1, 4, "a", 3.0, 14), ("t", 1, None, "quiet", None, 14), ("t", 1, 5, None, None, 14),
         ("t", 2, None, "a", None, 21), ("t", 2, None, "quiet", None, 21), ("t", 2, 7, None, None, 21)], key=repr)
