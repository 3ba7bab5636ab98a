from collections import defaultdict

import pytest
from helpers import ORIGIN_MS, at, events, members, rows
from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F

from pvspark.operators import snapshots, triggered

common = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
PVS = ["a", "b"]
# Half of all events are of one PV; "x" is in no list; some events precede the origin.
log_items = st.lists(
    st.tuples(st.sampled_from(["a", "a", "b", "x"]), st.integers(-20, 200)), min_size=1, max_size=40
)


def numbered(items):
    return [(i, pv, ms, i) for i, (pv, ms) in enumerate(items)]


def windows_by_hand(items, window, delay):
    """{(iteration, pv): [values in order]} for listed PVs, complete up to the last event."""
    period = window + delay
    last = max(ms for _, _, ms, _ in items) // period + 1
    out = {(i, pv): [] for i in range(1, last + 1) for pv in PVS}
    for seq, pv, ms, value in sorted(items, key=lambda r: (r[2], r[0])):
        if pv in PVS and ms >= 0 and ms % period < window:
            out[ms // period + 1, pv].append(float(value))
    return out


@common
@given(items=log_items, window=st.integers(1, 60), delay=st.integers(0, 40))
def test_windows_equal_the_definition(spark, items, window, delay):
    items = numbered(items)
    expected = windows_by_hand(items, window, delay)
    log, listed = events(spark, items), members(spark, PVS, window, delay)

    normal = snapshots.recurring_normal(log, listed, ORIGIN_MS).collect()
    assert {(r.iteration, r.pv_name): r.value for r in normal} == {
        key: values[-1] if values else None for key, values in expected.items()
    }
    for r in normal:
        assert r.header_timestamp == ORIGIN_MS + (r.iteration - 1) * (window + delay)
        assert r.tail_timestamp == r.timestamp == r.header_timestamp + window

    got = defaultdict(list)
    for r in snapshots.recurring_buffered(log, listed, ORIGIN_MS).orderBy("ts", "seq").collect():
        got[r.iteration, r.pv_name].extend([] if r.seq is None else [r.value])
    assert dict(got) == expected

    counters = snapshots.snapshot_counters(log, listed, ORIGIN_MS).collect()
    assert {r.iteration: (r.n_listed, r.n_pvs, r.n_values) for r in counters} == {
        i: (2, sum(bool(expected[i, pv]) for pv in PVS), sum(len(expected[i, pv]) for pv in PVS))
        for i in {key[0] for key in expected}
    }


@common
@given(items=log_items, push=st.integers(1, 30), longest=st.integers(1, 5))
def test_pushes_concatenate_to_the_window(spark, items, push, longest):
    items = numbered(items)
    log = events(spark, items)
    lists = defaultdict(list)
    whole = snapshots.buffered_lists(log, members(spark, PVS, 50), ORIGIN_MS, max_values=longest)
    for r in sorted(whole.collect(), key=lambda r: r.part):
        assert len(r["values"]) <= longest
        lists[r.iteration, r.pv_name].extend(r["values"])
    assert dict(lists) == windows_by_hand(items, 50, 0)

    batches = snapshots.sub_push_batches(
        log, members(spark, PVS, 50, push=push), ORIGIN_MS, max_values=longest
    )
    merged = defaultdict(dict)
    for r in snapshots.merge_pushes(batches).collect():
        merged[r.iteration, r.pv_name][r.pos] = r.value
    assert {
        key: [values[i] for i in range(len(values))] for key, values in merged.items()
    } == {key: values for key, values in lists.items() if values}


def test_window_edges_are_half_open(spark):
    log = events(spark, [(1, "a", 0, 1), (2, "a", 9, 2), (3, "a", 10, 3), (4, "a", 14, 4), (5, "a", 15, 5)])
    got = snapshots.recurring_buffered(log, members(spark, ["a"], 10, 5), ORIGIN_MS)
    assert rows(got.select("iteration", "seq")) == [(1, 1), (1, 2), (2, 5)]


def test_five_pushes_of_a_one_hertz_source(spark):
    log = events(spark, [(i, "ramp", 1000 * i, i) for i in range(10)])
    batches = snapshots.sub_push_summary(log, members(spark, ["ramp"], 5000, push=1000), ORIGIN_MS)
    assert rows(batches.select("iteration", "push_index", "n_values")) == [
        (i, p, 1) for i in (1, 2) for p in range(5)
    ]


def test_static_pv_is_listed_in_every_iteration(spark):
    log = events(spark, [(1, "a", 0, 7), (2, "b", 35, 1)])
    normal = snapshots.recurring_normal(log, members(spark, PVS, 10), ORIGIN_MS)
    assert rows(normal.select("iteration", "pv_name", "value")) == [
        (1, "a", 7.0), (1, "b", None), (2, "a", None), (2, "b", None), (3, "a", None), (3, "b", None),
        (4, "a", None), (4, "b", 1.0)]
    carried = snapshots.recurring_normal(log, members(spark, ["a"], 10), ORIGIN_MS, carry_forward=True)
    assert rows(carried.select("iteration", "value")) == [(i, 7.0) for i in range(1, 5)]


def test_values_are_carried_across_segments_of_iterations(spark, monkeypatch):
    monkeypatch.setattr(snapshots, "CARRY_ITERATIONS", 3)
    log = events(spark, [(1, "a", 5, 7), (2, "b", 205, 1), (3, "a", 121, 9)])
    carried = snapshots.recurring_normal(log, members(spark, PVS, 10), ORIGIN_MS, carry_forward=True)
    got = {(r.pv_name, r.iteration): r.value for r in carried.collect()}
    assert got == {
        **{("a", i): 7.0 if i < 13 else 9.0 for i in range(1, 22)}, **{("b", i): 1.0 if i == 21 else None for i in range(1, 22)}}


def test_empty_window_without_gap_is_an_error(spark):
    log = events(spark, [(1, "a", 0, 7)])
    with pytest.raises(Exception, match="must be positive"):
        snapshots.recurring_normal(log, members(spark, ["a"], 0), ORIGIN_MS).collect()
    only_gap = snapshots.recurring_buffered(log, members(spark, ["a"], 0, 5), ORIGIN_MS, complete=False)
    assert only_gap.count() == 0


def test_long_spine_is_generated_in_blocks(spark):
    log = events(spark, [(1, "a", 9_999, 7)])
    spine = snapshots.iteration_spine(members(spark, ["a"], 1), log, ORIGIN_MS)
    assert spine.count() == 10_000 and spine.select("iteration").distinct().count() == 10_000


def test_pv_in_two_snapshots(spark):
    log = events(spark, [(1, "a", 3, 7)])
    both = members(spark, ["a"], 10).union(members(spark, ["a"], 2, snapshot="other"))
    got = snapshots.recurring_buffered(log, both, ORIGIN_MS, complete=False)
    assert rows(got.select("snapshot_name", "iteration")) == [("other", 2), ("snap", 1)]


def trigger_table(spark, times, snapshot="snap"):
    return spark.createDataFrame(
        [(snapshot, i, at(ms)) for i, ms in enumerate(times)],
        "snapshot_name STRING, trigger_id BIGINT, ts TIMESTAMP_NTZ",
    )


@common
@given(
    items=log_items, times=st.lists(st.integers(-10, 210), min_size=1, max_size=6),
    window=st.integers(1, 60), segment=st.sampled_from([None, 7, 50]),
)
def test_triggered_snapshots_equal_the_definition(spark, items, times, window, segment):
    items = numbered(items)
    log, listed = events(spark, items), members(spark, PVS, window)
    asked = trigger_table(spark, times)
    rank = {i: n for n, (_, i) in enumerate(sorted((ms, i) for i, ms in enumerate(times)), 1)}
    ordered = sorted(items, key=lambda r: (r[2], r[0]))

    normal = triggered.triggered_normal(asked, listed, log, segment).collect()
    expected = {}
    for i, ms in enumerate(times):
        for pv in PVS:
            seen = [seq for seq, name, when, _ in ordered if name == pv and when <= ms]
            expected[i, pv] = (rank[i], seen[-1] if seen else None)
    assert {(r.trigger_id, r.pv_name): (r.iteration, r.value_seq) for r in normal} == expected

    buffered = triggered.triggered_buffered(asked, listed, log, segment).collect()
    expected = set()
    for i, ms in enumerate(times):
        for pv in PVS:
            inside = [seq for seq, name, when, _ in items if name == pv and ms - window < when <= ms]
            expected |= {(i, rank[i], pv, seq) for seq in inside or [None]}
    assert {(r.trigger_id, r.iteration, r.pv_name, r.seq) for r in buffered} == expected
    assert len(buffered) == len({(r.trigger_id, r.pv_name, r.seq) for r in buffered})


def test_two_triggers_give_two_snapshots(spark):
    log = events(spark, [(1, "a", 0, 1), (2, "b", 5, 2), (3, "a", 20, 3)])
    got = triggered.triggered_normal(trigger_table(spark, [10, 30]), members(spark, PVS, 1000), log)
    assert rows(got.select("iteration", "pv_name", "value")) == [
        (1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0), (2, "b", 2.0)]


def test_life_cycle(spark):
    log = events(spark, [(1, "a", 0, 1), (2, "a", 25, 2), (3, "a", 45, 3)])
    commands = spark.createDataFrame(
        [("snap", kind, i, at(ms)) for i, (kind, ms) in enumerate(
            [("trigger", 5), ("start", 10), ("trigger", 20), ("trigger", 30), ("stop", 40), ("trigger", 50),
             ("start", 60), ("trigger", 70)])],
        "snapshot_name STRING, command STRING, trigger_id BIGINT, ts TIMESTAMP_NTZ",
    )
    got = triggered.triggered_life_cycle(commands, members(spark, ["a"], 1000), log)
    assert rows(got.select("trigger_id", "iteration", "value")) == [(2, 1, None), (3, 2, 2.0), (7, 1, None)]


def test_the_spine_is_made_by_as_many_tasks_as_its_entries_need(spark, monkeypatch):
    monkeypatch.setattr(snapshots, "SPINE_ROWS", 50)
    log = events(spark, [(1, "p0", 0, 1), (2, "p0", 999, 2)])
    listed = members(spark, [f"p{i}" for i in range(40)], 10)
    spine = snapshots.iteration_spine(listed, log, ORIGIN_MS)
    sizes = [r.n for r in spine.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    # 40 PVs of one block each; a block is not split, and no task has more than a few of them.
    assert sum(sizes) == 4000 and len(sizes) > 20 and max(sizes) <= 500
