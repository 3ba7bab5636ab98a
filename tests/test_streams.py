"""Streams against their batch twins, over several files."""

import random
from collections import defaultdict

import pyarrow as pa
import pytest
from helpers import ORIGIN_MS, at, events, members, rows
from pyspark.sql import functions as F

from pvspark import schemas
from pvspark.operators import latest, reassembly, routing, snapshots, subscriptions, traffic, triggered
from pvspark.sources.live import as_event_time, file_stream
from pvspark.streaming import delivery, keyed, outcomes, stateful, windows
from pvspark.streaming.outcomes import REPLY, REQUEST

PVS = ["a", "b"]
ITEMS = [(i, "abax"[i % 4], (i * 37) % 1000, i) for i in range(60)]


def replay(spark, df, order, tmp_path, files=3):
    """The rows as a stream of files that keep the order of ``order``."""
    folder = str(tmp_path / "in")
    data = sorted(df.collect(), key=lambda r: r[order])
    size = -(-len(data) // files)
    for start in range(0, len(data), size):
        part = spark.createDataFrame(data[start : start + size], df.schema)
        part.coalesce(1).write.mode("append").parquet(folder)
    return file_stream(spark, folder, df.schema, max_files=1)


def event_replay(spark, log, tmp_path, files=3):
    return as_event_time(replay(spark, log, "ts", tmp_path, files))


def test_monitor_stream(spark, tmp_path):
    log = events(spark, ITEMS)
    subscribed = spark.createDataFrame([("a",)], "pv_name STRING")
    stream = keyed.monitor_stream(event_replay(spark, log, tmp_path), subscribed)
    got = delivery.run_append(spark, stream.select("seq"), "t")
    assert rows(got) == rows(subscriptions.monitor(log, subscribed).select("seq"))


def test_latest_stream(spark, tmp_path):
    log = events(spark, ITEMS)
    out = delivery.run_update(spark, keyed.latest_stream(event_replay(spark, log, tmp_path)), "t")
    got = latest.newest(out, ["pv_name"], ["batch_id"], ["seq", "value"])
    assert rows(got) == rows(latest.latest_values(log).select("pv_name", "seq", "value"))
    assert out.select("batch_id").distinct().count() == 3


def test_state_stream(spark, tmp_path):
    writes = spark.createDataFrame(
        [("p", "xy"[i % 2], at(i % 7), i, float(i)) for i in range(20)],
        "pv_name STRING, field STRING, ts TIMESTAMP_NTZ, seq BIGINT, value DOUBLE")
    out = delivery.run_update(spark, keyed.state_stream(event_replay(spark, writes, tmp_path)), "t")
    got = latest.newest(out, ["pv_name", "field"], ["batch_id"], ["seq", "value"])
    assert rows(got) == rows(latest.put_state(writes).select("pv_name", "field", "seq", "value"))


def test_members_with_different_windows_share_a_stream(spark, tmp_path):
    rng = random.Random(8)
    items = [(i, rng.choice("abx"), rng.randrange(2000), i) for i in range(200)]
    # Rows come in up to 150 ms late and across files; the last one closes every window.
    log = events(spark, items + [(1000, "a", 9000, 0)])
    late = {i: ms + rng.randrange(150) for i, _, ms, _ in items}
    arrival = spark.createDataFrame([*late.items(), (1000, 10**6)], "seq BIGINT, arrives BIGINT")
    stream = as_event_time(replay(spark, log.join(arrival, "seq"), "arrives", tmp_path, 6))
    listed = members(spark, PVS, 100, 30, snapshot="short").unionByName(members(spark, PVS, 700, 0, snapshot="long"))
    listed = listed.unionByName(members(spark, ["b"], 250, 400, snapshot="gaps"))
    got = delivery.run_append(
        spark, windows.recurring_members_stream(stream.drop("arrives"), listed, ORIGIN_MS, lateness_ms=150), "t")
    batch = snapshots.recurring_normal(log, listed, ORIGIN_MS, complete=False)
    columns = ["snapshot_name", "iteration", "pv_name", "header_timestamp", "tail_timestamp", "timestamp", "value", "value_seq", "n_events"]
    want = rows(batch.where(F.col("tail_timestamp") < ORIGIN_MS + 8000).select(columns))
    assert rows(got.select(columns)) == want
    assert {r[0] for r in want} == {"short", "long", "gaps"}


@pytest.mark.parametrize("delay", [0, 30])
def test_recurring_streams(spark, tmp_path, delay):
    # A last row far ahead, in a window and of a listed PV, closes all others.
    sentinel = [(1000, "a", 10 * (100 + delay), 0)]
    log = events(spark, ITEMS + sentinel)
    stream = event_replay(spark, log, tmp_path)
    listed = members(spark, PVS, 100, delay)
    batch = snapshots.recurring_normal(log, listed, ORIGIN_MS, complete=False)
    closed = F.col("header_timestamp") < ORIGIN_MS + 10 * (100 + delay)
    columns = ["snapshot_name", "iteration", "pv_name", "header_timestamp", "tail_timestamp", "value", "n_events"]
    got = delivery.run_append(spark, windows.recurring_stream(stream, listed, ORIGIN_MS, 100, delay), "t")
    assert rows(got.select(columns)) == rows(batch.where(closed).select(columns))

    lists = snapshots.buffered_lists(log, listed, ORIGIN_MS, complete=False)
    got = delivery.run_append(
        spark, windows.recurring_stream(stream, listed, ORIGIN_MS, 100, delay, kind="timedbuffered"), "t")
    columns = ["iteration", "pv_name", "values"]
    assert rows(got.select(columns)) == rows(lists.where(closed).select(columns))

    long = windows.buffered_stream(stream, listed, ORIGIN_MS)
    columns = ["iteration", "pv_name", "push_index", "seq", "tail_timestamp"]
    expected = snapshots.recurring_buffered(log, listed, ORIGIN_MS, complete=False)
    assert rows(delivery.run_append(spark, long, "t").select(columns)) == rows(expected.select(columns))


def test_sub_push_stream(spark, tmp_path):
    log = events(spark, ITEMS + [(1000, "a", 2000, 0)])
    # 100 ms windows in pushes of 30: the last push of a window is short.
    listed = members(spark, PVS, 100, 20, push=30)
    batch = snapshots.sub_push_batches(log, listed, ORIGIN_MS).where(F.col("header_timestamp") < ORIGIN_MS + 1900)
    got = delivery.run_append(
        spark, windows.sub_push_stream(event_replay(spark, log, tmp_path), listed, ORIGIN_MS, 100, 30, 20), "t")
    columns = ["snapshot_name", "iteration", "push_index", "pv_name", "values"]
    assert rows(got.select(columns)) == rows(batch.select(columns))


def test_bad_stream_parameters(spark):
    log, listed = events(spark, ITEMS), members(spark, PVS, 100)
    with pytest.raises(ValueError):
        windows.recurring_stream(log, listed, ORIGIN_MS, 0)
    with pytest.raises(ValueError):
        windows.recurring_stream(log, listed, ORIGIN_MS, 10, kind="other")
    with pytest.raises(ValueError):
        windows.sub_push_stream(log, listed, ORIGIN_MS, 10, 0)


def commands(spark, items):
    return spark.createDataFrame(
        [("snap", kind, i, at(ms)) for i, (kind, ms) in enumerate(items)],
        "snapshot_name STRING, command STRING, trigger_id BIGINT, ts TIMESTAMP_NTZ")


def both(spark, log, orders, tmp_path, files, late=0, seed=1):
    """Events and commands as two streams of files; rows come up to ``late`` ms behind their time.

    The last file holds an event far ahead, whose watermark closes all that came before.
    """
    rng = random.Random(seed)
    streams = []
    for name, df in (("e", log), ("c", orders)):
        parts = [[] for _ in range(files)]
        for row in df.collect():
            came = (row["ts"] - at(0)).total_seconds() * 1000 + rng.uniform(0, late)
            parts[min(files - 1, int(came * files / 1000))].append(row)
        for part in parts:
            rng.shuffle(part)
            spark.createDataFrame(part, df.schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        end = df.schema.names
        last = {"seq": 10**6, "pv_name": "a", "ts": at(10**6), "ts_ms": ORIGIN_MS + 10**6, "value": 0.0,
                "snapshot_name": "snap", "command": "end", "trigger_id": 10**6}
        spark.createDataFrame([tuple(last[c] for c in end)] if name == "e" else [], df.schema).coalesce(1).write.mode(
            "append").parquet(str(tmp_path / name))
        streams.append(as_event_time(file_stream(spark, str(tmp_path / name), df.schema, max_files=1)))
    return streams


IN_ANY_ORDER = pytest.mark.parametrize("files, late, seed", [(1, 0, 1), (5, 300, 3)])


@IN_ANY_ORDER
def test_triggered_streams(spark, tmp_path, files, late, seed):
    log = events(spark, ITEMS)
    orders = commands(spark, [("trigger", ms) for ms in (5, 130, 131, 400, 990)])
    asked = orders.select("snapshot_name", "trigger_id", "ts")
    listed = members(spark, [*PVS, "silent"], 150)
    live, triggers = both(spark, log, orders, tmp_path, files, late, seed)
    columns = ["trigger_id", "iteration", "pv_name"]

    got = delivery.run_append(spark, stateful.triggered_stream(live, triggers, listed, lateness_ms=late), "t")
    expected = triggered.triggered_normal(asked, listed, log)
    assert rows(got.select(*columns, "seq")) == rows(expected.select(*columns, "value_seq"))

    got = delivery.run_append(
        spark, stateful.triggered_stream(live, triggers, listed, kind="timedbuffered", lateness_ms=late), "t")
    expected = triggered.triggered_buffered(asked, listed, log)
    assert rows(got.select(*columns, "seq")) == rows(expected.select(*columns, "seq"))
    assert {"silent"} == {r.pv_name for r in got.where("seq IS NULL").collect() if r.trigger_id == 4}


def finished(stream, tmp_path):
    """The last progress of a stream that ran over all its input."""
    query = (
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    query.awaitTermination()
    return query.lastProgress


def test_a_key_is_one_row_of_the_state(spark, tmp_path):
    log = events(spark, ITEMS)
    orders = commands(spark, [("trigger", ms) for ms in (130, 400, 990)])
    live, triggers = both(spark, log, orders, tmp_path, 2, 0)
    listed = members(spark, PVS, 150)
    last = finished(stateful.triggered_stream(live, triggers, listed, kind="timedbuffered"), tmp_path)
    assert last["stateOperators"][0]["numRowsTotal"] == len(PVS)


def test_nulls_of_ordered_rows(spark, tmp_path):
    log = spark.createDataFrame(
        [(None, "a", at(10), 1.0), (2**60 + 1, "a", at(20), 2.0), (3, "a", None, 3.0), (4, "a", at(9000), 4.0)],
        "seq BIGINT, pv_name STRING, ts TIMESTAMP_NTZ, value DOUBLE")
    orders = spark.createDataFrame(
        [("snap", "trigger", 1, at(15)), ("snap", "trigger", None, at(30))],
        "snapshot_name STRING, command STRING, trigger_id BIGINT, ts TIMESTAMP_NTZ")
    live, triggers = (replay(spark, df, "value" if df is log else "ts", tmp_path / n, 1) for n, df in (("e", log), ("c", orders)))
    got = delivery.run_append(
        spark, stateful.triggered_stream(as_event_time(live), as_event_time(triggers), members(spark, ["a"], 150)), "t")
    assert rows(got.select("trigger_id", "iteration", "seq", "value")) == [(1, 1, None, 1.0), (None, 2, 2**60 + 1, 2.0)]


def test_what_the_watermark_has_not_passed_waits(spark, tmp_path):
    log = events(spark, [(1, "a", 10, 1), (2, "a", 500, 2)])
    orders = commands(spark, [("trigger", 100), ("trigger", 450)])
    listed = members(spark, ["a"], 150)
    for name, df in (("e", log), ("c", orders)):
        df.coalesce(1).write.parquet(str(tmp_path / name))
    live, triggers = (
        as_event_time(file_stream(spark, str(tmp_path / name), df.schema)) for name, df in (("e", log), ("c", orders)))
    got = delivery.run_append(spark, stateful.triggered_stream(live, triggers, listed, lateness_ms=200), "t")
    assert rows(got.select("trigger_id", "seq")) == [(0, 1)]


def test_rows_later_than_allowed_change_nothing(spark, tmp_path):
    schema = events(spark, []).schema
    for part in ([(1, "a", 10, 1), (3, "a", 5000, 3)], [(4, "a", 6000, 4)], [(2, "a", 20, 2), (5, "a", 9000, 5)]):
        events(spark, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "e"))
    commands(spark, [("trigger", 100), ("trigger", 5500)]).coalesce(1).write.parquet(str(tmp_path / "c"))
    live = as_event_time(file_stream(spark, str(tmp_path / "e"), schema, max_files=1))
    triggers = as_event_time(file_stream(spark, str(tmp_path / "c"), commands(spark, []).schema, max_files=1))
    got = delivery.run_append(spark, stateful.triggered_stream(live, triggers, members(spark, ["a"], 150)), "t")
    assert rows(got.select("trigger_id", "iteration", "seq")) == [(0, 1, 1), (1, 2, 3)]


@IN_ANY_ORDER
def test_life_cycle_stream(spark, tmp_path, files, late, seed):
    log = events(spark, ITEMS)
    orders = commands(
        spark, [("trigger", 5), ("start", 10), ("trigger", 200), ("trigger", 500), ("stop", 510), ("trigger", 600),
                ("start", 700), ("trigger", 701), ("start", 800), ("trigger", 990)])
    listed = members(spark, PVS, 150)
    live, controls = both(spark, log, orders, tmp_path, files, late, seed)
    got = delivery.run_append(
        spark, stateful.triggered_stream(live, controls, listed, needs_start=True, lateness_ms=late), "t")
    expected = triggered.triggered_life_cycle(orders, listed, log)
    columns = ["trigger_id", "iteration", "pv_name"]
    assert rows(got.select(*columns, "seq")) == rows(expected.select(*columns, "value_seq"))
    assert {r.trigger_id for r in got.collect()} == {2, 3, 7, 9}


@pytest.mark.parametrize("files", [1, 5])
def test_reassembly_stream(spark, tmp_path, files):
    items = []
    for i in range(1, 8):
        items += [("t", 0, i, None), ("t", 1, i, "a"), ("t", 1, i + 50, "b"), ("t", 1, i, None), ("u", 0, i, None)]
        items += [("t", 2, i, None)] if i != 5 else []
        items += [("u", 2, i, None), ("t", None, i, "a")]
    records = spark.createDataFrame(
        [(t, i, kind, it, 100 + i, pv, float(i) if pv else None) for i, (t, kind, it, pv) in enumerate(items)],
        "topic STRING, offset BIGINT, message_type INT, iter_index BIGINT, timestamp_ms BIGINT, pv_name STRING, value DOUBLE")
    out = delivery.run_append(
        spark, stateful.reassembly_stream(replay(spark, records, "offset", tmp_path, files)), "t")
    columns = ["topic", "header_offset", "iteration", "header_timestamp", "tail_timestamp", "offset", "pv_name", "value"]
    expected = reassembly.reassemble(records, "exact").select(columns)
    assert rows(out.select(columns)) == rows(expected)
    closed = reassembly.exact_epochs(records).select("topic", "header_offset", "tail_offset")
    assert rows(out.where("pv_name IS NULL").select("topic", "header_offset", "offset")) == rows(closed)


def test_request_reply_stream(spark, tmp_path):
    requests = spark.createDataFrame(
        [("ok", at(0), 100), ("err", at(10), 100), ("late", at(20), 50), ("none", at(30), 100), ("pend", at(40), None),
         ("two", at(50), 100), ("last", at(100_000), 100)],
        "reply_id STRING, ts TIMESTAMP_NTZ, timeout_ms BIGINT").withColumn("pv_name", F.lit("p"))
    replies = spark.createDataFrame(
        [("ok", at(60), 0), ("err", at(70), 4), ("late", at(75), 0), ("two", at(90), 2), ("two", at(80), 0),
         ("end", at(100_000), 0)],
        "reply_id STRING, ts TIMESTAMP_NTZ, error INT").withColumns({"message": F.lit("m"), "value": F.lit(1.0)})
    (tmp_path / "q").mkdir(), (tmp_path / "r").mkdir()
    stream = keyed.correlate_stream(
        event_replay(spark, requests, tmp_path / "q", 2), event_replay(spark, replies, tmp_path / "r", 2), 100)
    got = {r["reply_id"]: (r["status"], r["error"], r["latency_ms"]) for r in delivery.run_append(spark, stream, "t").collect()}
    assert got == {"ok": ("ok", 0, 60), "err": ("error", 4, 60), "late": ("timeout", None, None),
                   "none": ("timeout", None, None), "pend": ("pending", None, None), "two": ("ok", 0, 30)}


REQUESTS = "reply_id STRING, pv_name STRING, ts TIMESTAMP_NTZ, timeout_ms BIGINT"
REPLIES = "reply_id STRING, ts TIMESTAMP_NTZ, error INT, message STRING"


def asked_and_answered(spark, requests, replies, tmp_path, files=1, late=0, seed=1):
    """Requests and replies (``ts`` in ms) as two streams of files; rows come up to ``late`` ms behind their time.

    The last file of each has a row far ahead, whose watermark closes all that came before.
    """
    rng = random.Random(seed)
    streams = []
    for schema, items, when, end in (
        (REQUESTS, requests, 2, ("end", "p", 10**6, 1)), (REPLIES, replies, 1, ("end", 10**6, 0, "m"))
    ):
        parts = [[] for _ in range(files)] + [[end]]
        for item in items:
            came = (item[when] or 0) + rng.uniform(0, late)
            parts[max(0, min(files - 1, int(came * files / 1000)))].append(item)
        folder = str(tmp_path / schema.split()[-2])
        for part in parts:
            rng.shuffle(part)
            rows_of = [(*r[:when], None if r[when] is None else at(r[when]), *r[when + 1:]) for r in part]
            spark.createDataFrame(rows_of, schema).coalesce(1).write.mode("append").parquet(folder)
        streams.append(as_event_time(file_stream(spark, folder, spark.createDataFrame([], schema).schema, max_files=1)))
    return streams


def outcomes_by_definition(requests, replies, bound):
    def order(reply):
        _, when, error, message = reply
        return when, error is not None, error or 0, message is not None, message or ""

    out = []
    for reply_id, pv, when, timeout in set(requests):
        until = when + (bound if timeout is None else min(bound, timeout))
        timely = [r for r in replies if r[0] is not None and r[0] == reply_id and when <= r[1] <= until]
        first = min(timely, key=order, default=None)
        if first is None:
            out.append((reply_id, pv, at(when), "pending" if timeout is None else "timeout", None, None, None))
        else:
            error = first[2] or 0
            out.append((reply_id, pv, at(when), "error" if error else "ok", error, first[3], first[1] - when))
    return sorted(out, key=repr)


@IN_ANY_ORDER
def test_first_replies_of_repeated_requests(spark, tmp_path, files, late, seed):
    rng = random.Random(seed)
    ids = [None, *(f"r{i}" for i in range(12))]
    requests = [(rng.choice(ids), rng.choice([None, "p", "q"]), rng.randrange(1, 999), rng.choice([None, 0, 40, 100]))
                for _ in range(80)]
    requests += rng.choices(requests, k=20)
    replies = [(rng.choice(ids), rng.randrange(1, 999), rng.choice([None, 0, 4]), rng.choice([None, "m", "n\u00e9"]))
               for _ in range(150)]
    replies += [(reply_id, when, rng.choice([None, 0, 4]), "m") for reply_id, _, when, _ in rng.choices(requests, k=30)]
    live, answers = asked_and_answered(spark, requests, replies, tmp_path, files, late, seed)
    got = delivery.run_append(spark, keyed.correlate_stream(live, answers, 100, lateness_ms=late), "t")
    assert rows(got.withColumn("requested_at", F.col("requested_at").cast("timestamp_ntz"))) == outcomes_by_definition(
        requests, replies, 100)


def test_requests_share_a_row_of_the_state(spark, tmp_path):
    requests = [(f"r{i}", "p", 1 + i % 900, 100) for i in range(300)]
    replies = [(f"r{i}", 5 + i % 900, 0, "m") for i in range(300) for _ in range(3)]
    live, answers = asked_and_answered(spark, requests, replies, tmp_path, 2)
    last = finished(keyed.correlate_stream(live, answers, 100, groups=4), tmp_path)
    assert [operator["numRowsTotal"] <= 4 for operator in last["stateOperators"]] == [True]


def test_requests_without_an_instant_or_far_off(spark, tmp_path):
    far, past = 250_000_000_000_000, -2 * 10**12
    requests = [("a", None, 1, None), (None, "p", 1, 50), ("b", "p", None, 50), ("far", "p", far, 50), ("past", "p", past, 50)]
    replies = [("a", 1, None, None), (None, 1, 1, "m"), ("b", None, 0, "m"), ("far", far, 0, "m"), ("past", past, 0, "m")]
    live, answers = asked_and_answered(spark, requests, replies, tmp_path)
    got = delivery.run_append(spark, keyed.correlate_stream(live, answers, 100), "t")
    assert rows(got.select("reply_id", "pv_name", "status", "error", "message", "latency_ms").where(
        "reply_id IS NULL OR reply_id <> 'end'")) == rows(spark.createDataFrame(
            [("a", None, "ok", 0, None, 0), (None, "p", "timeout", None, None, None)],
            "reply_id STRING, pv_name STRING, status STRING, error INT, message STRING, latency_ms BIGINT"))


def test_a_passed_reply_waits_only_with_its_request():
    waiting = [(b"a", b"p", 1000, 100, True, REQUEST), (b"b", b"p", 2000, 0, False, REQUEST), (b"b", b"m", 2500, 0, True, REPLY),
               (b"a", b"n", 3000, 0, True, REPLY), (b"a", b"m", 3000, 0, True, REPLY), (b"a", b"m", 4000, 0, True, REPLY),
               (b"c", b"m", 4000, 0, True, REPLY), (b"a", b"m", 6000, 0, True, REPLY), (b"c", b"m", 6000, 0, True, REPLY)]
    table = pa.Table.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*waiting), outcomes._WAITING)], schema=outcomes._WAITING)
    rest, done = outcomes._settle(table, 100, 5)
    assert not len(done)
    assert rest.to_pylist() == [table.to_pylist()[i] for i in (0, 1, 2, 4, 7, 8)]
    rest, done = outcomes._settle(rest, 100, 102)
    assert done[["id", "replied", "message"]].values.tolist() == [[b"a", 3000, b"m"]]
    assert [r["id"] for r in rest.to_pylist()] == [b"b", b"b"]


def test_a_join_of_streams_has_one_store_a_partition(spark, tmp_path):
    requests = spark.createDataFrame([("r", "p", at(0), 100)], "reply_id STRING, pv_name STRING, ts TIMESTAMP_NTZ, timeout_ms BIGINT")
    replies = spark.createDataFrame([("r", at(60), 0, "m")], "reply_id STRING, ts TIMESTAMP_NTZ, error INT, message STRING")
    (tmp_path / "q").mkdir(), (tmp_path / "r").mkdir()
    stream = keyed.correlate_stream(
        event_replay(spark, requests, tmp_path / "q", 1), event_replay(spark, replies, tmp_path / "r", 1), 100)
    finished(stream, tmp_path)
    folders = [path.name for path in (tmp_path / "ck" / "state").rglob("*") if path.is_dir()]
    assert folders and not [name for name in folders if "key" in name.lower()]


def test_rows_reach_user_code(spark, tmp_path):
    log = events(spark, ITEMS)
    target = tmp_path / "seen"
    target.mkdir()

    def handler(name, value):
        (target / f"{name}-{value}").touch()

    delivery.deliver_rows(
        event_replay(spark, log, tmp_path), handler, str(tmp_path / "ck"), availableNow=True).awaitTermination()
    assert len(list(target.iterdir())) == len(ITEMS)


def test_batches_reach_user_code_whole(spark, tmp_path):
    log = events(spark, ITEMS)
    seen = defaultdict(int)

    def handler(batch, batch_id):
        seen[batch_id] += batch.count()

    delivery.deliver_batches(
        event_replay(spark, log, tmp_path), handler, str(tmp_path / "ck"), availableNow=True).awaitTermination()
    assert dict(seen) == {0: 20, 1: 20, 2: 20}


@IN_ANY_ORDER
def test_delivery_while_active_stream(spark, tmp_path, files, late, seed):
    log = events(spark, ITEMS)
    orders = spark.createDataFrame(
        [(pv, at(ms), 1000 + i, kind) for i, (pv, ms, kind) in enumerate(
            [("a", 100, "start"), ("a", 300, "start"), ("a", 500, "stop"), ("b", 10, "stop"), ("a", 800, "start"), ("b", 900, "start")])],
        "pv_name STRING, ts TIMESTAMP_NTZ, seq BIGINT, command STRING")
    live, controls = both(spark, log, orders, tmp_path, files, late, seed)
    got = delivery.run_append(spark, stateful.delivery_stream(live, controls, lateness_ms=late), "t")
    assert rows(got.select("seq")) == rows(subscriptions.deliver_while_active(log, orders).select("seq"))


@pytest.mark.parametrize("files", [1, 3])
def test_one_shot_stream(spark, tmp_path, files):
    bodies = ['"a":1', '"error":0,"b":2', '"a":1,"b":2', '"a":3', '"error":1', '"a":9', '"error":1']
    log = spark.createDataFrame(
        [(i, f'{{"reply_id":"{name}",{body}}}', name) for i, (name, body) in enumerate(
            [("s", body) for body in bodies] + [("open", '"a":1'), ("empty", '"error":2')])],
        "offset BIGINT, value STRING, msg_id STRING")
    out = delivery.run_append(spark, stateful.assembly_stream(replay(spark, log, "offset", tmp_path, files)), "t")
    columns = ["msg_id", "offset", "pv_name", "value"]
    assert rows(out.select(columns)) == rows(routing.assemble_snapshots(log).select(columns))
    assert rows(out.where("pv_name IS NULL").select("msg_id", "offset")) == [("empty", 8), ("s", 4)]


def test_one_shot_snapshots_share_rows_of_the_state(spark, tmp_path):
    log = spark.createDataFrame(
        [(i * 100 + j, f'{{"reply_id":"s","error":{int(j == 2 and i % 2)},"a":{j}}}', None if i == 99 else f"s{i}")
         for i in range(100) for j in range(3)],
        "offset BIGINT, value STRING, msg_id STRING")
    stream = stateful.assembly_stream(replay(spark, log, "offset", tmp_path, 3), groups=4)
    last = finished(stream, tmp_path)
    assert last["stateOperators"][0]["numRowsTotal"] <= 4
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 150 and got.where("msg_id IS NULL").count() == 3
    assert got.where("pv_name IS NULL").count() == 50


def test_traffic_stream(spark, tmp_path):
    log = spark.createDataFrame(
        [("tu"[i % 2], at(i * 40), "x" * i) for i in range(30)], "topic STRING, ts TIMESTAMP_NTZ, value STRING")
    got = delivery.run_append(spark, windows.traffic_stream(event_replay(spark, log, tmp_path), 100), "t")
    expected = traffic.traffic_report(log, 100).where(F.col("bucket_start_ms") < ORIGIN_MS + 1100)
    assert rows(got) == rows(expected)


def test_replies_on_a_stream(spark, tmp_path):
    log = spark.createDataFrame(
        [("x", 0, i, at(i), "json", body) for i, body in enumerate(
            ['{"reply_id":"r","p":{"value":1}}', '{"reply_id":"q","error":3,"message":"m"}', '{"reply_id":"k","publishing_topic":"snap"}'])],
        schemas.MESSAGES)
    nothing = spark.createDataFrame([], "reply_id STRING, pv_name STRING, topic STRING")
    requests = spark.createDataFrame([("r", "p"), ("q", "p"), ("k", "p")], "reply_id STRING, pv_name STRING")
    for routed in (
        routing.route(log, requests, nothing, nothing, nothing),
        delivery.run_append(spark, routing.route(replay(spark, log, "offset", tmp_path), requests, nothing, nothing, nothing), "t"),
    ):
        assert rows(routing.get_results(routed, requests).select("reply_id", "result")) == [
            ("k", '{"reply_id":"k","publishing_topic":"snap"}'), ("q", None), ("r", '{"value":1}')]
        assert rows(routing.acknowledged_topics(routed)) == [("k", "snap")]
