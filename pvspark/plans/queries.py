"""Registered queries: each operator over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pvspark.functions.timing import epoch_ms
from pvspark.functions.uri import uri_pv_name
from pvspark.operators import (
    catalog as catalogs,
    correlate,
    latest,
    projection,
    reassembly,
    routing,
    snapshots,
    spec_snapshots,
    specs,
    subscriptions as subs,
    tables,
    traffic,
    triggered,
)
from pvspark.plans import bindings as b
from pvspark.session import materialise, scratch_path, tune
from pvspark.sources import commands as cmd, event_log
from pvspark.streaming import delivery, keyed, stateful, windows as stream_windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tune(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


# --- sources and sinks ----------------------------------------------------------------


@query
def event_log_scan(spark, d):
    return b.pv_events(spark, d).select("seq", "pv_name", "protocol", "ts_ms", "value", "fields")


@query
def replay_from_timestamp(spark, d):
    return event_log.replay_from(b.messages(spark, d), F.expr(b.INSTANT)).select(
        "topic", F.col("partition").cast("bigint").alias("partition"), "offset", "start_offset"
    )


@query
def replay_start_offsets(spark, d):
    return event_log.start_offsets(b.messages(spark, d), F.expr(b.INSTANT)).select(
        "topic", F.col("partition").cast("bigint").alias("partition"), "start_offset"
    )


@query
def pv_list_file(spark, d):
    lines = b.table(spark, d, "customer").select(
        F.when(F.col("c_acctbal") < 0, "  \t")
        .otherwise(
            F.concat(F.lit("  pva://"), F.replace("c_name", F.lit("#"), F.lit(":")), F.lit("\t "))
        )
        .alias("line")
    )
    path = scratch_path(spark, "pv-list")
    lines.write.text(path)
    return catalogs.parse_uris(event_log.read_pv_list(spark, path))


def _address(name):
    return F.concat(F.lit("pva://"), F.col(name))


def _command_rows(exported: DataFrame) -> DataFrame:
    """Parse exported commands back, so that fields and not texts are compared."""
    texts = [
        "command", "serialization", "reply_topic", "reply_id", "pv_name", "value", "activate",
        "monitor_dest_topic", "snapshot_name", "type", "respect_push_order", "triggered",
        "time_window_msec", "repeat_delay_msec", "sub_push_delay_msec",
    ]
    body = F.from_json("value", "map<string,string>")
    return exported.select(body.alias("body")).select(
        *[F.col("body")[name].alias(name) for name in texts],
        F.json_array_length(F.col("body")["pv_name_list"]).cast("bigint").alias("n_pvs"),
        F.json_array_length(F.col("body")["pv_field_filter_list"]).cast("bigint").alias("n_fields"),
        F.size("body").cast("bigint").alias("n_keys"),
    )


@query
def command_export(spark, d):
    def keyed_by(df, kind, *names):
        return df.withColumn("reply_id", cmd.request_id(F.lit(kind), *[F.col(n) for n in names]))

    catalog = b.catalog(spark, d).withColumn("pv_uri", _address("pv_name"))
    listed = b.subscriptions(spark, d).withColumn("pv_uri", _address("pv_name"))
    puts = b.table(spark, d, "orders").select(
        F.concat(F.lit("pva://cust:"), F.col("o_custkey").cast("string")).alias("pv_uri"),
        F.col("o_orderstatus").alias("value"),
        "o_orderkey",
    )
    spec = b.spec_table(spark, d).withColumn(
        "pv_field_filter_list",
        F.when(F.col("snapshot_name") == "snap_0", F.array(F.lit("value"), F.lit("timeStamp")))
        .otherwise(F.array().cast("array<string>")),
    )
    jobs = {
        "get": keyed_by(catalog, "get", "pv_name"),
        "monitor": keyed_by(listed, "monitor", "pv_name"),
        "multi-monitor": keyed_by(spec, "multi-monitor", "snapshot_name"),
        "put": keyed_by(puts, "put", "o_orderkey"),
        "snapshot": keyed_by(spec, "snapshot", "snapshot_name"),
        "repeating_snapshot": keyed_by(spec, "repeating_snapshot", "snapshot_name"),
        "repeating_snapshot_trigger": keyed_by(spec, "repeating_snapshot_trigger", "snapshot_name"),
        "repeating_snapshot_stop": keyed_by(spec, "repeating_snapshot_stop", "snapshot_name"),
    }
    result = None
    for kind, requests in jobs.items():
        exported = cmd.export_commands(requests, kind, "demo")
        result = exported if result is None else result.unionByName(exported)
    return _command_rows(result)


# --- projections, filters, predicates -----------------------------------------------------


@query
def uri_catalog(spark, d):
    return catalogs.parse_uris(b.uris(spark, d)).select(
        F.col("list_id").cast("bigint").alias("list_id"), "uri", "protocol", "pv_name", "status"
    )


@query
def pv_catalog(spark, d):
    return catalogs.pv_catalog(b.uris(spark, d)).select(
        "pv_name", F.array_join("protocols", ",").alias("protocols")
    )


@query
def uri_list_report(spark, d):
    return catalogs.list_report(b.uris(spark, d)).withColumn(
        "list_id", F.col("list_id").cast("bigint")
    )


@query
def topic_map(spark, d):
    return catalogs.topic_map(b.colliding_names(spark, d))


@query
def topic_collisions(spark, d):
    return catalogs.topic_collisions(b.colliding_names(spark, d))


@query
def spec_validation(spark, d):
    return specs.validate_specs(b.part_specs(spark, d)).select("p_partkey", "snapshot_name", "error")


@query
def field_projection(spark, d):
    kept = projection.project_fields(b.pv_events(spark, d), ["k"])
    return projection.extract_field(kept, "k", "bigint", strict=True).select("seq", "pv_name", "k", "fields")


@query
def field_projection_struct(spark, d):
    events = b.pv_events(spark, d).withColumn(
        "fields", F.struct("value", F.col("ts_ms").alias("timeStamp"), "event_type", "protocol")
    )
    return projection.project_fields(events, ["value", "timeStamp"]).select("seq", "fields.*")


@query
def envelope_demux(spark, d):
    return _routed(spark, d).select("offset", "msg_id", "route", "message_size")


def _routed(spark, d, log=None):
    return routing.route(
        b.envelopes(spark, d) if log is None else log,
        b.pending_replies(spark, d),
        b.subscriptions(spark, d),
        b.open_snapshots(spark, d),
        b.recurring_topics(spark, d),
    )


@query
def demuxed_monitor_values(spark, d):
    return routing.monitor_values(_routed(spark, d)).select(
        "pv_name", "offset", F.get_json_object("value", "$.value").cast("double").alias("value")
    )


@query
def get_results(spark, d):
    rows = routing.get_results(_routed(spark, d), b.get_requests(spark, d))
    value = F.get_json_object("result", "$.value").try_cast("double")
    return rows.select(
        "reply_id", "pv_name", "offset", value.alias("value"),
        F.get_json_object("result", "$.reply_id").alias("whole_reply_id"),
    )


@query
def get_outcomes(spark, d):
    rows = routing.get_outcomes(_routed(spark, d), b.get_requests(spark, d))
    value = F.get_json_object("result", "$.value").try_cast("double")
    return rows.select("reply_id", "pv_name", "status", "offset", "error", "message", value.alias("value"))


# --- joins ------------------------------------------------------------------------------


@query
def monitor(spark, d):
    return subs.monitor(b.pv_events(spark, d), b.subscriptions(spark, d)).select(
        "seq", "pv_name", "ts_ms", "value"
    )


@query
def new_subscriptions(spark, d):
    return subs.new_subscriptions(b.catalog(spark, d), b.subscriptions(spark, d))


@query
def deliver_while_active(spark, d):
    return subs.deliver_while_active(b.value_events(spark, d), b.commands(spark, d)).select(
        "seq", "pv_name", "ts_ms", "value"
    )


@query
def monitor_command_outcomes(spark, d):
    return subs.command_outcomes(b.commands(spark, d)).select("seq", "pv_name", "command", "outcome")


@query
def request_reply(spark, d):
    rows = correlate.correlate(b.requests(spark, d), b.replies(spark, d))
    return rows.select(
        "reply_id", "pv_name", "status", F.col("error").cast("bigint").alias("error"), "message",
        "value", "latency_ms", epoch_ms(F.col("late_reply_ts")).alias("late_reply_ms"),
    )


@query
def triggered_snapshot(spark, d):
    return triggered.triggered_normal(
        b.triggers(spark, d), b.members(spark, d), b.pv_events(spark, d)
    ).select("snapshot_name", "trigger_id", "iteration", "pv_name", "value", "value_seq")


@query
def triggered_snapshot_buffered(spark, d):
    return triggered.triggered_buffered(
        b.triggers(spark, d), b.members(spark, d), b.pv_events(spark, d)
    ).select("snapshot_name", "trigger_id", "iteration", "pv_name", "seq", "value")


@query
def snapshot_life_cycle(spark, d):
    return triggered.triggered_life_cycle(
        b.life_cycle(spark, d), b.members(spark, d), b.pv_events(spark, d)
    ).select("snapshot_name", "trigger_id", "iteration", "pv_name", "value", "value_seq")


@query
def silent_pvs(spark, d):
    return catalogs.silent_pvs(b.catalog(spark, d), b.pv_events(spark, d))


@query
def pv_completion(spark, d):
    return snapshots.complete_pv_counts(b.pv_events(spark, d), b.members(spark, d), b.ORIGIN_MS)


# --- aggregations and snapshots -----------------------------------------------------------


@query
def bulk_get(spark, d):
    return latest.bulk_get(b.catalog(spark, d), b.pv_events(spark, d)).select(
        "pv_name", "seq", "value", "status"
    )


@query
def latest_values(spark, d):
    return latest.latest_values(b.pv_events(spark, d)).select(
        "pv_name", "seq", "value", epoch_ms(F.col("ts")).alias("ts_ms")
    )


@query
def snapshot_at_instant(spark, d):
    return latest.snapshot_at(
        b.pv_events(spark, d), b.subscriptions(spark, d), F.expr(b.INSTANT)
    ).select("pv_name", "seq", "value", F.col("error").cast("bigint").alias("error"))


@query
def one_shot_snapshot(spark, d):
    rows = routing.assemble_snapshots(b.one_shot_messages(spark, d))
    return rows.select("msg_id", "offset", "pv_name", F.col("value").cast("double").alias("value"))


_WINDOW = ["snapshot_name", "iteration", "pv_name", "header_timestamp", "tail_timestamp"]


@query
def recurring_normal(spark, d):
    return snapshots.recurring_normal(
        b.pv_events(spark, d), b.members(spark, d), b.ORIGIN_MS
    ).select(*_WINDOW, "value", "n_events")


@query
def recurring_normal_carried(spark, d):
    return snapshots.recurring_normal(
        b.pv_events(spark, d), b.members(spark, d), b.ORIGIN_MS, carry_forward=True
    ).select(*_WINDOW, "value", "n_events")


@query
def recurring_buffered(spark, d):
    return snapshots.recurring_buffered(
        b.pv_events(spark, d), b.members(spark, d), b.ORIGIN_MS
    ).select(*_WINDOW, "seq", "value")


@query
def recurring_from_specs(spark, d):
    members = specs.snapshot_members(b.spec_table(spark, d))
    return snapshots.recurring_buffered(b.pv_events(spark, d), members, b.ORIGIN_MS).select(
        *_WINDOW, "push_index", "seq", "value"
    )


@query
def snapshots_from_specs(spark, d):
    return spec_snapshots.snapshots_from_specs(
        b.pv_events(spark, d), b.mixed_specs(spark, d), b.triggers(spark, d), b.ORIGIN_MS
    )


def _positions(lists: DataFrame, *columns: str, first: str | None = None) -> DataFrame:
    """One row per list item; ``first`` names the place of a part's first item."""
    start = F.col(first) if first else F.lit(0).cast("bigint")
    rows = lists.select(*columns, start.alias("__first"), F.posexplode("values").alias("__at", "value"))
    return rows.select(*columns, (F.col("__first") + F.col("__at")).alias("pos"), "value")


@query
def recurring_buffered_lists(spark, d):
    lists = snapshots.buffered_lists(b.pv_events(spark, d), b.members(spark, d), b.ORIGIN_MS)
    return _positions(lists, "snapshot_name", "iteration", "pv_name", first="first_position")


@query
def sub_push_summary(spark, d):
    return snapshots.sub_push_summary(
        b.pv_events(spark, d), b.members(spark, d, sub_push=b.PUSH_MS), b.ORIGIN_MS
    ).select(
        "snapshot_name", "iteration", "push_index", "pv_name", "n_values", "first_value", "last_value"
    )


@query
def sub_push_merged(spark, d):
    batches = snapshots.sub_push_batches(
        b.pv_events(spark, d), b.members(spark, d, sub_push=b.PUSH_MS), b.ORIGIN_MS
    )
    return snapshots.merge_pushes(batches).select("snapshot_name", "iteration", "pv_name", "pos", "value")


@query
def repeat_delay(spark, d):
    return snapshots.recurring_buffered(
        b.pv_events(spark, d), b.members(spark, d, repeat_delay=b.GAP_MS), b.ORIGIN_MS, complete=False
    ).select(*_WINDOW, "seq", "value")


@query
def snapshot_counters(spark, d):
    return snapshots.snapshot_counters(b.pv_events(spark, d), b.members(spark, d), b.ORIGIN_MS)


_REASSEMBLED = ["topic", "iteration", "header_timestamp", "tail_timestamp", "offset", "pv_name", "value"]


@query
def reassembly_robust(spark, d):
    return reassembly.reassemble(
        b.snapshot_records(spark, d), "robust"
    ).select(*_REASSEMBLED)


@query
def reassembly_exact(spark, d):
    return reassembly.reassemble(
        b.snapshot_records(spark, d), "exact"
    ).select(*_REASSEMBLED)


@query
def reassembly_listed(spark, d):
    """The values of listed PVs, with a row for each that an iteration has no value of."""
    listed = b.members(spark, d).select(F.col("snapshot_name").alias("topic"), "pv_name")
    return reassembly.reassemble(
        b.snapshot_records(spark, d), "robust", pv_list=listed
    ).select(*_REASSEMBLED)


@query
def reassembly_completed(spark, d):
    records = b.snapshot_records(spark, d)
    epochs = materialise(reassembly.robust_epochs(records))
    values = reassembly.place_data(records, epochs)
    listed = b.members(spark, d).select(F.col("snapshot_name").alias("topic"), "pv_name")
    return reassembly.completed_iterations(epochs, values, listed).select(
        "topic", "iteration", "pv_name", "n_values"
    )


@query
def put_state(spark, d):
    return latest.put_state(b.writes(spark, d)).select("pv_name", "field", "seq", "value")


@query
def put_state_wide(spark, d):
    names = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "not_specified", "5-LOW": "low"}
    return latest.put_state_wide(b.writes(spark, d), list(names)).select(
        "pv_name", *[F.col(field).alias(name) for field, name in names.items()]
    )


def _packed(spark, d):
    return tables.pack_tables(
        b.table_rows(spark, d), b.TABLE_KEYS, b.TABLE_COLUMNS, b.TABLE_ORDER,
        position=epoch_ms(F.col("l_shipdate")), widest=subs.DAY_MS,
    )


@query
def table_pack(spark, d):
    return _packed(spark, d).select(
        *b.TABLE_KEYS,
        "part",
        "first_position",
        F.array_join("labels", ",").alias("labels"),
        F.size("payload.quantity").cast("bigint").alias("n_rows"),
        F.element_at("payload.price", 1).alias("first_price"),
        F.element_at("payload.price", -1).alias("last_price"),
    )


@query
def table_unpack(spark, d):
    return tables.unpack_tables(_packed(spark, d), b.TABLE_KEYS, b.TABLE_COLUMNS)


@query
def table_set_column(spark, d):
    """Quantities become the discounts of the same table; urgent orders name no known label."""
    packed = _packed(spark, d)
    keys = [*b.TABLE_KEYS, "part"]
    orders = b.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority", "o_orderstatus"
    )
    replacements = (
        packed.select(*keys, F.col("payload.discount").alias("data"))
        .join(orders.where(F.col("o_orderstatus") != "F"), "l_orderkey")
        .select(
            *keys,
            F.lit(1).alias("seq"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "weight").otherwise("quantity").alias("label"),
            F.transform("data", lambda item: item.cast("string")).alias("data"),
        )
    )
    replaced = tables.set_columns(packed, replacements, keys, b.TABLE_COLUMNS)
    total = F.aggregate("payload.quantity", F.lit(0.0), lambda acc, item: acc + item)
    return replaced.select(*keys, "status", F.round(total, 2).alias("sum_quantity"))


@query
def traffic_by_pv_day(spark, d):
    return traffic.traffic_report(b.messages(spark, d), subs.DAY_MS, keys=("pv_name",))


@query
def traffic_by_topic(spark, d):
    return traffic.traffic_report(b.envelopes(spark, d), 3_600_000)


# --- streams: run to the end of the available input, then read the result table ----------------


def _late_events(spark: SparkSession, d: str) -> Callable[[], DataFrame]:
    """Readers of the events in several micro-batches, in which rows come late."""
    folder = b.late_event_files(spark, d)
    return lambda: b.late_event_stream(spark, d, folder)


@query
def live_source_stream(spark, d):
    stream = b.pv_event_stream(spark, d).select("seq", "pv_name", "ts", "value")
    return delivery.run_append(spark, stream, "live").select(
        "seq", "pv_name", F.unix_millis("ts").alias("ts_ms"), "value"
    )


@query
def monitor_stream(spark, d):
    stream = keyed.monitor_stream(b.pv_event_stream(spark, d), b.subscriptions(spark, d))
    return delivery.run_append(spark, stream.select("seq", "pv_name", "ts_ms", "value"), "monitor")


@query
def delivery_stream(spark, d):
    """Monitored values handed over batch by batch, through the delivery sink."""
    path = scratch_path(spark, "delivered")

    def take(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/table/batch_id={batch_id}")

    stream = keyed.monitor_stream(b.pv_event_stream(spark, d), b.subscriptions(spark, d))
    delivery.deliver_batches(
        stream.select("pv_name", "value"), take, f"{path}/checkpoint", availableNow=True
    ).awaitTermination()
    return spark.read.parquet(f"{path}/table").select("pv_name", "value")


@query
def recurring_normal_stream(spark, d):
    stream = stream_windows.recurring_stream(
        b.pv_event_stream(spark, d), b.members(spark, d), b.ORIGIN_MS, b.WINDOW_MS,
        lateness_ms=b.LATENESS_MS,
    )
    return delivery.run_append(spark, stream, "normal").select(*_WINDOW, "value", "n_events")


@query
def recurring_buffered_stream(spark, d):
    stream = stream_windows.recurring_stream(
        b.pv_event_stream(spark, d), b.members(spark, d), b.ORIGIN_MS, b.WINDOW_MS,
        repeat_delay=b.GAP_MS, kind=specs.TIMED_BUFFERED, lateness_ms=b.LATENESS_MS,
    )
    lists = delivery.run_append(spark, stream, "buffered")
    return _positions(lists, *_WINDOW)


@query
def sub_push_stream(spark, d):
    stream = stream_windows.sub_push_stream(
        b.pv_event_stream(spark, d), b.members(spark, d), b.ORIGIN_MS, b.WINDOW_MS, b.PUSH_MS,
        lateness_ms=b.LATENESS_MS,
    )
    lists = delivery.run_append(spark, stream, "push")
    return _positions(lists, "snapshot_name", "iteration", "push_index", "pv_name")


@query
def triggered_stream(spark, d):
    live, listed = _late_events(spark, d), b.members(spark, d)
    triggers = b.trigger_stream(live(), listed)
    stream = stateful.triggered_stream(live(), triggers, listed, lateness_ms=b.LATENESS_MS)
    return delivery.run_append(spark, stream, "triggered").withColumnRenamed("seq", "value_seq")


@query
def triggered_buffered_stream(spark, d):
    live, listed = _late_events(spark, d), b.members(spark, d)
    triggers = b.trigger_stream(live(), listed)
    stream = stateful.triggered_stream(
        live(), triggers, listed, kind=specs.TIMED_BUFFERED, lateness_ms=b.LATENESS_MS
    )
    return delivery.run_append(spark, stream, "triggered-buffered")


@query
def reassembly_stream(spark, d):
    path = scratch_path(spark, "records")
    b.snapshot_records(spark, d).write.parquet(path)
    records = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    return delivery.run_append(spark, stateful.reassembly_stream(records), "reassembled").select(*_REASSEMBLED)


@query
def request_reply_stream(spark, d):
    stream = keyed.correlate_stream(
        b.request_stream(spark, d), b.reply_stream(spark, d), b.TIMEOUT_MS
    )
    return delivery.run_append(spark, stream, "correlated").select(
        "reply_id", "pv_name", "status", F.col("error").cast("bigint").alias("error"), "message",
        "latency_ms",
    )


@query
def latest_stream(spark, d):
    rows = delivery.run_update(spark, keyed.latest_stream(b.pv_event_stream(spark, d)), "latest")
    return latest.newest(rows, ["pv_name"], ["batch_id"], ["seq", "value"])


@query
def put_state_stream(spark, d):
    rows = delivery.run_update(spark, keyed.state_stream(b.write_stream(spark, d)), "state")
    return latest.newest(rows, ["pv_name", "field"], ["batch_id"], ["seq", "value"])


@query
def snapshot_life_cycle_stream(spark, d):
    live, listed = _late_events(spark, d), b.members(spark, d)
    commands = b.life_cycle_stream(live(), listed)
    stream = stateful.triggered_stream(live(), commands, listed, needs_start=True, lateness_ms=b.LATENESS_MS)
    return delivery.run_append(spark, stream, "life-cycle").withColumnRenamed("seq", "value_seq")


@query
def recurring_rows_stream(spark, d):
    stream = stream_windows.buffered_stream(
        b.pv_event_stream(spark, d), b.members(spark, d), b.ORIGIN_MS
    )
    return delivery.run_append(spark, stream.select(*_WINDOW, "seq", "value"), "rows")


@query
def deliver_while_active_stream(spark, d):
    live = _late_events(spark, d)
    stream = stateful.delivery_stream(b.value_event_stream(live()), b.command_stream(live()), b.LATENESS_MS)
    return delivery.run_append(spark, stream, "active").select(
        "seq", "pv_name", F.unix_millis("ts").alias("ts_ms"), "value"
    )


@query
def one_shot_snapshot_stream(spark, d):
    path = scratch_path(spark, "messages")
    b.one_shot_messages(spark, d).write.parquet(path)
    log = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    rows = delivery.run_append(spark, stateful.assembly_stream(log), "assembled")
    return rows.select("msg_id", "offset", "pv_name", F.col("value").cast("double").alias("value"))


@query
def envelope_demux_stream(spark, d):
    stream = _routed(spark, d, b.envelope_stream(spark, d))
    return delivery.run_append(
        spark, stream.select("offset", "msg_id", "route", "message_size"), "routed"
    )


@query
def traffic_stream(spark, d):
    stream = stream_windows.traffic_stream(
        b.message_stream(spark, d), subs.DAY_MS, keys=("pv_name",), lateness_ms=b.LATENESS_MS
    )
    return delivery.run_append(spark, stream, "traffic")
