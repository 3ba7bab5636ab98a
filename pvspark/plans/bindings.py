"""The driver's tables seen as control-system tables.

Each function maps whole tables to one canonical table; nothing is sampled or cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pvspark.functions.timing import epoch_ms, epoch_us, floor_div
from pvspark.session import scratch_path
from pvspark.sources.live import as_event_time, file_stream

ORIGIN_MS = 1_704_067_200_000  # 2024-01-01 00:00 UTC, before the first event
WINDOW_MS = 6 * 3_600_000
GAP_MS = 2 * 3_600_000
PUSH_MS = 3_600_000
TIMEOUT_MS = 90 * 86_400_000
LATENESS_MS = 3_600_000
INSTANT = "timestamp_ntz'2024-01-15 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _user_pv(column: str) -> Column:
    return F.concat(F.lit("user:"), F.col(column).cast("string"))


def _as_pv_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("event_id").alias("seq"),
        _user_pv("user_id").alias("pv_name"),
        F.when(F.col("user_id") % 2 == 0, "pva").otherwise("ca").alias("protocol"),
        "ts",
        epoch_ms(F.col("ts")).alias("ts_ms"),
        "value",
        F.col("props").alias("fields"),
        "event_type",
    )


def pv_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_pv_events(table(spark, sf_dir, "events"))


def pv_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_event_time(_as_pv_events(_table_stream(spark, sf_dir, "events")))


REPLAY_SLICES, REPLAY_FILES = 4, 4


def late_event_files(spark: SparkSession, sf_dir: str) -> str:
    """The whole event table as a folder of files in several slices, in which rows come late.

    A row is in the slice of its time plus up to half of the allowed lateness, so that neighbouring slices
    overlap; within a slice rows have no order.  Slices are written one after the other.
    """
    raw = table(spark, sf_dir, "events")
    came = epoch_ms(F.col("ts")) + F.pmod(F.xxhash64("event_id"), F.lit(LATENESS_MS // 2))
    span = raw.agg(F.min(came).alias("first"), F.max(came).alias("last")).first()
    width = ((span["last"] or 0) - (span["first"] or 0)) // REPLAY_SLICES + 1
    folder = scratch_path(spark, "late-events")
    slice_of = floor_div(came - F.lit(span["first"] or 0), F.lit(width).cast("bigint"))
    for which in range(REPLAY_SLICES):
        raw.where(slice_of == which).repartition(REPLAY_FILES).write.mode("append").parquet(folder)
    return folder


def late_event_stream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """``late_event_files`` as a stream of several micro-batches."""
    schema = table(spark, sf_dir, "events").schema
    return as_event_time(_as_pv_events(file_stream(spark, folder, schema, max_files=REPLAY_FILES)))


def members(
    spark: SparkSession, sf_dir: str, repeat_delay: int = 0, sub_push: int = 0
) -> DataFrame:
    """Snapshots of ten supplier PVs each; the other PVs are in no list."""
    return table(spark, sf_dir, "supplier").select(
        F.expr("concat('snap_', cast(s_suppkey div 10 as string))").alias("snapshot_name"),
        _user_pv("s_suppkey").alias("pv_name"),
        F.lit(WINDOW_MS).cast("bigint").alias("time_window"),
        F.lit(repeat_delay).cast("bigint").alias("repeat_delay"),
        F.lit(sub_push).cast("bigint").alias("sub_push_delay_msec"),
    )


def spec_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same snapshots as rows with a PV list (ten addresses, so the list is bounded)."""
    return (
        members(spark, sf_dir, GAP_MS, PUSH_MS)
        .groupBy("snapshot_name", "time_window", "repeat_delay", "sub_push_delay_msec")
        .agg(
            F.sort_array(F.collect_list(F.concat(F.lit("pva://"), "pv_name"))).alias("pv_uri_list")
        )
    )


def mixed_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Specs of every type and trigger mode, with nulls for defaults, field filters and faulty ones."""
    number = F.expr("cast(substring(snapshot_name, 6) as int)")
    spec = members(spark, sf_dir).groupBy("snapshot_name").agg(
        F.sort_array(F.collect_list(F.concat(F.lit("pva://"), "pv_name"))).alias("uris")
    ).withColumn("n", number)
    return spec.select(
        "snapshot_name",
        F.when(F.col("n") % 7 == 6, F.concat("uris", F.array(F.lit("pv://bad")))).otherwise(F.col("uris")).alias("pv_uri_list"),
        F.when(F.col("n") % 4 != 2, F.when(F.col("n") % 3 == 0, WINDOW_MS).otherwise(2 * WINDOW_MS)).cast("bigint").alias("time_window"),
        F.lit(None).cast("bigint").alias("repeat_delay"),
        F.when(F.col("n") % 5 == 1, PUSH_MS).cast("bigint").alias("sub_push_delay_msec"),
        F.when(F.col("n") % 4 > 1, True).alias("triggered"),
        F.when(F.col("n") % 11 == 10, "other").when(F.col("n") % 2 == 1, "timedbuffered").alias("type"),
        F.when(F.col("n") % 3 == 0, F.array(F.lit("k"))).when(F.col("n") % 3 == 1, F.array(F.lit("zz"))).alias("pv_field_filter_list"),
    )


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(_user_pv("s_suppkey").alias("pv_name"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(_user_pv("c_custkey").alias("pv_name"))


def uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-formed, wrong-protocol and malformed addresses."""
    named = table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment", "c_name")
    clean = F.replace("c_name", F.lit("#"), F.lit(":"))
    scheme = (
        F.when(F.col("c_mktsegment") == "BUILDING", "ca://")
        .when(F.col("c_mktsegment") == "MACHINERY", "pv://")
        .otherwise("pva://")
    )
    listed = named.select("c_nationkey", F.concat(scheme, clean).alias("uri"))
    twice = named.where(F.col("c_mktsegment") == "BUILDING").select(
        "c_nationkey", F.concat(F.lit("pva://"), clean).alias("uri")
    )
    raw = named.where(F.col("c_mktsegment") == "FURNITURE").select(
        "c_nationkey", F.concat(F.lit("pva://"), "c_name").alias("uri")
    )
    web = table(spark, sf_dir, "pages").select(F.lit(-1).alias("c_nationkey"), F.col("url").alias("uri"))
    return (
        listed.unionByName(twice)
        .unionByName(raw)
        .unionByName(web)
        .withColumnRenamed("c_nationkey", "list_id")
    )


def colliding_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.expr(
            "concat('unit', CASE WHEN c_custkey % 2 = 0 THEN ':' ELSE '_' END, "
            "cast(c_custkey div 2 as string))"
        ).alias("pv_name")
    )


def part_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Specs with every kind of fault, decided by columns of ``part``."""
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.expr(
            "CASE WHEN p_size = 1 THEN '' WHEN p_type = 'ECONOMY' THEN p_name "
            "ELSE replace(p_name, ' ', '_') END"
        ).alias("snapshot_name"),
        F.expr(
            "CASE WHEN p_size = 2 THEN cast(array() as array<string>) "
            "WHEN p_size = 3 THEN array(concat('pva://', p_brand)) "
            "WHEN p_size = 4 THEN array('pva://a:b', concat('pv://', replace(p_brand, '#', ':'))) "
            "WHEN p_size = 5 THEN array('pva://a:b', cast(null as string)) "
            "ELSE array(concat('pva://', replace(p_brand, '#', ':')), 'ca://x') END"
        ).alias("pv_uri_list"),
        F.expr("cast((p_size - 10) * 1000 as bigint)").alias("time_window"),
        F.expr("cast(CASE WHEN p_size > 45 THEN -1 ELSE 0 END as bigint)").alias("repeat_delay"),
        F.expr("CASE WHEN p_size = 40 THEN cast(null as boolean) ELSE false END").alias("triggered"),
    )


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _commands(pv_events(spark, sf_dir))


def command_stream(events: DataFrame) -> DataFrame:
    return _commands(events)


def _commands(events: DataFrame) -> DataFrame:
    """Monitor commands: a signup starts, an error stops."""
    return (
        events.where(F.col("event_type").isin("signup", "error"))
        .select(
            "pv_name",
            "ts",
            "seq",
            F.when(F.col("event_type") == "signup", "start").otherwise("stop").alias("command"),
        )
    )


def value_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pv_events(spark, sf_dir).where(~F.col("event_type").isin("signup", "error"))


def value_event_stream(events: DataFrame) -> DataFrame:
    return events.where(~F.col("event_type").isin("signup", "error"))


def _requests(raw: DataFrame) -> DataFrame:
    low = F.col("o_orderpriority") == "5-LOW"
    return raw.select(
        F.concat(F.lit("ord-"), F.col("o_orderkey").cast("string")).alias("reply_id"),
        F.concat(F.lit("cust:"), F.col("o_custkey").cast("string")).alias("pv_name"),
        F.col("o_orderdate").alias("ts"),
        F.when(~low, F.lit(TIMEOUT_MS)).cast("bigint").alias("timeout_ms"),
    )


def _replies(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.concat(F.lit("ord-"), F.col("l_orderkey").cast("string")).alias("reply_id"),
        F.col("l_shipdate").alias("ts"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("error"),
        F.col("l_linestatus").alias("message"),
        F.col("l_extendedprice").alias("value"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order asks; low-priority orders wait without a timeout."""
    return _requests(table(spark, sf_dir, "orders"))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line item replies to its order; a returned one is an error."""
    return _replies(table(spark, sf_dir, "lineitem"))


def _table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = table(spark, sf_dir, name).schema
    return file_stream(spark, sf_dir, schema, pattern=f"{name}.parquet")


def request_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_event_time(_requests(_table_stream(spark, sf_dir, "orders")))


def reply_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_event_time(_replies(_table_stream(spark, sf_dir, "lineitem")))


def triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each signup of a listed PV triggers the snapshot it is listed in."""
    listed = members(spark, sf_dir).select("snapshot_name", "pv_name")
    return (
        pv_events(spark, sf_dir)
        .where(F.col("event_type") == "signup")
        .join(listed, "pv_name")
        .select("snapshot_name", F.col("seq").alias("trigger_id"), "ts")
    )


def life_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, trigger and stop commands of snapshots, from the events of their PVs."""
    listed = members(spark, sf_dir).select("snapshot_name", "pv_name")
    return _life_cycle(pv_events(spark, sf_dir), listed)


def life_cycle_stream(events: DataFrame, listed: DataFrame) -> DataFrame:
    return _life_cycle(events, listed.select("snapshot_name", "pv_name"))


def trigger_stream(events: DataFrame, listed: DataFrame) -> DataFrame:
    return life_cycle_stream(events, listed).where(F.col("command") == "trigger")


def _life_cycle(events: DataFrame, listed: DataFrame) -> DataFrame:
    command = (
        F.when(F.col("event_type") == "signup", "trigger")
        .when(F.col("event_type") == "purchase", "start")
        .when(F.col("event_type") == "error", "stop")
    )
    return (
        events.withColumn("command", command)
        .where(F.col("command").isNotNull())
        .join(listed, "pv_name")
        .select("snapshot_name", "command", F.col("seq").alias("trigger_id"), "ts")
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(table(spark, sf_dir, "events"))


def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_event_time(_messages(_table_stream(spark, sf_dir, "events")))


def _messages(raw: DataFrame) -> DataFrame:
    """A message log with one topic per event type; the body is the properties text."""
    return raw.select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        "ts",
        F.lit("json").alias("ser_type"),
        F.col("props").alias("value"),
        _user_pv("user_id").alias("pv_name"),
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _envelopes(table(spark, sf_dir, "events"))


def envelope_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _envelopes(_table_stream(spark, sf_dir, "events"))


def get_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gets that wait for the replies in the envelope log: one per part, of a PV by its size."""
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("req-"), F.col("p_partkey").cast("string")).alias("reply_id"),
        F.concat(F.lit("user:"), (F.col("p_size") - 1).cast("string")).alias("pv_name"),
    )


def _envelopes(raw: DataFrame) -> DataFrame:
    """A log of all envelope kinds, chosen by event type, with faulty ones among the errors."""
    body = F.expr(
        """CASE event_type
             WHEN 'signup' THEN concat('{"error":0,"reply_id":"req-', event_id, '","user:', user_id, '":{"value":', value, '}}')
             WHEN 'view' THEN concat('{"user:', user_id, '":{"value":', value, '},"extra":1}')
             WHEN 'click' THEN concat('{"reply_id":"shot-', event_id, '","user:', user_id, '":', value, '}')
             WHEN 'purchase' THEN concat('{"', CASE WHEN value < 20 THEN 'message_type' ELSE 'kind' END, '":1,"iter_index":1,"user:', user_id, '":', value, '}')
             ELSE CASE WHEN value < 5 THEN '[1,2]' WHEN value < 10 THEN '{"reply_id":null}'
                       WHEN value < 15 THEN concat('{"snapshot_name":"snap_', user_id, '"}') ELSE '{}' END
           END"""
    )
    ser_type = F.expr(
        "CASE WHEN event_type <> 'error' THEN 'JSON' WHEN value < 40 THEN 'json' "
        "WHEN value < 60 THEN 'msgpack-compact' END"
    )
    return raw.select(
        F.expr("concat('snap_', cast(user_id div 10 as string))").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        "ts",
        ser_type.alias("ser_type"),
        body.alias("value"),
    )


def pending_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("req-"), F.col("p_partkey").cast("string")).alias("reply_id")
    )


def open_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("shot-"), F.col("c_custkey").cast("string")).alias("reply_id")
    )


def recurring_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members(spark, sf_dir).select(F.col("snapshot_name").alias("topic")).distinct()


def _bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by topic (ten PVs each) and six-hour bucket."""
    return table(spark, sf_dir, "events").select(
        F.expr("concat('snap_', cast(user_id div 10 as string))").alias("topic"),
        floor_div(epoch_ms(F.col("ts")) - ORIGIN_MS, F.lit(WINDOW_MS).cast("bigint")).alias("b"),
        (epoch_us(F.col("ts")) - ORIGIN_MS * 1000).alias("us"),
        "ts",
        F.col("event_id").alias("seq"),
        _user_pv("user_id").alias("pv_name"),
        "event_type",
        "value",
    )


def _buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _bucketed(spark, sf_dir)
        .groupBy("topic", "b")
        .agg(F.min_by("event_type", F.struct("ts", "seq")).alias("first_type"))
    )


# Offsets follow time: four per microsecond leave room for the header before and the tail
# after a bucket's data.
def _offset(us: Column) -> Column:
    return us * 4


def snapshot_records(spark: SparkSession, sf_dir: str, faults: bool = True) -> DataFrame:
    """Header, data and tail records of one iteration per topic and bucket.

    Faults: no tail where the bucket's first event is a purchase, and a foreign iteration
    on the data of cheap errors.
    """
    bucket_us = WINDOW_MS * 1000
    foreign = (F.col("event_type") == "error") & (F.col("value") < 10) & F.lit(faults)
    data = _bucketed(spark, sf_dir).select(
        "topic",
        (_offset(F.col("us")) + 1).alias("offset"),
        F.lit(1).alias("message_type"),
        (F.col("b") + 1 + F.when(foreign, 1000).otherwise(0)).alias("iter_index"),
        epoch_ms(F.col("ts")).alias("timestamp_ms"),
        "pv_name",
        "value",
    )
    buckets = _buckets(spark, sf_dir)
    no_value = [F.lit(None).cast("string").alias("pv_name"), F.lit(None).cast("double").alias("value")]
    headers = buckets.select(
        "topic",
        _offset(F.col("b") * bucket_us).alias("offset"),
        F.lit(0).alias("message_type"),
        (F.col("b") + 1).alias("iter_index"),
        (F.col("b") * WINDOW_MS + ORIGIN_MS).alias("timestamp_ms"),
        *no_value,
    )
    lost = (F.col("first_type") == "purchase") & F.lit(faults)
    tails = buckets.where(~lost).select(
        "topic",
        (_offset((F.col("b") + 1) * bucket_us) - 1).alias("offset"),
        F.lit(2).alias("message_type"),
        (F.col("b") + 1).alias("iter_index"),
        ((F.col("b") + 1) * WINDOW_MS + ORIGIN_MS).alias("timestamp_ms"),
        *no_value,
    )
    return data.unionByName(headers).unionByName(tails)


def one_shot_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-shot snapshot messages: a reply id per topic and bucket, a completing error."""
    bucket_us = WINDOW_MS * 1000
    msg_id = F.concat("topic", F.lit("-"), F.col("b").cast("string"))
    data = _bucketed(spark, sf_dir).select(
        msg_id.alias("msg_id"),
        _offset(F.col("us")).alias("offset"),
        F.expr(
            """concat('{"reply_id":"', topic, '-', b, '","error":0,"', pv_name, '":', value,
               CASE WHEN event_type = 'error' THEN ',"second":1}' ELSE '}' END)"""
        ).alias("value"),
    )
    ends = _buckets(spark, sf_dir).where(F.col("first_type") != "purchase").select(
        msg_id.alias("msg_id"),
        # A snapshot whose first event is an error completes half-way through its bucket.
        _offset(
            F.col("b") * bucket_us
            + F.when(F.col("first_type") == "error", bucket_us // 2).otherwise(bucket_us)
        ).alias("offset"),
        F.expr("""concat('{"reply_id":"', topic, '-', b, '","error":1}')""").alias("value"),
    )
    return data.unionByName(ends)


def _writes(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.concat(F.lit("cust:"), F.col("o_custkey").cast("string")).alias("pv_name"),
        F.col("o_orderpriority").alias("field"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_totalprice").alias("value"),
    )


def writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _writes(table(spark, sf_dir, "orders"))


def write_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_event_time(_writes(_table_stream(spark, sf_dir, "orders")))


TABLE_KEYS = ["l_orderkey"]
TABLE_COLUMNS = ["linenumber", "quantity", "price", "discount", "flag"]
TABLE_ORDER = ["l_shipdate", "linenumber", "l_partkey", "l_suppkey", "quantity", "price", "discount", "flag"]


def table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as table rows: one table per order."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_shipdate",
        F.col("l_linenumber").cast("bigint").alias("linenumber"),
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.col("l_returnflag").alias("flag"),
    )
