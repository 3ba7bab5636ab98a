"""The registered queries in plain SQL, written from the operators' definitions.

They share no code with the Spark side: each states its result over the driver's tables.
"""

from __future__ import annotations

ORIGIN = 1704067200000
WINDOW = 21600000
GAP = 7200000
PUSH = 3600000
LATE = 3600000
TIMEOUT = 90 * 86400000
INSTANT = "TIMESTAMP '2024-01-15 00:00:00'"
URI = r"^(pva?|ca)://([A-Za-z0-9\-_:]+(?:\.[A-Za-z0-9\-_]+)*)\z"
NAME = r"^[A-Za-z0-9_\-]+\z"

EV = """ev AS (
  SELECT event_id AS seq, 'user:' || user_id AS pv_name, ts, (epoch_us(ts) // 1000) AS ts_ms,
         epoch_us(ts) AS ts_us, value, event_type, props, user_id
  FROM events)"""

MB = """mb AS (
  SELECT 'snap_' || (s_suppkey // 10) AS snapshot_name, 'user:' || s_suppkey AS pv_name
  FROM supplier)"""

# Listed events with their iteration; period = window + gap.
def _windowed(gap: int) -> str:
    period = WINDOW + gap
    return f"""win AS (
  SELECT mb.snapshot_name, (ts_ms - {ORIGIN}) // {period} + 1 AS iteration, mb.pv_name,
         ((ts_ms - {ORIGIN}) % {period}) // {PUSH} AS push_index,
         {ORIGIN} + ((ts_ms - {ORIGIN}) // {period}) * {period} AS header_timestamp,
         {ORIGIN} + ((ts_ms - {ORIGIN}) // {period}) * {period} + {WINDOW} AS tail_timestamp,
         ts, ts_ms, seq, value
  FROM ev JOIN mb USING (pv_name)
  WHERE ts_ms >= {ORIGIN} AND (ts_ms - {ORIGIN}) % {period} < {WINDOW})"""


def _spine(gap: int) -> str:
    period = WINDOW + gap
    return f"""spine AS (
  SELECT snapshot_name, i AS iteration, pv_name,
         {ORIGIN} + (i - 1) * {period} AS header_timestamp,
         {ORIGIN} + (i - 1) * {period} + {WINDOW} AS tail_timestamp
  FROM mb, (SELECT unnest(generate_series(1, (SELECT max((ts_ms - {ORIGIN}) // {period} + 1) FROM ev))) AS i))"""


WIN = ", ".join([EV, MB, _windowed(0)])
WIN_SPINE = ", ".join([WIN, _spine(0)])
GAPPED = ", ".join([EV, MB, _windowed(GAP)])
GAPPED_SPINE = ", ".join([GAPPED, _spine(GAP)])

_KEYS = "snapshot_name, iteration, pv_name, header_timestamp, tail_timestamp"

URIS = """uris AS (
  SELECT c_nationkey AS list_id,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'ca://' WHEN 'MACHINERY' THEN 'pv://' ELSE 'pva://' END
           || replace(c_name, '#', ':') AS uri
  FROM customer
  UNION ALL SELECT c_nationkey, 'pva://' || replace(c_name, '#', ':') FROM customer WHERE c_mktsegment = 'BUILDING'
  UNION ALL SELECT c_nationkey, 'pva://' || c_name FROM customer WHERE c_mktsegment = 'FURNITURE'
  UNION ALL SELECT -1, url FROM pages)"""

PARSED = f"""{URIS}, parsed AS (
  SELECT CAST(list_id AS BIGINT) AS list_id, uri,
         nullif(regexp_extract(uri, '{URI}', 1), '') AS protocol,
         nullif(regexp_extract(uri, '{URI}', 2), '') AS pv_name,
         CASE WHEN NOT regexp_matches(uri, '{URI}') THEN 'malformed'
              WHEN uri LIKE 'pv://%' THEN 'bad_protocol' ELSE 'ok' END AS status
  FROM uris)"""

NAMES = """names AS (
  SELECT DISTINCT 'unit' || CASE WHEN c_custkey % 2 = 0 THEN ':' ELSE '_' END || (c_custkey // 2) AS pv_name
  FROM customer)"""

ROUTED = """msg AS (
  SELECT event_id AS "offset", 'snap_' || (user_id // 10) AS topic, event_type, value, user_id,
         CASE event_type
           WHEN 'signup' THEN '{"error":0,"reply_id":"req-' || event_id || '","user:' || user_id || '":{"value":' || value || '}}'
           WHEN 'view' THEN '{"user:' || user_id || '":{"value":' || value || '},"extra":1}'
           WHEN 'click' THEN '{"reply_id":"shot-' || event_id || '","user:' || user_id || '":' || value || '}'
           WHEN 'purchase' THEN '{"' || CASE WHEN value < 20 THEN 'message_type' ELSE 'kind' END || '":1,"iter_index":1,"user:' || user_id || '":' || value || '}'
           ELSE CASE WHEN value < 5 THEN '[1,2]' WHEN value < 10 THEN '{"reply_id":null}'
                     WHEN value < 15 THEN '{"snapshot_name":"snap_' || user_id || '"}' ELSE '{}' END
         END AS body
  FROM events),
ids AS (
  SELECT *, CASE event_type
      WHEN 'signup' THEN 'req-' || "offset"
      WHEN 'view' THEN 'user:' || user_id
      WHEN 'click' THEN 'shot-' || "offset"
      WHEN 'purchase' THEN CASE WHEN value < 20 THEN 'message_type' ELSE 'kind' END
      ELSE CASE WHEN value >= 10 AND value < 15 THEN 'snap_' || user_id END END AS msg_id
  FROM msg),
routed AS (
  SELECT "offset", topic, user_id, value, msg_id, strlen(body) AS message_size,
    CASE
      WHEN event_type = 'error' AND value >= 60 THEN 'no_header'
      WHEN event_type = 'error' AND value >= 40 THEN 'bad_ser_type'
      WHEN event_type = 'error' AND value < 5 THEN 'not_a_map'
      WHEN msg_id IS NULL THEN 'no_id'
      WHEN msg_id IN (SELECT 'req-' || p_partkey FROM part) THEN 'reply'
      WHEN msg_id IN (SELECT 'user:' || s_suppkey FROM supplier) THEN 'monitor'
      WHEN msg_id IN (SELECT 'shot-' || c_custkey FROM customer) THEN 'snapshot'
      WHEN msg_id = 'message_type' AND topic IN (SELECT 'snap_' || (s_suppkey // 10) FROM supplier) THEN 'recurring'
      ELSE 'dropped' END AS route
  FROM ids)"""

CMDS = """cmds AS (
  SELECT *, lag(event_type) OVER (PARTITION BY pv_name ORDER BY ts, seq) AS before
  FROM ev WHERE event_type IN ('signup', 'error'))"""

TRIG = """trig AS (
  SELECT snapshot_name, seq AS trigger_id, ts, ts_us,
         row_number() OVER (PARTITION BY snapshot_name ORDER BY ts, seq) AS iteration
  FROM ev JOIN mb USING (pv_name) WHERE event_type = 'signup')"""

# Life cycle: triggers after a start, up to the next start or stop.
LIFE = """lc AS (
  SELECT snapshot_name, seq AS trigger_id, ts,
         CASE event_type WHEN 'signup' THEN 'trigger' WHEN 'purchase' THEN 'start' ELSE 'stop' END AS command
  FROM ev JOIN mb USING (pv_name) WHERE event_type IN ('signup', 'purchase', 'error')),
turns AS (
  SELECT snapshot_name, command, ts AS since,
         coalesce(lead(ts) OVER (PARTITION BY snapshot_name ORDER BY ts, trigger_id), TIMESTAMP '9999-01-01') AS until
  FROM lc WHERE command <> 'trigger'),
live AS (
  SELECT lc.snapshot_name, trigger_id, ts, since,
         row_number() OVER (PARTITION BY lc.snapshot_name, since ORDER BY ts, trigger_id) AS iteration
  FROM lc JOIN turns ON lc.snapshot_name = turns.snapshot_name AND lc.ts > since AND lc.ts < until
  WHERE lc.command = 'trigger' AND turns.command = 'start')"""

LIFE_ROWS = f"""WITH {EV}, {MB}, {LIFE}
SELECT live.snapshot_name, live.trigger_id, live.iteration, mb.pv_name,
       arg_max(ev.value, (ev.ts, ev.seq)) AS value, arg_max(ev.seq, (ev.ts, ev.seq)) AS value_seq
FROM live JOIN mb USING (snapshot_name)
LEFT JOIN ev ON ev.pv_name = mb.pv_name AND ev.ts <= live.ts AND ev.ts > live.since
GROUP BY ALL"""

RECORDS = f"""bk AS (
  SELECT 'snap_' || (user_id // 10) AS topic, (ts_ms - {ORIGIN}) // {WINDOW} AS b, *,
         4 * (ts_us - {ORIGIN} * 1000) AS off
  FROM ev),
bucket AS (
  SELECT topic, b, arg_min(event_type, (ts, seq)) AS first_type, min(off) AS first_off FROM bk GROUP BY ALL),
kept AS (
  SELECT topic, b + 1 AS iteration, {ORIGIN} + b * {WINDOW} AS header_timestamp,
         {ORIGIN} + (b + 1) * {WINDOW} AS tail_timestamp, off + 1 AS "offset", pv_name, value
  FROM bk WHERE NOT (event_type = 'error' AND value < 10)),
closing AS (
  SELECT topic, b + 1 AS iteration, {ORIGIN} + b * {WINDOW} AS header_timestamp,
         {ORIGIN} + (b + 1) * {WINDOW} AS tail_timestamp, 4 * (b + 1) * {WINDOW} * 1000 - 1 AS "offset",
         CAST(NULL AS VARCHAR) AS pv_name, CAST(NULL AS DOUBLE) AS value
  FROM bucket WHERE first_type <> 'purchase')"""

TRIGGER_ROWS = f"""WITH {EV}, {MB}, {TRIG}
SELECT trig.snapshot_name, trig.trigger_id, trig.iteration, mb.pv_name,
       arg_max(ev.value, (ev.ts, ev.seq)) AS value, arg_max(ev.seq, (ev.ts, ev.seq)) AS value_seq
FROM trig JOIN mb USING (snapshot_name)
LEFT JOIN ev ON ev.pv_name = mb.pv_name AND ev.ts <= trig.ts
GROUP BY ALL"""

TRIGGER_VALUES = f"""WITH {EV}, {MB}, {TRIG}
SELECT trig.snapshot_name, trig.trigger_id, trig.iteration, mb.pv_name, ev.seq, ev.value
FROM trig JOIN mb USING (snapshot_name)
LEFT JOIN ev ON ev.pv_name = mb.pv_name AND ev.ts_us <= trig.ts_us AND ev.ts_us > trig.ts_us - {WINDOW * 1000}"""

EXACT_ROWS = f"""WITH {EV}, {RECORDS},
blocked AS (SELECT topic, min(b) AS b FROM bucket WHERE first_type = 'purchase' GROUP BY topic)
SELECT every.* FROM (SELECT * FROM kept UNION ALL SELECT * FROM closing) every LEFT JOIN blocked USING (topic)
WHERE blocked.b IS NULL OR every.iteration <= blocked.b"""

REQUESTS = f"""req AS (
  SELECT 'ord-' || o_orderkey AS reply_id, 'cust:' || o_custkey AS pv_name, o_orderkey, o_orderdate AS asked,
         CASE WHEN o_orderpriority <> '5-LOW' THEN {TIMEOUT} END AS timeout_ms
  FROM orders),
first_reply AS (
  SELECT reply_id, pv_name, asked, timeout_ms,
         min((l_shipdate, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END, l_linestatus, l_extendedprice))
           FILTER (WHERE l_shipdate IS NOT NULL) AS r
  FROM req LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate >= asked
  GROUP BY ALL),
opened AS (
  SELECT reply_id, pv_name, asked, timeout_ms, r[1] AS replied, r[2] AS error, r[3] AS message, r[4] AS value
  FROM first_reply)"""

STATE = """SELECT 'cust:' || o_custkey AS pv_name, o_orderpriority AS field, max(o_orderkey) AS seq,
       arg_max(o_totalprice, o_orderkey) AS value
FROM (SELECT *, rank() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC) AS r FROM orders)
WHERE r = 1 GROUP BY ALL"""

TABLES = """li AS (
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS linenumber, l_quantity AS quantity, l_extendedprice AS price,
         l_discount AS discount, l_returnflag AS flag,
         row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_returnflag) - 1 AS row_index
  FROM lineitem)"""

MONITORED = "SELECT event_id AS seq, 'user:' || user_id AS pv_name, (epoch_us(ts) // 1000) AS ts_ms, value FROM events WHERE user_id IN (SELECT s_suppkey FROM supplier)"

LATEST = """SELECT 'user:' || user_id AS pv_name, arg_max(event_id, (ts, event_id)) AS seq,
       arg_max(value, (ts, event_id)) AS value"""


def _command(kind: str, source: str, key: str, **fields: str) -> str:
    """One branch of the command export: every parsed field, null unless given."""
    names = [
        "pv_name", "value", "activate", "monitor_dest_topic", "snapshot_name", "type",
        "respect_push_order", "triggered", "time_window_msec", "repeat_delay_msec",
        "sub_push_delay_msec", "n_pvs", "n_fields",
    ]
    cells = []
    for name in names:
        kind_of = "BIGINT" if name in ("n_pvs", "n_fields") else "VARCHAR"
        cells.append(f"CAST({fields.get(name, 'NULL')} AS {kind_of}) AS {name}")
    n_keys = fields.get("n_keys", str(4 + len([n for n in fields if n in names])))
    return (
        f"SELECT '{kind}' AS command, 'msgpack' AS serialization, 'demo-reply' AS reply_topic, "
        f"md5('{kind}|' || {key}) AS reply_id, {', '.join(cells)}, CAST({n_keys} AS BIGINT) AS n_keys FROM {source}"
    )


_SPEC = "(SELECT snapshot_name, count(*) AS n FROM mb GROUP BY 1)"
COMMANDS = f"WITH {MB} " + " UNION ALL ".join(
    [
        _command("get", "customer", "'user:' || c_custkey", pv_name="'pva://user:' || c_custkey"),
        _command(
            "monitor", "supplier", "'user:' || s_suppkey", pv_name="'pva://user:' || s_suppkey",
            activate="'true'", monitor_dest_topic="'user_' || s_suppkey",
        ),
        _command("multi-monitor", _SPEC, "snapshot_name", activate="'true'", n_pvs="n"),
        _command(
            "put", "orders", "o_orderkey", pv_name="'pva://cust:' || o_custkey", value="o_orderstatus"
        ),
        _command("snapshot", _SPEC, "snapshot_name", n_pvs="n"),
        _command(
            "repeating_snapshot", _SPEC, "snapshot_name", snapshot_name="snapshot_name", n_pvs="n",
            type="'normal'", respect_push_order="'true'", triggered="'false'",
            time_window_msec=str(WINDOW), repeat_delay_msec=str(GAP), sub_push_delay_msec=str(PUSH),
            n_fields="CASE WHEN snapshot_name = 'snap_0' THEN 2 END",
            n_keys="CASE WHEN snapshot_name = 'snap_0' THEN 13 ELSE 12 END",
        ),
        _command("repeating_snapshot_trigger", _SPEC, "snapshot_name", snapshot_name="snapshot_name"),
        _command("repeating_snapshot_stop", _SPEC, "snapshot_name", snapshot_name="snapshot_name"),
    ]
)

TRAFFIC = "SELECT 'user:' || user_id AS pv_name, epoch_ms(date_trunc('day', ts)) AS bucket_start_ms, count(*) AS n_messages, CAST(sum(strlen(props)) AS BIGINT) AS n_bytes, max(strlen(props)) AS max_bytes FROM events GROUP BY 1, 2"

LISTED_EVENTS = "events WHERE user_id IN (SELECT s_suppkey FROM supplier)"


def _passed(rows: str, event: str, seen: str) -> str:
    """The rows of events that the watermark of ``seen`` has passed at the end of the input."""
    return (
        f"SELECT * FROM ({rows}) WHERE {event} IN (SELECT event_id FROM events WHERE epoch_us(ts) < "
        f"(SELECT (max(epoch_us(ts)) // 1000 - {LATE}) * 1000 FROM {seen}))"
    )


ORACLE: dict[str, str] = {
    "event_log_scan": "SELECT event_id AS seq, 'user:' || user_id AS pv_name, CASE WHEN user_id % 2 = 0 THEN 'pva' ELSE 'ca' END AS protocol, (epoch_us(ts) // 1000) AS ts_ms, value, props AS fields FROM events",
    "replay_start_offsets": f"SELECT event_type AS topic, user_id % 4 AS partition, min(event_id) AS start_offset FROM events WHERE ts >= {INSTANT} GROUP BY ALL",
    "replay_from_timestamp": f"""WITH starts AS (
  SELECT event_type AS topic, user_id % 4 AS partition, min(event_id) AS start_offset FROM events WHERE ts >= {INSTANT} GROUP BY ALL)
SELECT topic, partition, event_id AS "offset", start_offset
FROM events JOIN starts ON event_type = topic AND user_id % 4 = partition WHERE event_id >= start_offset""",
    "pv_list_file": "SELECT 'pva://' || replace(c_name, '#', ':') AS uri, 'pva' AS protocol, replace(c_name, '#', ':') AS pv_name, 'ok' AS status FROM customer WHERE c_acctbal >= 0",
    "command_export": COMMANDS,
    "uri_catalog": f"WITH {PARSED} SELECT * FROM parsed",
    "pv_catalog": f"WITH {PARSED} SELECT pv_name, string_agg(DISTINCT protocol, ',' ORDER BY protocol) AS protocols FROM parsed WHERE status = 'ok' GROUP BY pv_name",
    "uri_list_report": f"""WITH {PARSED} SELECT list_id, count(*) AS n_uris, count(*) FILTER (WHERE status = 'malformed') AS n_malformed,
  count(*) FILTER (WHERE status = 'bad_protocol') AS n_bad_protocol, bool_and(status = 'ok') AS accepted FROM parsed GROUP BY list_id""",
    "topic_map": f"WITH {NAMES} SELECT pv_name, replace(pv_name, ':', '_') AS topic FROM names",
    "topic_collisions": f"WITH {NAMES} SELECT replace(pv_name, ':', '_') AS topic, count(*) AS n_pvs, min(pv_name) AS first_pv, max(pv_name) AS last_pv FROM names GROUP BY 1 HAVING count(*) > 1",
    "spec_validation": f"""WITH s AS (
  SELECT p_partkey, p_size, CASE WHEN p_size = 1 THEN '' WHEN p_type = 'ECONOMY' THEN p_name ELSE replace(p_name, ' ', '_') END AS snapshot_name
  FROM part)
SELECT p_partkey, snapshot_name, CASE
  WHEN p_size = 3 THEN 'malformed_uri' WHEN p_size = 4 THEN 'bad_protocol'
  WHEN snapshot_name = '' THEN 'empty_name'
  WHEN NOT regexp_matches(snapshot_name, '{NAME}') THEN 'invalid_name'
  WHEN p_size = 2 THEN 'empty_pv_list' WHEN p_size = 5 THEN 'non_text_uri'
  WHEN p_size < 10 THEN 'negative_time_window' WHEN p_size > 45 THEN 'negative_repeat_delay' END AS error
FROM s""",
    "field_projection": "SELECT event_id AS seq, 'user:' || user_id AS pv_name, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(json_object('k', json_extract(props, '$.k')) AS VARCHAR) AS fields FROM events",
    "field_projection_struct": "SELECT event_id AS seq, value, (epoch_us(ts) // 1000) AS \"timeStamp\" FROM events",
    "envelope_demux": f'WITH {ROUTED} SELECT "offset", CASE WHEN route IN (\'no_header\', \'bad_ser_type\') THEN NULL ELSE msg_id END AS msg_id, route, message_size FROM routed',
    "demuxed_monitor_values": f'WITH {ROUTED} SELECT \'user:\' || user_id AS pv_name, "offset", value FROM routed WHERE route = \'monitor\'',
    "monitor": MONITORED,
    "new_subscriptions": "SELECT 'user:' || c_custkey AS pv_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)",
    "deliver_while_active": f"""WITH {EV}, {CMDS}, spans AS (
  SELECT pv_name, event_type, ts AS since, coalesce(lead(ts) OVER (PARTITION BY pv_name ORDER BY ts, seq), TIMESTAMP '9999-01-01') AS until
  FROM cmds)
SELECT ev.seq, ev.pv_name, ev.ts_ms, ev.value
FROM ev JOIN spans ON ev.pv_name = spans.pv_name AND ev.ts > since AND ev.ts < until
WHERE spans.event_type = 'signup' AND ev.event_type NOT IN ('signup', 'error')""",
    "monitor_command_outcomes": f"""WITH {EV}, {CMDS}
SELECT seq, pv_name, CASE event_type WHEN 'signup' THEN 'start' ELSE 'stop' END AS command,
  CASE WHEN event_type = 'signup' AND before = 'signup' THEN 'already_active' WHEN event_type = 'signup' THEN 'started'
       WHEN before = 'signup' THEN 'stopped' ELSE 'orphan_stop' END AS outcome
FROM cmds""",
    "request_reply": f"""WITH {REQUESTS}, timed AS (
  SELECT *, replied IS NOT NULL AND (timeout_ms IS NULL OR (epoch_us(replied) // 1000) <= (epoch_us(asked) // 1000) + timeout_ms) AS in_time FROM opened)
SELECT reply_id, pv_name,
  CASE WHEN in_time AND error <> 0 THEN 'error' WHEN in_time THEN 'ok' WHEN timeout_ms IS NULL THEN 'pending' ELSE 'timeout' END AS status,
  CASE WHEN in_time THEN CAST(error AS BIGINT) END AS error, CASE WHEN in_time THEN message END AS message,
  CASE WHEN in_time AND error = 0 THEN value END AS value,
  CASE WHEN in_time THEN (epoch_us(replied) // 1000) - (epoch_us(asked) // 1000) END AS latency_ms,
  CASE WHEN NOT in_time THEN (epoch_us(replied) // 1000) END AS late_reply_ms
FROM timed""",
    "triggered_snapshot": TRIGGER_ROWS,
    "triggered_snapshot_buffered": TRIGGER_VALUES,
    "snapshot_life_cycle": LIFE_ROWS,
    "silent_pvs": "SELECT 'user:' || c_custkey AS pv_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)",
    "pv_completion": f"WITH {WIN_SPINE} SELECT {_KEYS}, tail_timestamp AS timestamp, count(seq) AS n_values FROM spine LEFT JOIN win USING ({_KEYS}) GROUP BY ALL",
    "bulk_get": f"""WITH {EV}, l AS (SELECT pv_name, arg_max(seq, (ts, seq)) AS seq, arg_max(value, (ts, seq)) AS value FROM ev GROUP BY 1)
SELECT c.pv_name, l.seq, l.value, CASE WHEN l.seq IS NULL THEN 'not_found' ELSE 'ok' END AS status
FROM (SELECT 'user:' || c_custkey AS pv_name FROM customer) c LEFT JOIN l USING (pv_name)""",
    "latest_values": LATEST + ", max((epoch_us(ts) // 1000)) AS ts_ms FROM events GROUP BY user_id",
    "snapshot_at_instant": LATEST + f", CAST(0 AS BIGINT) AS error FROM events WHERE ts <= {INSTANT} AND user_id IN (SELECT s_suppkey FROM supplier) GROUP BY user_id",
    "one_shot_snapshot": f"""WITH {EV}, {RECORDS}, ends AS (
  SELECT topic, b, 4 * 1000 * (b * {WINDOW} + CASE WHEN first_type = 'error' THEN {WINDOW} // 2 ELSE {WINDOW} END) AS done
  FROM bucket WHERE first_type <> 'purchase')
SELECT topic || '-' || b AS msg_id, off AS "offset", pv_name, value
FROM bk JOIN ends USING (topic, b) WHERE off < done AND event_type <> 'error'
UNION ALL SELECT topic || '-' || b, done, NULL, NULL FROM ends""",
    "recurring_normal": f"WITH {WIN_SPINE} SELECT {_KEYS}, arg_max(value, (ts, seq)) AS value, count(seq) AS n_events FROM spine LEFT JOIN win USING ({_KEYS}) GROUP BY ALL",
    "recurring_normal_carried": f"""WITH {WIN_SPINE}, n AS (
  SELECT {_KEYS}, arg_max(value, (ts, seq)) AS value, count(seq) AS n_events FROM spine LEFT JOIN win USING ({_KEYS}) GROUP BY ALL)
SELECT {_KEYS}, last_value(value IGNORE NULLS) OVER (PARTITION BY snapshot_name, pv_name ORDER BY iteration) AS value, n_events FROM n""",
    "recurring_buffered": f"WITH {WIN_SPINE} SELECT {_KEYS}, seq, value FROM spine LEFT JOIN win USING ({_KEYS})",
    "recurring_from_specs": f"WITH {GAPPED_SPINE} SELECT {_KEYS}, push_index, seq, value FROM spine LEFT JOIN win USING ({_KEYS})",
    "recurring_buffered_lists": f"WITH {WIN} SELECT snapshot_name, iteration, pv_name, row_number() OVER (PARTITION BY snapshot_name, iteration, pv_name ORDER BY ts, seq) - 1 AS pos, value FROM win",
    "sub_push_summary": f"WITH {WIN} SELECT snapshot_name, iteration, push_index, pv_name, count(*) AS n_values, arg_min(value, (ts, seq)) AS first_value, arg_max(value, (ts, seq)) AS last_value FROM win GROUP BY ALL",
    "sub_push_merged": f"WITH {WIN} SELECT snapshot_name, iteration, pv_name, row_number() OVER (PARTITION BY snapshot_name, iteration, pv_name ORDER BY ts, seq) - 1 AS pos, value FROM win",
    "repeat_delay": f"WITH {GAPPED} SELECT {_KEYS}, seq, value FROM win",
    "snapshot_counters": f"""WITH {WIN_SPINE} SELECT snapshot_name, iteration, header_timestamp, tail_timestamp,
  count(DISTINCT pv_name) AS n_listed, count(DISTINCT pv_name) FILTER (WHERE seq IS NOT NULL) AS n_pvs, count(seq) AS n_values
FROM spine LEFT JOIN win USING ({_KEYS}) GROUP BY ALL""",
    "reassembly_robust": f"WITH {EV}, {RECORDS} SELECT kept.* FROM kept JOIN bucket ON kept.topic = bucket.topic AND kept.iteration = b + 1 WHERE first_type <> 'purchase' UNION ALL SELECT * FROM closing",
    "reassembly_exact": EXACT_ROWS,
    "reassembly_listed": f"""WITH {EV}, {MB}, {RECORDS}
SELECT closing.topic, closing.iteration, closing.header_timestamp, closing.tail_timestamp, kept."offset", mb.pv_name, kept.value
FROM closing JOIN mb ON mb.snapshot_name = closing.topic
LEFT JOIN kept ON kept.topic = closing.topic AND kept.iteration = closing.iteration AND kept.pv_name = mb.pv_name
UNION ALL SELECT * FROM closing WHERE topic IN (SELECT snapshot_name FROM mb)""",
    "reassembly_completed": f"""WITH {EV}, {MB}, {RECORDS}
SELECT bucket.topic, b + 1 AS iteration, mb.pv_name, count(kept.value) AS n_values
FROM bucket JOIN mb ON mb.snapshot_name = bucket.topic
LEFT JOIN kept ON kept.topic = bucket.topic AND kept.iteration = b + 1 AND kept.pv_name = mb.pv_name
WHERE first_type <> 'purchase' GROUP BY ALL""",
    "put_state": STATE,
    "put_state_wide": f"SELECT pv_name, max(value) FILTER (WHERE field = '1-URGENT') AS urgent, max(value) FILTER (WHERE field = '2-HIGH') AS high, max(value) FILTER (WHERE field = '3-MEDIUM') AS medium, max(value) FILTER (WHERE field = '4-NOT SPECIFIED') AS not_specified, max(value) FILTER (WHERE field = '5-LOW') AS low FROM ({STATE}) GROUP BY pv_name",
    "table_pack": f"""WITH {TABLES} SELECT l_orderkey, row_index // 100000 AS part, row_index // 100000 * 100000 AS first_position, 'linenumber,quantity,price,discount,flag' AS labels, count(*) AS n_rows,
  arg_min(price, row_index) AS first_price, arg_max(price, row_index) AS last_price FROM li GROUP BY ALL""",
    "table_unpack": f"WITH {TABLES} SELECT l_orderkey, 'ok' AS status, row_index, linenumber, quantity, price, discount, flag FROM li",
    "table_set_column": f"""WITH {TABLES}, t AS (SELECT l_orderkey, row_index // 100000 AS part, sum(quantity) AS q, sum(discount) AS d FROM li GROUP BY ALL)
SELECT l_orderkey, part,
  CASE WHEN o_orderkey IS NULL OR o_orderstatus = 'F' THEN 'unchanged' WHEN o_orderpriority = '1-URGENT' THEN 'undefined_label' ELSE 'replaced' END AS status,
  round(CASE WHEN o_orderkey IS NULL OR o_orderstatus = 'F' OR o_orderpriority = '1-URGENT' THEN q ELSE d END, 2) AS sum_quantity
FROM t LEFT JOIN orders ON o_orderkey = l_orderkey""",
    "traffic_by_pv_day": TRAFFIC,
    "traffic_by_topic": f"WITH {ROUTED} SELECT topic, epoch_ms(date_trunc('hour', ts)) AS bucket_start_ms, count(*) AS n_messages, CAST(sum(message_size) AS BIGINT) AS n_bytes, max(message_size) AS max_bytes FROM routed JOIN events ON event_id = \"offset\" GROUP BY 1, 2",
    "live_source_stream": "SELECT event_id AS seq, 'user:' || user_id AS pv_name, (epoch_us(ts) // 1000) AS ts_ms, value FROM events",
    "monitor_stream": MONITORED,
    "delivery_stream": "SELECT 'user:' || user_id AS pv_name, value FROM events WHERE user_id IN (SELECT s_suppkey FROM supplier)",
    # Windows and pushes the watermark has closed at the end of the input.
    "recurring_normal_stream": f"WITH {WIN} SELECT {_KEYS}, arg_max(value, (ts, seq)) AS value, count(*) AS n_events FROM win WHERE tail_timestamp <= (SELECT max(ts_ms) - {LATE} FROM ev) GROUP BY ALL",
    "recurring_buffered_stream": f"""WITH {GAPPED} SELECT {_KEYS}, row_number() OVER (PARTITION BY snapshot_name, iteration, pv_name ORDER BY ts, seq) - 1 AS pos, value
FROM win WHERE tail_timestamp + {GAP} <= (SELECT max(ts_ms) - {LATE} FROM ev WHERE (ts_ms - {ORIGIN}) % {WINDOW + GAP} < {WINDOW})""",
    "sub_push_stream": f"""WITH {WIN} SELECT snapshot_name, iteration, push_index, pv_name,
  row_number() OVER (PARTITION BY snapshot_name, iteration, push_index, pv_name ORDER BY ts, seq) - 1 AS pos, value
FROM win WHERE header_timestamp + (push_index + 1) * {PUSH} <=
  (SELECT max({ORIGIN} + ((ts_ms - {ORIGIN}) // {PUSH} + 1) * {PUSH}) - {LATE} - {PUSH} FROM ev)""",
    "triggered_stream": _passed(TRIGGER_ROWS, "trigger_id", LISTED_EVENTS),
    "triggered_buffered_stream": _passed(TRIGGER_VALUES, "trigger_id", LISTED_EVENTS),
    "reassembly_stream": EXACT_ROWS,
    "request_reply_stream": f"""WITH {REQUESTS}, timed AS (
  SELECT *, replied IS NOT NULL AND (epoch_us(replied) // 1000) <= (epoch_us(asked) // 1000) + {TIMEOUT} AS in_time FROM opened
  -- Requests that the watermark of both inputs has closed at the end of the input.
  WHERE epoch_us(asked) + {TIMEOUT} * 1000 < (SELECT least((SELECT max(epoch_us(o_orderdate)) FROM orders), (SELECT max(epoch_us(l_shipdate)) FROM lineitem))))
SELECT reply_id, pv_name,
  CASE WHEN in_time AND error <> 0 THEN 'error' WHEN in_time THEN 'ok' WHEN timeout_ms IS NULL THEN 'pending' ELSE 'timeout' END AS status,
  CASE WHEN in_time THEN CAST(error AS BIGINT) END AS error, CASE WHEN in_time THEN message END AS message,
  CASE WHEN in_time THEN (epoch_us(replied) // 1000) - (epoch_us(asked) // 1000) END AS latency_ms
FROM timed""",
    "latest_stream": LATEST + " FROM events GROUP BY user_id",
    "put_state_stream": STATE,
    "snapshot_life_cycle_stream": _passed(LIFE_ROWS, "trigger_id", LISTED_EVENTS),
    "recurring_rows_stream": f"WITH {WIN} SELECT {_KEYS}, seq, value FROM win",
    "traffic_stream": f"SELECT * FROM ({TRAFFIC}) WHERE bucket_start_ms + 86400000 <= (SELECT max(epoch_us(ts) // 1000) - {LATE} FROM events)",
    "get_results": f"""WITH {ROUTED}, req AS (SELECT 'req-' || p_partkey AS reply_id, 'user:' || (p_size - 1) AS pv_name FROM part)
SELECT reply_id, pv_name, "offset", CASE WHEN pv_name = 'user:' || user_id THEN value END AS value,
  CASE WHEN pv_name <> 'user:' || user_id THEN reply_id END AS whole_reply_id
FROM routed JOIN req ON msg_id = reply_id WHERE route = 'reply'""",
}

ORACLE["snapshots_from_specs"] = f"""WITH {EV}, {MB}, {TRIG}, spec AS (
  SELECT snapshot_name, pv_name, n, CASE WHEN n % 2 = 1 THEN 'timedbuffered' ELSE 'normal' END AS kind, n % 4 > 1 AS manual,
    CAST(CASE WHEN n % 4 = 2 THEN 1000 WHEN n % 3 = 0 THEN {WINDOW} ELSE {2 * WINDOW} END AS BIGINT) AS win
  FROM (SELECT *, CAST(substr(snapshot_name, 6) AS INTEGER) AS n FROM mb) WHERE n % 7 <> 6 AND n % 11 <> 10
), spine AS (
  SELECT spec.*, unnest(generate_series(1, (SELECT max(ts_ms) FROM ev) // win - {ORIGIN} // win + 1)) AS iteration
  FROM spec WHERE NOT manual
), placed AS (
  SELECT spine.snapshot_name, iteration, spine.pv_name, kind, manual, n, win, ev.seq, ev.value, ev.ts
  FROM spine LEFT JOIN ev ON ev.pv_name = spine.pv_name AND ev.ts_ms >= {ORIGIN} + (iteration - 1) * win AND ev.ts_ms < {ORIGIN} + iteration * win
  WHERE iteration <= ((SELECT max(ts_ms) FROM ev) - {ORIGIN}) // win + 1
  UNION ALL
  SELECT spec.snapshot_name, iteration, spec.pv_name, kind, manual, n, win, ev.seq, ev.value, ev.ts
  FROM spec JOIN trig USING (snapshot_name) LEFT JOIN ev ON ev.pv_name = spec.pv_name AND ev.ts_us <= trig.ts_us
    AND (kind = 'normal' OR ev.ts_us > trig.ts_us - win * 1000)
  WHERE manual
), rows AS (
  SELECT snapshot_name, iteration, pv_name, kind, manual, n, CASE WHEN NOT manual AND seq IS NOT NULL THEN
    CASE WHEN n % 5 = 1 THEN (epoch_us(ts) // 1000 - {ORIGIN} - (iteration - 1) * win) // {PUSH} ELSE 0 END END AS push_index, seq, value
  FROM placed WHERE kind = 'timedbuffered'
  UNION ALL
  SELECT snapshot_name, iteration, pv_name, kind, manual, n, NULL, arg_max(seq, (ts, seq)), arg_max(value, (ts, seq))
  FROM placed WHERE kind = 'normal' GROUP BY ALL
)
SELECT snapshot_name, iteration, CAST(push_index AS BIGINT) AS push_index, rows.pv_name, seq, rows.value, kind AS type, manual AS triggered,
  CASE WHEN props IS NULL THEN NULL WHEN n % 3 = 1 THEN '{{}}' ELSE props_kept END AS fields
FROM rows LEFT JOIN (SELECT seq, props, CAST(json_object('k', json_extract(props, '$.k')) AS VARCHAR) AS props_kept FROM ev) USING (seq)"""
ORACLE["get_outcomes"] = f"""WITH {ROUTED}, req AS (SELECT 'req-' || p_partkey AS reply_id, 'user:' || (p_size - 1) AS pv_name FROM part),
first AS (SELECT msg_id, min("offset") AS came FROM routed WHERE route = 'reply' GROUP BY msg_id)
SELECT reply_id, pv_name, CASE WHEN came IS NULL THEN 'unanswered' ELSE 'ok' END AS status, came AS "offset",
  CASE WHEN came IS NOT NULL THEN CAST(0 AS BIGINT) END AS error, CAST(NULL AS VARCHAR) AS message,
  CASE WHEN pv_name = 'user:' || user_id THEN value END AS value
FROM req LEFT JOIN first ON first.msg_id = reply_id LEFT JOIN routed ON routed."offset" = came"""
ORACLE["deliver_while_active_stream"] = _passed(ORACLE["deliver_while_active"], "seq", "events")
ORACLE["one_shot_snapshot_stream"] = ORACLE["one_shot_snapshot"]
ORACLE["envelope_demux_stream"] = ORACLE["envelope_demux"]
