"""Streams with custom keyed state: reassembly, triggered snapshots, snapshot life cycle.

Triggers, life cycles and deliveries follow event time: rows wait in the state until the watermark has passed
them and are then taken in order, so the result does not depend on which micro-batch brought them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pvspark.operators.reassembly import DATA, HEADER, TAIL
from pvspark.operators.routing import parse_one_shot
from pvspark.operators.specs import NORMAL, TIMED_BUFFERED
from pvspark.sizing import checked_broadcast

REASSEMBLED = (
    "topic STRING, header_offset BIGINT, iteration BIGINT, header_timestamp BIGINT, "
    "tail_timestamp BIGINT, offset BIGINT, pv_name STRING, value DOUBLE"
)


def _columns(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _gather(rows: Iterator[pd.DataFrame], *order: str) -> dict[str, np.ndarray]:
    """The columns of one key's rows in this micro-batch, sorted.

    A micro-batch is bounded by the source (files or offsets per trigger), and so is this.
    Keys are many and mostly small, so plain arrays are used instead of frames.
    """
    frames = list(rows)
    columns = {
        name: np.concatenate([frame[name].to_numpy() for frame in frames])
        for name in frames[0].columns
    }
    index = np.lexsort([columns[name] for name in reversed(order)])
    return {name: values[index] for name, values in columns.items()}


def _rows(batch: dict[str, np.ndarray], mask: np.ndarray, *names: str) -> list[tuple]:
    return list(zip(*[batch[name][mask].tolist() for name in names]))


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_columns(schema))


class ReassemblyProcessor(StatefulProcessor):
    """One open iteration per topic: its header, and its values so far in a list state.

    Only headers and tails are looked at one by one; the data between them is taken as a
    block.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.header = handle.getValueState(
            "header", "header_offset BIGINT, iteration BIGINT, header_timestamp BIGINT"
        )
        self.values = handle.getListState("values", "offset BIGINT, pv_name STRING, value DOUBLE")

    def handleInputRows(
        self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any
    ) -> Iterator[pd.DataFrame]:
        batch = _gather(rows, "offset")
        kind, offset, iteration = batch["message_type"], batch["offset"], batch["iter_index"]
        is_value = (kind == DATA) & ~pd.isna(batch["pv_name"])

        def values_between(low: int, high: float, current: int) -> list[tuple]:
            inside = is_value & (offset > low) & (offset < high) & (iteration == current)
            return _rows(batch, inside, "offset", "pv_name", "value")

        opened = self.header.get()
        since = -1
        out: list[tuple] = []
        control = (kind == HEADER) | (kind == TAIL)
        for what, where, current, when in _rows(
            batch, control, "message_type", "offset", "iter_index", "timestamp_ms"
        ):
            if what == HEADER:
                if opened is None:
                    opened, since = (where, current, when), where
            elif opened is not None and current == opened[1]:
                stored = [tuple(item) for item in self.values.get()]
                whole = [*stored, *values_between(since, where, current), (where, None, None)]
                out.extend((key[0], *opened, when, *item) for item in whole)
                self.values.clear()
                opened = None
        if opened is None:
            self.header.clear()
        else:
            self.header.update(tuple(opened))
            fresh = values_between(since, math.inf, opened[1])
            if fresh:
                self.values.appendList(fresh)
        if out:
            yield _frame(out, REASSEMBLED)

    def close(self) -> None:
        pass


def reassembly_stream(records: DataFrame) -> DataFrame:
    """Completed iterations of live snapshot records, strict rule, one row per value.

    The last row of an iteration has a null ``pv_name`` and the tail's offset, so an empty
    iteration shows too.  Records of a topic must arrive in offset order across batches.
    """
    prepared = records.select(
        "topic",
        "offset",
        "message_type",
        F.coalesce("iter_index", F.lit(0)).alias("iter_index"),
        "timestamp_ms",
        "pv_name",
        "value",
    ).where(F.col("message_type").isNotNull())
    return prepared.groupBy("topic").transformWithStateInPandas(
        ReassemblyProcessor(), REASSEMBLED, "append", "none"
    )


# What a waiting row is: an event (0) or one of the commands.
_EVENT, _TRIGGER, _START, _STOP = 0, 1, 2, 3

# Waiting rows of a key, as plain bytes in its state.  ``known`` is false where ``seq`` is null.
_WAITING = np.dtype(
    [("at", "i8"), ("rank", "i1"), ("known", "?"), ("seq", "i8"), ("what", "i1"), ("value", "f8"), ("window_us", "i8")]
)
_VALUE = np.dtype([("at", "i8"), ("known", "?"), ("seq", "i8"), ("value", "f8")])
_ORDERED_STATE = "waiting BINARY, carried BINARY, active BOOLEAN, iteration BIGINT"

# A key's rows in order, and what it carries (values, active, iteration): the new carry, and the rows out.
_Carry = tuple[np.ndarray, bool, int]
_Take = Callable[[np.ndarray, _Carry], tuple[_Carry, dict[str, Any]]]


def _command(column: Column, no_command: int) -> Column:
    code = F.when(column == "trigger", _TRIGGER).when(column == "start", _START).otherwise(_STOP)
    return F.when(column.isNull(), no_command).otherwise(code)


def _waiting(rows: DataFrame, keys: list[str], rank: int, seq: str, what: Column, value: Column, window_us: Column) -> DataFrame:
    """Rows as ``_WAITING`` has them, and ``ts`` for the watermark.  One without an instant has no place in the order."""
    return rows.where(F.col("ts").isNotNull()).select(
        *keys,
        "ts",
        F.unix_micros("ts").alias("at"),
        F.lit(rank).cast("tinyint").alias("rank"),
        F.col(seq).isNotNull().alias("known"),
        F.coalesce(seq, F.lit(0)).cast("bigint").alias("seq"),
        what.cast("tinyint").alias("what"),
        value.cast("double").alias("value"),
        F.coalesce(window_us, F.lit(0)).cast("bigint").alias("window_us"),
    )


def _nullable(values: np.ndarray, known: np.ndarray) -> pd.arrays.IntegerArray:
    return pd.arrays.IntegerArray(values.astype(np.int64), ~known)


def _in_order(
    rows: DataFrame, keys: list[str], out_schema: str, take: _Take, active: bool, lateness_ms: int
) -> DataFrame:
    """``take`` applied to each key's rows in the order of ``at`` (microseconds), ``rank`` and ``seq``.

    Rows wait in the key's state until the watermark has passed them; then all that it has passed are taken
    together, sorted.  What waits is what arrived within the allowed lateness.  Rows later than that never get
    here: Spark drops them.  A key costs one call and one state row in a micro-batch, and its rows are arrays
    throughout, so neither the number of keys nor that of rows means round trips to the state store.
    """
    names = _columns(out_schema)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting, carried, running, iteration = state.get if state.exists else (b"", b"", active, 0)
        parts = [np.frombuffer(waiting, _WAITING)]
        for frame in frames:
            part = np.empty(len(frame), _WAITING)
            for name in _WAITING.names if len(frame) else ():
                part[name] = frame[name].to_numpy()
            parts.append(part)
        held = np.concatenate(parts)
        watermark_ms = max(0, state.getCurrentWatermarkMs())
        passed = held["at"] < watermark_ms * 1000
        ready, rest = held[passed], held[~passed]
        out: dict[str, Any] = {}
        if len(ready):
            ready = ready[np.lexsort([ready[name] for name in ("seq", "known", "rank", "at")])]
            (values, running, iteration), out = take(
                ready, (np.frombuffer(carried, _VALUE), bool(running), int(iteration)))
            carried = values.tobytes()
        state.update((rest.tobytes(), bytes(carried), bool(running), int(iteration)))
        if len(rest):
            state.setTimeoutTimestamp(max(1, watermark_ms, int(rest["at"].min()) // 1000))
        if len(next(iter(out.values()), ())):
            yield pd.DataFrame({**dict(zip(keys, key)), **out})[names]

    return (
        rows.withWatermark("ts", f"{lateness_ms} milliseconds")
        .groupBy(*keys)
        .applyInPandasWithState(step, out_schema, _ORDERED_STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )


def _last_control(control: np.ndarray) -> np.ndarray:
    """For each row the position of the last control at or before it, -1 if there is none."""
    return np.maximum.accumulate(np.where(control, np.arange(len(control)), -1))


TRIGGERED = (
    "snapshot_name STRING, pv_name STRING, trigger_id BIGINT, iteration BIGINT, "
    "seq BIGINT, value DOUBLE"
)


def _take_snapshots(kind: str) -> _Take:
    """Last value (or the values of the window) of one PV of one snapshot at each trigger.

    A snapshot that needs a start only lives between its start and stop commands, and each start begins again
    with iteration 1 and no values.  Values are found by binary search, for all commands at once.  Only values
    a later trigger can ask for are kept.
    """

    def first(at: np.ndarray, start: Any, end: Any, after: Any) -> Any:
        """Position of the first value a snapshot at ``end`` holds."""
        if kind == NORMAL:
            return np.maximum(start, end - 1)
        return np.maximum(start, at.searchsorted(after, side="right"))

    def take(ready: np.ndarray, carry: _Carry) -> tuple[_Carry, dict[str, Any]]:
        kept, active, iteration = carry
        is_event = ready["what"] == _EVENT
        line = np.concatenate([kept, ready[is_event][list(_VALUE.names)].astype(_VALUE)])
        at, window_us = line["at"], ready["window_us"][0]
        asked = ready[~is_event]
        trigger = asked["what"] == _TRIGGER
        # Each start and stop, behind the state the snapshot was in before.
        last = _last_control(~trigger) + 1
        end = at.searchsorted(asked["at"], side="right")
        actives = np.concatenate([[active], asked["what"] == _START])
        # Values from this position on belong to the running snapshot.
        starts = np.concatenate([[0], end])
        pulled = np.cumsum(trigger)
        before = np.concatenate([[-iteration], pulled])
        at_trigger = trigger & actives[last]
        low = first(at, starts[last], end, asked["at"] - window_us)[at_trigger]
        n = np.maximum(0, end[at_trigger] - low)
        # A trigger without values has one row.
        size = np.maximum(1, n)
        of = np.repeat(np.arange(len(n)), size)
        place = low[of] + np.arange(len(of)) - (np.cumsum(size) - size)[of]
        found = np.concatenate([line, np.zeros(1, _VALUE)])[np.where(n[of] > 0, place, len(line))]
        pulls = asked[at_trigger][of]
        out = {
            "trigger_id": _nullable(pulls["seq"], pulls["known"]),
            "iteration": (pulled - before[last])[at_trigger][of],
            "seq": _nullable(found["seq"], found["known"]),
            "value": np.where(n[of] > 0, found["value"], np.nan),
        }
        if len(asked):
            active, start = bool(actives[last[-1]]), starts[last[-1]]
            # What is counted goes on only in a running snapshot; another begins anew.
            iteration = int(pulled[-1] - before[last[-1]]) if active else 0
        else:
            start = 0
        from_here = int(first(at, start, len(line), ready["at"][-1] - window_us)) if active else len(line)
        return (line[from_here:], active, iteration), out

    return take


def triggered_stream(
    events: DataFrame,
    commands: DataFrame,
    members: DataFrame,
    kind: str = NORMAL,
    needs_start: bool = False,
    lateness_ms: int = 0,
) -> DataFrame:
    """Snapshots of live events at live trigger commands, as their batch twins have them.

    ``commands`` has snapshot_name, command (``trigger``; also ``start`` and ``stop`` with
    ``needs_start``), trigger_id and ts.  They are spread over the snapshot's PV list, so
    state and work are keyed by (snapshot, PV).  A PV without a value has one null row.
    A trigger's rows appear once the watermark has passed it: the newest instant of all commands and listed
    PVs less ``lateness_ms``.  An event at the instant of a command precedes it.
    """
    if kind not in (NORMAL, TIMED_BUFFERED):
        raise ValueError(f"unknown snapshot type {kind!r}")
    listed = checked_broadcast(members.select("snapshot_name", "pv_name", "time_window"))
    keys, window_us, no_value = ["snapshot_name", "pv_name"], F.col("time_window") * 1000, F.lit(None)
    seen = _waiting(events.join(listed, "pv_name"), keys, 0, "seq", F.lit(_EVENT), F.col("value"), window_us)
    asked = _waiting(
        commands.join(listed, "snapshot_name"), keys, 1, "trigger_id", _command(F.col("command"), _STOP), no_value,
        window_us)
    return _in_order(
        seen.unionByName(asked), keys, TRIGGERED, _take_snapshots(kind), not needs_start, lateness_ms
    )


DELIVERED = "pv_name STRING, seq BIGINT, at BIGINT, value DOUBLE"


def _take_active(ready: np.ndarray, carry: _Carry) -> tuple[_Carry, dict[str, Any]]:
    """The events that come while the PV's monitor is started."""
    kept, active, iteration = carry
    control = ready["what"] != _EVENT
    last = _last_control(control) + 1
    actives = np.concatenate([[active], ready["what"] == _START])
    heard = ready[~control & actives[last]]
    out = {"seq": _nullable(heard["seq"], heard["known"]), "at": heard["at"], "value": heard["value"]}
    return (kept, bool(actives[last[-1]]), iteration), out


def delivery_stream(events: DataFrame, commands: DataFrame, lateness_ms: int = 0) -> DataFrame:
    """Live events that arrive, in (ts, seq) order, while their PV's monitor is started.

    ``commands`` has pv_name, ts, seq and command (``start`` or ``stop``).  An event appears once the watermark
    has passed it: the newest instant of events and commands less ``lateness_ms``.
    """
    keys, no_window = ["pv_name"], F.lit(0)
    seen = _waiting(events, keys, 0, "seq", F.lit(_EVENT), F.col("value"), no_window)
    asked = _waiting(commands, keys, 0, "seq", _command(F.col("command"), _EVENT), F.lit(None), no_window)
    return (
        _in_order(seen.unionByName(asked), keys, DELIVERED, _take_active, False, lateness_ms)
        .withColumn("ts", F.timestamp_micros("at"))
        .drop("at")
    )


ASSEMBLED = "msg_id STRING, completed_at BIGINT, offset BIGINT, pv_name STRING, value STRING"


# Groups of snapshots that share a row of the state.  More of them suit more snapshots open or remembered at once.
SNAPSHOT_GROUPS = 4096
_OPEN_COLUMNS = ["id", "offset", "pv_name", "value"]


def _pack(frame: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(frame, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(packed: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(packed).read_all().to_pandas()


def _assemble(remember_ms: int | None) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """Values of the open snapshots of a group, each until its first completing message.

    Which snapshots are complete is remembered, so that late messages are ignored.  Snapshots are very many
    and small, so a group of them is taken at once.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            values, done = (_unpack(packed) for packed in state.get)
        else:
            values = pd.DataFrame(columns=_OPEN_COLUMNS).astype({"offset": "int64"})
            done = pd.DataFrame({"id": pd.Series(dtype=object), "at_ms": pd.Series(dtype="int64")})
        now = state.getCurrentProcessingTimeMs()
        if remember_ms:
            done = done[done["at_ms"] > now - remember_ms]
        batch = pd.concat(list(frames), ignore_index=True).astype({"offset": "int64", "completes": bool})
        batch = batch[~batch["id"].isin(done["id"])].sort_values("offset", kind="stable")
        ends = batch[batch["completes"]].groupby("id")["offset"].min()
        fresh = batch.loc[batch["pv_name"].notna(), _OPEN_COLUMNS]
        closed, was_open = fresh["id"].isin(ends.index), values["id"].isin(ends.index)
        if len(ends):
            taken = fresh[closed]
            taken = taken[taken["offset"].to_numpy() < ends.loc[taken["id"]].to_numpy()]
            ending = pd.DataFrame({"id": ends.index, "offset": ends.to_numpy(), "pv_name": None, "value": None})
            whole = pd.concat([values[was_open], taken, ending], ignore_index=True)
            yield whole.assign(completed_at=ends.loc[whole["id"]].to_numpy())[_columns(_ASSEMBLED_IDS)]
            done = pd.concat([done, pd.DataFrame({"id": ends.index, "at_ms": now})], ignore_index=True)
        values = pd.concat([values[~was_open], fresh[~closed]], ignore_index=True)
        state.update((_pack(values), _pack(done)))
        if remember_ms and len(done):
            state.setTimeoutDuration(max(1, int(done["at_ms"].min()) + remember_ms - now))

    return step


_ASSEMBLED_IDS = ASSEMBLED.replace("msg_id", "id")


def assembly_stream(
    messages: DataFrame, remember_ms: int | None = None, groups: int = SNAPSHOT_GROUPS
) -> DataFrame:
    """One-shot snapshots of a live message log, one row per value.

    ``messages`` has msg_id, offset and value, as ``routing.assemble_snapshots`` takes them; one without an
    offset has no place in the log.  The last row of a snapshot has a null ``pv_name``, so an empty one shows
    too.  A query that runs for ever sets ``remember_ms``, after which a completed snapshot's last trace
    leaves the state; the clock then keeps the query running, so leave it out when a query
    should stop at the end of its input.  Snapshots are dealt into ``groups`` by a hash of msg_id; a running
    query keeps its number.
    """
    # A null msg_id names a snapshot like any other.
    name = F.coalesce(F.concat(F.lit("="), F.col("msg_id")), F.lit("")).alias("id")
    parsed = parse_one_shot(messages).where(F.col("offset").isNotNull())
    dealt = parsed.select(name, "offset", "completes", "pv_name", "value").withColumn(
        "dealt", F.pmod(F.xxhash64("id"), F.lit(groups))
    )
    timeout = GroupStateTimeout.ProcessingTimeTimeout if remember_ms else GroupStateTimeout.NoTimeout
    assembled = dealt.groupBy("dealt").applyInPandasWithState(
        _assemble(remember_ms), _ASSEMBLED_IDS, "open BINARY, done BINARY", "append", timeout
    )
    msg_id = F.when(F.col("id") != "", F.substring("id", 2, 2**31 - 1)).alias("msg_id")
    return assembled.select(msg_id, *_columns(ASSEMBLED)[1:])
