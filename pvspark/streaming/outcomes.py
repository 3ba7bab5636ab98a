"""First replies to live requests, by groups of requests that share a row of the state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.streaming.state import GroupState

# What a waiting row is.  ``text`` and ``number`` are the PV name and timeout of a request, the message and error of
# a reply; ``known`` is false where ``number`` is null.  Texts are bytes, so any of them comes through unchanged.
REQUEST, REPLY = 0, 1
_WAITING = pa.schema(
    [("id", pa.large_binary()), ("text", pa.large_binary()), ("at", pa.int64()), ("number", pa.int64()),
     ("known", pa.bool_()), ("what", pa.int8())]
)

OUTCOMES = (
    "id BINARY, pv_name BINARY, requested BIGINT, timeout_ms BIGINT, replied BIGINT, error BIGINT, message BINARY"
)


def _pack(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _WAITING, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpack(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all()


def _arrived(frame: pd.DataFrame) -> pa.Table:
    columns = [pa.array(frame[field.name], field.type, from_pandas=True) for field in _WAITING]
    return pa.Table.from_arrays(columns, schema=_WAITING)


def _codes(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each different text, -1 for null, and the texts by their number."""
    encoded = texts.dictionary_encode()
    return encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def _ranks(texts: pa.Array) -> np.ndarray:
    """The place of each text in the order of bytes; null comes first."""
    codes, different = _codes(texts)
    rank = np.empty(len(different) + 1, np.int64)
    rank[pc.array_sort_indices(different).to_numpy()] = np.arange(len(different))
    rank[-1] = -1
    return rank[codes]


def _nullable(values: np.ndarray, known: np.ndarray) -> pd.arrays.IntegerArray:
    return pd.arrays.IntegerArray(np.where(known, values, 0), ~known)


def _settle(rows: pa.Table, bound_ms: int, watermark_ms: int) -> tuple[pa.Table, pd.DataFrame]:
    """What still waits, and the outcomes of the requests whose bound the watermark has passed.

    A reply that the watermark has passed is kept only as the first one to a request that still waits: nothing
    can come in before it, and no request that comes later may take it.
    """
    ids, text = (rows.column(name).combine_chunks() for name in ("id", "text"))
    at, number, known, what = (rows.column(name).to_numpy() for name in ("at", "number", "known", "what"))
    names, _ = _codes(ids)
    instants, rank = np.unique(at, return_inverse=True)
    # The order of (id, instant) in one number.
    place = names * len(instants) + rank
    asked, replies = np.flatnonzero(what == REQUEST), np.flatnonzero(what == REPLY)
    pv_name, _ = _codes(text.take(pa.array(asked)))
    again = pd.DataFrame(
        {"place": place[asked], "pv_name": pv_name, "known": known[asked], "number": number[asked]}
    ).duplicated()
    asked = asked[~again.to_numpy()]
    message = _ranks(text.take(pa.array(replies)))
    replies = replies[np.lexsort([message, number[replies], known[replies], place[replies]])]
    first = np.append(replies, -1)[place[replies].searchsorted(place[asked])]
    patience_ms = np.where(known[asked], np.minimum(number[asked], bound_ms), bound_ms)
    found = (first >= 0) & (names[first] == names[asked]) & (at[first] <= at[asked] + patience_ms * 1000)
    closed = at[asked] <= (watermark_ms - bound_ms - 1) * 1000

    kept = np.zeros(len(rows), bool)
    kept[asked[~closed]] = True
    kept[replies] = at[replies] > watermark_ms * 1000
    kept[first[found & ~closed]] = True

    done, reply, has = asked[closed], first[closed], found[closed]
    taken = pa.array(reply, mask=~has)
    outcomes = pd.DataFrame(
        {
            "id": ids.take(pa.array(done)).to_pandas(),
            "pv_name": text.take(pa.array(done)).to_pandas(),
            "requested": at[done],
            "timeout_ms": _nullable(number[done], known[done]),
            "replied": _nullable(at[reply], has),
            "error": _nullable(number[reply], has & known[reply]),
            "message": text.take(taken).to_pandas(),
        }
    )
    return rows.filter(pa.array(kept)), outcomes


def first_replies(bound_ms: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """Each request with its first reply, once the watermark has passed the request's bound.

    Requests are very many and small, so a group of them is taken at once.  Rows wait as they came until the
    watermark has passed one of them.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        parts = [_unpack(state.get[0])] if state.exists else [_WAITING.empty_table()]
        rows = pa.concat_tables([*parts, *(_arrived(frame) for frame in frames if len(frame))])
        watermark_ms = max(0, state.getCurrentWatermarkMs())
        at = rows.column("at").to_numpy()
        if (at <= watermark_ms * 1000).any():
            rows, outcomes = _settle(rows, bound_ms, watermark_ms)
            at = rows.column("at").to_numpy()
            if len(outcomes):
                yield outcomes
        if not len(rows):
            if state.exists:
                state.remove()
            return
        state.update((_pack(rows),))
        # The next request's bound, or else the last reply, which then serves no request any more.
        asked = rows.column("what").to_numpy() == REQUEST
        until_us = int(at[asked].min()) + bound_ms * 1000 if asked.any() else int(at.max())
        state.setTimeoutTimestamp(max(1, watermark_ms, -(-until_us // 1000)))

    return step
