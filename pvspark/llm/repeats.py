"""Removal of byte strings of 400 that occur more than once, with suffix arrays.

A byte goes if any 400-byte string that covers it also starts elsewhere, in the same document or another.

1. Anchors (``repeats_anchors``) cut each document's windows into runs; equal windows have equal
   anchors.  Only hashes, digests and places are shuffled.
2. A context that occurs twice is repeated as a whole.  A gram that occurs once ends there.
3. The distinct contexts of the other grams are fetched from their documents and meet by gram.  Those
   that share too little with any other around the gram are left out; for the rest a suffix array
   (``suffix_array``) is built over a block of groups, and neighbours in it that agree on 400 bytes are
   repeated windows.
4. Each document gets its removed runs and is rewritten once.

Bounds: a gram with more than ``max_group`` distinct contexts (a line that many documents share) is
dealt out again by the 369 bytes that all windows of a stretch of 32 starts have in common, so only true
near-repeats meet.  What still exceeds the bound (the edges of a passage of very many documents) is
counted window by window with aggregates.  No group, context or occurrence is cut or dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pvspark.llm.repeats_anchors import BUFFER, LENGTH, anchors_of
from pvspark.llm.scratch import NUMBER_ROWS, TEXT_ROWS, batch_rows, written
from pvspark.llm.suffix_array import suffix_array

MAX_GROUP = 256
#: Starts per stretch when a group is dealt out again.
STRETCH = 32
#: Bytes of one suffix array's text, more or less.
BLOCK = 1 << 18

_ID, _KEY = "_id", "_key"


def _identified(docs: DataFrame) -> DataFrame:
    """A row is known by its id (as text, null: empty) and a hash of its text."""
    return docs.withColumn(_ID, F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).withColumn(
        _KEY, F.xxhash64("text")
    )


def _find_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [_ID, _KEY, "gram", "first", "last", "place", "digest"]
    for batch in batches:
        held: list[tuple[str, int, bytes]] = []
        for own, key, text in zip(batch[_ID], batch[_KEY], batch["text"]):
            raw = (text or "").encode("utf-8", "replace")
            if len(raw) >= LENGTH:
                held.append((own, key, raw))
        while held:
            part, size = [], 0
            while held and (not part or size + len(held[-1][2]) <= BUFFER):
                part.append(held.pop())
                size += len(part[-1][2])
            rows = []
            for (own, key, raw), shift, (begin, end) in _pieces(part):
                rows.append((own, key, shift, begin, end, raw))
            buffer = np.frombuffer(b"".join(r[5][r[2] : r[2] + r[4] - r[3]] for r in rows), np.uint8)
            out = [
                (rows[i][0], rows[i][1], gram, first + rows[i][2], last + rows[i][2], place + rows[i][2], digest)
                for i, gram, first, last, place, digest in _in_buffers(buffer, [(r[3], r[4]) for r in rows])
            ]
            yield pd.DataFrame(out, columns=names)


#: A text longer than this is searched in overlapping pieces, to bound the memory of a task.
_PIECE = 1 << 22


def _pieces(part):
    """Texts with the pieces they are searched in: (text, where the piece starts, its place in the buffer)."""
    at = 0
    for item in part:
        size = len(item[2])
        for shift in range(0, max(1, size - LENGTH + 1), _PIECE):
            length = min(size - shift, _PIECE + LENGTH - 1)
            yield item, shift, (at, at + length)
            at += length


def _in_buffers(buffer: np.ndarray, bounds: list[tuple[int, int]]):
    """As ``anchors_of``, a few pieces at a time."""
    i = 0
    while i < len(bounds):
        j = i + 1
        while j < len(bounds) and bounds[j][1] - bounds[i][0] <= BUFFER:
            j += 1
        base = bounds[i][0]
        for number, *rest in anchors_of(buffer[base : bounds[j - 1][1]], [(a - base, b - base) for a, b in bounds[i:j]]):
            yield number + i, *rest
        i = j


def anchor_table(docs: DataFrame) -> DataFrame:
    source = _identified(docs.select("doc_id", "text")).select(_ID, _KEY, "text")
    return source.mapInPandas(
        _find_anchors,
        f"{_ID} STRING, {_KEY} LONG, gram LONG, first LONG, last LONG, place LONG, digest BINARY",
    )


def _fetch(max_group: int):
    """Contexts of a document, or stretches of those whose gram is too common."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for own, key, text, wanted in zip(batch[_ID], batch[_KEY], batch["text"], batch["wanted"]):
                raw = text.encode("utf-8", "replace")
                for w in wanted:
                    first, last, place = w["first"], w["last"], w["place"]
                    if w["n_contexts"] <= max_group:
                        context = raw[first : last + LENGTH]
                        rows.append((own, key, w["gram"], 0, context, first, place - first, w["single"], False))
                        continue
                    # Stretches count from the anchor, so equal windows fall into equal stretches.
                    for block in range((place - last) // STRETCH, (place - first) // STRETCH + 1):
                        a = max(first, place - block * STRETCH - STRETCH + 1)
                        b = min(last, place - block * STRETCH)
                        # What every window of the stretch has, so it never leaves the document.
                        core = raw[place - block * STRETCH : place - block * STRETCH - STRETCH + 1 + LENGTH]
                        stretch = b"%d:%d:" % (w["gram"], block)
                        digest = hashlib.blake2b(stretch + core, digest_size=16).digest()
                        one, two = np.frombuffer(digest, np.int64).tolist()
                        rows.append((own, key, one, two, raw[a : b + LENGTH], a, place - a, w["single"], True))
            yield pd.DataFrame(
                rows, columns=[_ID, _KEY, "group", "part", "context", "start", "place", "single", "dealt"]
            )

    return run


def _agreement(sides: list[bytes]) -> list[int]:
    """For each string the longest common prefix with any other; sorted neighbours decide."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    best = [0] * len(sides)
    for i, j in zip(order, order[1:]):
        a, b = sides[i], sides[j]
        low, high = 0, min(len(a), len(b))
        if a[:high] == b[:high]:
            low = high
        while low < high:
            mid = (low + high + 1) // 2
            if a[low:mid] == b[low:mid]:
                low = mid
            else:
                high = mid - 1
        best[i], best[j] = max(best[i], low), max(best[j], low)
    return best


def repeated_windows(contexts: list[bytes]) -> list[np.ndarray]:
    """For each context, the starts of its 400-byte windows that occur again in any of them."""
    symbols = np.zeros(sum(map(len, contexts)) + len(contexts) + 1, np.int64)
    raw = np.zeros(len(symbols) + LENGTH, np.uint8)
    valid = np.zeros(len(symbols), bool)
    begins, at = [], 0
    for context in contexts:
        own = np.frombuffer(context, np.uint8)
        begins.append(at)
        symbols[at : at + len(own)] = own.astype(np.int64) + 2
        raw[at : at + len(own)] = own
        symbols[at + len(own)] = 1
        valid[at : at + max(0, len(own) - LENGTH + 1)] = True
        at += len(own) + 1
    order = np.array(suffix_array(symbols.tolist()), np.int64)
    left, right = order[:-1], order[1:]
    both = np.flatnonzero(valid[left] & valid[right])
    window = np.lib.stride_tricks.sliding_window_view(raw, LENGTH)
    again = np.zeros(len(symbols), bool)
    for k in range(0, len(both), 4096):
        a, b = left[both[k : k + 4096]], right[both[k : k + 4096]]
        same = (window[a] == window[b]).all(axis=1)
        again[a[same]] = again[b[same]] = True
    return [np.flatnonzero(again[b : b + len(c)]) for b, c in zip(begins, contexts)]


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Bytes covered by windows at ascending starts, as maximal runs."""
    if not len(starts):
        return []
    cuts = np.flatnonzero(np.diff(starts) > LENGTH)
    firsts = starts[np.concatenate(([0], cuts + 1))]
    lasts = starts[np.concatenate((cuts, [len(starts) - 1]))]
    return list(zip(firsts.tolist(), (lasts + LENGTH).tolist()))


def _search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs repeated by groups of contexts that come one after another, sorted by group and part."""
    group: list[tuple] = []
    block: list[tuple] = []
    out: list[tuple] = []
    size, now = 0, None

    def close_group() -> None:
        nonlocal size
        if len(group) > 1:
            right = _agreement([g[4][g[6] :] for g in group])
            left = _agreement([g[4][: g[6]][::-1] for g in group])
            for g, r, l in zip(group, right, left):
                if l + r >= LENGTH:
                    block.append((g[0], g[1], g[5] + g[6] - l, g[7], g[4][g[6] - l : g[6] + r]))
                    size += l + r
        group.clear()

    def close_block() -> None:
        nonlocal size
        if block:
            for (own, key, start, single, _), starts in zip(block, repeated_windows([b[4] for b in block])):
                if single:
                    out.extend((own, key, start + a, start + b) for a, b in _runs(starts))
        block.clear()
        size = 0

    def result() -> pd.DataFrame:
        frame = pd.DataFrame(out, columns=[_ID, _KEY, "begin", "end"])
        out.clear()
        return frame

    for batch in batches:
        for row in batch.itertuples(index=False, name=None):
            if row[2:4] != now:
                close_group()
                if size >= BLOCK:
                    close_block()
                now = row[2:4]
            group.append(row)
        if out:
            yield result()
    close_group()
    close_block()
    yield result()


def _digest_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for own, key, context, start, single in zip(*(batch[c] for c in (_ID, _KEY, "context", "start", "single"))):
            n = len(context) - LENGTH + 1
            digests = [hashlib.blake2b(context[i : i + LENGTH], digest_size=16).digest() for i in range(n)]
            yield pd.DataFrame({_ID: own, _KEY: key, "begin": np.arange(start, start + n), "single": single, "digest": digests})


def _distinct_stretches(dealt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row for each different stretch, and the runs of stretches that occur more than once.

    Such a stretch is repeated as a whole; it stays as one row that others may match, but asks no more.
    """
    marked = dealt.withColumn("digest", F.md5("context"))
    at = F.struct(_ID, _KEY, "context", "start", "place", "single")
    classes = written(
        marked.groupBy("group", "part", "digest").agg(F.count(F.lit(1)).alias("n"), F.first(at).alias("at")),
        "stretches",
    )
    single = (F.col("at.single") & (F.col("n") == 1)).alias("single")
    rows = classes.select(
        f"at.{_ID}", f"at.{_KEY}", "group", "part", "at.context", "at.start", "at.place", single, F.lit(True).alias("dealt")
    )
    often = classes.filter("n > 1").select("group", "part", "digest")
    runs = marked.filter("single").join(often, ["group", "part", "digest"], "left_semi").select(
        _ID, _KEY, F.col("start").alias("begin"), (F.col("start") + F.octet_length("context")).cast("long").alias("end")
    )
    return rows, runs


def repeated_runs(docs: DataFrame, max_group: int = MAX_GROUP) -> DataFrame:
    """``_id``, ``_key``, ``begin``, ``end`` of byte runs to remove; runs may overlap or repeat."""
    spark = docs.sparkSession
    with batch_rows(spark, TEXT_ROWS):
        anchors = written(anchor_table(docs), "anchors")
    source = _identified(docs.select("doc_id", "text"))
    with batch_rows(spark, TEXT_ROWS):
        # Written, so that the join below can split a gram that very many rows have.
        common = written(
            anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("digest").alias("a"), F.max("digest").alias("b"))
            .filter("n > 1")
            .select("gram", (F.col("a") != F.col("b")).alias("differ")),
            "common_grams",
        )
        place = F.struct(_ID, _KEY, "first", "last", "place")
        contexts = written(
            anchors.join(common, "gram")
            .groupBy("gram", "differ", "digest")
            .agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("at")),
            "contexts",
        )
        whole = anchors.join(contexts.filter("n > 1").select("gram", "digest"), ["gram", "digest"], "left_semi").select(
            _ID, _KEY, F.col("first").alias("begin"), (F.col("last") + LENGTH).alias("end")
        )
        differing = contexts.filter("differ")
        sizes = differing.groupBy("gram").agg(F.count(F.lit(1)).alias("n_contexts"))
        wanted = (
            differing.join(sizes, "gram")
            .select("at.*", "gram", "n_contexts", (F.col("n") == 1).alias("single"))
            .groupBy(_ID, _KEY)
            .agg(F.collect_list(F.struct("gram", "first", "last", "place", "n_contexts", "single")).alias("wanted"))
        )
        fetched = written(
            source.select(_ID, _KEY, "text").join(wanted, [_ID, _KEY]).mapInPandas(
                _fetch(max_group),
                f"{_ID} STRING, {_KEY} LONG, `group` LONG, part LONG, context BINARY, start LONG, place LONG, "
                "single BOOLEAN, dealt BOOLEAN",
            ),
            "fetched",
        )
        stretches, repeated = _distinct_stretches(fetched.filter("dealt"))
        large = written(
            stretches.groupBy("group", "part").count().filter(F.col("count") > max_group).select("group", "part"),
            "large_groups",
        )
        within, counted = fetched.filter("NOT dealt").unionByName(stretches), repeated
        if not large.isEmpty():
            within = within.join(large, ["group", "part"], "left_anti").select(fetched.columns)
            windows = (
                stretches.join(large, ["group", "part"], "left_semi")
                .select(fetched.columns)
                .mapInPandas(
                    _digest_windows, f"{_ID} STRING, {_KEY} LONG, `begin` LONG, single BOOLEAN, digest BINARY"
                )
            )
            often = windows.groupBy("digest").count().filter("count > 1").select("digest")
            counted = counted.unionByName(
                windows.filter("single").join(often, "digest", "left_semi")
                .select(_ID, _KEY, "begin", (F.col("begin") + LENGTH).alias("end"))
            )
        dealt = within.repartition("group", "part").sortWithinPartitions("group", "part")
        found = written(dealt.mapInPandas(_search, f"{_ID} STRING, {_KEY} LONG, `begin` LONG, `end` LONG"), "found")
    return whole.unionByName(found).unionByName(counted)


def _rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        kept, spans = [], []
        for text, runs in zip(batch["text"], batch["runs"]):
            raw = (text or "").encode("utf-8", "replace")
            merged: list[list[int]] = []
            for begin, end in sorted((r["begin"], r["end"]) for r in runs) if runs is not None else ():
                if merged and begin <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([begin, end])
            at, parts = 0, []
            for begin, end in merged:
                parts.append(raw[at:begin])
                at = end
            kept.append(b"".join([*parts, raw[at:]]))
            spans.append(merged)
        yield batch.drop(columns=["text", "runs"]).assign(
            n_bytes=[len(k) + sum(b - a for a, b in s) for k, s in zip(kept, spans)], kept=kept, removed=spans
        )


def remove_repeats(docs: DataFrame, max_group: int = MAX_GROUP) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``kept`` (remaining bytes), ``removed`` (maximal runs).

    Null text counts as empty.  Repeated rows are documents of their own, so what they share (from 400
    bytes on) goes from all of them.  Null ids are kept.  An empty table gives an empty result.  Other
    columns are not read.
    """
    runs = (
        repeated_runs(docs, max_group)
        .groupBy(_ID, _KEY)
        .agg(F.collect_list(F.struct("begin", "end")).alias("runs"))
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    joined = _identified(docs.select("doc_id", "text")).join(runs, [_ID, _KEY], "left").select("doc_id", "text", "runs")
    return joined.mapInPandas(
        _rewrite, f"doc_id {id_type}, n_bytes LONG, kept BINARY, removed ARRAY<ARRAY<LONG>>"
    )
