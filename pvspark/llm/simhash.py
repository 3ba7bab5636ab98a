"""SimHash near-duplicates found through an anchor-point covering.

A fingerprint has 64 bits; two link when at most ``threshold`` (3 or fewer) bits differ.  Then they
differ by at most one bit in the upper or the lower half.  The anchors of a half are the words of a
covering code of 32 bits: a Hamming code on 31 bits, whose balls of radius one fill the space, and one
free bit.  Every half lies within the covering radius 1 of an anchor, its home, and a half at distance 1
from it lies within 2 of that home.  So each fingerprint is copied to every anchor within 2 of either
half (17 at most), and fingerprints are compared per anchor only.

Equal fingerprints are one node, so copies cost nothing beyond their fingerprint.  Within an anchor a
spanning forest is grown: a fingerprint that is linked leaves the comparison, so a dense group costs
about its size.  An anchor with more than ``max_cell`` members is dealt out again by the anchors of the
other half (within ``1 + threshold``), which keeps every pair together: no cell is cut or dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from pvspark.llm.components import components
from pvspark.llm.scratch import NUMBER_ROWS, TEXT_ROWS, batch_rows, written

#: Seed of the shingle hash; a fixed value of the fingerprint's definition.
SEED = 42
SHINGLE_WORDS = 3
RADIUS = 1
MAX_CELL = 1 << 16
_CHUNK = 1 << 15


def shingle_hashes(text: str | None, width: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every shingle, repeats included.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` cuts at 0x20 and 0x09-0x0D.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.fromiter(map(len, words), np.int64, len(words)).cumsum() + np.arange(len(words))
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    lasts = ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, lasts)), np.uint64, len(lasts)
    )


def fingerprint(text: str | None) -> int:
    """Unsigned 64 bits; a bit is set if it is in over half the shingle hashes.  No words: zero."""
    hashes = shingle_hashes(text)
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * votes > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key`` (of the text) and ``fp`` (the 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.fromiter(map(fingerprint, batch.pop("text")), np.uint64, len(batch))
            yield batch.assign(fp=fps.view(np.int64))

    source = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return source.mapInPandas(run, f"doc_id {id_type}, key LONG, fp LONG")


_POSITIONS = np.arange(1, 32, dtype=np.uint32)


def _syndrome(word: np.ndarray) -> np.ndarray:
    s = np.zeros(len(word), np.uint32)
    for p in _POSITIONS:
        s ^= np.where((word >> np.uint32(p - 1)) & np.uint32(1), p, np.uint32(0))
    return s


def anchors(half: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code words within ``reach`` (0 to 4) of each 32-bit word, as (rows, anchors) pieces.

    Bit 31 is the free bit.  Flipping a set of positions leads to the code if their XOR is the syndrome.
    """
    s = _syndrome(half)
    rows = np.arange(len(half))
    one = np.uint32(1)

    def flip(word: np.ndarray, position: np.ndarray) -> np.ndarray:
        return np.where(position > 0, word ^ (one << np.maximum(position, one) - one), word)

    def within(budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Sets of ``budget`` flips or fewer: choose all but the last, which the syndrome decides."""
        free = np.flatnonzero(s == 0)
        yield rows[free], half[free]
        if budget >= 1:
            off = np.flatnonzero(s)
            yield rows[off], flip(half[off], s[off])
        for i in _POSITIONS if budget >= 2 else ():
            j = s ^ i
            ok = np.flatnonzero(j > i)
            yield rows[ok], flip(half[ok] ^ (one << i - one), j[ok])
            for k in range(int(i) + 1, 32) if budget >= 3 else ():
                last = s ^ i ^ np.uint32(k)
                ok = np.flatnonzero(last > k)
                two = half[ok] ^ (one << i - one) ^ (one << np.uint32(k - 1))
                yield rows[ok], flip(two, last[ok])
                for m in range(k + 1, 32) if budget >= 4 else ():
                    last = s ^ i ^ np.uint32(k) ^ np.uint32(m)
                    ok = np.flatnonzero(last > m)
                    three = half[ok] ^ (one << i - one) ^ (one << np.uint32(k - 1)) ^ (one << np.uint32(m - 1))
                    yield rows[ok], flip(three, last[ok])

    yield from within(reach)
    if reach:
        for r, a in within(reach - 1):
            yield r, a ^ (one << np.uint32(31))


def _halves(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (fp >> np.uint64(32)).astype(np.uint32), fp.astype(np.uint32)


def _replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        fp = batch["fp"].to_numpy().view(np.uint64)
        for side, half in enumerate(_halves(fp)):
            pieces = list(anchors(half, RADIUS + 1))
            rows = np.concatenate([r for r, _ in pieces])
            anchor = np.concatenate([a for _, a in pieces]).astype(np.int64) | (side << 32)
            yield pd.DataFrame({"anchor": anchor, "second": np.int64(0), "fp": fp[rows].view(np.int64)})


def _replicate_again(threshold: int):
    """Members of a large cell, dealt out by the anchors of the half that the cell is not about."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = batch["fp"].to_numpy().view(np.uint64)
            first = batch["anchor"].to_numpy()
            upper, lower = _halves(fp)
            for rows, other in anchors(np.where(first >> 32, upper, lower), RADIUS + threshold):
                yield pd.DataFrame(
                    {"anchor": first[rows], "second": other.astype(np.int64) + 1, "fp": fp[rows].view(np.int64)}
                )

    return run


def spanning_forest(fp: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links that connect the members of a cell as all their links do."""
    links: list[tuple[int, int]] = []
    rest = np.unique(fp)
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            node = front.pop()
            near = np.bitwise_count(rest ^ node) <= threshold
            if near.any():
                found = rest[near]
                links.extend((int(node), int(x)) for x in found)
                front.extend(found)
                rest = rest[~near]
    return links


def _compare(threshold: int):
    def links_of(key: np.ndarray, fp: np.ndarray) -> np.ndarray:
        """Pairs of equal key within the threshold; keys are sorted."""
        cuts = np.flatnonzero(np.any(key[1:] != key[:-1], axis=1)) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(fp)]))
        sizes = ends - starts
        out = []
        small = sizes <= 8
        index = starts[small & (sizes > 1)]
        stop = ends[small & (sizes > 1)]
        for i in range(7):
            for j in range(i + 1, 8):
                ok = index + j < stop
                a, b = fp[index[ok] + i], fp[index[ok] + j]
                near = (np.bitwise_count(a ^ b) <= threshold) & (a != b)
                out.append(np.stack([a[near], b[near]], axis=1))
        for a, b in zip(starts[~small], ends[~small]):
            if found := spanning_forest(fp[a:b], threshold):
                out.append(np.array(found, np.uint64))
        return np.concatenate(out) if out else np.zeros((0, 2), np.uint64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # the cell that may go on in the next batch

        def flush(whole: pd.DataFrame) -> pd.DataFrame:
            key = whole[["anchor", "second"]].to_numpy()
            found = links_of(key, whole["fp"].to_numpy().view(np.uint64)) if len(whole) else np.zeros((0, 2), np.uint64)
            found = np.unique(found, axis=0).view(np.int64)
            return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

        for batch in batches:
            if not len(batch):
                continue
            last = batch.iloc[-1]
            go_on = (batch["anchor"] == last["anchor"]) & (batch["second"] == last["second"])
            if go_on.all() and held and (held[-1].iloc[-1][["anchor", "second"]] == last[["anchor", "second"]]).all():
                held.append(batch)
                continue
            yield flush(pd.concat([*held, batch[~go_on]]))
            held = [batch[go_on]]
        if held:
            yield flush(pd.concat(held))

    return run


def fingerprint_links(fps: DataFrame, threshold: int = 2, max_cell: int = MAX_CELL) -> DataFrame:
    """Links (``a``, ``b``) that connect distinct fingerprints as all links within the threshold do."""
    if not 0 <= threshold <= 3:
        raise ValueError("the covering is made for thresholds of 0 to 3")
    cell = "anchor LONG, second LONG, fp LONG"
    copies = fps.select("fp").distinct().mapInPandas(_replicate, cell)
    large = written(
        copies.groupBy("anchor").count().filter(F.col("count") > max_cell).select("anchor"), "large_cells"
    )
    if not large.isEmpty():
        again = copies.join(large, "anchor", "left_semi").mapInPandas(_replicate_again(threshold), cell)
        copies = copies.join(large, "anchor", "left_anti").unionByName(again)
    dealt = copies.repartition("anchor", "second").sortWithinPartitions("anchor", "second")
    return dealt.mapInPandas(_compare(threshold), "a LONG, b LONG").distinct()


def near_duplicates(docs: DataFrame, threshold: int = 2, max_cell: int = MAX_CELL) -> DataFrame:
    """``doc_id``, ``key``, ``fp``, ``group`` and ``component_id`` (smallest doc_id reachable) of every row.

    ``group`` is the smallest fingerprint of the component.  Rows of equal fingerprint are linked, so rows
    without words (null, empty, blank) form one component with anything within the threshold of zero.
    Null ids: a component has a null id only if all its ids are null.  Repeated rows stay repeated.  An
    empty table gives an empty result.  Other columns are not read.
    """
    spark = docs.sparkSession
    with batch_rows(spark, TEXT_ROWS):
        fps = written(fingerprints(docs), "fingerprints")
    with batch_rows(spark, NUMBER_ROWS):
        nodes = components(fingerprint_links(fps, threshold, max_cell))
    joined = fps.join(nodes, fps["fp"] == nodes["node"], "left").select(
        "doc_id", "key", "fp", F.coalesce("component", "fp").alias("group")
    )
    least = joined.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    return joined.join(least, "group").select("doc_id", "key", "fp", "group", "component_id")


def keep_one(docs: DataFrame, threshold: int = 2) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id's (ties: the smallest text hash).

    Null ids come last.  Of rows that repeat id and text one stays.
    """
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))
    kept = near_duplicates(docs, threshold).groupBy("group").agg(F.min(order).alias("least"))
    identity = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_kept_id")
    chosen = kept.select(F.col("least.doc_id").alias("doc_id"), F.col("least.key").alias("_kept_key")).select(
        identity, "_kept_key"
    )
    keys = ["_kept_id", "_kept_key"]
    marked = docs.select("*", identity, F.xxhash64("text").alias("_kept_key")).join(chosen, keys, "left_semi")
    first = F.row_number().over(Window.partitionBy(*keys).orderBy("doc_id"))
    return marked.withColumn("_kept_at", first).filter("_kept_at = 1").select(*docs.columns)
