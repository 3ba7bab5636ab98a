"""Benchmark decontamination as a prefix-filtered set join.

A benchmark item is cut into windows of 13 consecutive words (a shorter item is one window).  A
document word is hit if it lies in an occurrence of any window.

A window is the set of its shingles of ``SHINGLE`` consecutive words.  Shingles are ordered by rarity,
by their counts over all documents.  A window that occurs whole shares all its shingles with the
document, so its necessary prefix is one shingle, the rarest; a window with a shingle that no document
has cannot occur.  Documents are searched for prefix shingles only.  A hit at word ``p`` of a shingle at
offset ``o`` of a window can only start the window at ``p - o``: the positional bound; it must end within
the document: the length bound.  What passes is verified word by word.

Documents are read twice in numpy batches, once for the counts and once for the hits.  A bit table of
bounded size keeps other shingles from leaving the tasks; it only spares work, as the join is exact
whatever the table lets through, so the benchmark may be of any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pvspark.llm.scratch import text_key, written

WINDOW_WORDS = 13
SHINGLE = 4
#: Bits of the prefilter: at least and at most.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 26

_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RNG = np.random.default_rng(13)
_VALUE = np.where(_IS_WORD, _RNG.integers(1, 2**63, 256, dtype=np.uint64), np.uint64(0))
_VALUE[65:91] = _VALUE[97:123]
_PLACE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of a batch of texts: where they are, whose they are and what they hash to."""

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode("utf-8", "replace") for t in texts]
        self.bytes = _LOWER[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
        edge = np.diff(_IS_WORD[self.bytes].view(np.int8), prepend=np.int8(0))
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        bounds = np.fromiter(map(len, raw), np.int64, len(raw)).cumsum() + np.arange(1, len(raw) + 1)
        # Words of text i: first[i] to first[i + 1].
        self.first = np.concatenate(([0], np.searchsorted(self.starts, bounds)))
        self.text = np.repeat(np.arange(len(raw)), np.diff(self.first))
        if len(self.starts):
            reach = np.diff(self.starts, append=len(self.bytes))
            place = np.arange(self.starts[0], len(self.bytes)) - np.repeat(self.starts, reach)
            spelled = _VALUE[self.bytes[self.starts[0] :]] * _PLACE[place & 255]
            self.hash = np.add.reduceat(spelled, self.starts - self.starts[0])
            self.hash ^= self.hash >> np.uint64(29)
        else:
            self.hash = np.zeros(0, np.uint64)

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all shingles that lie within one text."""
        n = len(self.hash) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = np.full(n, np.uint64(width))
        for k in range(width):
            h = h * _STEP + self.hash[k : k + n]
            h ^= h >> np.uint64(32)
        at = np.flatnonzero(self.text[:n] == self.text[width - 1 :])
        return at, h[at].view(np.int64)

    def joined(self, first: int, last: int) -> str:
        parts = (self.bytes[a:b].tobytes() for a, b in zip(self.starts[first:last], self.ends[first:last]))
        return b" ".join(parts).decode("utf-8", "replace")


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every window of every item with each of its shingles."""
    for batch in batches:
        words = Words(list(batch["text"]))
        of_width = {}
        rows = []
        for i, item in enumerate(batch["item_id"]):
            begin, end = int(words.first[i]), int(words.first[i + 1])
            length = min(WINDOW_WORDS, end - begin)
            if not length:
                continue
            width = min(SHINGLE, length)
            if width not in of_width:
                at, h = words.shingles(width)
                of_width[width] = dict(zip(at.tolist(), h.tolist()))
            for start in range(begin, end - length + 1):
                text = words.joined(start, start + length)
                for offset in range(length - width + 1):
                    rows.append((item, text, length, width, offset, of_width[width][start + offset]))
        yield pd.DataFrame(rows, columns=["item_id", "window", "length", "width", "offset", "shingle"])


def item_windows(benchmark: DataFrame) -> DataFrame:
    """``item_id`` (as text, null: empty), ``window``, ``length``, ``width``, ``offset``, ``shingle``."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    return items.mapInPandas(
        _windows, "item_id STRING, window STRING, length INT, width INT, offset INT, shingle LONG"
    )


class _BitTable:
    """Which shingle hashes may matter; of bounded size, and never wrong about those that do."""

    def __init__(self, spark: SparkSession, shingles: DataFrame):
        wanted = 64 * shingles.count()
        self.bits = LEAST_BITS
        while self.bits < min(wanted, MOST_BITS):
            self.bits *= 2
        bit = F.pmod(F.col("shingle"), F.lit(self.bits))
        cells = (
            shingles.groupBy(F.shiftright(bit, 6).alias("cell"))
            .agg(F.bit_or(F.expr(f"shiftleft(1L, int(pmod(pmod(shingle, {self.bits}L), 64L)))")).alias("mask"))
            .toPandas()  # one row for each cell of the table at most
        )
        table = np.zeros(self.bits // 64, np.uint64)
        table[cells["cell"].to_numpy(np.int64)] = cells["mask"].to_numpy(np.int64).view(np.uint64)
        self.widths = sorted(r.width for r in shingles.select("width").distinct().collect())
        self.shared = spark.sparkContext.broadcast(table)

    def lookup(self):
        """A picklable test for tasks."""
        shared, bits, widths = self.shared, self.bits, self.widths

        def hits(words: Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            table = shared.value
            for width in widths:
                at, h = words.shingles(width)
                bit = h.view(np.uint64) & np.uint64(bits - 1)
                ok = (table[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1)
                ok = np.flatnonzero(ok)
                yield width, at[ok], h[ok]

        return hits


def shingle_counts(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """How often each of the given shingles occurs over all documents (those that do)."""
    hits = _BitTable(docs.sparkSession, shingles).lookup()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, _, h in hits(Words(list(batch["text"]))):
                value, n = np.unique(h, return_counts=True)
                yield pd.DataFrame({"shingle": value, "n": n})

    found = docs.select("text").mapInPandas(count, "shingle LONG, n LONG")
    return found.groupBy("shingle").agg(F.sum("n").alias("n"))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """The rarest shingle of each window that can occur, with its offset."""
    counted = windows.join(counts, "shingle", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = F.min(F.struct("n", "shingle", "offset")).alias("rarest")
    return (
        counted.groupBy("item_id", "window", "length", "width")
        .agg(rarest)
        .filter(F.col("rarest.n") > 0)
        .select("item_id", "window", "length", "width", "rarest.shingle", "rarest.offset")
    )


def _search(hits):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = Words(list(batch["text"]))
            plain = batch.drop(columns="text").assign(n_words=np.diff(words.first))
            yield plain.assign(pos=None, shingle=None, before=None, context=None)
            found = []
            for _, at, h in hits(words):
                for p, value in zip(at.tolist(), h.tolist()):
                    text = int(words.text[p])
                    begin, end = int(words.first[text]), int(words.first[text + 1])
                    a, b = max(begin, p - WINDOW_WORDS + 1), min(end, p + WINDOW_WORDS)
                    found.append((text, p - begin, value, p - a, words.joined(a, b)))
            if found:
                hit = pd.DataFrame(found, columns=["_text", "pos", "shingle", "before", "context"])
                yield plain.iloc[hit["_text"]].reset_index(drop=True).assign(**hit.drop(columns="_text"))

    return run


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``key`` (of the text), ``n_words``, ``n_hit``, ``item_ids``.

    ``item_ids`` are the distinct ids, as text and sorted, of items with an occurring window.  Null or
    empty texts have no words and no hits; items without words match nothing; a null item id counts as
    the empty text.  Repeated documents and items are treated row by row.  Other columns are not read.
    """
    spark = docs.sparkSession
    windows = written(item_windows(benchmark).distinct(), "windows")
    counts = shingle_counts(docs, windows.select("shingle", "width").distinct())
    needed = written(prefixes(windows, counts), "prefixes")
    hits = _BitTable(spark, needed.select("shingle", "width").distinct()).lookup()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", text_key().alias("key"), "text", F.monotonically_increasing_id().alias("row"))
    scanned = written(
        source.mapInPandas(
            _search(hits),
            f"doc_id {id_type}, key BINARY, row LONG, n_words LONG, pos LONG, shingle LONG, before LONG, context STRING",
        ),
        "scanned",
    )
    start = F.col("pos") - F.col("offset")
    words = F.slice(F.split("context", " "), (F.col("before") - F.col("offset") + 1).cast("int"), F.col("length"))
    matches = (
        scanned.filter(F.col("shingle").isNotNull())
        .join(needed, "shingle")
        .filter((start >= 0) & (start + F.col("length") <= F.col("n_words")) & (F.col("before") >= F.col("offset")))
        .filter(F.array_join(words, " ") == F.col("window"))
        .select("row", start.alias("start"), (start + F.col("length")).alias("end"), "item_id")
    )
    in_order = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(in_order), F.lit(0))))
    per_row = (
        matches.withColumn("new_words", covered)
        .groupBy("row")
        .agg(F.sum("new_words").alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )
    return (
        scanned.filter(F.col("shingle").isNull())
        .join(per_row, "row", "left")
        .select(
            "doc_id", "key", "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        )
    )


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least one word in twenty is hit."""
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated rows; which they are depends on the text alone."""
    bad = contamination(docs, benchmark).filter(is_contaminated(F.col("n_hit"), F.col("n_words")))
    keys = bad.select(F.col("key").alias("_text_key")).distinct()
    return docs.withColumn("_text_key", text_key()).join(keys, "_text_key", "left_anti").select(*docs.columns)
