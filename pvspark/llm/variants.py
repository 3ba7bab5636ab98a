"""Spelling variants: words one edit apart, grouped under their most frequent form.

Words are decomposed into grams of variable length (``variable_grams``).  The dictionary of frequent grams
comes from the counts of all words' substrings, and a gram must make up at least one part in ``PARTS`` of all
positions to be in it, so its size does not grow with the words.

Two words one edit apart share all grams of either but for as many as the edit can affect.  With the grams
of every word in one order, rarest first, the first ``affected + 1`` of both therefore share one, the first
``affected + 2`` two, and so on.  So words meet in the lists of those grams, by length.  A list of more than
``LIST_WORDS`` words is dealt out again by the next shared gram, up to ``LEVELS`` grams; what still is longer,
and words that need not share so many grams, are compared in pairs of blocks.  In a list, the grams a word has
and the other lacks are counted on bit sets; a pair is verified only if neither count exceeds its word's bound.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pvspark.llm.scratch import written
from pvspark.llm.variable_grams import LONGEST, SHORTEST, GramIndex, substrings
from pvspark.sizing import checked_broadcast

RUN = re.compile("[a-zA-ZÀ-ÿ]+")
PARTS = 4096
COUNTED = 16  # grams that are not extended are counted from this part of the extension bound on
LIST_WORDS = 1000
LEVELS = 3
BUCKET_ROWS = 100_000
SLICE = 1 << 20
_PAIRS = 1 << 15  # at once, as many as a cache holds


def _slices(text: str) -> Iterator[str]:
    """The text in pieces that cut no run of letters."""
    start = 0
    while start < len(text):
        stop = start + SLICE
        if stop < len(text):
            run = RUN.match(text, stop)
            stop = run.end() if run else stop
        yield text[start:stop]
        start = stop


def _add_words(total: Counter[str], text: str, row_id: str, long_run: re.Pattern[str], slip: int | None) -> None:
    """Count the long runs of one text; ``slip`` drops a character from every run whose checksum it divides."""
    begun = zlib.crc32(f"{row_id}:".encode())
    for piece in _slices(text):
        # Bytes lower-case A to Z only.
        lowered = piece.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
        for run, n in Counter(long_run.findall(lowered)).items():
            if slip:
                mark = zlib.crc32(run.encode(), begun)
                if mark % slip == 0:
                    at = mark % len(run)
                    run = run[:at] + run[at + 1 :]
            total[run] += n


def words(
    docs: DataFrame, min_length: int = 7, min_count: int = 2, slip: int | None = None,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``word`` and ``n`` for the words of all texts; runs of letters, A to Z in lower case."""

    # A word is its run or one character shorter, so shorter runs are passed over.
    long_run = re.compile(RUN.pattern[:-1] + f"{{{min_length},}}")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total: Counter[str] = Counter()
            for row_id, text in zip(batch["row_id"], batch["text"]):
                _add_words(total, text, row_id, long_run, slip)
            kept = [(word, n) for word, n in total.items() if len(word) >= min_length]
            yield pd.DataFrame(kept, columns=["word", "n"])

    texts = docs.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("row_id"), F.col(text_column).alias("text")
    ).where(F.col("text").isNotNull())
    counted = texts.mapInPandas(count, "word STRING, n LONG")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def gram_index(vocabulary: DataFrame) -> GramIndex:
    """The dictionary of frequent grams; only those and the counts of common ones reach the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            total: Counter[str] = Counter()
            for word in batch["word"]:
                total.update(substrings(word))
            yield pd.DataFrame(list(total.items()), columns=["gram", "n"])

    grams = written(
        vocabulary.select("word").mapInPandas(count, "gram STRING, n LONG").groupBy("gram").agg(F.sum("n").alias("n")), "grams"
    )
    positions = grams.where(F.length("gram") == SHORTEST).agg(F.sum("n")).first()[0] or 0
    bound = positions / PARTS
    common = grams.where(F.col("n") > bound / COUNTED).collect()  # at most PARTS * COUNTED of each length
    frequent = frozenset(r["gram"] for r in common if r["n"] > bound and len(r["gram"]) < LONGEST)
    return GramIndex(frequent, {r["gram"]: r["n"] for r in common})


_DESCRIBED = "word STRING, n LONG, length INT, bits LONG, affected INT, spare INT, tokens ARRAY<STRING>"


def _described(vocabulary: DataFrame, index: GramIndex) -> DataFrame:
    """Words with their first grams, a bit set of all, the bound of affected grams, and the grams beyond it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for word, n in zip(batch["word"], batch["n"]):
                tokens, affected = index.tokens(word)
                bits = 0
                for token in tokens:
                    bits |= 1 << (zlib.crc32(token.encode()) & 63)
                rows.append(
                    (word, n, len(word), bits - (bits >> 63 << 64), affected, len(tokens) - affected, tokens[: affected + LEVELS])
                )
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _DESCRIBED.split(", ")])

    return vocabulary.select("word", "n").mapInPandas(run, _DESCRIBED)


def _first_lists(described: DataFrame) -> DataFrame:
    """Each word in the list of each of its first grams, for its own length and, as the shorter one, for the next."""
    targets = F.array(
        F.struct(F.col("length").alias("target"), F.lit(False).alias("shorter")),
        F.struct((F.col("length") + 1).alias("target"), F.lit(True).alias("shorter")),
    )
    return (
        described.select("*", F.posexplode(F.slice("tokens", F.lit(1), F.col("affected") + 1)).alias("at", "token"))
        .select("*", F.inline(targets))
        .select(
            "word", "n", "bits", "affected", "spare", "tokens", "at", "shorter", F.lit(False).alias("last"),
            F.xxhash64("token", "target").alias("list"),
        )
    )


def _next_lists(rows: DataFrame, level: int) -> DataFrame:
    """The words of long lists by one more gram; words that need not share so many also in a list of their own."""
    placed = F.transform("tokens", lambda token, at: F.struct(at.alias("next_at"), token.alias("token")))
    reach = F.greatest(F.lit(0), F.col("affected") + level - F.col("at"))
    few = F.when(F.col("spare") <= level, F.array(F.struct(F.lit(-1).alias("next_at"), F.lit("").alias("token"))))
    following = F.concat(F.slice(placed, F.col("at") + 2, reach), F.coalesce(few, F.array().cast("array<struct<next_at:int,token:string>>")))
    return rows.select("*", F.inline(following)).select(
        "word", "n", "bits", "affected", "spare", "tokens", F.col("next_at").alias("at"), "shorter",
        (F.col("next_at") < 0).alias("last"), F.xxhash64("list", "token").alias("list"),
    )


_POSTING = ["list", "word", "n", "bits", "affected", "shorter", "half"]


def _in_blocks(rows: DataFrame) -> DataFrame:
    """The words of long lists in pairs of blocks."""
    blocks = F.ceil(F.col("list_words") / LIST_WORDS).cast("int")
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    half = F.when(F.col("block") == F.col("with"), 0).when(F.col("block") < F.col("with"), 1).otherwise(2)
    return (
        rows.withColumn("blocks", blocks).withColumn("block", own)
        .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
        .select(
            F.xxhash64("list", F.least("block", "with"), F.greatest("block", "with")).alias("list"),
            "word", "n", "bits", "affected", "shorter", half.cast("int").alias("half"),
        )
    )


def _postings(described: DataFrame) -> tuple[DataFrame, int]:
    """All list entries that are to be compared, and about how many they are."""
    parts: list[DataFrame] = []
    first = described.agg(F.sum(2 * (F.col("affected") + 1)).alias("rows"), F.avg(F.col("affected") + 1).alias("each")).first()
    total = first["rows"] or 0
    rows = _first_lists(described)
    for level in range(1, LEVELS + 1):
        sizes = rows.groupBy("list").agg(F.count(F.lit(1)).alias("list_words"))
        long = written(sizes.where(F.col("list_words") > LIST_WORDS), "long_lists")
        total += int((long.agg(F.sum("list_words")).first()[0] or 0) * first["each"]) if first["each"] else 0
        marked = rows.join(checked_broadcast(long), "list", "left")
        is_long = F.col("list_words").isNotNull()
        parts.append(marked.where(~is_long).withColumn("half", F.lit(0)).select(*_POSTING))
        final = is_long if level == LEVELS else is_long & F.col("last")
        parts.append(_in_blocks(marked.where(final)))
        rows = _next_lists(marked.where(is_long & ~F.col("last")), level).select(*rows.columns)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out, total


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point makes one of the other."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    at = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[at + 1 :] == (b[at + 1 :] if len(a) == len(b) else b[at:])


_LINK = "word STRING, other STRING, other_n LONG"
_SHORT = 48  # code points of words that are verified many at a time


def _characters(names: np.ndarray) -> np.ndarray:
    """Code points, one row a word, zeros after its end."""
    return np.array(names, dtype=f"U{_SHORT}").view(np.uint32).reshape(len(names), _SHORT)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many characters rows have in common from the left."""
    differs = a != b
    return np.where(differs.any(axis=1), differs.argmax(axis=1), a.shape[1])


def _compare(group: pd.DataFrame) -> pd.DataFrame:
    """The near words of all lists of one bucket, both ways."""
    # The shorter words of a list come last and meet only the others.
    group = group.sort_values(["list", "shorter"], kind="stable")
    lists, names = group["list"].to_numpy(), group["word"].to_numpy()
    bits = group["bits"].to_numpy().view(np.uint64)
    most, half = group["affected"].to_numpy(), group["half"].to_numpy()
    shorter, n = group["shorter"].to_numpy(), group["n"].to_numpy()
    code, different = pd.factorize(names)
    length = np.array([len(name) for name in different], np.int64)
    forward = _characters(different)
    backward = _characters(np.array([name[:-_SHORT - 1:-1] for name in different], object))
    ends = np.searchsorted(lists, lists, side="right")
    reach = np.where(shorter, 0, ends - np.arange(len(lists)) - 1)
    before = np.concatenate([[0], np.cumsum(reach)])
    found: list[np.ndarray] = []
    first = 0
    while first < len(lists):
        # As many rows as give about _PAIRS pairs, one at least.
        stop = max(first + 1, int(np.searchsorted(before, before[first] + _PAIRS, side="right")) - 1)
        some = reach[first:stop]
        a = np.repeat(np.arange(first, stop), some)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(some) - some, some)
        first = stop
        merged = np.bitwise_count(bits[a] & ~bits[b]) <= most[a]
        a, b = a[merged], b[merged]
        merged = (np.bitwise_count(bits[b] & ~bits[a]) <= most[b]) & ((half[a] == 0) | (half[a] != half[b]))
        one, two = code[a[merged]], code[b[merged]]
        longer = np.maximum(length[one], length[two])
        same = _common(forward[one], forward[two]) + _common(backward[one], backward[two])
        near = (one != two) & (same >= longer - 1)
        for k in np.flatnonzero(longer > _SHORT):
            near[k] = one_edit(different[one[k]], different[two[k]])
        found.append(np.unique(np.minimum(one, two)[near] * len(different) + np.maximum(one, two)[near]))
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    where = np.zeros(len(different), np.int64)
    where[code] = np.arange(len(code))
    a, b = where[pairs // max(1, len(different))], where[pairs % max(1, len(different))]
    one, two = np.concatenate([a, b]), np.concatenate([b, a])
    return pd.DataFrame({"word": names[one], "other": names[two], "other_n": n[two]})


def near_words(vocabulary: DataFrame) -> DataFrame:
    """``word``, ``other``, ``other_n`` for all words exactly one edit apart, both ways.

    ``vocabulary`` has ``word`` (distinct) and ``n``.  Exact for words of four code points and more.
    """
    described = written(_described(vocabulary, gram_index(vocabulary)), "described_words")
    postings, rows = _postings(described)
    buckets = max(1, -(-rows // BUCKET_ROWS))
    bucket: Column = F.pmod(F.xxhash64(F.lit(11), "list"), F.lit(buckets)).alias("bucket")
    met = postings.select("*", bucket).groupBy("bucket").applyInPandas(_compare, _LINK)
    return met.groupBy("word", "other").agg(F.first("other_n").alias("other_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """Words that have a form, with the last form reached; each round doubles how far it has looked."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        following = written(
            now.join(further, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        now = following.select("word", "root")
        if not following.where("moved").take(1):
            return now


def group_variants(vocabulary: DataFrame, times: int = 10) -> DataFrame:
    """Each word with ``form``, ``root``, ``n``, ``n_near`` and ``form_n``.

    Near words are exactly one inserted, deleted or replaced code point apart.  A word's form is its near
    word of largest ``n`` (ties: the smallest in code-point order) if that is at least ``times`` its own, else
    null; ``root`` follows forms to the last and is the word itself if it has none.
    """
    vocabulary = written(vocabulary.select("word", "n"), "vocabulary")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = near_words(vocabulary).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    holds = -F.col("best.less") >= times * F.col("n")
    formed = written(
        vocabulary.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(holds, F.col("best.other")).alias("form"), F.when(holds, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.where(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(
    docs: DataFrame, min_length: int = 7, min_count: int = 2, times: int = 10, slip: int | None = None,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Spelling variants among the words of whole texts, see ``words`` and ``group_variants``.

    A null text has no words, a null id counts as no digits, and repeated rows count again.  Other columns are not
    read.  No words give no rows.
    """
    if min_length < 4:
        raise ValueError("words of less than four code points need not share a gram with a near word")
    return group_variants(words(docs, min_length, min_count, slip, id_column, text_column), times)
