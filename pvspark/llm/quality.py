"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are grown on histograms of binned statistics and kept as flat arrays (one complete binary
tree per row), so scoring walks all trees for a whole batch with numpy indexing.

Only the text gives inputs of a score.  The model is fitted on the driver from a documented, bounded
sample: at most ``MAX_TRAINING_ROWS`` labelled documents, chosen by a hash of their id.  Every document
is scored in full in one pass without a shuffle; the model is a few thousand numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

#: Bound of the labelled sample that the model is fitted on.
MAX_TRAINING_ROWS = 20_000

STATISTICS = (
    "log_bytes log_words word_bytes longest_word short_words upper_words distinct_words top_word "
    "distinct_pairs distinct_lines line_words digits uppers symbols punctuation non_ascii entropy "
    "marked_ends"
).split()

_BYTES = np.arange(256)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_SPACE = np.isin(_BYTES, [9, 10, 11, 12, 13, 32])
_PUNCTUATION = np.isin(_BYTES, np.frombuffer(b".,;:'\"?()-", np.uint8))
_SYMBOL = (_BYTES > 32) & (_BYTES < 127) & ~_DIGIT & ~_UPPER & ~_PUNCTUATION & ~((_BYTES >= 97) & (_BYTES <= 122))
_WORD_MARKS = tuple(bytes([b]) for b in np.flatnonzero(_SYMBOL))


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a whole text; null counts as empty and gives zeros."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n = len(words)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = counts / len(raw)
    seen = share[share > 0]
    inked = max(1, int(counts[~_SPACE].sum()))
    vocabulary = Counter(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return [
        np.log1p(len(raw)),
        np.log1p(n),
        sizes.mean(),
        np.log1p(sizes.max()),
        (sizes <= 3).mean(),
        sum(c for w, c in vocabulary.items() if w.isupper() and len(w) > 1) / n,
        len(vocabulary) / n,
        max(vocabulary.values()) / n,
        len(set(zip(words, words[1:]))) / max(1, n - 1),
        len(set(lines)) / len(lines),
        n / len(lines),
        counts[_DIGIT].sum() / inked,
        counts[_UPPER].sum() / inked,
        counts[_SYMBOL].sum() / inked,
        counts[_PUNCTUATION].sum() / inked,
        counts[128:].sum() / inked,
        float(-(seen * np.log2(seen)).sum()),
        sum(c for w, c in vocabulary.items() if w.endswith(_WORD_MARKS)) / n,
    ]


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth; ``feature`` and ``cut`` per inner node, ``leaf`` per leaf."""

    base: float
    feature: np.ndarray  # (trees, 2 ** depth - 1) int
    cut: np.ndarray  # (trees, 2 ** depth - 1) float; a row goes right if its value is greater
    leaf: np.ndarray  # (trees, 2 ** depth) float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        total = np.full(len(x), self.base)
        if len(self.feature):
            trees, inner = self.feature.shape
            rows, columns = np.arange(len(x))[:, None], np.arange(trees)[None, :]
            node = np.zeros((len(x), trees), np.int64)
            while node[0, 0] < inner:
                node = 2 * node + 1 + (x[rows, self.feature[columns, node]] > self.cut[columns, node])
            total = total + self.leaf[columns, node - inner].sum(axis=1)
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30.0, 30.0)))


def fit_forest(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15,
    bins: int = 64, ridge: float = 1.0, least_rows: int = 10,
) -> Forest:
    """Boost logistic loss with second-order leaf values; splits are sought on bin histograms."""
    if not len(y):
        return Forest(0.0, np.zeros((0, 0), int), np.zeros((0, 0)), np.zeros((0, 1)))
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(prior / (1 - prior)))
    inner, n_features = 2**depth - 1, x.shape[1]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(n_features)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    feature, cut = np.zeros((trees, inner), int), np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    total = np.full(len(y), base)
    for t in range(trees):
        p = 1.0 / (1.0 + np.exp(-total))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-6)
            local = node - first
            for f in range(n_features):
                slot = local * bins + binned[:, f]
                g, h, c = (
                    np.bincount(slot, w, width * bins).reshape(width, bins).cumsum(axis=1)
                    for w in (grad, hess, np.ones(len(y)))
                )
                rest_g, rest_h, rest_c = g[:, -1:] - g, h[:, -1:] - h, c[:, -1:] - c
                gain = (
                    g**2 / (h + ridge) + rest_g**2 / (rest_h + ridge)
                    - g[:, -1:] ** 2 / (h[:, -1:] + ridge)
                )
                gain[(c < least_rows) | (rest_c < least_rows)] = 0.0
                gain[:, len(edges[f]) :] = 0.0
                at = gain.argmax(axis=1)
                value = gain[np.arange(width), at]
                better = np.flatnonzero(value > best)
                best[better] = value[better]
                feature[t, first + better] = f
                if len(better):
                    cut[t, first + better] = edges[f][at[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > cut[t, node])
        at = node - inner
        g = np.bincount(at, grad, inner + 1)
        h = np.bincount(at, hess, inner + 1)
        leaf[t] = rate * g / (h + ridge)
        total = total + leaf[t][at]
    return Forest(base, feature, cut, leaf)


def held_out(id_column: str = "doc_id"):
    """Rows whose id's CRC-32 leaves remainder 1; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_statistics(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS
) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of a bounded sample of the labelled documents that are not held out.

    Ids labelled both ways, or with null, teach nothing.  The sample is cut by a hash of the id, and
    again by a hash of the row, as one id may have many documents.
    """
    clear = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .filter(F.col("quality") == F.col("most"))
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    chosen = (
        docs.select("doc_id", "text")
        .join(F.broadcast(clear), "doc_id")  # max_rows ids at most
        .mapInPandas(_describe, ", ".join(f"{s} DOUBLE" for s in STATISTICS) + ", quality INT, place LONG")
        .orderBy("place", *STATISTICS)
        .limit(max_rows)
        .toPandas()
    )
    return chosen[STATISTICS].to_numpy(float), chosen["quality"].to_numpy(float)


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = pd.DataFrame([statistics(t) for t in batch["text"]], columns=STATISTICS, dtype=float)
        out["quality"] = batch["quality"].to_numpy()
        out["place"] = pd.util.hash_array(batch["doc_id"].to_numpy()).view(np.int64)
        yield out


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Forest:
    return fit_forest(*training_statistics(docs, labels, max_rows))


def score(docs: DataFrame, forest: Forest, threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``, replacing columns of these names.

    Null and empty texts are scored as texts without words; no row is dropped.
    """
    plain = docs.drop("score", "predicted")
    names = plain.columns
    text_at = names.index("text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array([statistics(t) for t in batch.iloc[:, text_at]], float).reshape(-1, len(STATISTICS))
            p = forest.score(x) if len(x) else np.zeros(0)
            yield batch.assign(score=p, predicted=(p >= threshold).astype(np.int32))

    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    schema = T.StructType([*plain.schema.fields, *added])
    return plain.mapInPandas(run, schema)


def keep_good(docs: DataFrame, forest: Forest, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more; only texts go to Python."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t) for t in texts], float).reshape(-1, len(STATISTICS))
        return pd.Series(forest.score(x) if len(x) else np.zeros(0))

    return docs.filter(scored("text") >= threshold)
