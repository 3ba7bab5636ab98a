"""Nearest vectors by largest inner product: probed lists, scanned with adaptive dimensions.

**Lists.**  Vectors get one more component that makes all lengths equal, so that the largest inner
product is the smallest distance; k-means on a bounded sample of them gives the lists.  Every vector is
put into its nearest list, and a query probes as many lists as ``RECALL`` needs.  That number is
calibrated on the sample, where neighbours are no nearer than among all rows.

**Adaptive dimension scan.**  Within a probed list, queries and candidates are turned by one random
rotation and compared by blocks of columns.  Of a squared distance, ``d`` of ``D`` randomly turned columns
hold a share that is distributed as Beta(d/2, (D-d)/2).  A candidate is abandoned as soon as its partial
distance exceeds the quantile ``1 - LEVEL`` of that share of what its whole distance may be at most, that is, when
the hypothesis that it is near enough is rejected at that level.  What it may be at most follows from its length
and the query's ``k``-th best product so far.  The product of a candidate that survives is computed in
double precision on the original vectors.

**Two passes.**  A query scans its nearest list first; the ``k``-th best product found there is the bound
with which it enters its other lists.

Equal vectors are one class: candidates with their smallest ids, queries scanned once.  A list's classes and
its queries are dealt into blocks, and each pair of blocks is a group of its own, so no list is too hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from pvspark.llm.embeddings import _is_valid, _key
from pvspark.llm.scratch import written
from pvspark.sizing import checked_broadcast

FIT_ROWS = 20_000  # at most, for the lists and the number of probes
FIT_VALUES = 4_000_000  # at most, over all fitting rows
FIT_QUERIES = 400
LIST_ROWS = 1024  # classes a list holds on average, while there are not more lists than MOST_LISTS
MOST_LISTS = 4096
RECALL = 0.99
LEVEL = 0.001  # of each test
COLUMNS = 16  # of one block
DENSE = 0.1  # share of pairs left from which on a block is one matrix product
BLOCK_ROWS = 4096
CHUNK, QUERY_CHUNK = 512, 128
HOT_ANSWERS = 50_000
_SEED = 12


@dataclass(frozen=True)
class Index:
    """The lists of vectors of one length, how many a query probes, and the rotation."""

    dim: int
    centers: np.ndarray  # of the lengthened vectors
    longest: float
    probes: int
    scale: float  # of the fitting, so that squares neither overflow nor vanish

    def lengthened(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / self.scale
        rest = np.sqrt(np.maximum(0.0, self.longest**2 - (scaled**2).sum(axis=1, keepdims=True)))
        return np.hstack([scaled, rest])

    def list_of(self, vectors: np.ndarray) -> np.ndarray:
        return _distances(self.lengthened(vectors), self.centers).argmin(axis=1)

    def probed(self, queries: np.ndarray) -> np.ndarray:
        """The lists of each query, nearest first."""
        lengths = np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-300)
        # The length of a query does not matter; the longest candidate's makes it comparable.
        level = np.hstack([queries / lengths * self.longest, np.zeros((len(queries), 1))])
        return np.argsort(_distances(level, self.centers), axis=1, kind="stable")[:, : self.probes]


@lru_cache(4)
def rotation(dim: int) -> np.ndarray:
    turned, _ = np.linalg.qr(np.random.default_rng([_SEED, dim]).standard_normal((dim, dim)))
    return turned


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, up to a term that is the same for all of ``b``."""
    return (b**2).sum(axis=1)[None, :] - 2.0 * (a @ b.T)


def fit(sample: np.ndarray, rows: int, longest: float, k: int, recall: float = RECALL) -> Index:
    """Lists for ``rows`` vectors of which ``sample`` is a part; ``longest`` is the largest length of all."""
    rng = np.random.default_rng([_SEED, len(sample)])
    dim = sample.shape[1]
    scale = max(longest, 1e-300)
    lists = int(max(1, min(MOST_LISTS, -(-rows // LIST_ROWS), len(sample) // 8)))
    plain = Index(dim, np.zeros((1, dim + 1)), 1.0, 1, scale)
    points = plain.lengthened(sample)
    centers = points[rng.choice(len(points), lists, replace=False)]
    for _ in range(12):
        own = _distances(points, centers).argmin(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, points)
        counts = np.bincount(own, minlength=lists)
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    own = _distances(points, centers).argmin(axis=1)
    every = Index(dim, centers, 1.0, lists, scale)
    asked = rng.choice(len(sample), min(FIT_QUERIES, len(sample)), replace=False)
    products = sample[asked] @ sample.T
    products[np.arange(len(asked)), asked] = -np.inf
    near = np.argsort(-products, axis=1)[:, : max(1, min(k, len(sample) - 1))]
    order = every.probed(sample[asked])
    place = np.argsort(order, axis=1)
    needed = np.sort(np.take_along_axis(place, own[near], axis=1).ravel()) + 1
    probes = int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))])
    return Index(dim, centers, 1.0, probes, scale)


def scan(
    candidates: np.ndarray, ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, rotation: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, product) of each query's ``k`` best, ties to the smaller of ``ids``.

    ``bounds`` are products that a candidate must reach (minus infinity: none known); they rise as the scan goes on.
    """
    dim = candidates.shape[1]
    scale = max(float(np.abs(candidates).max()), float(np.abs(queries).max()))
    xs, qs = (candidates / scale) @ rotation, (queries / scale) @ rotation
    x_square, q_square = (xs**2).sum(axis=1), (qs**2).sum(axis=1)
    out = []
    for first in range(0, len(queries), QUERY_CHUNK):
        asked = slice(first, first + QUERY_CHUNK)
        bound = bounds[asked].copy()
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for start in range(0, len(candidates), CHUNK):
            part = slice(start, start + CHUNK)
            most = q_square[asked, None] + x_square[None, part] - 2.0 * (bound / scale / scale)[:, None]
            q_at, x_at = _survivors(xs[part], qs[asked], most, dim)
            x_at += start
            product = np.einsum("ij,ij->i", queries[q_at + first], candidates[x_at])
            good = product >= bound[q_at]
            best = tuple(np.concatenate(pair) for pair in zip(best, (q_at[good], x_at[good], product[good])))
            best, full, least = _best(best, ids, k)
            bound[full] = np.maximum(bound[full], least)
        out.append((best[0] + first, best[1], best[2]))
    return tuple(np.concatenate(column) for column in zip(*out))


def _best(rows: tuple, ids: np.ndarray, k: int) -> tuple[tuple, np.ndarray, np.ndarray]:
    """Each query's ``k`` best rows; the queries that have so many, and their smallest product."""
    q_at, x_at, product = rows
    order = np.lexsort((ids[x_at], -product, q_at))
    q_at, x_at, product = q_at[order], x_at[order], product[order]
    begins = np.flatnonzero(np.concatenate([[True], q_at[1:] != q_at[:-1]])) if len(q_at) else np.zeros(0, np.int64)
    rank = np.arange(len(q_at)) - np.repeat(begins, np.diff(np.append(begins, len(q_at))))
    last = rank == k - 1
    kept = rank < k
    return (q_at[kept], x_at[kept], product[kept]), q_at[last], product[last]


@lru_cache(64)
def share_at_most(seen: int, dim: int) -> float:
    """The share of a squared distance in ``seen`` of ``dim`` turned columns, exceeded with probability ``LEVEL``."""
    if seen >= dim:
        return 1.0
    shares = np.random.default_rng([_SEED, seen, dim]).beta(seen / 2, (dim - seen) / 2, 200_000)
    return float(np.quantile(shares, 1 - LEVEL))


def _survivors(xs: np.ndarray, qs: np.ndarray, most: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that no test abandoned.

    While many are left a block of columns is one matrix product for all pairs, then it is looked at pair by pair.
    """
    # Rounding may take a distance of nothing below zero.
    most = np.maximum(most, 0.0) + 1e-9
    partial, cut = np.zeros(most.shape), 0
    while cut < dim:
        block = slice(cut, min(cut + COLUMNS, dim))
        q, x = qs[:, block], xs[:, block]
        partial += (q**2).sum(axis=1)[:, None] + (x**2).sum(axis=1)[None, :] - 2.0 * (q @ x.T)
        cut = block.stop
        stays = partial <= share_at_most(cut, dim) * most
        if np.count_nonzero(stays) < DENSE * stays.size:
            break
    q_at, x_at = np.nonzero(stays)
    left, most = partial[q_at, x_at], most[q_at, x_at]
    while cut < dim and len(q_at):
        block = slice(cut, min(cut + COLUMNS, dim))
        left = left + ((qs[q_at, block] - xs[x_at, block]) ** 2).sum(axis=1)
        cut = block.stop
        stays = left <= share_at_most(cut, dim) * most
        q_at, x_at, left, most = q_at[stays], x_at[stays], left[stays], most[stays]
    return q_at, x_at


_HITS = "query_class LONG, class_id LONG, score DOUBLE"


def _scan_group(k: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        asks = group["bound"].notna().to_numpy()
        if asks.all() or not asks.any():
            return pd.DataFrame({"query_class": [], "class_id": [], "score": []})
        vectors = np.stack([np.frombuffer(v, np.float64) for v in group["vector"]])
        ids = group["class_id"].to_numpy()
        q_at, x_at, score = scan(
            vectors[~asks], group["least_id"].to_numpy()[~asks], vectors[asks], group["bound"].to_numpy()[asks],
            rotation(int(key[0])), k,
        )
        return pd.DataFrame({"query_class": ids[asks][q_at], "class_id": ids[~asks][x_at], "score": score})

    return run


def _fit_all(classes: DataFrame, k: int) -> dict[int, Index]:
    """One index per vector length; only the bounded samples and one row per length reach the driver."""
    squares = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x)
    lengths = classes.groupBy("dim").agg(F.count(F.lit(1)).alias("rows"), F.max(F.sqrt(squares)).alias("longest")).collect()
    out = {}
    for r in lengths:
        most = max(50, min(FIT_ROWS, FIT_VALUES // r["dim"]))
        taken = classes.where(F.col("dim") == r["dim"]).orderBy("hash_one", "hash_two").limit(most).select("embedding")
        sample = np.array([row[0] for row in taken.collect()], np.float64)
        out[r["dim"]] = fit(sample, r["rows"], r["longest"], k)
    return out


def nearest(
    table: DataFrame,
    is_query: Column,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The ``k`` rows of largest inner product for each row that is a query, its own row left out.

    One row per query and rank (from 1): ``query_id``, ``rank``, the id, ``score`` (double).  Best first, ties
    to the smaller id; fewer than ``k`` rows if there are not so many candidates.  ``is_query`` may
    use the id column only.  Rows whose id is null or whose vector is null, empty, zero or holds null or
    non-finite components take no part; vectors meet only vectors of their own length.  Rows that repeat an id
    and a vector are one row.  Other columns are not read.
    """
    valid = (
        table.select(F.col(id_column), F.col(vector_column).cast("array<double>").alias("embedding"))
        .where(F.col(id_column).isNotNull() & _is_valid("embedding"))
        .select(F.col(id_column).alias("row_id"), is_query.alias("asks"), "embedding", *_key("embedding"))
    )
    rows = written(valid, "vectors")
    hashes = ["hash_one", "hash_two"]
    # At most k + 1 ids of a class can be in one answer; the limit is applied before the shuffle as well.
    by_id = Window.partitionBy(*hashes).orderBy("row_id")
    ids = (
        rows.select(*hashes, "row_id").distinct().withColumn("at", F.row_number().over(by_id)).where(F.col("at") <= k + 1)
        .groupBy(*hashes).agg(F.array_sort(F.collect_list("row_id")).alias("ids"))
    )
    vectors = rows.groupBy(*hashes).agg(F.first("embedding").alias("embedding"), F.count_if("asks").alias("n_queries"))
    classes = written(
        vectors.join(ids, hashes).select(
            *hashes, "ids", F.col("ids")[0].alias("least_id"), "embedding", F.size("embedding").alias("dim"),
            "n_queries", F.monotonically_increasing_id().alias("class_id"),
        ),
        "classes",
    )
    indexes = _fit_all(classes, k)

    id_type = classes.schema["least_id"].dataType.simpleString()
    schema = f"dim INT, list INT, probe INT, class_id LONG, least_id {id_type}, vector BINARY"

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                index, vectors = indexes[dim], np.stack(part["embedding"].to_numpy()).astype(np.float64)
                raw, ids = np.array([v.tobytes() for v in vectors], object), part["class_id"].to_numpy()
                least = part["least_id"].to_numpy()
                yield pd.DataFrame(
                    {"dim": dim, "list": index.list_of(vectors), "probe": -1, "class_id": ids, "least_id": least, "vector": raw}
                )
                asks = part["n_queries"].to_numpy() > 0
                if asks.any():
                    probed = index.probed(vectors[asks])
                    yield pd.DataFrame(
                        {
                            "dim": dim, "list": probed.ravel(), "probe": np.tile(np.arange(probed.shape[1]), len(probed)),
                            "class_id": np.repeat(ids[asks], probed.shape[1]),
                            "least_id": np.repeat(least[asks], probed.shape[1]), "vector": np.repeat(raw[asks], probed.shape[1]),
                        }
                    )

    placed = written(
        classes.select("dim", "class_id", "least_id", "embedding", "n_queries").mapInPandas(place, schema),
        "placed",
    )

    def scanned(queries: DataFrame) -> DataFrame:
        cell = ["dim", "list"]
        members = placed.where(F.col("probe") < 0).withColumn("bound", F.lit(None).cast("double"))
        sizes = written(
            members.select(*cell, F.lit(1).alias("c"), F.lit(0).alias("q"))
            .unionByName(queries.select(*cell, F.lit(0).alias("c"), F.lit(1).alias("q")))
            .groupBy(*cell)
            .agg(*[F.greatest(F.lit(1), F.ceil(F.sum(n) / BLOCK_ROWS)).cast("int").alias(f"{n}_blocks") for n in "cq"]),
            "list_sizes",
        )
        sizes = checked_broadcast(sizes)

        def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
            return side.join(sizes, cell).select(
                *cell, "class_id", "least_id", "vector", "bound",
                F.pmod(F.xxhash64("class_id"), f"{own}_blocks").cast("int").alias(f"{own}_block"),
                F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block"),
            )

        both = dealt(members, "c", "q").unionByName(dealt(queries, "q", "c"))
        return both.groupBy(*cell, "c_block", "q_block").applyInPandas(_scan_group(k + 1), _HITS)

    asked = placed.where(F.col("probe") >= 0)
    first = written(scanned(asked.where(F.col("probe") == 0).withColumn("bound", F.lit(float("-inf")))), "near_first")
    place_of = Window.partitionBy("query_class").orderBy(F.col("score").desc())
    bound = (
        first.withColumn("at", F.row_number().over(place_of)).where(F.col("at") <= k + 1)
        .groupBy("query_class").agg(F.min("score").alias("bound"), F.count(F.lit(1)).alias("n"))
        .select(F.col("query_class").alias("class_id"), F.when(F.col("n") > k, F.col("bound")).alias("bound"))
    )
    others = asked.where(F.col("probe") > 0).join(bound, "class_id", "left").withColumn(
        "bound", F.coalesce("bound", F.lit(float("-inf")))
    )
    hits = first.unionByName(scanned(others))
    return _answers(rows, classes, hits, k, id_column)


def _answers(rows: DataFrame, classes: DataFrame, hits: DataFrame, k: int, id_column: str) -> DataFrame:
    """The best ``k + 1`` ids of each query class, once per query, without its own id."""
    best = Window.partitionBy("query_class").orderBy(F.col("score").desc(), "row_id")
    merged = (
        hits.join(classes.select("class_id", "ids"), "class_id")
        .select("query_class", "score", F.explode("ids").alias("row_id"))
        .withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1)
        .groupBy("query_class").agg(F.array_sort(F.collect_list(F.struct("at", "row_id", "score"))).alias("found"))
    )
    hashes = ["hash_one", "hash_two"]
    # The queries of a hot class are dealt out; its answer goes with each part.
    parts = F.ceil(F.col("n_queries") / HOT_ANSWERS).cast("int").alias("parts")
    by_class = written(
        classes.where(F.col("n_queries") > 0).select(*hashes, F.col("class_id").alias("query_class"), parts)
        .join(merged, "query_class", "left"),
        "answers",
    )
    hot = checked_broadcast(by_class.where(F.col("parts") > 1).select(*hashes, "parts"))
    queries = rows.where("asks").select("row_id", *hashes).distinct().join(hot, hashes, "left").select(
        F.col("row_id").alias("query_id"), *hashes,
        F.pmod(F.xxhash64("row_id"), F.coalesce("parts", F.lit(1))).cast("int").alias("part"),
    )
    answers = by_class.select(*hashes, "found", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    others = F.slice(F.filter("found", lambda hit: hit["row_id"] != F.col("query_id")), 1, k)
    return (
        queries.join(answers, [*hashes, "part"])
        .select("query_id", F.posexplode(others).alias("pos", "hit"))
        .select(
            "query_id", (F.col("pos") + 1).cast("int").alias("rank"),
            F.col("hit.row_id").alias(id_column), F.col("hit.score").alias("score"),
        )
    )
