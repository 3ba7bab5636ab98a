"""Near-duplicate embeddings by counting collisions of one-dimensional projections.

Vectors of length one are projected on many random directions.  On each projection, sorted, a vector's
window reaches ``WINDOW`` to both sides; vectors at the threshold's angle fall into each other's window
far more often than others.  A pair that collides on enough projections is verified by its cosine in
double precision.  How many are enough is calibrated: pairs made at exactly the threshold's angle must
pass with probability ``PASS``.

To keep the count near linear in the number of vectors, windows are counted within cells.  A table of
cells is a random rotation; a vector's cell is the axis (and sign) it points to most, several axes of
several rotations if cells would hold more than about ``CELL_ROWS``.  The number of tables is calibrated
in the same way: a pair at the threshold shares a cell in some table with probability ``SHARE``.  A pair
that shares several cells counts in the first only, so no pair needs to be shuffled or made distinct.

Equal vectors are one class with a multiplicity; they are never paired.  A cell of more than
``BLOCK_ROWS`` classes is cut into blocks, and each pair of blocks is a task of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pvspark.llm.components import components
from pvspark.llm.scratch import written

PROJECTIONS = 32
SHARE, PASS = 0.995, 0.995
CELL_ROWS = 400
BLOCK_ROWS = 1024
MOST_TABLES = 200
_PAIRS = 4000  # simulated, for calibration


def _rng(*seed: int) -> np.random.Generator:
    return np.random.default_rng([6, *seed])


@dataclass(frozen=True)
class Plan:
    """What tasks need to place and compare vectors of one dimension."""

    dim: int
    axes: tuple[int, ...]  # axes that each digit of a cell chooses from
    tables: int
    window: float
    least_hits: int
    cosine: float

    def rotation(self, table: int, digit: int) -> np.ndarray:
        q, _ = np.linalg.qr(_rng(self.dim, table, digit).standard_normal((self.dim, self.dim)))
        return q[:, : self.axes[digit]]

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """Cell of each vector in each table."""
        out = np.zeros((len(unit), self.tables), np.int64)
        for table in range(self.tables):
            out[:, table] = self.cell(unit, table)
        return out

    def cell(self, unit: np.ndarray, table: int) -> np.ndarray:
        cell = np.zeros(len(unit), np.int64)
        for digit, axes in enumerate(self.axes):
            turned = unit @ self.rotation(table, digit)
            at = np.abs(turned).argmax(axis=1)
            sign = turned[np.arange(len(unit)), at] < 0
            cell = cell * (2 * axes) + 2 * at + sign
        return cell

    def projections(self, unit: np.ndarray) -> np.ndarray:
        return unit @ _rng(self.dim).standard_normal((self.dim, PROJECTIONS))


def _digits(dim: int, cells: float) -> tuple[int, ...]:
    axes: list[int] = []
    while cells > 2:
        axes.append(int(min(dim, max(1, round(cells / 2)))))
        cells /= 2 * axes[-1]
    return tuple(axes)


def calibrate(dim: int, rows: int, cosine: float) -> Plan:
    """Choose window, tables and least hits on simulated pairs at exactly ``cosine``."""
    rng = _rng(dim, 0, 0, 1)
    a = rng.standard_normal((_PAIRS, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((_PAIRS, dim))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
    b = cosine * a + np.sqrt(max(0.0, 1 - cosine**2)) * b
    window = float(np.sqrt(max(2 - 2 * cosine, 1e-6)))  # one standard deviation at the threshold
    plan = Plan(dim, _digits(dim, rows / CELL_ROWS) if dim > 1 else (), MOST_TABLES, window, 0, cosine)
    hits = (np.abs(plan.projections(a) - plan.projections(b)) <= window).sum(axis=1)
    least = int(np.sort(hits)[int((1 - PASS) * _PAIRS)])
    met, tables = np.zeros(_PAIRS, bool), 0
    while met.mean() < SHARE and tables < MOST_TABLES:
        met |= plan.cell(a, tables) == plan.cell(b, tables)
        tables += 1
    if met.mean() < SHARE:
        raise ValueError(f"{MOST_TABLES} tables reach {met.mean():.3f} of the pairs at cosine {cosine}, not {SHARE}: use a higher cosine")
    return Plan(dim, plan.axes, max(1, tables), window, least, cosine)


def _collisions(values: np.ndarray, window: float) -> np.ndarray:
    """On how many projections each pair lies within the window; pair ``i < j`` stands at ``i * n + j``."""
    n = len(values)
    counts = np.zeros(n * n, np.uint8)
    for j in range(values.shape[1]):
        order = np.argsort(values[:, j], kind="stable")
        line = values[order, j]
        reach = np.searchsorted(line, line + window, side="right") - np.arange(n) - 1
        total = int(reach.sum())
        if not total:
            continue
        first = np.repeat(np.arange(n), reach)
        step = np.arange(total) - np.repeat(np.cumsum(reach) - reach, reach) + 1
        one, two = order[first], order[first + step]
        # Each pair occurs once on one projection, so plain indexing adds safely.
        counts[np.minimum(one, two) * n + np.maximum(one, two)] += 1
    return counts


def _links(plans: dict[int, Plan]):
    """Verified links of one cell or pair of blocks: partial link counts and forest edges."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        dim, table, _, one, two = key
        plan = plans[int(dim)]
        n = len(group)
        ids, times = group["class_id"].to_numpy(), group["times"].to_numpy()
        block = group["block"].to_numpy()
        vectors = np.stack([np.frombuffer(v, np.float64) for v in group["vector"]])
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        counts = _collisions(plan.projections(unit), plan.window)
        code = np.flatnonzero(counts >= max(1, plan.least_hits))
        a, b = code // n, code % n
        if one != two:
            ok = block[a] != block[b]
            a, b = a[ok], b[ok]
        if len(a):
            cells = plan.cells(unit)[:, : int(table)]
            linked = np.zeros(len(a), bool)
            for k in range(0, len(a), 65536):
                i, j = a[k : k + 65536], b[k : k + 65536]
                near = np.einsum("ij,ij->i", unit[i], unit[j]) >= plan.cosine
                near[near] = ~(cells[i[near]] == cells[j[near]]).any(axis=1)
                linked[k : k + 65536] = near
            a, b = a[linked], b[linked]
        links = np.bincount(a, times[b], n) + np.bincount(b, times[a], n) if len(a) else np.zeros(n)
        rows = np.flatnonzero(links)
        counted = pd.DataFrame({"class_id": ids[rows], "other": None, "n": links[rows].astype(np.int64)})
        edges = _forest(a, b, n)
        tree = pd.DataFrame({"class_id": ids[edges[:, 0]], "other": ids[edges[:, 1]], "n": np.int64(0)})
        return pd.concat([counted, tree]).astype({"other": "Int64"})

    return run


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Star edges with the same components as the given pairs: smallest labels spread until they settle."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    members = np.flatnonzero(label != np.arange(n))
    return np.stack([members, label[members]], axis=1)


def _key(column: str) -> list[Column]:
    """128 bits of a vector's values; zeros of both signs are one.  The second hash starts from another seed."""
    plain = F.transform(column, lambda x: x + F.lit(0.0))
    return [F.xxhash64(plain).alias("hash_one"), F.xxhash64(F.lit(1), plain).alias("hash_two")]


def _is_valid(column: str) -> Column:
    finite = F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


def near_duplicates(
    table: DataFrame, cosine: float = 0.9, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``.

    Vectors that are null or empty, hold null or non-finite values or are all zeros link with nothing; their
    component is their own id.  Vectors of different length link with nothing of the other.  Ids are
    taken as they are: rows that repeat an id and a vector are copies of each other, and a null id is
    a component's id only if it has no other.  Other columns are not read.
    """
    spark = table.sparkSession
    rows = table.select(F.col(id_column).alias("vec_id"), F.col(vector_column).cast("array<double>").alias("embedding"))
    rows = written(rows.withColumn("valid", _is_valid("embedding")).select("*", *_key("embedding")), "vectors")
    valid = rows.filter("valid")
    classes = written(
        valid.groupBy("hash_one", "hash_two")
        .agg(F.count(F.lit(1)).alias("times"), F.min("vec_id").alias("least_id"), F.first("embedding").alias("embedding"))
        .select("*", F.size("embedding").alias("dim"), F.monotonically_increasing_id().alias("class_id")),
        "classes",
    )
    dims = classes.groupBy("dim").count().collect()  # one row per vector length in use
    plans = {r["dim"]: calibrate(r["dim"], r["count"], cosine) for r in dims}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                plan = plans[dim]
                vectors = np.stack(part["embedding"].to_numpy()).astype(np.float64)
                # Scaled first, so that very large or small values neither overflow nor vanish.
                vectors /= np.abs(vectors).max(axis=1, keepdims=True)
                unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
                raw = [v.tobytes() for v in vectors]
                for t in range(plan.tables):
                    yield pd.DataFrame(
                        {"dim": dim, "tab": t, "cell": plan.cell(unit, t), "class_id": part["class_id"].to_numpy(),
                         "times": part["times"].to_numpy(), "vector": raw}
                    )

    cell = ["dim", "tab", "cell"]
    placed = classes.select("dim", "class_id", "times", "embedding").mapInPandas(
        place, "dim INT, tab INT, cell LONG, class_id LONG, times LONG, vector BINARY"
    )
    large = written(
        placed.groupBy(*cell).count().filter(F.col("count") > BLOCK_ROWS)
        .select(*cell, F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("blocks")),
        "large_cells",
    )
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("class_id"), blocks).cast("int")
    dealt = (
        placed.join(large, cell, "left")
        .select(*placed.columns, blocks.alias("blocks"), own.alias("block"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
        .select(*placed.columns, "block", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("two"))
    )
    found = written(
        dealt.groupBy(*cell, "one", "two").applyInPandas(_links(plans), "class_id LONG, other LONG, n LONG"), "found"
    )
    joined = components(found.filter(F.col("other").isNotNull()).select("class_id", "other"))
    counts = found.filter(F.col("other").isNull()).groupBy("class_id").agg(F.sum("n").alias("n"))
    grouped = (
        classes.select("hash_one", "hash_two", "class_id", "times", "least_id")
        .join(counts, "class_id", "left")
        .join(joined.withColumnRenamed("node", "class_id"), "class_id", "left")
        .withColumn("group", F.coalesce("component", "class_id"))
    )
    least = grouped.groupBy("group").agg(F.min("least_id").alias("component_id"))
    by_class = grouped.join(least, "group").select(
        "hash_one", "hash_two", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component_id"
    )
    linked = valid.select("vec_id", "hash_one", "hash_two").join(by_class, ["hash_one", "hash_two"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.col("valid")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("vec_id").alias(id_column), "n_links", "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
