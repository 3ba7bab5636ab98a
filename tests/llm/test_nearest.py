"""Nearest vectors against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pvspark.llm import nearest

SCHEMA = "vec_id LONG, embedding ARRAY<DOUBLE>, score STRING, list INT"


def brute(rows, asks, k):
    usable = {}
    for row_id, vector in rows:
        if row_id is None or not vector or any(x is None or not np.isfinite(x) for x in vector) or not any(vector):
            continue
        usable[row_id] = np.array(vector, np.float64)
    out = []
    for q in usable:
        if not asks(q):
            continue
        others = [(-float(usable[q] @ v), i) for i, v in usable.items() if i != q and len(v) == len(usable[q])]
        out += [(q, rank, i, round(-s, 9)) for rank, (s, i) in enumerate(sorted(others)[:k], 1)]
    return sorted(out)


def found(spark, rows, asks, k=5):
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(4)
    got = nearest.nearest(table, asks, k).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got)


def test_small_table_with_faulty_rows_ties_and_repeats(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6)]) for i in range(60)]
    rows += [(i, [1.0, 2.0, 0.0, 0.0, 1.0, 0.0]) for i in range(100, 140)]  # equal vectors, queries among them
    rows += [(60, None), (65, []), (70, [0.0] * 6), (75, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (80, [float("nan")] * 6), (85, [float("inf")] + [0.0] * 5)]
    rows += [(None, [1.0] * 6), (200, [1.0, 1.0]), (205, [2.0, -1.0]), (210, [5.0])]
    rows += rows[:10]
    assert found(spark, rows, F.col("vec_id") % 5 == 0) == brute(rows, lambda i: i % 5 == 0, 5)


def test_empty_table_and_no_queries(spark):
    assert found(spark, [], F.col("vec_id") % 5 == 0) == []
    assert found(spark, [(1, [1.0]), (2, [2.0])], F.col("vec_id") % 5 == 0) == []


def test_hot_vector_and_very_different_lengths(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 64)
    monkeypatch.setattr(nearest, "LIST_ROWS", 100)
    monkeypatch.setattr(nearest, "HOT_ANSWERS", 20)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.standard_normal(8) * 10.0 ** (i % 3)]) for i in range(600)]
    rows += [(1000 + i, [3.0] + [1.0] * 7) for i in range(300)]
    got, want = found(spark, rows, F.col("vec_id") % 10 == 0, 10), brute(rows, lambda i: i % 10 == 0, 10)
    assert len(got) == len(want)
    shared = {(q, i) for q, _, i, _ in got} & {(q, i) for q, _, i, _ in want}
    assert len(shared) >= 0.95 * len(want)
    # Members of the hot class have one answer but for their own id.
    hot = {q: [i for h, _, i, _ in got if h == q] for q in range(1000, 1300, 10)}
    assert all(q not in ids and len(ids) == 10 for q, ids in hot.items())


def test_all_products_tie(spark, monkeypatch):
    monkeypatch.setattr(nearest, "CHUNK", 16)
    rows = [(i, [1.0 if k == i % 32 else 0.0 for k in range(32)]) for i in range(32)]
    assert found(spark, rows, F.col("vec_id") % 4 == 0) == brute(rows, lambda i: i % 4 == 0, 5)


@pytest.mark.parametrize("clustered", [False, True])
def test_recall_over_many_lists(spark, monkeypatch, clustered):
    monkeypatch.setattr(nearest, "LIST_ROWS", 128)
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((20, 48)) * (3 if clustered else 0)
    vectors = centers[rng.integers(0, 20, 4000)] + rng.standard_normal((4000, 48))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    got, want = found(spark, rows, F.col("vec_id") % 20 == 0, 20), brute(rows, lambda i: i % 20 == 0, 20)
    assert len(got) == len(want)
    assert len({r[::2] for r in got} & {r[::2] for r in want}) >= 0.95 * len(want)


def test_the_test_keeps_near_pairs_at_its_level():
    rng = np.random.default_rng(4)
    dim, turned = 64, nearest.rotation(64)
    difference = (rng.standard_normal((20_000, dim)) * np.linspace(0.1, 5, dim)) @ turned
    whole = (difference**2).sum(axis=1)
    for seen in (16, 32, 48):
        part = (difference[:, :seen] ** 2).sum(axis=1)
        assert (part > nearest.share_at_most(seen, dim) * whole).mean() < 0.05
    plain = rng.standard_normal((50_000, dim))
    part = (plain[:, :16] ** 2).sum(axis=1) / (plain**2).sum(axis=1)
    assert (part > nearest.share_at_most(16, dim)).mean() < 3 * nearest.LEVEL
