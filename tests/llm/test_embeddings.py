"""Embedding links against brute force, recall at the threshold, odd vectors."""

import numpy as np
import pytest

from pvspark.llm import embeddings


def brute(rows, cosine=0.9):
    """rows: (id, vector or None); as the operator's docstring says."""
    good = []
    for at, (i, v) in enumerate(rows):
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            v = np.array(v, float)
            v = v / np.abs(v).max()
            good.append((at, v / np.linalg.norm(v)))
    links, parent = {at: 0 for at in range(len(rows))}, list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, u) in enumerate(good):
        for b, v in good[k + 1 :]:
            if len(u) == len(v) and u @ v >= cosine:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    out = []
    for at, (i, _) in enumerate(rows):
        own = [rows[o][0] for o in range(len(rows)) if find(o) == find(at)]
        known = [o for o in own if o is not None]
        out.append((i, links[at], min(known) if known else None))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>")
    got = embeddings.near_duplicates(df, **options)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in got.collect()), key=repr)


def clustered(rng, n, dim, spread):
    centres = rng.standard_normal((max(1, n // 6), dim))
    return [(i, (centres[i % len(centres)] + spread * rng.standard_normal(dim)).tolist()) for i in range(n)]


@pytest.mark.parametrize("n,dim,spread", [(300, 16, 0.1), (200, 3, 0.3), (60, 1, 1.0)])
def test_small_tables_equal_brute_force(spark, n, dim, spread):
    rows = clustered(np.random.default_rng(n), n, dim, spread)
    rows += [(1000, rows[0][1]), (1001, rows[0][1]), (0, rows[0][1])]
    assert run(spark, rows) == brute(rows)


def test_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "CELL_ROWS", 20)
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", 16)
    rows = clustered(np.random.default_rng(5), 500, 32, 0.04)
    rows += [(900 + i, (np.array(rows[3][1]) * (1 + i)).tolist()) for i in range(60)]
    assert run(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, float("nan")]), (5, [1.0, None]), (6, [1.0, float("inf")]),
            (7, [1.0, 1.0]), (8, [2.0, 2.0]), (9, [1e300, 1e300]), (10, [1e-300, 1e-300]), (11, [-1.0, -1.0]), (12, [1.0, 1.0, 1.0]),
            (None, [1.0, 1.0]), (None, None), (13, [0.0, 1.0]), (14, [-0.0, 1.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


@pytest.mark.parametrize("rows", [10_000, 1_000_000])
def test_recall_at_the_threshold(rows):
    """Pairs at exactly the threshold, other than those it was calibrated on."""
    plan = embeddings.calibrate(64, rows, 0.9)
    rng = np.random.default_rng(99)
    a = rng.standard_normal((3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((3000, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(0.19) * b / np.linalg.norm(b, axis=1, keepdims=True)
    met = (plan.cells(a) == plan.cells(b)).any(axis=1)
    hits = (np.abs(plan.projections(a) - plan.projections(b)) <= plan.window).sum(axis=1) >= plan.least_hits
    assert (met & hits).mean() > 0.97


def test_a_cosine_out_of_reach_is_refused():
    with pytest.raises(ValueError, match="higher cosine"):
        embeddings.calibrate(64, 10**9, 0.2)
