"""Quality: held-out accuracy and the trees; decontamination: brute force over all windows."""

import random
import re
import zlib

import numpy as np
import pytest

from pvspark.llm import decontamination, q_quality, quality

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    scored = {r.doc_id: r for r in q_quality.query(spark, SF_DIR).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert len(scored) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for r in scored.values():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [(scored[i].predicted, y) for i, y in labels.items() if scored[i].held_out]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) >= 0.95


def test_trees_fit_and_traverse():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(quality.STATISTICS)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    forest = quality.fit_forest(x[:2000], y[:2000], trees=40)
    assert ((forest.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.95
    total = np.full(20, forest.base)
    for t in range(len(forest.feature)):
        for r in range(20):
            node = 0
            while node < forest.feature.shape[1]:
                node = 2 * node + 1 + int(x[r, forest.feature[t, node]] > forest.cut[t, node])
            total[r] += forest.leaf[t, node - forest.feature.shape[1]]
    assert np.allclose(1 / (1 + np.exp(-total)), forest.score(x[:20]))


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (None, ""), (2, " \n"), (3, "w " * 60_000), (3, "w " * 60_000), (4, "a")], "doc_id LONG, text STRING")
    labels = spark.createDataFrame([(2, 1), (2, 0), (3, None), (None, 1), (4, 1)], "doc_id LONG, quality INT")
    forest = quality.fit(docs, labels)
    got = quality.score(docs, forest).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), labels.limit(0))).count() == 0
    assert quality.held_out("doc_id") is not None


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12)) if w else ():
            windows.setdefault(tuple(w[i : i + 13]), set()).add("" if item is None else str(item))
    out = []
    for i, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [1 << 20, 64])
def test_contamination(spark, monkeypatch, bits):
    monkeypatch.setattr(decontamination, "LEAST_BITS", bits)
    monkeypatch.setattr(decontamination, "MOST_BITS", bits)
    rng = random.Random(2)
    vocabulary = ["the", "of", "Éa", "x9", "ñ", "tion", "A", "b", "über", "ten"]
    prose = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, prose(rng.choice([13, 14, 20, 40]))) for i in range(12)]
    items += [(20, "one TWO three"), (21, "lonely"), (22, ""), (23, None), (None, prose(15)), (5, prose(13)), (24, "one two")]
    docs = []
    for i in range(40):
        text = prose(rng.randint(0, 60))
        if i % 3 == 0:
            text += rng.choice(items)[1] or ""
        docs.append((i, text + prose(rng.randint(0, 20))))
    docs += [(50, None), (51, ""), (None, "Lonely one two"), (52, items[0][1]), (52, items[0][1]), (53, "the " * 40_000 + items[1][1])]
    table = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id LONG, text STRING, row INT").repartition(3)
    benchmark = spark.createDataFrame([(i, t, "c") for i, t in items], "item_id LONG, text STRING, window STRING")
    got = sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids)) for r in decontamination.contamination(table, benchmark).collect()), key=repr)
    assert got == brute(docs, items)
    assert decontamination.contamination(table, benchmark.limit(0)).filter("n_hit > 0").count() == 0
    assert decontamination.contamination(table.limit(0), benchmark).count() == 0
