"""SimHash against brute force: fingerprints, the covering, components."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pvspark.llm import simhash
from pvspark.llm.components import components


def brute_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one two", "A b\x0bC  d\ne", "ÀÉ x y z w", "a " * 40_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_spark_hashes_shingles_the_same_way(spark):
    row = spark.sql("select xxhash64('one two three') h").first()
    assert row.h & (2**64 - 1) == int(simhash.shingle_hashes("one TWO three")[0])


@pytest.mark.parametrize("reach", [1, 2, 3])
def test_anchors_are_all_code_words_in_reach(reach):
    rng = np.random.default_rng(reach)
    half = rng.integers(0, 2**32, 20, dtype=np.uint32)
    half[0] = 0
    found = {(int(r), int(a)) for rows, anchors in simhash.anchors(half, reach) for r, a in zip(rows, anchors)}
    total = sum(len(rows) for rows, _ in simhash.anchors(half, reach))
    assert total == len(found)
    for r, a in found:
        assert bin(int(half[r]) ^ a).count("1") <= reach
        assert simhash._syndrome(np.array([a], np.uint32))[0] == 0
    # Every code word within reach, by trying all flips of so many bits.
    from itertools import combinations

    for r, word in enumerate(half[:3]):
        expected = set()
        for n in range(reach + 1):
            for bits in combinations(range(32), n):
                candidate = int(word) ^ sum(1 << b for b in bits)
                if simhash._syndrome(np.array([candidate], np.uint32))[0] == 0:
                    expected.add(candidate)
        assert {a for row, a in found if row == r} == expected


@pytest.mark.parametrize("threshold,max_cell", [(2, 1 << 16), (2, 3), (3, 1 << 16), (1, 2), (0, 10)])
def test_components_of_fingerprints(spark, threshold, max_cell):
    rng = np.random.default_rng(threshold)
    seeds = [int(x) for x in rng.integers(0, 2**63, 12)]
    fps = set(seeds)
    for s in seeds:
        for _ in range(12):
            s ^= sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(1, 5)))
            fps.add(s)
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    links = simhash.fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp LONG"), threshold, max_cell)
    got = {n: n for n in signed} | {r.node: r.component for r in components(links).collect()}
    expected = brute_components(sorted(signed), lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1") <= threshold)
    assert got == expected


def test_near_duplicates_and_odd_rows(spark):
    base = " ".join(f"word{i}" for i in range(60))
    rows = [(4, base), (2, base), (9, base + " tail"), (2, base), (7, None), (6, ""), (None, "q r s t"), (5, "q r s t"), (3, "x" * 70_000)]
    docs = spark.createDataFrame([(i, t, "other", 1) for i, t in rows], "doc_id LONG, text STRING, component STRING, fp INT")
    got = sorted(((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(docs).collect()), key=repr)
    fps = {t: brute_fingerprint(t) for _, t in rows}
    comp = brute_components(sorted(set(fps.values())), lambda a, b: bin(a ^ b).count("1") <= 2)
    least = {}
    for i, t in rows:
        if i is not None:
            root = comp[fps[t]]
            least[root] = min(i, least.get(root, i))
    assert got == sorted(((i, fps[t], least[comp[fps[t]]]) for i, t in rows), key=repr)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == sorted(least.values())


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id LONG, text STRING")
    assert simhash.near_duplicates(docs).count() == 0 and simhash.keep_one(docs).count() == 0
    assert components(spark.createDataFrame([], "a LONG, b LONG")).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, i) for i in range(1001, 1300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain + star + [(5, 5), (None, 3)], "a LONG, b LONG")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1300)}
