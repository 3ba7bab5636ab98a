"""Repeat removal against a set of all windows; the suffix array against sorting."""

import hashlib
import random
from collections import Counter

import pytest

from pvspark.llm import repeats
from pvspark.llm.suffix_array import suffix_array


def brute(texts, length=400):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), runs, bytes(b for b, g in zip(r, gone) if not g)))
    return out


def check(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id LONG, text STRING, runs STRING")
    got = {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.removed), bytes(r.kept)) for r in repeats.remove_repeats(docs, **options).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def prose(rng, n, letters="abcdefgh éß"):
    return "".join(rng.choice(letters) for _ in range(n))


def test_suffix_array_is_the_sorted_order():
    rng = random.Random(3)
    for _ in range(1500):
        word = [rng.randint(1, rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(0, 30))]
        if rng.random() < 0.4:
            word = (word[: rng.randint(1, 5)] * 12)[:40]
        text = word + [0]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])
    with pytest.raises(ValueError):
        suffix_array([1, 0, 0])


def test_odd_texts(spark):
    check(spark, [None, "", "a" * 399, "b" * 400, "b" * 400, "c" * 401, "ab" * 500, "é" * 300, "é" * 300, "z" * 5000])


@pytest.mark.parametrize("max_group", [256, 3])
def test_shared_passages(spark, max_group):
    rng = random.Random(7)
    passage, other = prose(rng, 900), prose(rng, 420)
    texts = [prose(rng, rng.randint(0, 700)) + passage[a : a + n] + prose(rng, rng.randint(0, 500)) for a, n in ((0, 900), (10, 700), (50, 400), (60, 399), (3, 450), (200, 600), (0, 430), (1, 430), (5, 800))]
    texts += [other + prose(rng, 30) + other, prose(rng, 1500), texts[0], texts[3]]
    near = prose(rng, 3000)
    for _ in range(6):
        at = rng.randint(0, 2900)
        texts.append(near[:at] + "#" + near[at + 1 :])
    check(spark, texts, max_group=max_group)


def test_a_passage_in_very_many_documents(spark):
    """More contexts per gram than the bound, so that they are dealt out again and counted by window."""
    rng = random.Random(11)
    passage, line = prose(rng, 600), prose(rng, 90)
    texts = [prose(rng, 300) + line + prose(rng, 330) for _ in range(30)]
    texts += [prose(rng, 200) + passage + prose(rng, 200) for _ in range(30)]
    check(spark, texts, max_group=8)


def test_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_PIECE", 1000)
    rng = random.Random(5)
    passage = prose(rng, 500)
    long = prose(rng, 2500) + passage + prose(rng, 1700)
    rows = list(repeats._find_anchors(iter([__import__("pandas").DataFrame({"_id": ["1"], "_key": [1], "text": [long]})])))[0]
    raw = long.encode()
    starts = sorted((a, b) for a, b in zip(rows["first"], rows["last"]))
    assert starts[0][0] == 0 and starts[-1][1] == len(raw) - 400
    assert all(b + 1 == c for (_, b), (c, _) in zip(starts, starts[1:]))
    assert all(hashlib.blake2b(raw[a : b + 400], digest_size=16).digest() == d for a, b, d in zip(rows["first"], rows["last"], rows["digest"]))


def test_repeated_rows_null_ids_and_empty_tables(spark):
    text = "q" * 10 + prose(random.Random(2), 600)
    docs = spark.createDataFrame([(None, text), (1, text), (1, text), (None, None)], "doc_id LONG, text STRING")
    got = sorted((r.doc_id or 0, r.n_bytes, len(r.kept)) for r in repeats.remove_repeats(docs).collect())
    size = len(text.encode())
    assert got == [(0, 0, 0), (0, size, 0), (1, size, 0), (1, size, 0)]
    assert repeats.remove_repeats(docs.limit(0)).count() == 0
