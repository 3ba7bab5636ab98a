"""Spelling variants against brute force."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from pvspark.llm import variants
from pvspark.llm.variable_grams import GramIndex, LONGEST, substrings


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(counts, times=10):
    around = {w: [] for w in counts}
    for a, b in itertools.combinations(counts, 2):
        if near(a, b):
            around[a].append(b)
            around[b].append(a)
    form = {}
    for word, others in around.items():
        if others:
            best = min(others, key=lambda o: (-counts[o], o))
            if counts[best] >= times * counts[word]:
                form[word] = best

    def root(word):
        while word in form:
            word = form[word]
        return word

    return sorted((w, form.get(w), root(w), n, len(around[w]), counts.get(form.get(w))) for w, n in counts.items())


def grouped(spark, counts):
    table = spark.createDataFrame(list(counts.items()), "word STRING, n LONG").repartition(3)
    got = variants.group_variants(table).collect()
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got)


def made_words(seed, n):
    rng = random.Random(seed)
    parts = ["tion", "ment", "anti", "aux", "é", "con", "der", "Ü", "ing", "s", "able"]
    words = {}
    while len(words) < n:
        word = "".join(rng.choice(parts) for _ in range(rng.randint(3, 5)))
        for _ in range(rng.randint(1, 6)):
            if len(word) >= 7:
                words[word] = rng.choice([2, 3, 20, 40, 400, 5000])
            at = rng.randrange(len(word) + 1)
            word = rng.choice([word[:at] + word[at + 1 :], word[:at] + "e" + word[at:], word[:at] + "x" + word[at + 1 :]])
    return words


def test_words_of_whole_texts(spark):
    texts = [
        (1, "Hello WORLDLY worldly ÀÉÎÔÛÄÖ"), (2, None), (3, ""), (None, "worldly worldly"), (4, "abcdefgh2abcdefgh中abcdefgh"),
        (5, "x" * 9 + " " + "worldly " * 40_000), (6, "y" * (3 << 20)), (6, "y" * (3 << 20)), (7, "×÷×÷×÷× ×÷×÷×÷×"),
    ]
    for slip in (None, 3):
        want = Counter()
        for doc_id, text in texts:
            for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
                run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if slip and h % slip == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                want[run] += 1
        docs = spark.createDataFrame([(*t, 1) for t in texts], "doc_id LONG, text STRING, word INT").repartition(4)
        got = {r.word: r.n for r in variants.words(docs, slip=slip).collect()}
        assert got == {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}


def test_slices_cut_no_run(monkeypatch):
    monkeypatch.setattr(variants, "SLICE", 7)
    text = "ab cdefghijklmnop q r stu vwxyzabcdefgh é " * 5
    pieces = list(variants._slices(text))
    assert "".join(pieces) == text
    assert [r for p in pieces for r in variants.RUN.findall(p)] == variants.RUN.findall(text)


def test_groups_equal_brute_force(spark):
    counts = made_words(1, 900)
    assert grouped(spark, counts) == brute(counts)


@pytest.mark.parametrize("limit", [2, 5])
def test_long_lists_are_dealt_out_and_cut_into_blocks(spark, monkeypatch, limit):
    monkeypatch.setattr(variants, "LIST_WORDS", limit)
    monkeypatch.setattr(variants, "BUCKET_ROWS", 500)
    monkeypatch.setattr(variants, "PARTS", 64)
    counts = made_words(2, 250)
    assert grouped(spark, counts) == brute(counts)


def test_very_long_words_chains_ties_and_no_words(spark):
    long = "ab" * 40
    counts = {
        long: 900, long + "c": 3, long[:-1]: 3, "x" + long: 1, "aaaaaaa": 2, "aaaaaaaa": 20, "aaaaaaaaa": 200, "aaaaaaaaaa": 2000,
        "zzzzzzb": 20, "zzzzzzc": 20, "zzzzzzd": 2,
    }
    assert grouped(spark, counts) == brute(counts)
    assert grouped(spark, {}) == []


def test_no_documents_and_too_short_words(spark):
    docs = spark.createDataFrame([(1, None)], "doc_id LONG, text STRING")
    assert variants.spelling_variants(docs).collect() == []
    with pytest.raises(ValueError):
        variants.spelling_variants(docs, min_length=3)


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.text("abc", min_size=4, max_size=14), min_size=1, max_size=30, unique=True),
    st.integers(0, 14), st.sampled_from("abcd"), st.integers(0, 2), st.floats(0.5, 8),
)
def test_near_words_share_all_but_the_affected_grams(words, at, letter, kind, bound):
    """The bound holds for every edit, whatever grams are frequent."""
    word = words[0]
    at = min(at, len(word) - 1)
    edited = [word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]][kind]
    counts = Counter(g for w in {*words, edited} for g in substrings(w))
    index = GramIndex(frozenset(g for g, n in counts.items() if n > bound and len(g) < LONGEST), dict(counts))
    one, affected_one = index.tokens(word)
    two, affected_two = index.tokens(edited)
    shared = len(set(one) & set(two))
    assert shared >= len(one) - affected_one
    assert shared >= len(two) - affected_two
