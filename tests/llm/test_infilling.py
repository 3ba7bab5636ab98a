"""Fill-in-the-middle against plain slicing, and its exact round trip."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pvspark.llm import infilling

TEXTS = [
    None, "", "a", "ab", "héllo wörld", "日本語のテキスト" * 40, "🎉" * 700 + "x", "has <P> inside", "<S>", "x<M>",
    "< P>", "<<P", "a <P", "S>b", " \t\n", "word " * 5000, "é" * 200_000, "<",
]


def numbers(doc_id):
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def plain(doc_id, text):
    text = text or ""
    h1, h2, h3, h4 = numbers(doc_id)
    n = len(text)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return (n, "plain", None, None, text)
    if h4 % 100 < 20:
        return (n, "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (n, "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{middle}")


def test_against_slicing_with_clashing_columns_nulls_and_repeated_rows(spark):
    rows = [(doc_id, text, "x", 1) for doc_id in [None, 0, 1, 2**53 + 1, -7, 40, 40] for text in TEXTS]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, form STRING, n INT").repartition(3)
    made = infilling.fill_in_middle(docs)
    got = made.withColumn("restored", infilling.restore(F.col("output"), F.col("form"))).collect()
    key = lambda r: repr(r)
    assert sorted([(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in got], key=key) == sorted(
        [(d, *plain(d, t), t or "") for d, t, _, _ in rows], key=key
    )
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table_and_unknown_unit(spark):
    docs = spark.createDataFrame([], "doc_id LONG, text STRING")
    assert infilling.fill_in_middle(docs).collect() == []
    with pytest.raises(ValueError):
        infilling.fill_in_middle(docs, unit="line")


@pytest.mark.parametrize("block", [1, 2, 7, 1024])
def test_cuts_of_every_unit_with_any_block(block):
    rng = random.Random(block)
    for _ in range(200):
        text = "".join(rng.choice(["a", "b", " ", "\n", "é", "日", "🎉"]) for _ in range(rng.randint(0, 40)))
        first, second = rng.randrange(10**6), rng.randrange(10**6)
        pieces, n, head, inner = infilling.cut(text, first, second, infilling.CODE_POINT, block)
        low, high = sorted((first % (len(text) + 1), second % (len(text) + 1)))
        assert (pieces, n, head, inner) == ((text[:low], text[low:high], text[high:]), len(text), low, high - low)

        begins = [k for k, c in enumerate(text) if c not in " \n" and (k == 0 or text[k - 1] in " \n")]
        places = [0, *begins[1:], len(text)] if begins else [0]
        pieces, n, head, inner = infilling.cut(text, first, second, infilling.WORD, block)
        low, high = sorted((places[first % (len(begins) + 1)], places[second % (len(begins) + 1)]))
        assert (pieces, n, head, inner) == ((text[:low], text[low:high], text[high:]), len(begins), low, high - low)


def test_nothing_is_shuffled(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id LONG, text STRING")
    plan = infilling.fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
