"""Personal data: base patterns against plain regular expressions, the model on held-out spellings."""

import random
import re

import numpy as np
import pytest

from pvspark.llm import pii


def plain(text):
    """The base rules as they are written, without care for long runs."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        total = sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(digits[::-1]))
        if 16 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_follow_the_rules():
    rng = random.Random(8)
    pieces = ["a.b", "@", "x-1", ".", "com", " ", "-", "+1", "(", ")", "255", "256", "1.2.3.4", "4387513035237269", "0", "é", "_", "%", "\n", "555-2485"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(text) == plain(text), text


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + "(" * 300_000, "@" * 100_000, "a@" * 100_000, "1 " * 100_000])
def test_long_runs_take_linear_time(text):
    pii.base_spans(text)


@pytest.fixture(scope="module")
def model():
    rng = random.Random(3)
    texts = []
    for _ in range(200):
        word = lambda: "".join(rng.choice("aeinorst") for _ in range(rng.randint(2, 8)))
        number = "".join(str(rng.randint(0, 9)) for _ in range(15))
        card = next(number + str(d) for d in range(10) if pii.luhn(number + str(d)))
        entity = rng.choice([f"{word()}.{rng.randint(1, 99)}@mail{rng.randint(1, 9)}.example.com", ".".join(str(rng.randint(0, 255)) for _ in range(4)), card, f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}", f"version {rng.randint(1, 9)}.0", f"in {rng.randint(1900, 2030)},"])
        texts.append(f"{word()} {word()} {word()} {entity} {word()} {word()}")
    return pii.fit_model(texts[:150], rounds=6), texts[150:]


def test_model_finds_other_spellings_and_leaves_look_alikes(model):
    fitted, held = model
    right = wrong = missed = 0
    for place, gold in pii._examples(held, seed=7):
        base = pii.base_spans(place.text)
        extra = {s for s in gold if s not in base}
        got = set(pii.decode(fitted, place, [(a, b) for _, a, b in base]))
        right, wrong, missed = right + len(extra & got), wrong + len(got - extra), missed + len(extra - got)
    assert right >= 0.85 * (right + missed) and right >= 0.85 * (right + wrong)


def test_decoding_is_the_best_segmentation(model):
    """Dynamic programming against all segmentations of short places."""
    fitted, _ = model
    rng = np.random.default_rng(1)
    random_model = pii.Model(rng.standard_normal((pii.WEIGHTS, 4)), rng.standard_normal((5, 5)))
    place = pii.Place(0, "x 1.2.3.4 y 555-1234567 z")
    found, index = pii._lattice(place, [], True)
    score = pii._scores(random_model, index)
    n = len(place.tokens)

    def every(t, before, spans, value):
        if t == n:
            yield value, spans
            return
        yield from every(t + 1, 0, spans, value + random_model.follows[before, 0])
        for c, (i, j) in enumerate(found):
            if i == t:
                for k in range(4):
                    yield from every(j, k + 1, [*spans, (pii.KINDS[k], place.tokens[i][0], place.tokens[j - 1][1])], value + random_model.follows[before, k + 1] + score[c, k])

    assert pii.decode(random_model, place, []) == max(every(0, 0, [], 0.0), key=lambda x: x[0])[1]


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (None, "mail a@b.c"), (1, "mail a@b.c"), (1, "mail a@b.c"), (3, "x" * 200_000 + " a@b.c")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id LONG, text STRING, base STRING")
    got = sorted(((r.doc_id or 0, r.base, r.spans) for r in pii.find(docs, model[0]).collect()))
    assert got == [(0, "email:5:10", "email:5:10"), (1, "", ""), (1, "email:5:10", "email:5:10"), (1, "email:5:10", "email:5:10"), (2, "", ""), (3, "email:200001:200006", "email:200001:200006")]
    assert pii.find(docs.limit(0), model[0]).count() == 0
