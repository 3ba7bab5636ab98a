"""The sample that the model is fitted on holds every kind, wherever in the documents it occurs."""

import random

from pvspark.llm import pii


def corpus():
    rng = random.Random(3)
    number = lambda n: "".join(str(rng.randint(0, 9)) for _ in range(n))
    filler = "plain words without any mark " * 8
    rows = []
    for i in range(1200):
        later = ""
        if i % 8 == 0:
            start = number(15)
            card = next(start + str(d) for d in range(10) if pii.luhn(start + str(d)))
            phone = f"+1 ({rng.randint(200, 999)}) 555-{number(4)}"
            ip = ".".join(str(rng.randint(0, 255)) for _ in range(4))
            later = filler.join(["", f"card {card} ends", f"call {phone} now", f"host {ip} up", ""])
        rows.append((i, f"by writer{i}@mail.example.com today {filler}{later}"))
    return rows


def test_kinds_that_come_late_and_seldom_are_sampled(spark):
    docs = spark.createDataFrame(corpus(), "doc_id LONG, text STRING")
    texts = pii.sample_places(docs)
    n = {kind: sum(any(k == kind for k, _, _ in pii.base_spans(t)) for t in texts) for kind in pii.KINDS}
    assert len(texts) <= pii.MAX_PLACES and all(v == 140 for v in n.values())
    model = pii.fit(docs)
    for text, kind in [("card 4111.1111.1111.1111 ends", "card"), ("call 212-555-0147 now", "phone"), ("host 10[.]20[.]30[.]40 up", "ip")]:
        assert [k for k, _, _ in pii.all_spans(model, text)[1]] == [kind]


def test_a_long_place_is_sampled_in_pieces(spark):
    text = " ".join(f"row {k} of host 10.0.{k % 256}.7 port" for k in range(200))
    assert len(next(pii.places(text)).text) > pii.MOST_PIECE
    pieces = list(pii._pieces(text))
    assert sum(len(pii.base_spans(p)) for p in pieces) == 200 and max(map(len, pieces)) <= pii.MOST_PIECE
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id LONG, text STRING")
    assert pii.sample_places(docs) == sorted(pieces)
    assert pii.sample_places(docs.limit(0)) == []
