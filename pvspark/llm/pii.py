"""Personal data in texts: fixed patterns, and a semi-Markov conditional random field for other spellings.

Base spans are what the patterns find.  The model looks at the rest of the text near digits and at
signs: every segment of up to ``MOST_TOKENS`` tokens that could be an entity is scored by features of the
whole segment (digits, groups, checksum, separators, edges, neighbours), and dynamic programming over
positions, with weights for the kind of the segment before, chooses boundaries and kinds together.  A
token that is in no entity is a segment of its own with score zero.

The model is fitted on the driver by conditional likelihood from a bounded sample of such places
(``MAX_PLACES``).  Their labels are the base spans; each also appears with its entities respelled (at signs
and dots written out, other separators, no plus sign), and with look-alikes that are none.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pvspark.llm.scratch import written

KINDS = ("email", "ip", "card", "phone")
#: Bound of the sample of places that the model is fitted on.
MAX_PLACES = 800
#: Characters of a sampled place; longer ones are cut into pieces of about this length.
MOST_PIECE = 1000
MOST_TOKENS = 20
WEIGHTS = 1 << 13

# Fixed patterns of the base spans, written so that no run of characters is read again and again.
_EMAIL_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for at, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if at % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        local = len(before) - len(before.rstrip(_EMAIL_LOCAL))
        domain = _EMAIL_DOMAIN.match(text, at + 1) if local else None
        if domain:
            yield "email", at - local, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _small_part(part: str) -> bool:
    plain = part.lstrip("0")
    return len(plain) < 4 and int(plain or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by kind as listed, then start."""
    spans = list(_emails(text))
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small_part, m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return spans


_TRIGGER = re.compile(r"[0-9]+|@|[\[({<]\s?(?:at|AT|At)\s?[\])}>]")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")
_REACH = 60  # characters to both sides of a trigger
_ENTITY_EDGE = "+("


@dataclass
class Place:
    """A stretch of text near triggers, as tokens; positions count from the whole text."""

    start: int
    text: str
    tokens: list[tuple[int, int, str]] = field(default_factory=list)  # start, end, kind: d, a or the character

    def __post_init__(self) -> None:
        for m in _TOKEN.finditer(self.text):
            c = m[0][0]
            kind = "d" if "0" <= c <= "9" else "a" if c.isalpha() else c
            self.tokens.append((m.start(), m.end(), kind))


def places(text: str) -> Iterator[Place]:
    """Stretches around triggers, merged where they touch, cut at blanks."""
    begin = end = None
    for m in _TRIGGER.finditer(text):
        if begin is None:
            begin = m.start()
        elif m.start() - end > 2 * _REACH:
            yield _place(text, begin, end)
            begin = m.start()
        end = m.end()
    if begin is not None:
        yield _place(text, begin, end)


def _place(text: str, begin: int, end: int) -> Place:
    left = max(0, begin - _REACH)
    right = min(len(text), end + _REACH)
    # Not inside a word: move to the next blank if there is one on the way.
    while 0 < left < begin and not text[left - 1].isspace():
        left += 1
    while end < right < len(text) and not text[right].isspace():
        right -= 1
    return Place(left, text[left:right])


def _is_at(text: str, tokens: list, k: int) -> bool:
    """Token ``k`` is an at sign or the middle of a bracketed one."""
    a, b, kind = tokens[k]
    if kind == "@":
        return True
    return kind == "a" and text[a:b].lower() == "at" and 0 < k < len(tokens) - 1 and tokens[k - 1][2] in "[({<" and tokens[k + 1][2] in "])}>"


def candidates(place: Place) -> list[tuple[int, int]]:
    """Token ranges that could be an entity: with an at sign, seven to nineteen digits, or four numbers."""
    text, tokens = place.text, place.tokens
    at_signs = [_is_at(text, tokens, k) for k in range(len(tokens))]
    out = []
    for i, (_, _, kind) in enumerate(tokens):
        if kind not in ("d", "a") and kind not in _ENTITY_EDGE:
            continue
        digits = groups = signs = 0
        for j in range(i, min(len(tokens), i + MOST_TOKENS)):
            a, b, k = tokens[j]
            if j > i:
                gap = text[tokens[j - 1][1] : a]
                if len(gap) > 2 or "\n" in gap:
                    break
            if k == "d":
                digits += b - a
                groups += 1
            signs += at_signs[j]
            if signs > 1 or digits > 30:
                break
            if k not in ("d", "a"):
                continue
            letters_inside = kind == "a" or k == "a"
            if signs and not at_signs[j] and not at_signs[i]:
                out.append((i, j + 1))
            elif not letters_inside and not signs and (7 <= digits <= 19 or groups == 4):
                out.append((i, j + 1))
    return out


def _bucket(n: int, cuts: tuple[int, ...]) -> int:
    return sum(n >= c for c in cuts)


def features(place: Place, i: int, j: int) -> list[int]:
    """Hashed features of the whole segment of tokens ``i`` to ``j``."""
    text, tokens = place.text, place.tokens
    a, b = tokens[i][0], tokens[j - 1][1]
    segment = text[a:b]
    digits = _digits(segment)
    groups = re.findall(r"[0-9]+", segment)
    letters = [text[x:y].lower() for x, y, k in tokens[i:j] if k == "a"]
    marks = "".join(sorted({k for _, _, k in tokens[i:j] if k not in ("d", "a")}))
    names = [
        "bias",
        f"digits{_bucket(len(digits), (1, 7, 8, 10, 11, 12, 14, 16, 17, 20))}",
        f"groups{min(len(groups), 6)}",
        f"marks{marks}",
        f"blanks{_bucket(sum(c.isspace() for c in segment), (1, 2, 4, 7))}",
        f"letters{_bucket(len(letters), (1, 2, 3, 5, 8))}",
        f"starts{tokens[i][2]}",
        f"shape{'.'.join(str(min(len(g), 6)) for g in groups[:6])}",
    ]
    if len(digits) >= 13:
        names.append(f"luhn{luhn(digits)}{_bucket(len(digits), (16, 20))}")
        names.append(f"even{len({len(g) for g in groups[:-1]}) <= 1}{max(map(len, groups)) <= 4}")
    if len(groups) == 4:
        names.append(f"parts{all(map(_small_part, groups))}{bool(letters)}{max(map(len, groups)) <= 3}")
    if segment.startswith("00"):
        names.append("zeros")
    if any(_is_at(text, tokens, k) for k in range(i, j)):
        sign = next(k for k in range(i, j) if _is_at(text, tokens, k))
        dots = sum(k == "." or (k == "a" and text[x:y].lower() == "dot") for x, y, k in tokens[sign:j])
        names += [f"sign{tokens[sign][2]}", f"dots{min(dots, 3)}", f"before{min(sign - i, 8)}"]
        names.append(f"tail{tokens[j - 1][2]}{_bucket(tokens[j - 1][1] - tokens[j - 1][0], (2, 3, 4, 7))}")
    # The tokens outside, and whether they touch.
    for side, k, gap in (("left", i - 1, text[tokens[i - 1][1] : a] if i else None), ("right", j, text[b : tokens[j][0]] if j < len(tokens) else None)):
        if gap is None:
            names.append(f"{side}none")
        else:
            kind = tokens[k][2]
            names.append(f"{side}{kind}{bool(gap)}")
            if kind == "a" and gap:
                names.append(f"{side}word{min(len(text[tokens[k][0] : tokens[k][1]]), 5)}")
    return [zlib.crc32(n.encode()) % WEIGHTS for n in names]


@dataclass
class Model:
    """Weights of features by kind, and of kind after kind (0: no entity)."""

    weights: np.ndarray  # (WEIGHTS, kinds)
    follows: np.ndarray  # (kinds + 1, kinds + 1)


def _lattice(place: Place, blocked: list[tuple[int, int]], free_of_base: bool):
    """Candidate segments that touch no blocked range, with their features, padded."""
    found = candidates(place)
    if free_of_base and blocked:
        found = [
            (i, j) for i, j in found
            if not any(place.tokens[i][0] < e and s < place.tokens[j - 1][1] for s, e in blocked)
        ]
    rows = [features(place, i, j) for i, j in found]
    width = max(map(len, rows), default=0)
    index = np.full((len(rows), width), -1)
    for r, row in enumerate(rows):
        index[r, : len(row)] = row
    return found, index


def _scores(model: Model, index: np.ndarray) -> np.ndarray:
    if not len(index):
        return np.zeros((0, len(KINDS)))
    return (model.weights[index] * (index >= 0)[:, :, None]).sum(axis=1)


def decode(model: Model, place: Place, blocked: list[tuple[int, int]]) -> list[Span]:
    """The best segmentation's entities; positions count from the whole text."""
    found, index = _lattice(place, blocked, True)
    if not found:
        return []
    score, follows, states = _scores(model, index), model.follows, range(len(KINDS) + 1)
    by_end: dict[int, list[int]] = {}
    for c, (_, j) in enumerate(found):
        by_end.setdefault(j, []).append(c)
    n = len(place.tokens)
    best = [[-np.inf] * len(states) for _ in range(n + 1)]
    back: list[list] = [[None] * len(states) for _ in range(n + 1)]
    best[0][0] = 0.0
    for t in range(1, n + 1):
        for y in states:
            value = best[t - 1][y] + follows[y, 0]
            if value > best[t][0]:
                best[t][0], back[t][0] = value, (t - 1, y)
        for c in by_end.get(t, ()):
            i = found[c][0]
            for y in states:
                if best[i][y] == -np.inf:
                    continue
                for k in range(len(KINDS)):
                    value = best[i][y] + follows[y, k + 1] + score[c, k]
                    if value > best[t][k + 1]:
                        best[t][k + 1], back[t][k + 1] = value, (i, y)
    y = max(states, key=lambda s: best[n][s])
    t, spans = n, []
    while t:
        i, before = back[t][y]
        if y:
            spans.append((KINDS[y - 1], place.start + place.tokens[i][0], place.start + place.tokens[t - 1][1]))
        t, y = i, before
    return spans[::-1]


def _gradient(model: Model, n: int, found: list[tuple[int, int]], index: np.ndarray, gold: dict[int, int]):
    """Gradient of the log likelihood: true counts less expected ones, by forward and backward sums."""
    score, follows, size = _scores(model, index), model.follows, len(KINDS) + 1
    by_end: dict[int, list[int]] = {}
    for c, (_, j) in enumerate(found):
        by_end.setdefault(j, []).append(c)
    forward = np.full((n + 1, size), -np.inf)
    forward[0, 0] = 0.0
    for t in range(1, n + 1):
        forward[t, 0] = np.logaddexp.reduce(forward[t - 1] + follows[:, 0])
        for c in by_end.get(t, ()):
            into = np.logaddexp.reduce(forward[found[c][0]][:, None] + follows[:, 1:], axis=0) + score[c]
            forward[t, 1:] = np.logaddexp(forward[t, 1:], into)
    backward = np.full((n + 1, size), -np.inf)
    backward[n] = 0.0
    by_start: dict[int, list[int]] = {}
    for c, (i, _) in enumerate(found):
        by_start.setdefault(i, []).append(c)
    for t in range(n - 1, -1, -1):
        backward[t] = follows[:, 0] + backward[t + 1, 0]
        for c in by_start.get(t, ()):
            out = follows[:, 1:] + (score[c] + backward[found[c][1], 1:])[None, :]
            backward[t] = np.logaddexp(backward[t], np.logaddexp.reduce(out, axis=1))
    total = np.logaddexp.reduce(forward[n])
    expected_follows = np.zeros_like(follows)
    for t in range(n):
        expected_follows[:, 0] += np.exp(forward[t] + follows[:, 0] + backward[t + 1, 0] - total)
    delta = np.zeros((len(found), len(KINDS)))
    for c, (i, j) in enumerate(found):
        p = np.exp(forward[i][:, None] + follows[:, 1:] + (score[c] + backward[j, 1:])[None, :] - total)
        expected_follows[:, 1:] += p
        delta[c] = -p.sum(axis=0)
    true_follows = np.zeros_like(follows)
    t = y = 0
    starts = {found[c][0]: c for c in gold}
    while t < n:
        c = starts.get(t)
        now = 0 if c is None else gold[c] + 1
        true_follows[y, now] += 1
        if c is not None:
            delta[c, gold[c]] += 1
        t, y = (t + 1, 0) if c is None else (found[c][1], now)
    return delta, true_follows - expected_follows


def _respell(rng: random.Random, kind: str, text: str) -> tuple[str, bool]:
    """Another spelling of an entity, or a look-alike that is none (False)."""
    digits = _digits(text)
    if rng.random() < 0.4:
        if kind == "card":
            wrong = digits[:-1] + str((int(digits[-1]) + rng.randint(1, 9)) % 10)
            return "".join(f"{d}{rng.choice(['', '', ' ']) if k % 4 == 3 else ''}" for k, d in enumerate(wrong)).strip(), False
        if kind == "ip":
            parts = text.split(".")
            parts[rng.randrange(4)] = str(rng.randint(256, 999))
            return rng.choice([".".join(parts), f"{parts[0]}.{parts[1]}", ".".join(parts[:3])]), False
        if kind == "phone":
            year, month, day = rng.randint(1990, 2030), rng.randint(1, 12), rng.randint(1, 28)
            clock = f"{rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}:{rng.randint(0, 59):02d}"
            return rng.choice([f"{year}-{month:02d}-{day:02d}", f"{day:02d}.{month:02d}.{year}", clock, f"{year}-{month:02d}-{day:02d} {clock}", f"{rng.randint(1, 999)},{rng.randint(100, 999)},{rng.randint(100, 999)}.{rng.randint(10, 99)}", digits[:7], f"v{digits[0]}.{digits[1]}.{digits[2]}"]), False
        return text.replace("@", rng.choice([" at ", ".", "/"])), False
    if kind == "email":
        sign = rng.choice([" (at) ", "(at)", " [at] ", "[at]", " @ ", " (AT) ", "{at}"])
        dot = rng.choice([".", ".", " (dot) ", "[dot]", " [dot] "])
        local, _, domain = text.partition("@")
        return local + sign + domain.replace(".", dot), True
    if kind == "ip":
        return text.replace(".", rng.choice(["[.]", "(.)", " . "])), True
    if kind == "card":
        return rng.choice([".", "/", "  "]).join(digits[k : k + 4] for k in range(0, len(digits), 4)), True
    short = digits[-10:] if len(digits) > 10 else digits
    return rng.choice([f"({short[:3]}) {short[3:6]}-{short[6:]}", f"{short[:3]}-{short[3:6]}-{short[6:]}", f"00{digits[:-10] or '1'} {short[:3]} {short[3:6]} {short[6:]}", f"{short[:3]}/{short[3:6]}-{short[6:]}", f"{short[:3]}.{short[3:6]}.{short[6:]}"]), True


def _examples(texts: list[str], seed: int = 1) -> Iterator[tuple[Place, list[Span]]]:
    """Each sampled place as it stands, and with its entities respelled."""
    rng = random.Random(seed)
    for text in texts:
        base = sorted(base_spans(text), key=lambda s: s[1])
        yield Place(0, text), base
        for _ in range(2 if base else 0):
            out, at, spans = "", 0, []
            for kind, a, b in base:
                if a < at:
                    continue
                out += text[at:a]
                spelled, is_one = _respell(rng, kind, text[a:b])
                if is_one:
                    spans.append((kind, len(out), len(out) + len(spelled)))
                out += spelled
                at = b
            yield Place(0, out + text[at:]), spans


def fit_model(texts: list[str], rounds: int = 8, rate: float = 0.3, decay: float = 1e-4) -> Model:
    """Maximise the conditional likelihood by adaptive gradient steps, one place at a time."""
    model = Model(np.zeros((WEIGHTS, len(KINDS))), np.zeros((len(KINDS) + 1, len(KINDS) + 1)))
    lattices = []
    for place, spans in _examples(texts):
        found, index = _lattice(place, [], False)
        at = {(place.tokens[i][0], place.tokens[j - 1][1]): c for c, (i, j) in enumerate(found)}
        gold, end = {}, 0
        for kind, a, b in sorted(spans, key=lambda s: s[1]):
            if (a, b) in at and a >= end:
                gold[at[a, b]] = KINDS.index(kind)
                end = b
        if found:
            lattices.append((len(place.tokens), found, index, gold))
    seen_w, seen_f = np.full_like(model.weights, 1e-6), np.full_like(model.follows, 1e-6)
    order = random.Random(2)
    for _ in range(rounds):
        order.shuffle(lattices)
        for n, found, index, gold in lattices:
            delta, follows = _gradient(model, n, found, index, gold)
            rows, columns = np.nonzero(index >= 0)
            g = np.zeros_like(model.weights[:0])
            used, inverse = np.unique(index[rows, columns], return_inverse=True)
            g = np.zeros((len(used), len(KINDS)))
            np.add.at(g, inverse, delta[rows])
            g -= decay * model.weights[used]
            seen_w[used] += g**2
            model.weights[used] += rate * g / np.sqrt(seen_w[used])
            seen_f += follows**2
            model.follows += rate * follows / np.sqrt(seen_f)
    return model


def _pieces(text: str) -> Iterator[str]:
    """All places of a text; a long one in pieces that end between its entities and triggers."""
    for place in places(text):
        own = place.text
        if len(own) <= MOST_PIECE:
            yield own
            continue
        marks: list[list[int]] = []
        for a, b in sorted([m.span() for m in _TRIGGER.finditer(own)] + [(a, b) for _, a, b in base_spans(own)]):
            if marks and a < marks[-1][1]:
                marks[-1][1] = max(marks[-1][1], b)
            else:
                marks.append([a, b])
        first = 0
        for k, (_, end) in enumerate(marks):
            if k + 1 < len(marks) and marks[k + 1][1] - marks[first][0] <= MOST_PIECE - 2 * _REACH:
                continue
            left = max(marks[first - 1][1] if first else 0, marks[first][0] - _REACH)
            yield own[left : min(marks[k + 1][0] if k + 1 < len(marks) else len(own), end + _REACH)]
            first = k + 1


def sample_places(docs: DataFrame, max_places: int = MAX_PLACES) -> list[str]:
    """At most ``max_places`` places out of all places of all documents, by a hash of their text.

    Seven fortieths at most for each of the four kinds, by its base spans, and three tenths for places
    with none; a place with several kinds counts for each.  Long places take part in pieces.
    """
    each = max(1, max_places * 7 // 10 // len(KINDS))
    bounds = {**dict.fromkeys(KINDS, each), "": max(1, max_places - each * len(KINDS))}

    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[str, dict[str, str]] = {kind: {} for kind in bounds}
        most = dict.fromkeys(bounds, "g")  # above any digest, while a kind has room
        for batch in batches:
            for text in batch["text"]:
                for own in _pieces(text or ""):
                    digest = hashlib.blake2b(own.encode("utf-8", "replace"), digest_size=8).hexdigest()
                    if digest >= max(most.values()):
                        continue
                    for kind in {k for k, _, _ in base_spans(own)} or {""}:
                        lowest = kept[kind]
                        if digest < most[kind]:
                            lowest[digest] = own
                            if len(lowest) > bounds[kind]:
                                del lowest[most[kind] if most[kind] != "g" else max(lowest)]
                            if len(lowest) == bounds[kind]:
                                most[kind] = max(lowest)
        yield pd.DataFrame([(k, d, t) for k, own in kept.items() for d, t in own.items()], columns=["kind", "place", "text"])

    found = docs.select("text").filter(F.col("text").rlike(r"[0-9@]|[\[({<]\s?(at|AT|At)\s?[\])}>]")).mapInPandas(sample, "kind STRING, place STRING, text STRING")
    found = written(found.dropDuplicates(["kind", "place"]), "places")
    lowest = [found.filter(F.col("kind") == kind).orderBy("place").limit(n) for kind, n in bounds.items()]
    return sorted({r["text"] for r in reduce(DataFrame.unionByName, lowest).select("text").collect()})


def fit(docs: DataFrame, max_places: int = MAX_PLACES) -> Model:
    """Fit on a bounded sample of places, see ``sample_places``."""
    return fit_model(sample_places(docs, max_places))


def all_spans(model: Model, text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and model spans together; both by kind as listed, then start."""
    if not _TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    by_start = sorted((a, b) for _, a, b in base)
    added: list[Span] = []
    at = 0
    for place in places(text):
        end = place.start + len(place.text)
        while at < len(by_start) and by_start[at][1] <= place.start:
            at += 1
        near = []
        for a, b in by_start[at:]:
            if a >= end:
                break
            near.append((a - place.start, b - place.start))
        added += decode(model, place, near)
    order = {k: n for n, k in enumerate(KINDS)}
    return base, sorted(base + added, key=lambda s: (order[s[0]], s[1]))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``doc_id``, ``base`` and ``spans``, each ``kind:start:end`` comma-joined.

    Positions count code points, the end is exclusive.  Null and empty texts have no spans.  Repeated rows
    and null ids are kept.  Model spans overlap no base span and no other model span.  No shuffle.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [all_spans(model, text or "") for text in batch["text"]]
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "base": [_joined(b) for b, _ in found], "spans": [_joined(s) for _, s in found]}
            )

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {id_type}, base STRING, spans STRING")
