"""Variable-length grams of words and how many of them one edit can change.

A word is padded on both sides.  The gram at a position is the shortest prefix of what follows that is
not frequent among all words, between ``SHORTEST`` and ``LONGEST`` characters; a gram that lies within
an earlier one is left out.  So common parts of words give long grams and rare parts short ones.

One edit at a position can change the grams that contain it, those before it that might have grown over
it (what lies between could go on as a longer gram), and those after it that might come to lie within
a gram which reaches over it.  The largest such number over all positions is the word's bound of
affected grams: two words one edit apart share all grams of either but for that many.
"""

from __future__ import annotations

from dataclasses import dataclass, field

SHORTEST, LONGEST = 2, 5
PAD = LONGEST - 1
HEAD, FOOT = "\u0002", "\u0003"  # in no word


def padded(word: str) -> str:
    return HEAD * PAD + word + FOOT * PAD


@dataclass(frozen=True)
class GramIndex:
    """The frequent grams, and how often common grams that are not extended occur.

    Both are bounded by how often a gram must occur to be in them, whatever the number of words.
    """

    frequent: frozenset[str]
    counts: dict[str, int]
    suffixes: frozenset[str] = field(init=False)

    def __post_init__(self) -> None:
        ends = {gram[k:] for gram in self.frequent for k in range(1, len(gram))}
        object.__setattr__(self, "suffixes", frozenset(ends))

    def decompose(self, word: str) -> tuple[list[tuple[int, int]], str]:
        """(start, end) of each gram of the padded word, and that word."""
        s = padded(word)
        frequent, size = self.frequent, len(s)
        out, reached = [], 0
        for a in range(size - SHORTEST + 1):
            e = a + SHORTEST
            stop = min(a + LONGEST, size)
            while e < stop and s[a:e] in frequent:
                e += 1
            if e > reached:
                out.append((a, e))
                reached = e
        return out, s

    def affected(self, grams: list[tuple[int, int]], s: str) -> int:
        """How many of the grams one edit can change at most."""
        size = len(s)
        starts, ends = [0] * (size + 2), [0] * (size + 2)
        for a, e in grams:
            starts[a + 1] += 1
            ends[e] += 1
        for k in range(1, size + 2):
            starts[k] += starts[k - 1]  # grams that start before k
            ends[k] += ends[k - 1]  # grams that end at or before k
        frequent, suffixes, most = self.frequent, self.suffixes, 0
        for p in range(PAD, size - PAD):
            first = p - SHORTEST + 1
            for m in range(LONGEST - 1, SHORTEST - 1, -1):
                if s[p - m : p] in frequent:
                    first = p - m
                    break
            last = p + SHORTEST
            for m in range(LONGEST - 1, SHORTEST - 1, -1):
                if s[p + 1 : p + m] in suffixes:
                    last = p + 1 + m
                    break
            most = max(most, ends[min(last, size)] - starts[first])
        return most

    def tokens(self, word: str) -> tuple[list[str], int]:
        """The word's grams, rarest first, a repeated one numbered; and the bound of affected grams."""
        grams, s = self.decompose(word)
        seen: dict[str, int] = {}
        keyed = []
        for a, e in grams:
            gram = s[a:e]
            times = seen[gram] = seen.get(gram, 0) + 1
            keyed.append((self.counts.get(gram, 0), gram, times))
        keyed.sort()
        named = [gram if times == 1 else f"{gram}{HEAD}{FOOT}{times}" for _, gram, times in keyed]
        return named, self.affected(grams, s)


def substrings(word: str) -> list[str]:
    """All grams a word has of every length."""
    s = padded(word)
    return [s[a : a + q] for q in range(SHORTEST, LONGEST + 1) for a in range(len(s) - q + 1)]
