"""Suffix array by linear grouping.

Suffixes start in groups by their first symbol.  Groups are processed from the largest down; a
suffix's previous-smaller pointer leads to the nearest suffix before it whose group is smaller.  That
one's Lyndon prefix grows by the group's, so it moves into a new group just above those that it was with;
a suffix that gains the group's prefix several times moves above those that gain it fewer times.  When
all are processed, a group holds the suffixes of one Lyndon prefix.  One pass in ascending order then
emits each group's order through the same pointers; nothing is renamed and no shorter string is sorted.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Starts of the suffixes in ascending order.  The last symbol must be smaller than all others."""
    n = len(symbols)
    if n < 2:
        return list(range(n))
    if min(symbols[:-1]) <= symbols[-1]:
        raise ValueError("the last symbol must be the only smallest one")
    members: dict[int, list[int]] = {}
    for i, c in enumerate(symbols):
        members.setdefault(c, []).append(i)
    order: list[int] = []
    group, size, place, previous = [0] * n, [0] * n, [0] * n, [-1] * n
    for c in sorted(members):
        start = len(order)
        for i in members[c]:
            group[i] = start
        order.extend(members[c])
        size[start] = len(members[c])
    for at, i in enumerate(order):
        place[i] = at

    end = n - 1
    while end >= 0:
        start = group[order[end]]
        gains: dict[int, int] = {}
        if start == end:
            i = order[end]
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                # One suffix gains: it moves to the top of its group.
                old = group[p]
                left = size[old] - 1
                if left:
                    top = old + left
                    other, at = order[top], place[p]
                    order[at], place[other] = other, at
                    order[top], place[p] = p, top
                    size[old], size[top], group[p] = left, 1, top
            end -= 1
            continue
        for i in sorted(order[start : end + 1]):
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = previous[p]
            previous[i] = p
            if p >= 0:
                gains[p] = gains.get(p, 0) + 1
        end = start - 1
        by_gain: dict[int, list[int]] = {}
        for p, times in gains.items():
            by_gain.setdefault(times, []).append(p)
        for times in sorted(by_gain, reverse=True):
            moved: dict[int, int] = {}
            for p in by_gain[times]:
                old = group[p]
                left = size[old] - 1
                size[old] = left
                top = old + left
                other, at = order[top], place[p]
                order[at], place[other] = other, at
                order[top], place[p] = p, top
                moved[old] = moved.get(old, 0) + 1
            for p in by_gain[times]:
                group[p] += size[group[p]]
            for old, many in moved.items():
                size[old + size[old]] = many

    free = list(range(n))  # next free place of the group that starts there
    out = [-1] * n
    out[0] = n - 1
    done = bytearray(n)
    done[n - 1] = 1
    for at in range(n):
        j = out[at] - 1
        while j >= 0 and not done[j]:
            start = group[j]
            to = free[start]
            out[to] = j
            free[start] = to + 1
            done[j] = 1
            j = previous[j]
    return out
