"""Content-chosen anchors: which 400-byte strings may repeat, without shipping text.

Of the 369 grams of 32 bytes in a 400-byte window the one with the smallest hash (leftmost of ties) is
the window's anchor.  Equal windows have equal grams, so they choose the same anchor at the same place.
The windows of one anchor are a run of starts; the bytes that they cover are the anchor's context.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

LENGTH = 400
GRAM = 32  # a power of two
_POSITION_BITS = np.uint64(24)
_POSITION_MASK = np.uint64((1 << 24) - 1)
#: Bytes of text handled at once; positions must fit in the low bits.
BUFFER = 1 << 21

_VALUE = np.random.default_rng(400).integers(1, 2**63, 256, dtype=np.uint64)


def gram_hashes(buffer: np.ndarray) -> np.ndarray:
    """Hash of the gram that starts at each byte, built by doubling."""
    h, step, width = _VALUE[buffer], np.full(1, 0x9E3779B97F4A7C15, np.uint64), 1
    while width < GRAM:
        h = h[:-width] * step + h[width:]
        step *= step
        width *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def anchors_of(buffer: np.ndarray, bounds: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, int, int, bytes]]:
    """(text number, gram hash, first start, last start, gram start, digest of context) of each anchor.

    ``bounds`` are the texts' places in ``buffer``, each at least LENGTH long; starts count from the text.
    """
    h = gram_hashes(buffer)
    least = (h & ~_POSITION_MASK) | np.arange(len(h), dtype=np.uint64)
    windows, width = LENGTH - GRAM + 1, 1
    while 2 * width <= windows:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (windows - width)], least[windows - width :])
    anchor = (least & _POSITION_MASK).astype(np.int64)
    raw = buffer.tobytes()
    digest = hashlib.blake2b
    for number, (begin, end) in enumerate(bounds):
        own = anchor[begin : end - LENGTH + 1]
        firsts = np.concatenate(([0], np.flatnonzero(own[1:] != own[:-1]) + 1))
        lasts = np.append(firsts[1:], len(own)) - 1
        places = own[firsts]
        grams = h[places].view(np.int64).tolist()
        for gram, first, last, place in zip(grams, firsts.tolist(), lasts.tolist(), (places - begin).tolist()):
            context = raw[begin + first : begin + last + LENGTH]
            yield number, gram, first, last, place, digest(context, digest_size=16).digest()
