"""Fill-in-the-middle: a text is cut at two units and its middle is moved to the end.

A text is UTF-8 bytes in fixed blocks.  Two Fenwick trees over the blocks hold how many units and how
many code points begin in each.  A cut after ``c`` units is found by a binary-lifting descent to the
block in which unit ``c + 1`` begins, and then within that block alone; the same trees tell how many
code points lie before the cut.  Building is linear in the text, a cut costs the logarithm of the
number of blocks plus one block.

Forms: ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` is ``<S>`` suffix ``<P>`` prefix
``<M>`` middle, ``plain`` is the text as it is.  A text that is empty or holds a marker stays plain, so
the markers of an output are always those that were put there and ``restore`` is exact: a marker begins
with ``<`` and has no second one, so no text around a marker can form another with it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

BLOCK_BYTES = 1024
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
CODE_POINT, WORD = "code_point", "word"
_PARTS = "output STRING, form STRING, n LONG, prefix_chars LONG, middle_chars LONG"


class BlockCounts:
    """A Fenwick tree over the sums of fixed blocks of a boolean array."""

    def __init__(self, begins: np.ndarray, block: int = BLOCK_BYTES) -> None:
        self.begins, self.block = begins, block
        starts = np.arange(0, len(begins), block)
        sums = np.add.reduceat(begins, starts, dtype=np.int64) if len(begins) else np.zeros(0, np.int64)
        before = np.concatenate([[0], np.cumsum(sums)])
        at = np.arange(1, len(sums) + 1)
        self.tree = [0, *(before[at] - before[at - (at & -at)]).tolist()]
        self.total = int(before[-1])

    def position_of(self, count: int) -> int:
        """Where element ``count`` (from 0) begins; the end if there are not so many."""
        if count >= self.total:
            return len(self.begins)
        at, left = 0, count
        step = 1 << (len(self.tree) - 1).bit_length()
        while step:
            following = at + step
            if following < len(self.tree) and self.tree[following] <= left:
                at = following
                left -= self.tree[following]
            step >>= 1
        low = at * self.block
        return low + int(np.flatnonzero(self.begins[low : low + self.block])[left])

    def count_before(self, position: int) -> int:
        """How many elements begin before ``position``."""
        at = position // self.block
        count = int(np.count_nonzero(self.begins[at * self.block : position]))
        while at:
            count += self.tree[at]
            at -= at & -at
        return count


def _begins(data: bytes, unit: str) -> tuple[np.ndarray, np.ndarray]:
    """For each byte, whether a unit and whether a code point begins there."""
    raw = np.frombuffer(data, np.uint8)
    points = (raw & 0xC0) != 0x80
    if unit == CODE_POINT:
        return points, points
    blank = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
    after_blank = np.concatenate([[True], blank[:-1]]) if len(raw) else blank
    return ~blank & after_blank, points


def cut(text: str, first: int, second: int, unit: str = CODE_POINT, block: int = BLOCK_BYTES):
    """(prefix, middle, suffix), number of units, code points of prefix and of middle.

    The cuts lie after ``first % (n + 1)`` and ``second % (n + 1)`` units, the smaller one first.
    """
    data = text.encode("utf-8", "surrogatepass")
    unit_begins, point_begins = _begins(data, unit)
    units = BlockCounts(unit_begins, block)
    points = units if point_begins is unit_begins else BlockCounts(point_begins, block)
    n = units.total
    low, high = sorted((first % (n + 1), second % (n + 1)))
    one = units.position_of(low) if low else 0
    two = units.position_of(high) if high else 0
    head = points.count_before(one)
    pieces = tuple(p.decode("utf-8", "surrogatepass") for p in (data[:one], data[one:two], data[two:]))
    return pieces, n, head, points.count_before(two) - head


def _transform(unit: str, fim_percent: int, spm_percent: int, block: int):
    def run(text: pd.Series, h1: pd.Series, h2: pd.Series, h3: pd.Series, h4: pd.Series) -> pd.DataFrame:
        rows = []
        for whole, first, second, third, fourth in zip(text, h1, h2, h3, h4):
            (prefix, middle, suffix), n, head, inner = cut(whole, int(first), int(second), unit, block)
            if not whole or int(third) % 100 >= fim_percent or any(m in whole for m in (PREFIX, SUFFIX, MIDDLE)):
                rows.append((whole, PLAIN, n, None, None))
            elif int(fourth) % 100 < spm_percent:
                rows.append((f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}", SPM, n, head, inner))
            else:
                rows.append((f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}", PSM, n, head, inner))
        out = pd.DataFrame(rows, columns=["output", "form", "n", "prefix_chars", "middle_chars"])
        return out.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    return run


def _digest_number(which: int, seed: str, id_column: str) -> Column:
    """The given group (from 0) of eight hexadecimal digits of a row's digest, as an unsigned integer."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(name, 256), 8 * which + 1, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame,
    unit: str = CODE_POINT,
    fim_percent: int = 90,
    spm_percent: int = 20,
    seed: str = "1",
    id_column: str = "doc_id",
    text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Each row's id, ``output``, ``form``, ``n`` (units), ``prefix_chars`` and ``middle_chars``.

    Units are code points or words (a word reaches to where the next begins; blanks before the first
    belong to it).  All choices follow from the id and the seed, so reruns agree.  A null text is an
    empty one, and a null id counts as no digits; rows that repeat an id get equal cuts for equal texts.
    ``prefix_chars`` and ``middle_chars`` are null in a plain row.  Other columns are not read, so their
    names do not matter.  No rows give no rows.  Nothing is shuffled.
    """
    if unit not in (CODE_POINT, WORD):
        raise ValueError(f"unknown unit {unit!r}")
    parts = F.pandas_udf(_transform(unit, fim_percent, spm_percent, block_bytes), _PARTS)
    made = parts(
        F.coalesce(F.col(text_column), F.lit("")), *[_digest_number(k, seed, id_column) for k in range(4)]
    )
    return docs.select(F.col(id_column), made.alias("__parts")).select(id_column, "__parts.*")


def restore(output: Column, form: Column) -> Column:
    """The exact text from an output and its form."""
    s, p, m = (F.instr(output, marker) for marker in (SUFFIX, PREFIX, MIDDLE))

    def between(start: Column, stop: Column) -> Column:
        return F.substring(output, start + 3, stop - start - 3)

    middle = F.substring(output, m + 3, F.length(output))
    return (
        F.when(form == PSM, F.concat(between(p, s), middle, between(s, m)))
        .when(form == SPM, F.concat(between(p, m), middle, between(s, p)))
        .otherwise(output)
    )
