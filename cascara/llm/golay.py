"""The binary Golay code of length 23: 4096 codewords, distance 7, and every
word within three bits of exactly one of them."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

# Fixed value: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, a generator of the code.
GENERATOR = 0b101011100011
N, CHECK = 23, 11


def _remainder(v: int) -> int:
    for bit in range(N - 1, CHECK - 1, -1):
        if v >> bit & 1:
            v ^= GENERATOR << (bit - CHECK)
    return v


@lru_cache(1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """``high``: the remainder of each value of the upper 12 bits. ``error``:
    for each remainder the error patterns of up to four bits that explain it,
    fewest bits first, six to a row (-1: none).

    The first leads to the nearest codeword. A word three bits from it is four
    bits from five more, and no other word has a second codeword that near: so
    one or six codewords lie within four bits. Two words that differ in one bit
    or none share the nearest codeword of either: it is within 3 + 1 bits of
    the other."""
    high = np.array([_remainder(m << CHECK) for m in range(1 << (N - CHECK))], dtype=np.int32)
    rows: list[list[int]] = [[] for _ in range(1 << CHECK)]
    for bits in range(5):
        for where in combinations(range(N), bits):
            e = sum(1 << b for b in where)
            rows[_remainder(e)].append(e)
    return high, np.array([r + [-1] * (6 - len(r)) for r in rows], dtype=np.int32)


def near(v: np.ndarray) -> np.ndarray:
    """Indices (12 bits) of the codewords within four bits of each 23-bit word,
    six to a row, the nearest first; -1 where there are fewer."""
    high, error = tables()
    v = v.astype(np.int32)
    e = error[(v & ((1 << CHECK) - 1)) ^ high[v >> CHECK]]
    return np.where(e < 0, -1, (v[:, None] ^ e) >> CHECK)
