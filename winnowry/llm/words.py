"""Word boundaries and word hashes of many texts at once, on their bytes."""

from __future__ import annotations

import numpy as np

from .hashing import span_hashes

#: A-Z to a-z, all other bytes to themselves.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words of letters, digits and non-ASCII characters (after LOWER).
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

#: Bytes of words between white space.
VISIBLE = np.ones(256, bool)
VISIBLE[[32, *range(9, 14)]] = False

BLOCK = 1 << 21


def spans(text: np.ndarray, at: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end bytes of the words of the rows, whose bytes are text[at[0]:at[-1]]; no word crosses rows."""
    part = kinds[text[at[0] : at[-1]]]
    edge = np.zeros(len(part) + 1, bool)
    edge[at - at[0]] = True
    before = np.zeros(len(part), bool)
    before[1:] = part[:-1]
    begin = np.flatnonzero(part & (~before | edge[:-1]))
    after = np.zeros(len(part), bool)
    after[:-1] = part[1:]
    end = np.flatnonzero(part & (~after | edge[1:])) + 1
    return begin + at[0], end + at[0]


def hashes(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words, a bounded block of text at a time; text is lower-cased where it has A-Z."""
    out = np.empty(len(begin), np.uint64)
    lo = 0
    while lo < len(begin):
        hi = max(lo + 1, int(np.searchsorted(end, begin[lo] + BLOCK, side="right")))
        a = int(begin[lo])
        out[lo:hi] = span_hashes(LOWER[text[a : int(end[hi - 1])]], begin[lo:hi] - a, end[lo:hi] - a)
        lo = hi
    return out
