"""64-bit hashes of byte spans and of number sequences, and a hash table, in numpy.

The hash of a span is a polynomial over its bytes modulo 2**64 from one running sum, mixed with the span's length. The
chance that any two of n distinct spans agree is about n * n / 2**65.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
BASE2 = 0xC2B2AE3D27D4EB4F | 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**0 ... base**n and their inverses modulo 2**64, kept for the worker."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        size = 1 << max(12, int(n + 1).bit_length())
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.ones(size, np.uint64)
            x[1:] = np.uint64(b)
            out.append(np.cumprod(x))
        _powers[base] = have = tuple(out)
    return have


def running(text: np.ndarray, base: int = BASE) -> np.ndarray:
    """Sums of (value + 1) * base**i over the first 0, 1, ... values."""
    up, _ = powers(len(text), base)
    out = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[: len(text)], out=out[1:])
    return out


def spans_of(sums: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hashes of the spans begin .. end, from running()."""
    _, down = powers(len(sums), base)
    return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def span_hashes(text: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int = BASE) -> np.ndarray:
    return spans_of(running(text, base), begin, end, base)


class HashTable:
    """Numbers 0, 1, 2, ... for 64-bit keys in the order in which they are added; open addressing."""

    def __init__(self, most: int):
        self.bits = int(most * 2).bit_length()
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.keys = np.zeros(most, np.uint64)
        self.n = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers, -1 for those that are missing."""
        out = np.full(len(keys), -1, np.int32)
        todo, at = np.arange(len(keys)), (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(todo):
            got = self.slots[at]
            same = (got >= 0) & (self.keys[got] == keys[todo])
            out[todo[same]] = got[same]
            on = (got >= 0) & ~same
            todo, at = todo[on], (at[on] + 1) & (len(self.slots) - 1)
        return out

    def add(self, keys: np.ndarray) -> int:
        """Adds distinct keys that the table lacks; gives the number of the first."""
        first = self.n
        self.keys[first : first + len(keys)] = keys
        self.n += len(keys)
        todo = np.arange(first, self.n, dtype=np.int32)
        at = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]
            left = self.slots[at] != todo
            todo, at = todo[left], (at[left] + 1) & (len(self.slots) - 1)
        return first
