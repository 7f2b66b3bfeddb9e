"""Hashes of all windows of n characters, in numpy, and the first window that two texts share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

#: Characters that are hashed at once.
STEP = 1 << 18
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def folded(x: np.ndarray, n: int, join: Callable) -> np.ndarray:
    """Each n neighbours of x joined, in steps that double."""
    p = 1
    while p * 2 <= n:
        x, p = join(x[:-p], x[p:]), p * 2
    return join(x[: p - n], x[n - p :]) if p < n else x


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + b + np.uint64(1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(text: str, n: int, step: int = 1) -> Iterator[np.ndarray]:
    """The polynomial hashes of the windows of n characters, `step` apart, in pieces of bounded size; they tell most windows apart, not all."""
    size = max(1, STEP // step) * step
    for at in range(0, len(text) - n + 1, size):
        codes = np.frombuffer(text[at : at + size + n - 1].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        levels = iter(FACTORS)  # another factor at each level, or windows whose halves are swapped would be equal
        yield folded(codes, n, lambda x, y: x * next(levels) + y)[::step]  # noqa: B023


def first_shared(short: str, long: str, n: int, step: int) -> str | None:
    """The first of the windows of short, `step` apart, that lies in long and has no line feed; time grows with the texts' lengths, not their product."""
    if min(len(short), len(long)) < n or len(short) < step:
        return None
    own = np.concatenate(list(hashes(short, n, step)))
    shift = np.uint64(64 - min(30, 4 + len(own).bit_length()))
    seen = np.zeros(1 << (64 - int(shift)), bool)
    seen[own >> shift] = True
    hit = np.zeros(len(own), bool)
    for there in hashes(long, n):
        there = there[seen[there >> shift]]  # few others are sorted
        if len(there):
            hit |= np.isin(own, there)
    for at in (hit.nonzero()[0] * step).tolist():
        g = short[at : at + n]
        if "\n" not in g and g in long:
            return g
    return None
