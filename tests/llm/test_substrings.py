"""Phrases and comparisons of op3: results against brute force, work in blocks of a processor's cache."""

import collections
import random
import tracemalloc

import numpy as np
import pytest

from winnowry.llm import substrings


@pytest.mark.parametrize("block", [300, 1000, 1 << 15])
def test_each_window_lies_in_one_phrase(block, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK", block)
    R = random.Random(block)
    for _ in range(40):
        texts = [bytes(R.choice(b"ab\0") if R.random() < 0.5 else R.randrange(256) for _ in range(R.choice((0, 5, 199, 200, 201, 700, 3000)))) for _ in range(6)] + [b"a" * R.randint(0, 900)]
        at = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
        trigger, _, row, first, n, place = substrings.phrases(np.frombuffer(b"".join(texts), np.uint8), at)
        assert sorted((k, f + i) for k, f, m in zip(row.tolist(), first.tolist(), n.tolist(), strict=True) for i in range(m)) == [(k, i) for k, x in enumerate(texts) for i in range(len(x) - 199)]
        assert ((place >= n - 1) & (place <= 200 - 64)).all()
        grams = collections.defaultdict(set)
        for t, k, f, p in zip(trigger.tolist(), row.tolist(), first.tolist(), place.tolist(), strict=True):
            grams[t].add(texts[k][f + p : f + p + 64])
        assert all(len(g) == 1 for g in grams.values())


def test_equal_windows_have_equal_triggers_at_equal_places(monkeypatch):
    R = random.Random(7)
    shared = bytes(R.randrange(256) for _ in range(5000))
    found = []
    for block, ahead in ((1 << 15, b""), (777, bytes(333)), (1000, b"xy" * 50)):
        monkeypatch.setattr(substrings, "BLOCK", block)
        text = np.frombuffer(ahead + shared, np.uint8)
        trigger, _, _, first, n, place = substrings.phrases(text, np.array([0, len(text)]))
        own = {f + i - len(ahead): (t, p - i) for t, f, m, p in zip(trigger.tolist(), first.tolist(), n.tolist(), place.tolist(), strict=True) for i in range(m)}
        found.append({k: v for k, v in own.items() if k >= 0})
    assert len(found[0]) == 4801 and found[0] == found[1] == found[2]


def test_repeated_windows_of_phrases():
    R = random.Random(3)
    for _ in range(150):
        base, own = bytes(R.choice(b"a\0bc") for _ in range(336)), {}
        for _ in range(R.randint(1, 12)):
            text, left = bytearray(base), R.randint(0, 136)
            for _ in range(R.randint(0, 3)):
                text[R.choice([*range(136), *range(200, 336)])] = R.randrange(3)
            own[bytes(text[136 - left : 136 + R.randint(200 - left, 200)])] = left
        n = collections.Counter(t[k : k + 200] for t in own for k in range(len(t) - 199))
        for t, marks in zip(own, substrings.repeated(list(own), list(own.values()), 200), strict=True):
            assert marks.tolist() == [n[t[k : k + 200]] > 1 for k in range(len(t) - 199)]


def test_phrases_work_in_small_blocks():
    rows = np.random.default_rng(1).integers(0, 256, 1 << 21).astype(np.uint8)
    for at in (np.array([0, len(rows)]), np.arange(0, len(rows) + 1, 1 << 11)):
        substrings.phrases(rows, at)  # tables are kept for the worker
        tracemalloc.start()
        try:
            substrings.phrases(rows, at)
            assert tracemalloc.get_traced_memory()[1] < 16 << 20
        finally:
            tracemalloc.stop()
