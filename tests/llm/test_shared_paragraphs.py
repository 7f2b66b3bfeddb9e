"""The Jaccard join on documents that are composed of shared paragraphs: many shared shingles, few links."""

import random

import numpy as np
import pytest

pytest.importorskip("winnowry.llm")

from winnowry.llm import jaccard  # noqa: E402


def composed(n, R, paragraphs):
    """n documents of 20 of the paragraphs; every tenth repeats the one before but for a paragraph."""
    out = []
    for i in range(n):
        own = R.sample(range(len(paragraphs)), 20) if i % 10 else [*out[-1][:-1], R.randrange(len(paragraphs))] if out else R.sample(range(len(paragraphs)), 20)
        out.append(own)
    return [(i, "\n".join(paragraphs[k] for k in own)) for i, own in enumerate(out)]


def expected(rows):
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t in rows for w in [t.split()]}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * (both := len(sets[a] & sets[b])) >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in sets}


def test_pairs_compared_grow_with_documents(spark, monkeypatch):
    R = random.Random(2)
    words = [f"w{i}" for i in range(4000)]
    paragraphs = [" ".join(R.choice(words) for _ in range(40)) for _ in range(60)]
    compared, write = [], jaccard.stored

    def counted(df, name):
        out = write(df, name)
        if name in ("pairs", "rest"):
            compared[-1] += out.count()
        return out

    monkeypatch.setattr(jaccard, "stored", counted)
    for n in (120, 240):
        rows = composed(n, R, paragraphs)
        compared.append(0)
        found = jaccard.join_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache())
        assert {r.doc_id: r.component_id for r in found.select("doc_id", "component_id").collect()} == expected(rows)
    assert compared[1] <= 2.5 * compared[0]


def test_bitmaps_bound_from_above():
    """No pair shares more keys than its bitmaps tell, whatever their sizes."""
    R = np.random.default_rng(1)
    sets = [np.unique(R.integers(0, 60_000, n)) for n in (1, 3, 40, 70, 700, 1000, 2500, 100_000)]
    differ = jaccard.differing([jaccard.bitmap(x) for x in sets], [jaccard.bitmap(x) for x in sets])
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            both = len(np.intersect1d(x, y))
            assert both <= (len(x) + len(y) - differ[i, j]) // 2
            assert i != j or differ[i, j] == 0
    assert (len(sets[4]) + len(sets[5]) - differ[4, 5]) // 2 < 500  # sets that share little are told apart


def test_substrings_keep_columns_of_any_name(spark):
    from winnowry.llm import substrings

    text = "".join(f"{k} unlike " for k in range(80))
    rows = [(1, text + " one", "a", 5, [1]), (2, "two " + text, "b", 6, None), (3, None, "c", 7, [])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _uid string, _Spans long, uid array<int>").cache()
    found = sorted(substrings.remove(docs).collect())
    assert [(r[0], r[2], r[3], r[4]) for r in found] == [(r[0], r[2], r[3], r[4]) for r in rows]
    assert [len(r.text or "") < 30 for r in found] == [True] * 3
