"""Clusters of near hashes against a walk over all rows, whatever the partitions."""

import random

import pytest

from winnowry.operators import clusters


def walked(rows, near=3):
    """doc_id: (cluster, member) by the walk: rows (doc_id, hi, lo)."""
    rows = sorted((hi, lo, i) for i, hi, lo in rows if hi is not None)
    distance = lambda a, b: (a[0] ^ b[0]).bit_count() + (a[1] ^ b[1]).bit_count()
    anchor, ptr, out = 0, 1, {}
    if rows:
        out[rows[0][2]] = (rows[0][2], False)
    while ptr < len(rows):
        if distance(rows[anchor], rows[ptr]) < near:
            out[rows[ptr][2]] = (rows[anchor][2], True)
            ptr += 1
        elif ptr - anchor > 1:
            anchor = ptr - 1
        else:
            anchor = ptr
            out[rows[ptr][2]] = (rows[ptr][2], False)
            ptr = anchor + 1
    return out


def made(n, spread, R):
    """Hashes in chains of small steps, with repeats."""
    out, x = [], R.getrandbits(64)
    for i in range(n):
        kind = R.random()
        if kind < 0.3:
            x ^= 1 << R.randrange(spread)
        elif kind < 0.4:
            x ^= 3 << R.randrange(spread)
        elif kind > 0.97:
            x = R.getrandbits(64)
        out.append((i, x >> 32, x & 0xFFFFFFFF))
    return out


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_clusters_equal_the_walk(spark, parts):
    R = random.Random(parts)
    rows = made(400, 12, R) + [(1000 + i, 5, 9) for i in range(150)] + [(2000, None, None), (2001, 0xFFFFFFFF, 0xFFFFFFFF), (2002, 0, 0)]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = clusters.clusters(spark.createDataFrame(rows, "doc_id long, hi long, lo long"))
        assert {r.doc_id: (r.cluster, r.member) for r in found.collect()} == walked(rows)
        assert clusters.clusters(spark.createDataFrame(rows[:0], "doc_id long, hi long, lo long")).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_summaries_join_to_the_walk():
    """Any cut of the sorted hashes: partitions' summaries give the anchors that a walk over all rows has at the cuts."""
    R = random.Random(3)
    for k in range(1500):
        rows = sorted(x[1] << 32 | x[2] for x in made(R.randint(1, 60), R.choice((3, 6, 40)), R))
        ends = sorted(R.sample(range(1, len(rows)), min(len(rows) - 1, R.randint(0, 12)))) + [len(rows)]
        parts, lo = [], 0
        for part, hi in enumerate(ends):
            own = rows[lo:hi]
            places, outs, _ = clusters.summary(own, 3)
            parts.append({"part": part, "hashes": [own[i] for i in places], "outs": [own[i] for i in outs], "out_keys": [lo + i for i in outs], "last": own[-1], "last_key": hi - 1})
            lo = hi
        whole = clusters.walk(rows, 3)
        found = list(clusters.came_in(parts, 3))
        for (_, value, key, *_), cut in zip(found[1:], ends, strict=False):
            assert (value, key) == (rows[whole[cut - 1]], whole[cut - 1])


def test_bad_row_files(spark, tmp_path):
    rows = [(f, i) for f in (3, 12) for i in (7, 100, 2)]
    clusters.write_bad_rows(spark.createDataFrame(rows, "file long, row_no long"), str(tmp_path / "bad"))
    assert sorted(tuple(r) for r in clusters.read_bad_rows(spark, str(tmp_path / "bad")).collect()) == sorted(rows)
    assert sorted(p.name for p in (tmp_path / "bad").iterdir() if p.is_dir()) == ["file=12", "file=3"]


def test_bad_row_lists_are_spread_over_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(clusters, "LISTS", 16, raising=False)
    rows = [(f, i) for f in range(160) for i in range(3)]
    clusters.write_bad_rows(spark.createDataFrame(rows, "file long, row_no long"), str(tmp_path / "bad"))
    lists = {}
    for p in (tmp_path / "bad").glob("file=*/part-*"):
        lists.setdefault(p.name[:10], set()).add(p.parent.name)
    assert len(lists) > 7 and max(map(len, lists.values())) <= 32
    assert sorted(tuple(r) for r in clusters.read_bad_rows(spark, str(tmp_path / "bad")).collect()) == rows
    clusters.write_bad_rows(spark.createDataFrame([], "file long, row_no long"), str(tmp_path / "none"))
    assert clusters.read_bad_rows(spark, str(tmp_path / "none")).count() == 0


def test_hashes_are_computed_once(spark):
    n = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            n.add(b.num_rows)
            yield b

    rows = made(300, 12, random.Random(5))
    own = spark.createDataFrame(rows, "doc_id long, hi long, lo long").mapInArrow(counted, "doc_id long, hi long, lo long")
    assert {r.doc_id: (r.cluster, r.member) for r in clusters.clusters(own).collect()} == walked(rows)
    assert n.value == 300
