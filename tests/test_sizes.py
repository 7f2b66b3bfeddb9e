"""Steps whose time or memory must not grow faster than their input."""

import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from winnowry.functions import lexicon, pieces
from winnowry.functions import text as T
from winnowry.functions import windows
from winnowry.operators import refine
from winnowry.sources import wet
from winnowry.streaming import neardup as streamed


def lines(n, seed=7):
    """n characters of changing text."""
    out, x = [], seed
    while len(out) * 8 < n:
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(f"{x >> 36:07x} ")
    return "".join(out)[:n]


def test_ngrams_of_a_long_text(spark):
    text = lines(1_500_000) + "🐎é\n" * 5
    begun = time.time()
    for n, step in ((5, 3), (3, 7)):
        found = spark.createDataFrame([(text,), ("abcde",), ("abcd",), ("",), (None,)], "text string").select(T.ngrams(F.col("text"), n, step).alias("g"))
        sized = spark.createDataFrame([(text,)], "text string").select(F.size(T.ngrams(F.col("text"), n, step)).alias("k")).first()["k"]
        want = [text[i : i + n] for i in range(0, len(text) - n + 1, step)]
        got = [r["g"] for r in found.collect()]
        assert got[0] == want and sized == len(want)
        assert got[1:] == ([["abcde"], [], [], []] if n == 5 else [[], [], [], []])
    assert time.time() - begun < 120  # minutes and more when each gram was looked up from the text's beginning


def test_first_block_of_long_texts(spark):
    a, b = lines(2_000_000, 1), lines(2_100_000, 2)
    for short, long, want in ((a, b, None), (a + "#" * 300, b + "#" * 200, "#" * 100), ("é" * 9, "é" * 20, None), ("ab\n" * 60, "ab\n" * 90, None), ("x" * 10, "y" + "x" * 10, "x" * 10), (None, b, None)):
        begun = time.time()
        got = spark.createDataFrame([(short, long)], "a string, b string").select(T.ngram_lcs(F.col("a"), F.col("b"), 10).alias("x")).first()["x"]
        if want is not None or short is None or len(short) < 1000:
            assert got == want
        else:
            grams = (short[i : i + n] for n, step in ((100, 30), (10, 10)) for i in range(0, len(short) - n + 1, step))
            there = {long[i : i + 10] for i in range(len(long) - 9)}
            assert got == next((g for g in grams if len(g) == 10 and g in there), None)
        assert time.time() - begun < 60


def test_first_shared_equals_a_loop(monkeypatch):
    monkeypatch.setattr(windows, "STEP", 40)
    for seed in range(30):
        short, long = ("".join("ab\n"[int(c, 16) % 3] for c in lines(200 + seed, seed + k) if c != " ") for k in (0, 99))
        for n, step in ((5, 3), (9, 10), (12, 1)):
            want = next((short[i : i + n] for i in range(0, len(short) - n + 1, step) if short[i : i + n] in long and "\n" not in short[i : i + n]), None)
            assert windows.first_shared(short, long, n, step) == want


def test_stream_state_has_few_keys(spark, tmp_path):
    """Keys of the state are parts of a band pair's values, however many hashes come; pairs are those of a loop."""
    R = np.random.default_rng(5)
    base = R.integers(0, 1 << 63, 6000).astype(np.uint64)
    own = np.unique(np.concatenate([base, base[:90] ^ np.uint64(1 << 40), base[:60] ^ np.uint64(3 << 15), base[:30] ^ np.uint64(7)]))
    rows = [(i, int(x) >> 32, int(x) & 0xFFFFFFFF) for i, x in enumerate(own)]
    spark.createDataFrame(rows, "doc_id long, hi long, lo long").repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("doc_id long, hi long, lo long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = streamed.links(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert 0 < q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 6 * streamed.PARTS < len(own)
    found = [(r.hi << 32 | r.lo, r.other_hi << 32 | r.other_lo, r.distance) for r in spark.read.schema(streamed.LINK).parquet(str(tmp_path / "out")).collect()]
    want = {frozenset((int(x), int(y))) for x in own[: len(own)] for y in own[np.bitwise_count(own ^ x) <= 2] if x != y}
    assert len(found) == len(want) >= 150 and {frozenset(f[:2]) for f in found} == want
    assert all((x ^ y).bit_count() == d for x, y, d in found)


def test_near_in_pieces():
    R = np.random.default_rng(6)
    own = np.unique(np.uint64(5 << 40) ^ (np.uint64(1) << R.integers(0, 30, 400).astype(np.uint64)) ^ (np.uint64(1) << R.integers(0, 64, 400).astype(np.uint64)))
    want = {(int(x), int(y)) for i, x in enumerate(own) for y in own[:i] if int(x ^ y).bit_count() <= 2}
    for step in (1, 50, 1 << 18):
        got = [(int(x), int(y)) for pair in range(6) for a, b in streamed.near(own[:0], own, pair, 2, step) for x, y in zip(a, b, strict=True)]
        assert len(got) == len(want) and set(got) == want
        split = [frozenset((int(x), int(y))) for pair in range(6) for part in (own[::2], own[1::2]) for a, b in streamed.near(own[:0] if part is not own[1::2] and part[0] == own[0] else own[::2], part, pair, 2, step) for x, y in zip(a, b, strict=True)]
        assert len(split) == len(want) and set(split) == {frozenset(p) for p in want}


def test_gates_deal_no_rows_by_group(spark):
    """Rows meet the few groups by a broadcast: nothing with a text in it is shuffled by its language."""
    docs = spark.range(400).selectExpr("id AS doc_id", "concat(repeat(concat('w', id, ' and some longer text of its own '), 20), id) AS text", "'x' AS domain", "'en' AS language")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")  # the groups' files are below it, the texts' above
    try:
        steps = refine.rounds(docs, F.lit(0), refine.Config(keys=("language",)))
        for name in ("sens", "kept"):
            plan = steps[name]._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "hashpartitioning(language" not in plan
        assert steps["kept"].count() == 400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_places_of_words_equal_a_loop():
    words = ["ab", "abc", "b", "ca", "c]", "-a", "aab", "^^"]
    for trie, most in ((lexicon.build(words), 64), (lexicon.build(words), 2), (lexicon.build(["b"]), 64), ({}, 64)):
        for seed in range(20):
            text = "".join("abc]-^"[int(c, 16) % 6] for c in lines(300, seed) if c != " ")
            want = [w for i in range(len(text)) for w in sorted(words, key=len) if len(w) > 1 and text.startswith(w, i)] if len(trie) > 1 else []
            assert lexicon.matches(trie, text, places=lexicon.begins(trie, most)) == want


def test_short_ranges_share_tasks(spark, tmp_path):
    """Tasks grow with the archives' bytes, not with the number of ranges."""
    rows = [(i, f"https://a.example/{i}", "2024-01-01T00:00:00Z", lines(3000, i).encode()) for i in range(300)]
    wet.write_records(spark.createDataFrame(rows, "doc_id long, uri string, date string, body binary").coalesce(2), str(tmp_path / "w"))
    found = wet.read_records(spark, str(tmp_path / "w"), "part-*", size=1000)
    assert wet.ranges(spark, str(tmp_path / "w"), "part-*", 1000).count() > 300
    assert found.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert sorted(bytes(r.body) for r in found.filter("error is null").collect()) == sorted(r[3] for r in rows)


def test_pieces_hold_few_values(monkeypatch):
    """Of a batch only a piece is held as Python objects."""
    held, most = [0], [0]

    class Counted(str):
        def __new__(cls, x):
            held[0] += 1
            most[0] = max(most[0], held[0])
            return super().__new__(cls, x)

        def __del__(self):
            held[0] -= 1

    column = pa.array([None, *(f"text {i}" for i in range(3000))])
    got = pieces._joined((None if x is None else Counted(x.upper()) for x in pieces.values(column)), pa.string())
    assert got.to_pylist() == [None, *(f"TEXT {i}" for i in range(3000))] and most[0] <= pieces.ROWS + 1
    assert pieces._joined(pieces.values(column.slice(0, 0)), pa.string()).to_pylist() == []


def test_blocks_are_hashed_once(spark):
    docs = spark.range(9).selectExpr("id AS doc_id", "repeat(concat('shared words ', id % 2, ' '), 9) AS text", "'x' AS domain", "'en' AS language")
    out = refine.dedup_blocks(docs, refine.Config(keys=("language",)))
    assert "MapInArrow" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.agg(F.sum("n_removed")).first()[0] == 9
