"""Grouped files, places in files, streams of near duplicates, samples and pattern texts."""

import collections
import json
import random

import pytest
from pyspark.sql import functions as F

from winnowry.functions.simhash import simhash
from winnowry.operators import neardup, refine, sampling
from winnowry.sources import sinks
from winnowry.streaming import ingest
from winnowry.streaming import neardup as streamed


def test_grouped_files(spark, tmp_path):
    """Files hold whole groups in order, null ones too, and groups beyond a file's rows come in pieces."""
    R = random.Random(3)
    sizes = [1, 9, 3, 200, 4, 4, 30, 11, 2]
    rows = [(f"g{i}" if i else None, f"s{i % 2}", k) for i, n in enumerate(sizes) for k in range(n)]
    R.shuffle(rows)
    own = spark.createDataFrame(rows, "domain string, language string, k int").repartition(5)
    sinks.write_grouped(own, str(tmp_path / "out"), ["domain", "language"], most=20, salt=F.col("k"))
    found = spark.read.parquet(str(tmp_path / "out")).select("domain", "language", "k", "file").collect()
    assert collections.Counter((r.domain, r.language, r.k) for r in found) == collections.Counter(rows)
    files = collections.defaultdict(lambda: collections.defaultdict(int))
    for r in found:
        files[r.file][r.domain] += 1
    assert all(len({r.file for r in found if r.domain == g}) == 1 for g, n in ((f"g{i}" if i else None, n) for i, n in enumerate(sizes)) if n <= 20)
    assert len({r.file for r in found if r.domain == "g3"}) >= 8 and all(sum(g.values()) < 20 + 20 for g in files.values())
    for n in range(len(sizes)):
        assert all(len(list((tmp_path / "out").glob(f"file={f}/*.parquet"))) == 1 for f in files)
    sinks.write_grouped(own.limit(0), str(tmp_path / "none"), ["domain"])


@pytest.mark.parametrize("split", [40, 1 << 20])
def test_places_in_files(spark, tmp_path, split):
    """Places don't depend on how files are split and packed into tasks."""
    (tmp_path / "in").mkdir()
    for f, n in (("a", 50), ("b c", 7), ("d", 1), ("e", 0)):
        (tmp_path / "in" / f"{f}.jsonl").write_text("".join(json.dumps({"f": f, "k": k}) + "\n" for k in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = sinks.placed(sinks.read_jsonl(spark, str(tmp_path / "in"), "f string, k int"))
        assert sorted((r.f, r.k, r.place) for r in rows.collect()) == sorted((f, k, k) for f, n in (("a", 50), ("b c", 7), ("d", 1)) for k in range(n))
        wanted = rows.filter("k in (3, 49)").select("file_path", "place")
        assert sorted((r.f, r.k) for r in sinks.gather(sinks.read_jsonl(spark, str(tmp_path / "in"), "f string, k int"), wanted).collect()) == [("a", 3), ("a", 49), ("b c", 3)]
        drawn = sorted((r.f, r.k) for r in sampling.two_stage(rows, 2, 6, seed=1).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(drawn) == len(set(drawn)) == 6 and len({f for f, _ in drawn}) <= 2
    if split == 40:
        test_places_in_files.drawn = drawn
    else:
        assert drawn == test_places_in_files.drawn  # the same rows, whatever the partitions


def test_text_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("b", 1), ("a", None), ("b", 2), (None, 3)], "domain string, n int")
    sinks.write_lines(rows, str(tmp_path / "l"), "domain")
    assert [x for p in sorted((tmp_path / "l").glob("part-*")) for x in p.read_text().splitlines()] == ["a", "b"]
    sinks.write_pairs(rows.coalesce(1), str(tmp_path / "p"))
    assert "domain: b\nn: 1\n\ndomain: a\nn: \n\n" in "".join(p.read_text() for p in (tmp_path / "p").glob("part-*"))
    sinks.append_jsonl(rows, str(tmp_path / "j"), compress=True)
    sinks.append_jsonl(rows, str(tmp_path / "j"), compress=True)
    sinks.append_jsonl(rows.limit(0), str(tmp_path / "none"))
    assert sinks.read_jsonl(spark, str(tmp_path / "j")).count() == 8 and not (tmp_path / "none").exists()


def near_texts():
    R = random.Random(8)
    words = [f"word{i}" for i in range(400)]
    base = [[R.choice(words) for _ in range(120)] for _ in range(25)]
    texts = [" ".join(b) for b in base]
    texts += [" ".join([*b[:k], R.choice(words), *b[k + 1 :]]) for b in base for k in (3, 60, 119)] + texts[:9] + ["", None, " "]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("runs", [1, 3])
def test_streams_meet_what_came_before(spark, tmp_path, runs):
    """Any split into files and runs gives the batch result."""
    rows = near_texts()
    random.Random(runs).shuffle(rows)
    for k in range(runs):
        for j in range(2):
            spark.createDataFrame(rows[2 * k + j :: 2 * runs], "doc_id long, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        streamed.run(spark, str(tmp_path / "in"), "doc_id long, text string", str(tmp_path / "out"), files=1)
    hashes = spark.read.parquet(str(tmp_path / "out/hashes"))
    found = spark.read.schema(streamed.LINK).parquet(str(tmp_path / "out/links"))
    batch = simhash(spark.createDataFrame(rows, "doc_id long, text string"))
    want = sorted(tuple(r) for r in neardup.pairs(batch).collect())
    assert len(want) > 5 and sorted(tuple(r) for r in streamed.pairs(hashes, found).collect()) == want
    assert sorted(tuple(r) for r in streamed.keep(hashes, found).collect()) == sorted(tuple(r) for r in neardup.keep(batch).collect())


def test_first_seen(spark, tmp_path):
    for part in ([(1, "a"), (2, "b"), (1, "c")], [(2, "d"), (3, "e")]):
        spark.createDataFrame(part, "k long, v string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        ingest.ingest(spark, str(tmp_path / "in"), "k long, v string", lambda d: ingest.first_seen(d, ["k"]), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]


def test_balanced_and_score_samples(spark):
    rows = spark.createDataFrame([(i, i % 2, i / 100) for i in range(100)], "id long, pseudo_label int, score double")
    extra = spark.createDataFrame([(1000 + i,) for i in range(30)], "id long")
    found = sampling.balanced(rows.select("id"), rows.select("id", "pseudo_label"), extra, "id", 20, ratio=0.3).collect()
    assert collections.Counter((r.pseudo_label, r.id >= 1000) for r in found) == {(0, False): 10, (1, False): 7, (1, True): 3}
    drawn = sampling.by_score(rows, "score", "pseudo_label", "id", 10).collect()
    assert collections.Counter(r.pseudo_label for r in drawn) == {0: 10, 1: 10}
    assert sum(r.score for r in drawn if r.pseudo_label) > sum(r.score for r in drawn if not r.pseudo_label)


def test_pattern_texts(spark):
    """Paragraphs and blocks that were taken out are named once each, bad words too, by group."""
    R = random.Random(4)
    free = lambda n: " ".join("".join(R.choice("abcdefghij") for _ in range(7)) for _ in range(n))
    line, block = "a line that all of these pages show", "a passage that stands in the middle of other words and is long enough"
    rows = [(i, "\n".join([f"{free(40)}", line, free(40), f"{free(6)} {block} {free(6)}"]), "d", "en", 0.5) for i in range(9)] + [(20 + i, free(60), "e", "en", 1.0) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string, language string, lang_score double").cache()
    bad = F.when(F.col("doc_id") == 1, F.array(F.lit("moron"), F.lit("idiot"))).otherwise(F.array().cast("array<string>"))
    steps = refine.rounds(docs, bad, detector=lambda t: F.struct(F.lit("en").alias("lang"), F.lit(0.75).alias("score")))
    found = {r.domain: r for r in refine.group_patterns(steps).collect()}
    d, e = found["d"], found["e"]
    assert d.sens_patterns == ["idiot", "moron"] and d.num_sens == 0 and d.len == 9
    assert line in d.dedup_patterns and d.dedup_patterns == sorted(set(d.dedup_patterns))
    others = [p for p in d.dedup_patterns if p != line]
    assert others and all(block[:40] in p and len(p) == 50 and any(p in r[1] for r in rows) for p in others)
    assert (d.num_dedup_para, d.num_dedup_block, d.avg_lang_score, d.avg_dedup_after_lang_score) == (9, 9, 0.5, 0.75)
    assert e.dedup_patterns is None and e.sens_patterns is None and e.len == 8 and e.avg_lang_score == 1.0
