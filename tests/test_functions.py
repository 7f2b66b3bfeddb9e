"""Functions on literals that the given tables don't hold."""

import gzip

from pyspark.sql import functions as F

from winnowry.functions import lang, lexicon, scores, url
from winnowry.functions import text as T
from winnowry.operators import graph, neardup, paths, refine, sampling
from winnowry.sources import archives
from winnowry.streaming import ingest


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "text string").select(column.alias("x")).first()["x"]


def test_garble(spark):
    for text, good in (("Ã、�、¤", True), ("Ã" * 5 + "x", True), ("Ã" * 6, False), ("x" * 300 + "Ã" * 9, True)):
        assert one(spark, text, T.is_readable(F.col("text"))) == good


def test_clean(spark):
    for text in ("qq 2304160042", "\nSKLDJKLS\n", "\n1293918273\n", "\nmyasdasd@mail.com\n", "\n+86 13800138000\n"):
        assert len(one(spark, text, T.clean(F.col("text")))) < len(text)
    assert one(spark, "电话13800138000联系", T.clean(F.col("text"))) == "电话13800138000联系"


def test_spans(spark):
    keep, drop = "今天心情真不错，今天天气真好。", "今天心情真不错!今天心情真不错.今天心情真不错，今天天气真好。\n今天心情真不错，今天天气真好。"
    assert one(spark, keep, T.has_repeated_spans(F.col("text"))) is False
    assert one(spark, drop, T.has_repeated_spans(F.col("text"))) is True
    assert one(spark, "a a a", T.has_repeated_spans(F.col("text"))) is False
    assert one(spark, "", T.has_repeated_spans(F.col("text"))) is False


def test_short_lines(spark):
    assert one(spark, "\n".join(["short"] * 5), T.has_short_lines(F.col("text"))) is True
    assert one(spark, "\n".join(["short"] * 4 + ["a line that is long enough"] + ["short"]), T.has_short_lines(F.col("text"))) is False


def test_ngrams(spark):
    assert one(spark, "今天心情真不错", T.ngrams(F.col("text"), 3, 2)) == ["今天心", "心情真", "真不错"]
    assert one(spark, "ab", T.ngrams(F.col("text"), 3, 2)) == []
    assert one(spark, "心情真不错", T.ngram_match(F.col("text"), F.array(F.lit("心情真好"), F.lit("今天心情真不错"), F.lit("今天天气真好")), 3)) == 2
    assert one(spark, "0123456789abcdefghij", T.ngram_lcs(F.col("text"), F.lit("xx0123456789yyyyyyyyyyyyyyyyyy"), 10)) == "0123456789"
    assert one(spark, "你好，我测你🐎", F.substring("text", 1, 2)) == "你好"


def test_trie(spark):
    trie = lexicon.build(["你好", "world", "rust", "rustacean"])
    assert lexicon.passes(trie, "你好", 1) and lexicon.passes(trie, "world", 1) and not lexicon.passes(trie, "你好！RUSTACEAN", 1)
    assert lexicon.matches(trie, "rustacean") == ["rust", "rustacean"] and lexicon.matches(trie, "RUST") == []
    assert lexicon.matches(lexicon.build(["a", "aa"]), "aaa") == ["aa", "aa"]
    words = spark.createDataFrame([("zh", "你好"), ("zh", "好的")], "language string, word string")
    docs = spark.createDataFrame([("zh", "你好的"), ("en", "你好")], "language string, text string")
    assert [r.x for r in docs.select(lexicon.find_matches(F.col("text"), F.col("language"), lexicon.forest(words)).alias("x")).collect()] == [["你好", "好的"], []]


def test_languages(spark):
    docs = spark.createDataFrame([("the cat is on the mat and it was good",), ("der Hund ist nicht das Haus und die Katze",), ("今天天气真好",), ("",), ("1234",)], "text string")
    assert [r.x.lang for r in docs.select(lang.detect(F.col("text")).alias("x")).collect()] == ["en", "de", "zh", "unknown", "unknown"]
    assert one(spark, "國語", lang.simplify(F.col("text"))) == "国语"
    for text, name in (("今天天气真好，我们去公园", "gb18030"), ("plain", "utf-8"), ("é", "utf-16")):
        assert lang.decode(text.encode(name)) == text
    assert lang.decode(b"\xff\x00\xfe\x80\x81") is None


def test_urls(spark):
    for text, want in (("http://User@Example.COM:80/a", "example.com"), ("http://127.0.0.1/x", None), ("http://[::1]/", None), ("not a url", None)):
        assert one(spark, text, url.domain(F.col("text"))) == want
    assert one(spark, "com.example.www", url.reverse_host(F.col("text"))) == "www.example.com"
    assert one(spark, "a" * 200, F.length(url.salted_domain(F.col("text"), F.lit("k"), F.lit(0)))) == 128


def test_segments():
    text = "One. Two\nThree! " + "x" * 40 + "。" + "y" * 25
    for most in (12, 20, 512):
        parts = scores.segments(text, most)
        assert "".join(parts) == text and all(0 < len(p) <= most - 2 for p in parts)
    assert scores.segments("", 20) == [] and scores.segments("a" * 19, 20) == ["a" * 18, "a"]
    assert scores.segments("abc\ndefghijk", 10) == ["abc", "\ndefghij", "k"]


def test_select_and_runs(spark):
    rows = spark.createDataFrame([(1, 0, "a", 0.9), (1, 1, "b", 0.1), (1, 2, "c", 0.8), (1, 3, "d", 0.7), (2, 0, "e", 0.2)], "doc_id long, pos int, segment string, score double")
    found = {r.doc_id: r for r in scores.select_segments(rows, 0.5, 0.75).collect()}
    assert found[1].text == "a\nc\nd" and found[1].bucket == "hq" and found[2].mean_score is None and found[2].bucket == "lowq"
    assert sorted((r.first, r.text) for r in scores.contiguous(rows, 0.5).collect()) == [(0, "a"), (2, "cd")]


def test_refine_groups(spark):
    docs = spark.createDataFrame([(i, f"own text number {i}\nshared line here\nanother {i}", "d", "en") for i in range(7)] + [(i, "shared line here\nx", "e", "en") for i in range(10, 16)], "doc_id long, text string, domain string, language string")
    found = {r.doc_id: r.n_removed for r in refine.dedup_paragraphs(docs).collect()}
    assert all(found[i] == 1 for i in range(7)) and all(found[i] == 0 for i in range(10, 16))
    block = "a shared passage that is long enough to be a block of text in all of these documents"
    more = spark.createDataFrame([(i, f"{i} first {block} tail {i}\nother {i}", "d", "en") for i in range(8)], "doc_id long, text string, domain string, language string")
    cfg = refine.Config(block=30, block_bits=1)
    assert all(r.n_removed == 1 and r.text.startswith("other") for r in refine.dedup_blocks(more, cfg).collect())
    assert refine.stats(docs.limit(0)).count() == 0
    assert {r.domain: r.group_dirty for r in refine.screen_bad_words(docs, F.when(F.col("doc_id") == 0, 3), first=100).collect()} == {"d": True, "e": False}
    twice = refine.screen_bad_words(docs.unionByName(docs), F.lit(3)).collect()
    assert len(twice) == 2 * docs.count() and all(r.flagged for r in twice)  # repeated ids are rows of their own
    assert one(spark, "0123456789abcdefghij", T.ngram_lcs(F.col("text"), F.lit("abcdefghijXXXXXXXXXX"), 10)) == "abcdefghij"  # of texts of equal bytes the first is searched for
    try:
        refine.dedup_paragraphs(docs.withColumn("_row", F.lit(1)))
    except ValueError as e:
        assert "_row" in str(e)
    else:
        raise AssertionError("a reserved name must be refused")


def test_dedup_blocks_brute(spark):
    """All shared blocks count, at every place: runs of just the block's length, and one character short of it, in both lengths."""
    import collections
    import math
    import random

    r = random.Random(3)
    draw = lambda n, zh: "".join(chr(r.randrange(0x4E00, 0x9000)) if zh else r.choice("abcdefghij é") for _ in range(n))
    rows = []
    for domain, zh in (("d", False), ("c", True)):
        n = 30 if zh else 50
        runs = [(draw(n + d, zh), k) for d in (-1, 0, 0, 0, 0, 3, 40) for k in (2, 3, 4, 8)]
        for k in range(12):
            own = [draw(r.randrange(0, 40), zh) + x + draw(r.randrange(0, 40), zh) for x, m in runs if k < m]
            rows.append((k + 100 * zh, "\n".join([*own, draw(n - 1, zh), "", draw(200, zh)]), domain, "zh" if zh else "en"))
    rows += [(900 + k, rows[0][1], "small", "en") for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string, language string").repartition(3).cache()
    seen = collections.defaultdict(set)
    blocks = lambda p, g: {p[k : k + (30 if g == "zh" else 50)] for k in range(len(p) - (29 if g == "zh" else 49))}
    for i, t, d, g in rows:
        for p in t.split("\n"):
            for b in blocks(p, g):
                seen[d, b].add(i)
    sizes = collections.Counter(x[2] for x in rows)
    least = {d: max(3, math.ceil(n / math.sqrt(max(20, min(500, n // 5))))) for d, n in sizes.items()}
    want = {}
    for i, t, d, g in rows:
        kept = [p for p in t.split("\n") if sizes[d] < 7 or not any(len(seen[d, b]) >= least[d] for b in blocks(p, g))]
        want[i] = ("\n".join(kept), t.count("\n") + 1 - len(kept))
    assert {x.doc_id: (x.text, x.n_removed) for x in refine.dedup_blocks(docs).collect()} == want
    assert refine.block_patterns(docs).count() == sum(sizes[d] >= 7 and len(x) >= least[d] for (d, _), x in seen.items())


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 99)], "a long, b long")
    found = {r.id: r.component for r in graph.components(links).collect()}
    assert all(found[k] == 0 for k in range(41)) and found[100] == found[101] == found[99] == 99


def test_simhash_pairs(spark):
    rows = spark.createDataFrame([(1, 0b11, 0), (2, 0b00, 0), (3, 0b111, 0), (4, (1 << 31) | 0b11, 0), (5, 0b11, 0)], "doc_id long, hi long, lo long")
    assert {(r.a, r.b, r.distance) for r in neardup.pairs(rows).collect()} == {(1, 2, 2), (1, 3, 1), (1, 4, 1), (3, 4, 2)}
    assert {r.doc_id for r in neardup.keep(rows).filter("kept").collect()} == {1}


def test_sampling(spark):
    rows = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("label"), F.when(F.col("id") < 10, 1000.0).otherwise(1.0).alias("w"))
    assert rows.transform(sampling.per_class, "label", "k", 5).count() == 15
    assert sum(r.k < 10 for r in sampling.weighted(rows, "w", "k", 10, 4).collect()) >= 7
    drawn = sampling.with_replacement(rows, "w", "k", 200, 1).collect()
    assert sum(r.times for r in drawn) == 200 and sum(r.times for r in drawn if r.k < 10) > 150
    assert sampling.batches(rows, "k", 64, whole=True).count() == 960
    assert abs(sampling.bernoulli(rows, "k", 0.3).count() - 300) < 60


def test_paths(spark):
    text = spark.createDataFrame([('{"CC-MAIN-2019-10": {"1": ["a/b.gz", "c.gz"]}}',)], "value string")
    assert {(r.name, r.link) for r in paths.flatten_table(text).collect()} == {("CC-MAIN-2019-10/1", "a/b.gz"), ("CC-MAIN-2019-10/1", "c.gz")}
    page = spark.createDataFrame([("x CC-MAIN-2019-10 y CC-MAIN-2021-04",)], "text string")
    assert [r.crawl_id for r in paths.in_years(paths.crawl_ids(page), 2020, 2022).collect()] == ["CC-MAIN-2021-04"]
    ranks = spark.createDataFrame([("#a #b #c #d #host_rev",), ("1 2 3 4 com.example",)], "value string")
    assert [r.domain for r in paths.host_ranks(ranks).collect()] == ["example.com"]
    assert [tuple(r) for r in paths.large_domains(spark.createDataFrame([("a.com\t25000",), ("",)], "value string")).collect()] == [("a.com", 2)]


def record(kind, uri, body):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Date: 2019-01-01T00:00:00Z\r\n" + (f"WARC-Target-URI: {uri}\r\n" if uri else "") + f"Content-Length: {len(body)}\r\n\r\n"
    return gzip.compress(head.encode() + body + b"\r\n\r\n")


def test_archives(spark, tmp_path):
    good = ("the cat is on the mat and it was good " * 8).encode()
    data = b"".join([record("warcinfo", None, b"x"), record("conversion", "http://a.com/1", good), record("conversion", "http://b.com/1", good), record("conversion", "http://a.com/2", b"short"), record("conversion", None, good), record("conversion", "http://10.0.0.1/", good), record("conversion", "http://a.com/3", b"\xff\xfe\x80" * 100)])
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.gz").write_bytes(data + data[:40])
    (tmp_path / "in/bad.gz").write_bytes(b"\x1f\x8bbroken")
    rows = archives.read_archives(spark, str(tmp_path / "in"))
    assert rows.count() == 7
    archives.register(spark)
    assert spark.read.format("crawl").option("path", str(tmp_path / "in")).load().filter("error is null").count() == 7
    found = archives.extracted(rows, lang.decoded, lang.detect, ["en"], spark.createDataFrame([("b.com",)], "domain string"), spark.createDataFrame([("a.com", 3)], "domain string, parts int"))
    got = found.collect()
    assert [r.uri for r in got] == ["http://a.com/1"] and got[0].domain.startswith("a.com---")
    archives.write_by_domain(found, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).first()["alpha"] == "a"


def test_files(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w/en.txt").write_text("bad\n\nworse\n")
    assert {(r.language, r.word) for r in archives.read_words(spark, str(tmp_path / "w")).collect()} == {("en", "bad"), ("en", "worse")}
    (tmp_path / "t.json").write_text('[{"text": "a", "score": 1, "cc_score": 0.2}, {"text": "b", "score": 0, "cc_score": 0.4}]')
    assert {r.text: r.label for r in archives.read_training(spark, str(tmp_path / "t.json"), True).collect()} == {"a": 1.0, "b": 0.4}
    (tmp_path / "e.tsv").write_text("1\tone two three\t4\none two\t5\nbroken\n")
    assert [(r.text, r.label) for r in archives.read_essays(spark, str(tmp_path / "e.tsv"), words=2).collect()] == [("one two", 4.0), ("one two", 5.0)]
    rows = spark.range(10).select(F.col("id").alias("doc_id"), F.col("id").alias("hi"), F.col("id").alias("lo"))
    archives.write_hashes(rows, str(tmp_path / "h"))
    assert archives.read_hashes(spark, str(tmp_path / "h")).count() == 10
    archives.write_rolled(rows.coalesce(1), str(tmp_path / "r"), 3)
    assert len(list((tmp_path / "r").glob("*.parquet"))) == 4
    archives.write_buckets(rows.withColumn("bucket", F.lit("hq")), str(tmp_path / "b"))
    assert (tmp_path / "b/bucket=hq").exists()


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x" * 300), (2, "y")], "doc_id long, text string")
    rows.write.parquet(str(tmp_path / "in"))
    step = lambda d: d.filter(F.octet_length("text") >= 200)
    for _ in range(2):
        ingest.ingest(spark, str(tmp_path / "in"), "doc_id long, text string", step, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert [r.doc_id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [1]


def test_simhash_cost_does_not_grow_with_known_tokens(spark):
    """Rows after many distinct tokens take as long as rows before them: a row looks at its own tokens alone."""
    import time

    from winnowry.functions.simhash import simhash

    few = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a few words of each row").alias("text"))
    many = spark.range(40).select((F.col("id") - 100).alias("doc_id"), F.array_join(F.transform(F.sequence(F.col("id") * 8000, F.col("id") * 8000 + 7999), lambda i: F.concat(F.lit("w"), i.cast("string"))), " ").alias("text"))
    took = []
    for rows in (few, few, many.unionByName(few).coalesce(1), many):
        began = time.time()
        simhash(rows.coalesce(1)).write.format("noop").mode("overwrite").save()
        took.append(time.time() - began)
    assert took[2] < took[1] + took[3] + 5  # 3,000 walks over 320,000 known tokens take a minute


def test_shared_folder_is_never_local_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from winnowry.plans.session import shared_folder

    context = SimpleNamespace(getConf=lambda: {}, getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: d)))
