"""Trained language and charset detection: held-out accuracy, slow versions, edge cases."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnowry.functions import charset, lang, langid
from winnowry.plans.queries import CHARSETS, QUERIES

TEXTS = ["The cat sat on the mat.", "Der Hund läuft über die Straße.", "", None, "12345 !!!", "été à la plage", "a"]


def test_languages_of_documents_held_out(spark, sf):
    found = QUERIES["language_id"](spark, sf).filter("held_out and labelled is not null and lang <> 'unknown'")
    n, good = found.count(), found.filter("lang = labelled").count()
    assert n > 10 and good >= 0.97 * n


def _slow(text):
    words = " " + langid.OTHER.sub(" ", text.lower()).strip() + " "
    out = Counter()
    for n in range(1, langid.GRAMS + 1):
        for i in range(len(words) - n + 1):
            h = 0
            for c in words[i : i + n]:
                h = ((h ^ ord(c)) * int(langid.FACTORS[n - 1])) % 2**64
                h ^= h >> 29
            out[(h * int(langid.FACTORS[0])) % 2**64 >> (64 - langid.BUCKETS.bit_length() + 1)] += 1
    return out


@pytest.mark.parametrize("step", [4, 7, 1 << 18])
def test_counts_equal_a_loop(monkeypatch, step):
    monkeypatch.setattr(langid, "STEP", step)
    for t in TEXTS:
        own = langid.counts(t)
        want = _slow(t) if t and langid.OTHER.sub("", t) else {}
        assert {int(k): int(own[k]) for k in own.nonzero()[0]} == want


def test_model_is_the_same_however_rows_are_split(spark):
    rows = spark.createDataFrame([(t, k) for k, t in [("en", "the cat and the dog"), ("de", "der Hund und die Katze"), ("en", "a house"), (None, "x"), ("de", None)]], "lang string, text string")
    rows = rows.select(F.col("text").alias("lang"), F.col("lang").alias("text"))
    a, b = langid.train(rows.repartition(5)), langid.train(rows.coalesce(1))
    assert a.labels == b.labels == ["de", "en"] and np.array_equal(a.weights, b.weights)
    assert a("the dogs")[0] == "en" and a("die Hunde")[0] == "de"
    assert abs(a.shares("the dogs").sum() - 1) < 1e-12


def test_detect_takes_the_model(spark):
    model = langid.fit({"en": langid.counts("the cat and the dog"), "de": langid.counts("der Hund und die Katze")})
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(["the\ndog", "die Katze", "", None, "123"])], "i int, text string")
    found = rows.select("i", lang.detect(F.col("text"), model, first=1000, least=0.4).alias("d")).orderBy("i").collect()
    assert [r["d"]["lang"] for r in found] == ["en", "de", "unknown", "unknown", "unknown"]
    assert langid.fit({})("text") == ("unknown", 0.0)


def test_recall_of_each_charset(spark, sf):
    found = QUERIES["charset_decode"](spark, sf)
    shares = {r["charset"]: (r["n"], r["same"]) for r in found.groupBy("charset").agg(F.count("*").alias("n"), F.sum(F.col("same").cast("int")).alias("same")).collect()}
    assert set(shares) == {*CHARSETS, "utf-8"}
    for name, (n, same) in shares.items():
        assert same >= 0.95 * n, name


@pytest.fixture(scope="module")
def model():
    texts = ["Der Bär läuft über die Straße und fällt in die Höhle, während Vögel schön fröhlich singen.", "L’été à la plage, où l'on a déjà goûté ces pâtes.", "El niño comió piñas mañana según él, ¿no?"]
    eastern = {"shift_jis": "これは日本語の文章です。東京は大きな都市で、人が多い。", "gb18030": "这是一个中文句子。北京是一个很大的城市,人很多。", "euc_kr": "이것은 한국어 문장입니다. 서울은 아주 큰 도시입니다."}
    sums = {}
    for name, own in {**{c: " ".join(texts) for c in CHARSETS}, **eastern}.items():
        at, n = charset.pairs(own.encode(name, "ignore"))
        sums[name] = np.zeros(2 * charset.PAIRS, np.int64)
        sums[name][at] = n
    return charset.fit(sums)


def test_charsets_by_marks_sequences_and_pairs(model):
    assert model.decode("für über".encode("utf-8-sig"))[::2] == ("utf-8-sig", "für über")
    assert model.decode("für".encode("utf-16"))[::2] == ("utf-16", "für")
    assert model.decode("für über".encode())[::2] == ("utf-8", "für über")
    for name in ("cp1252", "cp850", "mac_roman", "utf-16-le"):
        text = "über die Straße läuft ein Bär"
        assert model.decode(text.encode(name))[::2] == (name, text)
    for name, text in {"shift_jis": "東京の人です。", "gb18030": "北京人很多。", "euc_kr": "서울은 큰 도시입니다."}.items():
        assert model.decode(text.encode(name))[::2] == (name, text)


def test_bytes_that_are_no_text_are_rejected(model):
    noise = np.random.default_rng(5).integers(0, 256, 5000).astype(np.uint8).tobytes()
    assert model.decode(noise) == (None, 0.0, None)
    assert model.decode(None) == (None, 0.0, None) and model.decode(b"")[::2] == ("utf-8", "")
    assert charset.fit({}).decode(b"\xff\x80") == (None, 0.0, None)
    assert model.decode("fällt".encode("cp1252"), least=1.0)[2] is None


@pytest.mark.parametrize("step", [3, 8])
def test_pairs_of_long_bytes(monkeypatch, step):
    data = "über die Straße läuft ein Bär".encode("cp1252")
    whole = charset.pairs(data)
    monkeypatch.setattr(charset, "STEP", step)
    assert all(np.array_equal(a, b) for a, b in zip(whole, charset.pairs(data), strict=True))


def test_few_and_many_pairs_are_counted_alike(monkeypatch):
    data = "über die Straße läuft ein Bär".encode("utf-16-le")
    few = charset.pairs(data)
    monkeypatch.setattr(charset, "FEW", 0)
    assert all(np.array_equal(a, b) for a, b in zip(few, charset.pairs(data), strict=True))


def _longest(text, table):
    out, i = [], 0
    while i < len(text):
        k = max((k for k in table if k and text.startswith(k, i)), key=len, default="")
        out.append(table[k] if k else text[i])
        i += len(k) or 1
    return "".join(out)


def test_conversion_is_leftmost_longest(spark):
    rng = np.random.default_rng(3)
    table = {"".join(rng.choice(list("abc"), rng.integers(1, 5))): str(i) for i in range(12)} | {"": "never", "乾隆": "乾隆", "乾": "干"}
    texts = ["".join(rng.choice(list("abcd乾隆"), rng.integers(0, 40))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate([*texts, None])), "i int, text string")
    found = [r[0] for r in rows.orderBy("i").select(lang.converted(F.col("text"), table)).collect()]
    assert found == [*(_longest(t, table) for t in texts), None]
    hard = {"ation": "1", "tion": "2", "io": "3", "e": "4"}  # "io" begins within the failed beginning of "ation"
    assert spark.createDataFrame([("eatior",)], "t string").select(lang.converted(F.col("t"), hard)).first()[0] == _longest("eatior", hard) == "4at3r"
    assert rows.select(lang.converted(F.col("text"), {}).alias("t")).filter("t <=> null").count() == 1
