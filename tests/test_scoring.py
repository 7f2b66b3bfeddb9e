"""Batches of windows and the heads against one document at a time."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnowry.functions import heads
from winnowry.functions.scores import segments
from winnowry.operators import predict, scoring

TEXTS = ["one two three.", None, "", "   ", "word " * 700, "Ein Satz. Noch einer!\nUnd mehr。" * 40, "x" * 900, *(f"text {i} of some words" * (i % 5) for i in range(40)), "one two three."]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i < 45 else 3, t, "old", 7) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, pieces string, label int").repartition(3).cache()


def planes(ids, length):
    own = [101, *ids, 102]
    return np.array([[own + [0] * (length - len(own)), [0] * length, [1] * len(own) + [0] * (length - len(own))]])


def alone(text, pieces, length, scorer):
    """Results of a document's windows, scored one by one."""
    return [scorer(planes(ids, length))[0] for ids in pieces(text)[1]] if text else []


@pytest.mark.parametrize("batch", [1, 3, 32, 5000])
def test_any_batch_gives_the_same_scores(spark, docs, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for pieces, length in ((scoring.by_window(scoring.hashed_words, 12), 12), (scoring.by_window(scoring.hashed_words, 12, 2), 12), (scoring.by_segment(scoring.hashed_words, 30), 30)):
            found = scoring.score(docs, pieces, scoring.mean_id, length=length, batch=batch).collect()
            assert found[0].asDict().keys() == {"doc_id", "text", "label", "pieces", "scores"}
            assert len(found) == len(TEXTS)
            for r in found:
                want = alone(r.text, pieces, length, scoring.mean_id)
                assert r.scores == pytest.approx(want) and r.pieces == (pieces(r.text)[0] if r.text else [])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert scoring.score(docs.limit(0), pieces, scoring.mean_id, length=length).count() == 0


def test_batches_are_full():
    """The scorer sees batches of one size, whatever documents the windows are of, and the rest at the end."""
    seen = []
    packer = scoring.Batches(lambda p: seen.append(len(p)) or np.arange(len(p)), 8, 5)
    targets = [[] for _ in range(13)]
    for k, t in enumerate(targets):
        packer.add(list(range(k % 6)), t)
    packer.run()
    assert seen == [5, 5, 3] and [t[0] for t in targets] == [*range(5), *range(5), *range(3)]


def test_windows_as_expressions(docs):
    """The three planes of the expressions are those that the batches hold."""
    own = docs.filter("text is not null").select("doc_id", "label", "text", scoring.hashed_words_of(F.col("text")).alias("tokens"))
    found = sorted(((r.doc_id, r.text, r.seq, tuple(r.ids), tuple(r.types), tuple(r["mask"])) for r in scoring.windows(own, 12).collect()), key=repr)
    want = []
    for r in own.collect():
        for seq, ids in enumerate(scoring.by_window(scoring.hashed_words, 12)(r.text)[1]):
            want.append((r.doc_id, r.text, seq, *map(tuple, planes(ids, 12)[0].tolist())))
    assert found == sorted(want, key=repr)
    assert scoring.windows(own, 12, most=1).filter("seq > 0").count() == 0


def slow_lstm(x, w):
    h, c, out = [0.0] * w.size, [0.0] * w.size, []
    for row in x:
        gates = [sum(a * b for a, b in zip(w.inputs[k], row, strict=True)) + sum(a * b for a, b in zip(w.hidden[k], h, strict=True)) + w.bias[k] for k in range(4 * w.size)]
        s = lambda v: 1 / (1 + math.exp(-v))
        for u in range(w.size):
            i, f, g, o = (gates[u + k * w.size] for k in range(4))
            c[u] = s(f) * c[u] + s(i) * math.tanh(g)
            gates[u] = s(o) * math.tanh(c[u])
        h = gates[: w.size]
        out.append(h)
    return out


def slow_score(vectors, model):
    """A document's score, step by step."""
    if not vectors:
        return None
    total = sum(a * b for a, b in zip(vectors[0], model.tokens.weight, strict=True)) + model.tokens.bias
    head = model.segments
    out = slow_lstm([v[len(v) // 2 :] for v in vectors], head.recurrent)
    levels = []
    for h in out:
        hidden = [math.tanh(sum(h[a] * head.attention[a][b] for a in range(len(h))) + head.attention_bias[b]) for b in range(len(h))]
        levels.append(math.exp(sum(a * b for a, b in zip(hidden, head.query, strict=True))))
    for u in range(len(out[0])):
        total += head.weight[u] * sum(x * h[u] for x, h in zip(levels, out, strict=True)) / sum(levels)
    total += head.bias
    return model.lo + (model.hi - model.lo) / (1 + math.exp(-total))


def test_heads_equal_a_loop_per_document(docs):
    encoder, model = heads.example()
    found = predict.document_scores(docs, scoring.hashed_words, encoder, model, length=9, batch=10).collect()
    assert len({round(r.score, 6) for r in found if r.score is not None}) > 10
    for r in found:
        want = slow_score([v.tolist() for v in alone(r.text, scoring.by_window(scoring.hashed_words, 9), 9, encoder)], model)
        assert r.score is None if want is None else r.score == pytest.approx(want, abs=1e-12)


def test_documents_in_a_batch_do_not_change_each_other():
    _, model = heads.example()
    R = np.random.default_rng(2)
    documents = [R.normal(size=(n, 12)) for n in (3, 0, 1, 9, 4)]
    together = model(documents)
    for d, x in zip(documents, together, strict=True):
        assert np.isnan(x) if not len(d) else x == pytest.approx(slow_score(d.tolist(), model))


def test_prediction_writes_all_rows(spark, tmp_path):
    rows = [(i, "Gut. " * (i + 1), "fr" if i % 3 else "en", 0.9, "fr" if i % 2 else "unknown", 0.7 if i % 5 else 0.1) for i in range(40)] + [(99, None, "fr", 0.9, "fr", 0.9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, language string, lang_score double, lang_after_dedup string, dedup_after_lang_score double")
    found, rest = predict.scored(docs, scoring.hashed_words, scoring.mean_id, language="fr", threshold=0.5)
    predict.write_scored(found, rest, str(tmp_path / "out"))
    lines = [json.loads(x) for p in (tmp_path / "out").rglob("*.json") for x in p.read_text().splitlines()]
    kept = [r for r in rows if r[5] > 0.6]
    assert sorted(x["doc_id"] for x in lines) == sorted(r[0] for r in kept)
    for x in lines:
        row = next(r for r in rows if r[0] == x["doc_id"])
        if "scores" in x:
            assert x.get("orig_text") == row[1] and "\n".join(segments(row[1] or "", 512)) == x["text"]


def test_refused_scripts_stop_prediction(spark):
    from pyspark.errors import PySparkException

    docs = spark.createDataFrame([(1, "x", "zho_Hant", 0.9, "zh", 0.9)], "doc_id long, text string, language string, lang_score double, lang_after_dedup string, dedup_after_lang_score double")
    with pytest.raises(PySparkException, match="script"):
        predict.reliable(docs).collect()
