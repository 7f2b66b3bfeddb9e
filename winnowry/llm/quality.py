"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words. Each passage is encoded from shares of byte kinds, word statistics and
hashed words; gated attention (tanh times sigmoid) weighs the encodings, and their weighted sum is scored. All weights are
learnt together from document labels with Adam, in numpy, on a bounded sample of labelled documents.

Rows: null, empty and wordless texts are bags of one blank passage; without labels of both kinds every score is 1.0 (or
the only label there is); null, repeated and clashing doc_ids are kept row by row. Memory: a block of text; on the driver the
sample, of at most DOCS bags of BAG passages.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, stored, table, text_parts
from .hashing import mix
from .labelled import held_out, sample, texts
from .words import LOWER, VISIBLE, hashes, spans

PASSAGE = 64
HASHED = 32
HIDDEN, GATE = 32, 16
#: The bound of the sample: labelled documents, and passages learnt from of each, evenly spaced. Scores see all passages.
DOCS, BAG = 4000, 32
MOD, REST, LIMIT = 4, 2, 0.7

#: Byte kinds: space, line feed, other control, lower, upper, digit, non-ASCII lead, continuation, then each sign by itself.
KIND = np.zeros(256, np.int64)
KIND[:] = 2
KIND[32], KIND[10] = 0, 1
KIND[97:123], KIND[65:91], KIND[48:58] = 3, 4, 5
KIND[192:], KIND[128:192] = 6, 7
SIGNS = [b for b in range(33, 127) if not chr(b).isalnum()]
KIND[SIGNS] = np.arange(8, 8 + len(SIGNS))
KINDS = 8 + len(SIGNS)
WIDTH = KINDS + HASHED + 6


def passages(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the rows' passages, float32, and the rows' offsets into them; at least one passage a row."""
    n, base = len(at) - 1, int(at[0])
    text = data[base : at[-1]]
    begin, end = spans(text, at - base, VISIBLE)
    first = np.searchsorted(begin, at - base)
    words = np.diff(first)
    bags = np.maximum(1, -(-words // PASSAGE))
    offs = np.concatenate([[0], np.cumsum(bags)])
    total = int(offs[-1])
    row = np.repeat(np.arange(n), words)
    place = np.arange(len(begin)) - first[row]
    bag = offs[row] + place // PASSAGE
    starts = np.zeros(total, np.int64)
    starts[offs[:-1]] = at[:-1] - base
    lead = (place % PASSAGE == 0) & (place > 0)
    starts[bag[lead]] = begin[lead]
    sizes = np.diff(np.append(starts, len(text)))
    of = np.repeat(np.arange(total), sizes)
    kinds = np.bincount(of * KINDS + KIND[text], minlength=total * KINDS).reshape(total, KINDS)
    keys = hashes(LOWER[text], begin, end)
    hashed = np.bincount(bag * HASHED + (mix(keys) % np.uint64(HASHED)).astype(np.int64), minlength=total * HASHED).reshape(total, HASHED)
    count = np.bincount(bag, minlength=total)
    again = np.zeros(len(keys), bool)
    again[1:] = (keys[1:] == keys[:-1]) & (row[1:] == row[:-1])
    by = np.lexsort((keys, bag))
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[by][1:] != keys[by][:-1]) | (bag[by][1:] != bag[by][:-1])
    some = np.maximum(count, 1)
    lens = np.bincount(bag, weights=end - begin, minlength=total)
    x = np.concatenate(
        [
            np.sqrt(kinds / np.maximum(sizes, 1)[:, None]),
            hashed / some[:, None],
            np.stack([np.log1p(count), count / PASSAGE, np.bincount(bag, weights=again, minlength=total) / some, np.bincount(bag[by], weights=fresh, minlength=total) / some, lens / some / 10, np.log1p(bags[np.repeat(np.arange(n), bags)])], axis=1),
        ],
        axis=1,
    )
    return x.astype(np.float32), offs


class Model:
    """Encoder, gated attention and score; forward() keeps what backward() needs."""

    def __init__(self, width: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        f = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float64)
        self.p = {"w": f(width, HIDDEN), "b": np.zeros(HIDDEN), "v": f(HIDDEN, GATE), "u": f(HIDDEN, GATE), "a": f(GATE), "c": f(HIDDEN), "d": np.zeros(1)}
        self.mean, self.scale = np.zeros(width), np.ones(width)
        self.constant: float | None = None

    def forward(self, x: np.ndarray, offs: np.ndarray) -> np.ndarray:
        p = self.p
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        h = np.tanh(x @ p["w"] + p["b"])
        t, s = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * s) @ p["a"]
        n = np.diff(offs)
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, offs[:-1]), n))
        w = e / np.repeat(np.add.reduceat(e, offs[:-1]), n)
        z = np.add.reduceat(w[:, None] * h, offs[:-1], axis=0)
        self.kept = (x, h, t, s, w, z, n, offs)
        return 1 / (1 + np.exp(-(z @ p["c"] + p["d"])))

    def backward(self, error: np.ndarray) -> dict[str, np.ndarray]:
        p, (x, h, t, s, w, z, n, offs) = self.p, self.kept
        g = {"c": z.T @ error, "d": np.array([error.sum()])}
        dz = np.repeat(error[:, None] * p["c"], n, axis=0)
        dw = (dz * h).sum(axis=1)
        de = w * (dw - np.repeat(np.add.reduceat(w * dw, offs[:-1]), n))
        g["a"] = (t * s).T @ de
        dt, ds = de[:, None] * p["a"] * s * (1 - t * t), de[:, None] * p["a"] * t * s * (1 - s)
        g["v"], g["u"] = h.T @ dt, h.T @ ds
        dh = (w[:, None] * dz + dt @ p["v"].T + ds @ p["u"].T) * (1 - h * h)
        g["w"], g["b"] = x.T @ dh, dh.sum(axis=0)
        return g

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, rounds: int = 12, size: int = 64, rate: float = 0.01, decay: float = 1e-4) -> Model:
        if len(set(labels.tolist())) < 2:
            self.constant = float(labels[0]) if len(labels) else 1.0
            return self
        x = np.concatenate(bags)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        rng = np.random.default_rng(3)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        q = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(rounds):
            order = rng.permutation(len(bags))
            for lo in range(0, len(order), size):
                own = order[lo : lo + size]
                offs = np.concatenate([[0], np.cumsum([len(bags[i]) for i in own])])
                score = self.forward(np.concatenate([bags[i] for i in own]), offs)
                grads = self.backward((score - labels[own]) / len(own))
                step += 1
                for k, v in grads.items():
                    v = v + decay * self.p[k]
                    m[k], q[k] = 0.9 * m[k] + 0.1 * v, 0.999 * q[k] + 0.001 * v * v
                    self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(q[k] / (1 - 0.999**step)) + 1e-8)
        self.kept = None
        return self

    def score(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(at) - 1, self.constant)
        out = []
        for lo, hi in chunks(at, 1 << 20):
            out.append(self.forward(*passages(data, at[lo : hi + 1])))
            self.kept = None
        return np.concatenate([np.zeros(0), *out])


def train(docs: DataFrame, labels: DataFrame, docs_most: int = DOCS, bag_most: int = BAG) -> Model:
    """A model of labels.quality from a sample of rows that aren't held out."""

    def encode(batches):
        for b in batches:
            data, at = text_parts(b.column(1))
            for lo, hi in chunks(at):
                x, offs = passages(data, at[lo : hi + 1])
                out = []
                for k in range(hi - lo):
                    own = x[offs[k] : offs[k + 1]]
                    out.append(own[np.unique(np.linspace(0, len(own) - 1, min(bag_most, len(own))).astype(int))].tobytes())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo), pa.array(out, pa.binary())], names=["doc_id", "label", "x"])

    chosen = stored(sample(labels, "quality", MOD, REST, docs_most), "quality-sample")
    rows = texts(docs, chosen).select("doc_id", "text", "label").mapInArrow(encode, "doc_id long, label int, x binary")
    once = rows.groupBy("doc_id").agg(F.min(F.struct("label", "x")).alias("own")).select("doc_id", "own.*")  # one row of each id, the same on every run
    got = sorted((r["doc_id"], r["label"], bytes(r["x"])) for r in once.collect())
    return Model(WIDTH).fit([np.frombuffer(x, np.float32).reshape(-1, WIDTH) for *_, x in got], np.array([y for _, y, _ in got], float))


def extra(docs: DataFrame) -> str:
    """A column name that docs lacks."""
    name = "quality_"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs with one more column, named by extra(docs)."""
    model, added = docs.sparkSession.sparkContext.broadcast(model), extra(docs)
    names = docs.columns
    where = names.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(added, T.DoubleType())])

    def score(batches):
        for b in batches:
            out = model.value.score(*text_parts(b.column(where)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out)], names=[*names, added])

    return docs.mapInArrow(score, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of all documents."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = scored(own, train(docs, labels))
    return out.select("doc_id", held_out(MOD, REST).alias("held_out"), F.col("quality_").alias("score"), (F.col("quality_") >= LIMIT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs that the classifier accepts."""
    return scored(docs, train(docs, labels)).filter(F.col(extra(docs)) >= LIMIT).select(*docs.columns)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
