"""Charset detection: legal byte sequences, then frequencies of byte pairs.

Byte-order marks and valid UTF-8 decide at once. Of the other charsets those whose decoder (a state machine of legal
sequences) accepts the bytes are compared by how likely a model, trained from text, makes the pairs with a byte outside
printable ASCII. The posterior of the best is the confidence; bytes that are far less likely than the charset's own
training text are rejected, whatever the others are.
"""

from __future__ import annotations

import codecs
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import pieces

#: What each pair counts beforehand, and by how many nats a pair may be less likely than in training on average.
SMOOTH, FAR = 0.01, 4.0
#: Bytes looked at at once; pairs of bytes; so few pairs are sorted rather than counted in a table.
STEP, PAIRS, FEW = 1 << 18, 1 << 16, 1 << 13
PLAIN = np.zeros(256, bool)
PLAIN[[9, 10, 13, *range(32, 127)]] = True
MARKS = [(codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF32_LE, "utf-32"), (codecs.BOM_UTF32_BE, "utf-32"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16")]
#: Characters that no text holds: controls but for white space, non-characters, surrogates and private use.
NEVER = re.compile("[\x00-\x08\x0e-\x1a\x1c-\x1f\x7f-\x84\x86-\x9f\ud800-\udfff\ue000-\uf8ff\ufdd0-\ufdef\ufffe\uffff]")
ZERO = re.compile("\0")


def pairs(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the byte pairs with a byte outside printable ASCII, in order, and how often each occurs; those at odd places come last."""
    total: np.ndarray | None = None
    for at in range(0, max(len(data) - 1, 0), STEP):
        b = np.frombuffer(data[at : at + STEP + 1], np.uint8)
        plain = PLAIN[b]
        own = (~(plain[:-1] & plain[1:])).nonzero()[0]
        numbers = (own + at) % 2 * PAIRS + b[own].astype(np.int64) * 256 + b[own + 1]
        if len(data) <= STEP and len(own) < FEW:
            return np.unique(numbers, return_counts=True)
        n = np.bincount(numbers, minlength=2 * PAIRS)
        total = n if total is None else total + n
    if total is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = total.nonzero()[0]
    return at, total[at]


def legal(data: bytes, charset: str, never: re.Pattern = NEVER) -> bool:
    """Whether the bytes are text of the charset without characters of `never`; a character cut off at the end is let pass."""
    try:
        return not never.search(codecs.getincrementaldecoder(charset)("strict").decode(data, False))
    except UnicodeDecodeError:
        return False


class Model:
    """Charsets, logarithms of their pairs' shares and these weights' means over the training text."""

    def __init__(self, charsets: list[str], weights: np.ndarray, means: np.ndarray):
        self.charsets, self.weights, self.means = charsets, weights, means

    def detect(self, data: bytes | None) -> tuple[str | None, float]:
        """Charset and confidence; (None, 0.0) where none fits."""
        if data is None:
            return None, 0.0
        for mark, name in MARKS:
            if data.startswith(mark):
                return (name, 1.0) if legal(data, name, ZERO) else (None, 0.0)
        if legal(data, "utf-8", ZERO):
            return "utf-8", 1.0
        at, n = pairs(data)
        fits = [k for k, c in enumerate(self.charsets) if legal(data, c)]
        if not fits or not n.sum():
            return None, 0.0
        z = np.array([self.weights[k, at].astype(float) @ n for k in fits])
        best = int(z.argmax())
        if z[best] / n.sum() < self.means[fits[best]] - FAR:
            return None, 0.0
        e = np.exp((z - z[best]) / np.sqrt(n.sum()))
        return self.charsets[fits[best]], float(e[best] / e.sum())

    def decode(self, data: bytes | None, least: float = 0.5) -> tuple[str | None, float, str | None]:
        """Charset, confidence and text; no charset and text where the confidence isn't over `least`."""
        name, sure = self.detect(data)
        if name is None or sure <= least:
            return None, sure, None
        return name, sure, data.decode(name, "ignore")


def fit(sums: dict[str, np.ndarray]) -> Model:
    """A model of each charset's summed pairs; only charsets of two-byte units tell odd places from even ones."""
    charsets = sorted(sums)
    weights, means = [], []
    for c in charsets:
        own = sums[c].reshape(2, PAIRS)
        n = own if c.startswith("utf-16") else np.repeat(own.sum(axis=0, keepdims=True), 2, axis=0)
        w = np.log((n + SMOOTH) / (n.sum(axis=1, keepdims=True) + SMOOTH * PAIRS)).reshape(-1)
        weights.append(w.astype(np.float32))
        means.append(float(w @ sums[c]) / max(int(sums[c].sum()), 1))
    return Model(charsets, np.stack(weights) if weights else np.zeros((0, 2 * PAIRS), np.float32), np.array(means))


def train(rows: DataFrame, charsets: tuple[str, ...], text: str = "text") -> Model:
    """A model of all texts, encoded in each charset without the characters it lacks. To the driver go 2 * PAIRS sums a charset at most."""

    def count(batches):
        sums = {c: np.zeros(2 * PAIRS, np.int64) for c in charsets}
        for b in batches:
            for t in pieces.values(b.column(0)):
                for c in charsets:
                    at, n = pairs((t or "").encode(c, "ignore"))
                    sums[c][at] += n
        for c, own in sums.items():
            at = own.nonzero()[0]
            yield pa.RecordBatch.from_arrays([pa.array([c] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at], pa.int64())], names=["charset", "pair", "n"])

    own = rows.select(F.col(text).cast("string").alias("text")).filter("text is not null")
    got: pd.DataFrame = own.mapInArrow(count, "charset string, pair int, n long").groupBy("charset", "pair").agg(F.sum("n").alias("n")).toPandas()
    sums = {c: np.zeros(2 * PAIRS, np.int64) for c in charsets}
    for c, part in got.groupby("charset"):
        sums[c][part["pair"].to_numpy()] = part["n"].to_numpy()
    return fit(sums)


def decoded(body: Column, model: Model, least: float = 0.5) -> Column:
    """struct<charset, confidence, text>, nulls where none is sure enough."""

    names = ("charset", "confidence", "text")
    kind = pa.struct(list(zip(names, (pa.string(), pa.float64(), pa.string()), strict=True)))
    return pieces.mapped(lambda b: dict(zip(names, model.decode(b, least), strict=True)), "charset string, confidence double, text string", kind, body)


def encoded(text: Column, charset: Column) -> Column:
    """Bytes of text in the charset of the row; null where it lacks a character."""

    return pieces.mapped(_encode, "binary", pa.binary(), text, charset)


def _encode(text: str | None, charset: str) -> bytes | None:
    if text is None:
        return None
    try:
        return text.encode(charset)
    except UnicodeEncodeError:
        return None
