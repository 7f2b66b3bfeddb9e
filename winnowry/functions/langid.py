"""Language identification trained from labelled text: a linear model over hashed character n-grams.

Counts of hashed 1- to 3-grams are summed for each label over all rows in Spark; smoothed logarithms of their shares are the
weights. A text's score is the softmax of its summed weights over the square root of its n-grams, which depend on each other.
Texts without letters are "unknown". A model is a detector for `lang.detect`: it takes a text and gives language and score.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pieces

#: Buckets of the hash, a power of two; longest n-gram; what each bucket counts beforehand.
BUCKETS, GRAMS, SMOOTH = 1 << 14, 3, 0.5
#: Characters of a text that are looked at at once; longer texts are read in pieces that overlap.
STEP = 1 << 18
OTHER = re.compile(r"[\W\d_]+")
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def buckets(codes: np.ndarray, n: int) -> np.ndarray:
    """The bucket of each n-gram of code points."""
    h = np.zeros(len(codes) - n + 1, np.uint64)
    for k in range(n):
        h = (h ^ codes[k : len(codes) - n + 1 + k]) * FACTORS[n - 1]
        h ^= h >> np.uint64(29)
    return ((h * FACTORS[0]) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def counts(text: str | None) -> np.ndarray:
    """How often each bucket occurs; all are zero for texts without letters."""
    out = np.zeros(BUCKETS, np.int64)
    words = OTHER.sub(" ", (text or "").replace("\0", "").lower()).strip()
    if not words:
        return out
    words = f" {words} "
    for at in range(0, len(words), STEP):
        codes = np.frombuffer(words[at : at + STEP + GRAMS - 1].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        for n in range(1, GRAMS + 1):
            own = codes[: STEP + n - 1]
            if len(own) >= n:
                out += np.bincount(buckets(own, n), minlength=BUCKETS)
    return out


class Model:
    """Labels and their weights, a row for each label."""

    def __init__(self, labels: list[str], weights: np.ndarray):
        self.labels, self.weights = labels, weights

    def shares(self, text: str | None) -> np.ndarray | None:
        """Each label's score; none for a text without letters."""
        own = counts(text)
        n = own.sum()
        if not n or not self.labels:
            return None
        at = own.nonzero()[0]
        z = self.weights[:, at] @ own[at] / np.sqrt(n)
        e = np.exp(z - z.max())
        return e / e.sum()

    def __call__(self, text: str | None) -> tuple[str, float]:
        p = self.shares(text)
        return ("unknown", 0.0) if p is None else (self.labels[int(p.argmax())], float(p.max()))


def fit(sums: dict[str, np.ndarray]) -> Model:
    """A model of the summed counts of each label."""
    labels = sorted(sums)
    rows = [np.log((sums[k] + SMOOTH) / (sums[k].sum() + SMOOTH * BUCKETS)) for k in labels]
    return Model(labels, np.stack(rows) if rows else np.zeros((0, BUCKETS)))


def train(rows: DataFrame, text: str = "text", label: str = "lang") -> Model:
    """A model of all labelled rows. Rows with null labels or texts aren't learnt from; to the driver go BUCKETS sums for each label."""

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for k, t in zip(pieces.values(b.column(0)), pieces.values(b.column(1)), strict=True):
                if k in sums:
                    sums[k] += counts(t)
                else:
                    sums[k] = counts(t)
        for k, own in sums.items():
            at = own.nonzero()[0]
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at], pa.int64())], names=["label", "bucket", "n"])

    own = rows.select(F.col(label).cast("string").alias("label"), F.col(text).cast("string").alias("text")).filter("label is not null and text is not null")
    summed = own.mapInArrow(count, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    sums: dict[str, np.ndarray] = {}
    got: pd.DataFrame = summed.toPandas()
    for k, part in got.groupby("label"):
        sums[k] = np.zeros(BUCKETS, np.int64)
        sums[k][part["bucket"].to_numpy()] = part["n"].to_numpy()
    return fit(sums)
