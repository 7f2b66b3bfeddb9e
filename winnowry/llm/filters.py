"""Filters of fixed size over 64-bit keys: no false negatives; keys beyond what the bits tell apart cost time, not results."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """A filter of the only column of keys, a well mixed long; 2**bits bits reach the driver, whatever the keys' number."""
    name = keys.columns[0]
    slots = keys.filter(F.col(name).isNotNull()).select(F.shiftrightunsigned(name, 64 - bits).alias("slot")).distinct()

    def unite(key, t):
        part = np.zeros(1 << 16, bool)
        part[t.column("slot").to_numpy() & 0xFFFF] = True
        return pa.table({"cell": pa.array([key[0].as_py()], pa.int64()), "part": pa.array([np.packbits(part).tobytes()], pa.binary())})

    whole = np.zeros((1 << (bits - 16), 1 << 13), np.uint8)
    cells = slots.withColumn("cell", F.shiftright("slot", 16)).groupBy("cell").applyInArrow(unite, "cell long, part binary")
    for r in cells.toLocalIterator():
        whole[r["cell"]] = np.frombuffer(r["part"], np.uint8)
    return whole.reshape(-1)


def has(whole: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the unsigned keys the filter may hold."""
    shift = 64 - (len(whole) * 8 - 1).bit_length()
    i = (keys >> np.uint64(shift)).astype(np.int64)
    return (whole[i >> 3] >> (7 - (i & 7)).astype(np.uint8)) & 1 != 0
