"""64-bit simhash as two 32-bit halves, from MD5 of white-space tokens, within each row: nothing is shuffled."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import pieces

BANDS = 4
#: Tokens whose digests a worker keeps.
CACHE = 200_000


def simhash(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, hi, lo of each row, repeated keys too; hi and lo are null where the text is null or has no tokens."""

    def rows(batches):
        known: dict[bytes, bytes] = {}
        for b in batches:
            hi, lo = [], []
            for t in pieces.values(b.column(1)):
                tokens = (t or "").encode().split()
                if len(known) > CACHE:
                    known.clear()
                for x in [x for x in set(tokens) if x not in known]:
                    known[x] = hashlib.md5(x).digest()[:8]
                ones = np.zeros(64, np.int64)
                for at in range(0, len(tokens), 1 << 16):
                    part = tokens[at : at + (1 << 16)]
                    ones += np.unpackbits(np.frombuffer(b"".join(map(known.__getitem__, part)), np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
                word = np.packbits(2 * ones > len(tokens)).tobytes()
                hi.append(int.from_bytes(word[:4], "big") if tokens else None)
                lo.append(int.from_bytes(word[4:], "big") if tokens else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(hi, pa.int64()), pa.array(lo, pa.int64())], names=[key, "hi", "lo"])

    own = docs.select(key, F.col(text).cast("string").alias(text))
    return own.mapInArrow(rows, own.select(key, F.lit(None).cast("long").alias("hi"), F.lit(None).cast("long").alias("lo")).schema)


def hamming(hi: Column, lo: Column, other_hi: Column, other_lo: Column) -> Column:
    return F.bit_count(hi.bitwiseXOR(other_hi)) + F.bit_count(lo.bitwiseXOR(other_lo))


def bands() -> Column:
    """The four 16-bit bands of hi, lo with their numbers; values within two bits agree in two bands at least."""
    parts = [F.shiftright("hi", 16), F.col("hi").bitwiseAND(0xFFFF), F.shiftright("lo", 16), F.col("lo").bitwiseAND(0xFFFF)]
    return F.array(*(F.struct(F.lit(k).alias("band"), p.alias("value")) for k, p in enumerate(parts)))
