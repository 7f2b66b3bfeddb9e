"""Near duplicates across runs: hashes that arrive in batches meet all that came before, by keyed state of band pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.simhash import bands, simhash
from ..operators.graph import components

LINK = "hi long, lo long, other_hi long, other_lo long, distance int"
PAIRS = [(i, j) for i in range(4) for j in range(i + 1, 4)]
#: Parts of the values of a band pair. Not to be changed between runs on the same checkpoint.
PARTS = 256


def links(stream: DataFrame, most: int = 2) -> DataFrame:
    """Pairs of different hashes within `most` bits, once each, of a stream of rows (hi, lo): the one that came later first.

    Values within two bits agree in two of the four 16-bit bands. State is keyed by a band pair and a part of its values, so that a call meets many rows
    at once, and holds the different hashes seen in that part, 8 bytes each; a pair is given under the first band pair that it agrees in.
    """
    if most > 2:
        raise ValueError("four bands find pairs within two bits")
    own = stream.filter("hi is not null and lo is not null").select("hi", "lo", bands().alias("bands"))
    keys = [F.struct(F.lit(k).alias("pair"), F.shiftleft(F.get("bands", F.lit(i))["value"], 16).bitwiseOR(F.get("bands", F.lit(j))["value"]).alias("value")) for k, (i, j) in enumerate(PAIRS)]
    rows = own.select("hi", "lo", F.explode(F.array(*keys)).alias("k")).select("k.pair", F.pmod(F.hash("k.value"), F.lit(PARTS)).alias("part"), "hi", "lo")

    def meet(key, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        seen = np.frombuffer(state.get[0], np.uint64) if state.exists else np.zeros(0, np.uint64)
        new = [p["hi"].to_numpy(np.uint64) << np.uint64(32) | p["lo"].to_numpy(np.uint64) for p in parts]
        fresh = np.setdiff1d(np.concatenate([seen[:0], *new]), seen)
        for x, y in near(seen, fresh, key[0], most):
            low = np.uint64(0xFFFFFFFF)
            columns = {"hi": x >> np.uint64(32), "lo": x & low, "other_hi": y >> np.uint64(32), "other_lo": y & low}
            yield pd.DataFrame({**{k: v.astype(np.int64) for k, v in columns.items()}, "distance": np.bitwise_count(x ^ y).astype(np.int32)})
        if len(fresh):
            state.update((np.concatenate([seen, fresh]).tobytes(),))

    return rows.groupBy("pair", "part").applyInPandasWithState(meet, LINK, "seen binary", "append", "NoTimeout")


def equal_bands(differ: np.ndarray, pair: int) -> np.ndarray:
    """Where differences are none in both bands of a pair."""
    i, j = PAIRS[pair]
    return differ & np.uint64(0xFFFF << (48 - 16 * i) | 0xFFFF << (48 - 16 * j)) == 0


def near(seen: np.ndarray, fresh: np.ndarray, pair: int, most: int, step: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within `most` bits of fresh hashes and seen ones, or fresh ones before them, whose first band pair in which they agree is `pair`; in pieces of about `step` comparisons."""
    i, j = PAIRS[pair]
    values = np.concatenate([seen, fresh])
    part = (values >> np.uint64(48 - 16 * i) & np.uint64(0xFFFF)) << np.uint64(16) | values >> np.uint64(48 - 16 * j) & np.uint64(0xFFFF)
    order = np.argsort(part, kind="stable")  # within a value of the band pair those seen come first
    values, part, old = values[order], part[order], order < len(seen)
    first = np.searchsorted(part, part)  # where each row's group begins
    rows = (~old).nonzero()[0]
    before = rows - first[rows]
    rows, before = rows[before > 0], before[before > 0]
    at = 0
    while at < len(rows):
        end = max(at + 1, int(np.searchsorted(np.cumsum(before[at : at + step]), step, side="right")) + at)
        x, n = rows[at:end], before[at:end]
        left = np.repeat(x, n)
        right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[x], n)
        differ = values[left] ^ values[right]
        keep = np.bitwise_count(differ) <= most
        for k in range(pair):
            keep &= ~equal_bands(differ, k)
        if keep.any():
            yield values[left[keep]], values[right[keep]]
        at = end


def run(spark, source: str, schema: str, target: str, files: int = 100) -> None:
    """Hashes the rows (doc_id, text) of the parquet files that are new below source, and adds hashes and links below target, until none are left.

    Hashes and links are streams of their own, each with its checkpoint; another run goes on where the last one ended.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    first = simhash(reader.parquet(source)).writeStream.format("parquet").option("path", f"{target}/hashes").option("checkpointLocation", f"{target}/state-hashes").trigger(availableNow=True).start()
    first.awaitTermination()
    hashes = spark.readStream.schema("doc_id long, hi long, lo long").parquet(f"{target}/hashes")
    second = links(hashes).writeStream.format("parquet").option("path", f"{target}/links").option("checkpointLocation", f"{target}/state-links").trigger(availableNow=True).start()
    second.awaitTermination()


def pairs(hashes: DataFrame, found: DataFrame) -> DataFrame:
    """a, b, distance as operators.neardup.pairs gives them: links between the first documents of their hashes."""
    first = hashes.filter("hi is not null").groupBy("hi", "lo").agg(F.min("doc_id").alias("doc_id"))
    one = first.select("hi", "lo", F.col("doc_id").alias("x"))
    two = first.select(F.col("hi").alias("other_hi"), F.col("lo").alias("other_lo"), F.col("doc_id").alias("y"))
    return found.join(one, ["hi", "lo"]).join(two, ["other_hi", "other_lo"]).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "distance")


def keep(hashes: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, component, kept of all rows so far, as operators.neardup.keep gives them."""
    first = hashes.filter("hi is not null").groupBy("hi", "lo").agg(F.min("doc_id").alias("first"))
    linked = components(pairs(hashes, found)).withColumnRenamed("id", "first")
    named = first.join(linked, "first", "left").select("hi", "lo", F.coalesce("component", "first").alias("component"))
    own = hashes.join(named, ["hi", "lo"], "left").withColumn("component", F.coalesce("component", "doc_id"))
    return own.select("doc_id", "component", F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))
