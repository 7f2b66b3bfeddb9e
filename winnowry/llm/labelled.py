"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remainder(mod: int):
    """crc32 of doc_id as text, modulo mod."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(mod)).cast("int")


def held_out(mod: int, rest: int):
    """Whether a document is never learnt from; false for null ids, whose labels aren't used either."""
    return F.coalesce(remainder(mod) == rest, F.lit(False))


def sample(labels: DataFrame, label: str, mod: int, rest: int, most: int) -> DataFrame:
    """doc_id, label of `most` labelled ids at most, chosen by a hash of the id, none of them held out.

    Ids with several labels count once, with the largest.
    """
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).filter(F.col("label").isNotNull() & (remainder(mod) != rest))
    once = own.groupBy("doc_id").agg(F.max("label").alias("label"))
    return once.orderBy(F.xxhash64(F.lit(label), "doc_id"), "doc_id").limit(most)


def texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """doc_id, text, label of the chosen rows, whose number is bounded and which so may be broadcast."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.join(F.broadcast(chosen), "doc_id")
