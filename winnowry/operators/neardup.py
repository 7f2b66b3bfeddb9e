"""Near duplicates by simhash: exact repeats, pairs within two bits, sorted neighbours, components."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.simhash import bands, hamming
from .graph import components


def first_of_hash(hashes: DataFrame) -> DataFrame:
    """hi, lo, doc_id: the smallest doc_id of each hash, and how many have it; rows without a hash are left out."""
    return hashes.filter("hi is not null").groupBy("hi", "lo").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


def pairs(hashes: DataFrame, most: int = 2) -> DataFrame:
    """a, b, distance: pairs of different hashes' first documents that differ in `most` bits at most, a < b.

    Values within two bits agree in two of the four 16-bit bands, so candidates agree in a pair of bands and share its 32 bits.
    """
    if most > 2:
        raise ValueError("four bands find pairs within two bits")
    own = first_of_hash(hashes).select("doc_id", "hi", "lo", bands().alias("bands"))
    two = [F.concat(F.lit(f"{i}{j}"), F.hex(F.shiftleft(F.get("bands", F.lit(i))["value"], 16).bitwiseOR(F.get("bands", F.lit(j))["value"]))) for i in range(4) for j in range(i + 1, 4)]
    rows = own.select("doc_id", "hi", "lo", F.explode(F.array(*two)).alias("key"))
    left, right = rows.select("key", *(F.col(c).alias(f"l_{c}") for c in ("doc_id", "hi", "lo"))), rows.select("key", *(F.col(c).alias(f"r_{c}") for c in ("doc_id", "hi", "lo")))
    found = left.join(right, "key").filter("l_doc_id < r_doc_id")
    distance = hamming(F.col("l_hi"), F.col("l_lo"), F.col("r_hi"), F.col("r_lo"))
    return found.select(F.col("l_doc_id").alias("a"), F.col("r_doc_id").alias("b"), distance.alias("distance")).filter(F.col("distance") <= most).distinct()


def keep(hashes: DataFrame, most: int = 2) -> DataFrame:
    """doc_id, component, kept: components of pairs and repeats; the smallest doc_id of each is kept, and so are rows without a hash."""
    firsts = first_of_hash(hashes)
    linked = components(pairs(hashes, most))
    named = firsts.join(linked.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("hi", "lo", F.coalesce("component", "doc_id").alias("component"))
    own = hashes.join(named, ["hi", "lo"], "left").withColumn("component", F.coalesce("component", "doc_id"))
    return own.select("doc_id", "component", F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))


def neighbours(hashes: DataFrame, near: int = 3) -> DataFrame:
    """doc_id, distance, near to the one before in the order of (hi, lo, doc_id), over range partitions.

    Only the last row of each partition crosses to the next.
    """
    from ..plans.session import stored

    ranged = stored(hashes.filter("hi is not null").repartitionByRange("hi", "lo", "doc_id").withColumn("part", F.spark_partition_id()), "neighbours")
    order = Window.partitionBy("part").orderBy("hi", "lo", "doc_id")
    ends = ranged.groupBy("part").agg(F.max(F.struct("hi", "lo", "doc_id")).alias("end"))  # a row for each partition
    before = ends.select("part", F.lag("end").over(Window.orderBy("part")).alias("end"))
    own = ranged.select("*", F.lag("hi").over(order).alias("p_hi"), F.lag("lo").over(order).alias("p_lo")).join(F.broadcast(before), "part")
    distance = hamming(F.col("hi"), F.col("lo"), F.coalesce("p_hi", "end.hi"), F.coalesce("p_lo", "end.lo"))
    return own.select("doc_id", distance.alias("distance"), F.coalesce(distance < near, F.lit(False)).alias("near"))


def drop_rows(rows: DataFrame, bad: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(bad.select(*keys), keys, "left_anti")

