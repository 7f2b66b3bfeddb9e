"""Clusters of near hashes by a walk over the sorted hashes with a moving anchor, in two passes over range partitions.

The walk: the first row is the anchor. A row within `near` bits of the anchor is a member of its cluster. One that isn't
ends the cluster: the row before it becomes the anchor, and where the row isn't near that either, the row itself is. So the last
member of a cluster may begin the next one, of which it is no member but the anchor.

What a partition does depends on the anchor that comes in only until the first row that isn't near it: then the anchor is that row or the
one before, whatever came in. So a partition sums up as its first different hashes, each with the anchor that is left at the
partition's end if the one that comes in ends at that hash. No anchor outlives a hash over 2 * (near - 1) bits from the first one, so that a
summary is short: there are but 2,081 hashes within two bits of an anchor. Summaries are joined in the partitions' order, a row for each
partition; the second pass walks each partition from the anchor that really comes in.

Rows: those without a hash are in no cluster and are left out; repeated keys are kept row by row; equal hashes are ordered by key; further columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import stored

SUMMARY = "part long, hashes array<long>, outs array<long>, out_keys array<long>, last long, last_key long"
MASK = (1 << 64) - 1
#: Lists of bad rows, and lines of them, that one task writes.
LISTS, LINES = 128, 1 << 20


def close(a: int, b: int, near: int) -> bool:
    return ((a ^ b) & MASK).bit_count() < near


def walk(hashes: list[int], near: int) -> list[int]:
    """The place of each hash's anchor in a walk that begins with the first hash."""
    out = []
    for i, x in enumerate(hashes):
        if not i or not close(hashes[out[-1]], x, near):
            out.append(i - 1 if i and close(hashes[i - 1], x, near) else i)
        else:
            out.append(out[-1])
    return out


def summary(hashes: list[int], near: int) -> tuple[list[int], list[int], bool]:
    """Places of the first different hashes, the place of the anchor that is left if the one that comes in ends there, and whether these are all hashes.

    The first place stands for a walk that begins with the first hash.
    """
    main = walk(hashes, near)
    places, outs, seen = [0], [main[-1]], {hashes[0]}
    for i in range(1, len(hashes)):
        if hashes[i] in seen:
            continue
        seen.add(hashes[i])
        places.append(i)
        at, k = (i - 1 if close(hashes[i - 1], hashes[i], near) else i), i
        while k < len(hashes) and hashes[main[k]] != hashes[at]:  # until the anchor is the main walk's
            k += 1
            if k < len(hashes) and not close(hashes[at], hashes[k], near):
                at = k - 1 if close(hashes[k - 1], hashes[k], near) else k
        outs.append(at if k == len(hashes) or main[-1] == main[k] else main[-1])
        if not close(hashes[0], hashes[i], 2 * near - 1):
            return places, outs, False
    return places, outs, True


def came_in(rows: list[dict], near: int) -> Iterator[tuple[int, int | None, int | None, int | None, int | None]]:
    """part, the anchor (hash, key) that comes into it, and the row before it, from summaries in the partitions' order."""
    anchor: tuple[int, int] | None = None
    before: tuple[int, int] | None = None

    for r in rows:
        yield r["part"], *(anchor or (None, None)), *(before or (None, None))
        first = r["hashes"][0]
        own = anchor
        if own is None or not close(own[0], first, near):
            own = before if before is not None and close(before[0], first, near) else None
        if own is None:
            anchor = r["outs"][0], r["out_keys"][0]
        else:
            end = next((k for k, x in enumerate(r["hashes"]) if not close(own[0], x, near)), None)
            anchor = own if end is None else (r["outs"][end], r["out_keys"][end])
        before = r["last"], r["last_key"]


def clusters(hashes: DataFrame, near: int = 3) -> DataFrame:
    """doc_id, cluster (the doc_id of its anchor), member (false: it is an anchor alone) of rows (doc_id, hi, lo)."""
    if near > 3:
        raise ValueError("summaries are short for anchors within two bits")
    word = F.shiftleft("hi", 32).bitwiseOR(F.col("lo"))
    own = hashes.filter("hi is not null and lo is not null").select(F.col("doc_id").cast("long").alias("key"), "hi", "lo", word.alias("hash"))
    own = stored(own, "cluster-hashes")  # sampling for ranges would compute the hashes once more
    ranged = stored(own.repartitionByRange("hi", "lo", "key").select("key", "hi", "lo", "hash", F.spark_partition_id().cast("long").alias("part")), "cluster-rows")
    order = ["part", "hi", "lo", "key"]
    parts = ranged.repartition("part").sortWithinPartitions(*order)

    def sum_up(batches):
        part, keys, values = None, [], []

        def row():
            places, outs, _ = summary(values, near)
            lists = ([values[i] for i in places], [values[i] for i in outs], [keys[i] for i in outs])
            return pa.RecordBatch.from_arrays([pa.array([part]), *(pa.array([x], pa.list_(pa.int64())) for x in lists), pa.array([values[-1]], pa.int64()), pa.array([keys[-1]], pa.int64())], names=[x.split()[0] for x in SUMMARY.split(", ")])

        for b in batches:
            for p, k, h in zip(*(b.column(c).to_pylist() for c in ("part", "key", "hash")), strict=True):
                if p != part and values:
                    yield row()
                    keys, values = [], []
                part = p
                keys.append(k)
                values.append(h)
        if values:
            yield row()

    def join(t: pa.Table) -> pa.Table:
        rows = sorted(t.drop_columns("one").to_pylist(), key=lambda r: r["part"])
        names = ["part", "anchor", "anchor_key", "before", "before_key"]
        return pa.table([pa.array(c, pa.int64()) for c in zip(*came_in(rows, near), strict=True)], names=names)

    sums = parts.mapInArrow(sum_up, SUMMARY).withColumn("one", F.lit(1))  # a row for each partition
    starts = stored(sums.groupBy("one").applyInArrow(join, "part long, anchor long, anchor_key long, before long, before_key long"), "cluster-starts")

    def again(batches):
        part = value = name = prior = prior_name = None
        for b in batches:
            found = []
            for p, k, h, *start in zip(*(b.column(c).to_pylist() for c in ("part", "key", "hash", "anchor", "anchor_key", "before", "before_key")), strict=True):
                if p != part:
                    part, (value, name, prior, prior_name) = p, start
                member = True
                if value is None or not close(value, h, near):
                    member = prior is not None and close(prior, h, near)
                    value, name = (prior, prior_name) if member else (h, k)
                prior, prior_name = h, k
                found.append((k, name, member))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int64(), pa.int64(), pa.bool_()), strict=True)], names=["doc_id", "cluster", "member"])

    placed = ranged.join(F.broadcast(starts), "part").repartition("part").sortWithinPartitions(*order)
    return placed.select("part", "key", "hash", "anchor", "anchor_key", "before", "before_key").mapInArrow(again, "doc_id long, cluster long, member boolean")


def bad_rows(found: DataFrame, rows_per_file: int | None = None) -> DataFrame:
    """file, row_no of the members of clusters(), which repeat their anchor; with rows_per_file, files hold so many ids each, else found has file and row_no."""
    own = found.filter("member")
    if rows_per_file is not None:
        own = own.select(F.floor(F.col("doc_id") / rows_per_file).cast("long").alias("file"), F.pmod("doc_id", F.lit(rows_per_file)).cast("long").alias("row_no"))
    return own.select("file", "row_no")


def write_bad_rows(rows: DataFrame, path: str) -> None:
    """The numbers of bad rows (file, row_no) as ascending lines, below file=<file>; a file's list is in as many parts as it needs.

    A list takes as long to open as thousands of its lines to write, so tasks are as many as the lists ask for, however few bytes they hold.
    """
    own = stored(rows.select("file", "row_no"), "bad-row-numbers")
    lists, lines = own.agg(F.count_distinct("file"), F.count("*")).first()
    ordered = own.repartitionByRange(max(1, -(-lists // LISTS), -(-lines // LINES)), "file", "row_no").sortWithinPartitions("file", "row_no")
    ordered.select(F.col("row_no").cast("string").alias("value"), "file").write.partitionBy("file").text(path)


def read_bad_rows(spark, path: str) -> DataFrame:
    own = spark.read.option("basePath", path).text(path)
    file = F.col("file") if "file" in own.columns else F.lit(None)  # no lists, where no row is bad
    return own.select(file.cast("long").alias("file"), F.col("value").cast("long").alias("row_no"))
