"""Merkle manifest of a table: a tree of FAN-ary runs for each source, and one over the sources' roots.

A block is the subtree of SPAN = FAN**LEVELS nodes that are aligned in their source's order. Its nodes are gathered in one
task, which walks the subtree in postorder: each call returns its subtree's digest and, while it unwinds, appends the siblings of each
node of the run to the paths of the leaves below. The blocks' digests are the nodes of the next traversal, until a
source has one node left; those are the leaves of the tree over all sources. Paths are then handed down, from block to leaf.

Order is by range partitions: a node's place is its rank in its partition plus the nodes of its tree in the partitions before,
so that a source of any size is spread over all tasks.

Rows: null fields are "-"; null doc_ids come first; rows of one doc_id are ordered by their leaves, so equal rows are neighbours and the
result doesn't depend on how they are read; a null doc_id is never tampered with; a null source is a source of its own, before the
others; further columns are ignored; an empty table gives no rows. Texts are hashed whole, in their rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

FAN, LEVELS = 16, 3
SPAN = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def joined(digests: list[bytes]) -> bytes:
    """The digest of a run: of its nodes' digests as hexadecimal text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def levels_of(n: int) -> int:
    """How often n nodes are gathered in runs until one is left."""
    k = 0
    while n > 1:
        n, k = -(-n // FAN), k + 1
    return k


def climb(nodes: list[bytes], levels: int) -> tuple[bytes, list[bytes]]:
    """Digest of the subtree over nodes, and each node's path in it.

    A path has for each level, from the leaf up, the run's size, the place in it, and the siblings from left to right.
    """
    paths = [bytearray() for _ in nodes]

    def visit(lo: int, level: int) -> bytes:
        if not level:
            return nodes[lo]
        step = FAN ** (level - 1)
        hi = min(lo + FAN * step, len(nodes))
        run = [visit(x, level - 1) for x in range(lo, hi, step)]
        for i, x in enumerate(range(lo, hi, step)):
            more = bytes([len(run), i]) + b"".join(run[:i] + run[i + 1 :])
            for leaf in range(x, min(x + step, hi)):
                paths[leaf] += more
        return joined(run)

    return visit(0, levels), [bytes(p) for p in paths]


def siblings(path: bytes) -> list[tuple[int, list[bytes]]]:
    """Place and siblings of each level of a path."""
    out, at = [], 0
    while at < len(path):
        n, place = path[at], path[at + 1]
        out.append((place, [path[k : k + 32] for k in range(at + 2, at + 2 + 32 * (n - 1), 32)]))
        at += 2 + 32 * (n - 1)
    return out


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    for place, others in siblings(path):
        leaf = joined([*others[:place], leaf, *others[place:]])
    return leaf


def field(value: Column) -> Column:
    """A value's encoding: its bytes in UTF-8, a colon, the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(row: dict[str, Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*(field(row[c]) for c in FIELDS)).cast("binary"), 256))


def placed(nodes: DataFrame, order: list, name: str) -> DataFrame:
    """nodes (tree, ...) with place, from 0 in each tree by the order, and n, the nodes of the tree."""
    ranged = stored(nodes.repartitionByRange("tree", *order).withColumn("part", F.spark_partition_id()), name)
    counts = ranged.groupBy("tree", "part").agg(F.count("*").alias("own"))  # a row for each tree in each partition
    ahead = Window.partitionBy("tree").orderBy("part")
    starts = counts.select("tree", "part", (F.sum("own").over(ahead) - F.col("own")).alias("before"), F.sum("own").over(Window.partitionBy("tree")).alias("n"))
    rank = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order))
    return ranged.withColumn("rank", rank).join(starts, ["tree", "part"]).withColumn("place", F.col("before") + F.col("rank") - 1).drop("part", "rank", "before")


def blocks(nodes: DataFrame) -> DataFrame:
    """tree, n, place, digest of the blocks over nodes (tree, n, place, digest): n nodes of the tree below, SPAN nodes a block."""

    def gather(key, t):
        n = t.column("n")[0].as_py()
        own = t.sort_by("place").column("digest").to_pylist()
        top, _ = climb(own, min(LEVELS, levels_of(n)))
        return pa.table({"tree": t.column("tree").slice(0, 1), "n": pa.array([-(-n // SPAN)], pa.int64()), "place": pa.array([key[1].as_py()], pa.int64()), "digest": pa.array([top], pa.binary())})

    own = nodes.select("tree", "n", F.col("place").cast("long").alias("place"), "digest", F.floor(F.col("place") / SPAN).alias("block"))
    return own.groupBy("tree", "block").applyInArrow(gather, "tree string, n long, place long, digest binary")


def handed_down(nodes: DataFrame, above: DataFrame, rest: list[tuple[str, str]]) -> DataFrame:
    """nodes (tree, n, place, digest, and the columns `rest`) with top and path: their own in their blocks, followed by their block's.

    above: tree, place, top, path of the blocks.
    """
    names = [c for c, _ in rest]

    def gather(key, t):
        n = t.column("n")[0].as_py()
        t = t.sort_by("place")
        _, paths = climb(t.column("digest").to_pylist(), min(LEVELS, levels_of(n)))
        ends = t.column("above")[0].as_py()
        return t.select(["tree", "place", "digest", *names, "top"]).append_column("path", pa.array([p + ends for p in paths], pa.binary()))

    up = above.select("tree", F.col("place").alias("block"), "top", F.col("path").alias("above"))
    own = nodes.select("tree", "n", F.col("place").cast("long").alias("place"), "digest", *names, F.floor(F.col("place") / SPAN).alias("block")).join(up, ["tree", "block"])
    kinds = ", ".join(["tree string", "place long", "digest binary", *(f"{c} {k}" for c, k in rest), "top binary", "path binary"])
    return own.groupBy("tree", "block").applyInArrow(gather, kinds)


def rising(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of each traversal, leaves first, and the trees' last ones: tree, digest."""
    rounds, most = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:  # SPAN times fewer each time
        rounds.append(stored(blocks(rounds[-1]), name))
        most = -(-most // SPAN)
    # a tree whose one node is left early is passed on: its blocks are of no levels
    return rounds, rounds[-1].select("tree", "digest")


def proofs(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, tampered (null: not), subroot, root and path of each row, digests in binary.

    tampered is the leaf of the row with A-Z of its text in lower case, where 5 divides the CRC-32 of its doc_id.
    """
    own = {c: F.col(c) for c in FIELDS}
    low = own | {"text": F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))  # never null, in the sources' order
    leaves = docs.select(F.col("doc_id").cast("long").alias("doc_id"), tree.alias("tree"), leaf_of(own).alias("digest"), F.when(picked, leaf_of(low)).alias("tampered"), F.monotonically_increasing_id().alias("row"))
    nodes = stored(placed(stored(leaves, "merkle-leaves"), [F.col("doc_id").asc_nulls_first(), "digest", "row"], "merkle-ordered").drop("row"), "merkle-nodes")
    rounds, tops = rising(nodes, "merkle-blocks")
    sources = stored(placed(tops.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest"), ["of"], "merkle-sources"), "merkle-tops")
    upper, last = rising(sources, "merkle-upper")

    above = last.select("tree", F.lit(0).cast("long").alias("place"), F.col("digest").alias("top"), F.lit(b"").alias("path"))
    for k in range(len(upper) - 1, 0, -1):
        above = handed_down(upper[k - 1], above, [("of", "string")] if k == 1 else [])
    if len(upper) == 1:
        above = sources.join(above.select("tree", "top", "path"), "tree")
    above = stored(above.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("place"), F.col("digest").alias("subroot"), "top", "path"), "merkle-roots")
    roots = above.select("tree", "subroot")

    above = above.select("tree", "place", "top", "path")
    for k in range(len(rounds) - 1, 0, -1):
        above = handed_down(rounds[k - 1], above, [("doc_id", "long"), ("tampered", "binary")] if k == 1 else [])
    if len(rounds) == 1:
        above = nodes.join(above.select("tree", "top", "path"), "tree")
    # the sources' roots are few beside the rows, but may be many: a plain join
    return above.join(roots, "tree").select("doc_id", F.col("digest").alias("leaf"), "tampered", "subroot", F.col("top").alias("root"), "path")


CHECKED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def checked(rows: DataFrame) -> DataFrame:
    """The rows of proofs() in hexadecimal, with the digest of each path's siblings, and whether the leaf, tampered with or not, leads to the root."""

    def check(batches):
        for b in batches:
            out = []
            for doc_id, leaf, tampered, subroot, root, path in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                proof = joined([x for _, others in siblings(path) for x in others])
                folded = fold(leaf if tampered is None else tampered, path)
                out.append((doc_id, leaf.hex(), subroot.hex(), root.hex(), proof.hex(), folded.hex(), folded == root))
            if out:
                kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=[x.split()[0] for x in CHECKED.split(", ")])

    return rows.mapInArrow(check, CHECKED)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked(proofs(table(spark, sf_dir, "documents")))
