"""Content-addressed store of token ids.

A rolling hash over windows of ids cuts each document's ids into chunks; a chunk's address is a digest of its ids. The store
has three kinds of files: chunks (each address once), recipes (a document's chunks in order) and a manifest in ascending
doc_id order with each document's position, length and the Merkle root over its chunk addresses. Reading checks every
chunk against its address and every document against its root.

Rows: null text is an empty document (its end id alone); null doc_ids sort first; repeated doc_ids are kept row by row, in
the order of the table's files; further columns are ignored; an empty table gives an empty store.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_path, table, text_parts
from .hashing import mix, powers, running
from .packing import vocabulary_path
from .tokens import encoder

ROLL, MEAN, LEAST, MOST = 16, 2048, 512, 8192

ROWS = pa.schema([("kind", pa.string()), ("slot", pa.int64()), ("uid", pa.int64()), ("doc_id", pa.int64()), ("seq", pa.int64()), ("address", pa.binary()), ("n", pa.int64()), ("payload", pa.binary())])
ROWS_SQL = "kind string, slot long, uid long, doc_id long, seq long, address binary, n long, payload binary"


def cuts(ids: np.ndarray, roll: int = ROLL, mean: int = MEAN, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of ids: after windows whose hash is 0 modulo mean, least to most ids apart."""
    n = len(ids)
    if n <= least:
        return [n] if n else []
    sums = running(ids)
    _, down = powers(n)
    found = np.flatnonzero(mix((sums[roll:] - sums[:-roll]) * down[: n + 1 - roll]) % np.uint64(mean) == 0) + roll
    out, at = [], 0
    for c in found.tolist():
        while c - at > most:
            at += most
            out.append(at)
        if c - at >= least:
            at = c
            out.append(at)
    while n - at > most:
        at += most
        out.append(at)
    return out if at == n else [*out, n]


def address(ids: np.ndarray) -> bytes:
    return hashlib.blake2b(np.ascontiguousarray(ids, "<u4").tobytes(), digest_size=16).digest()


def root(leaves: list[bytes]) -> bytes:
    """Merkle root: pairs of digests are hashed level by level, an odd last one moves up."""
    level = [hashlib.blake2b(b"\0" + x, digest_size=16).digest() for x in leaves] or [hashlib.blake2b(b"", digest_size=16).digest()]
    while len(level) > 1:
        level = [hashlib.blake2b(b"\1" + b"".join(level[i : i + 2]), digest_size=16).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def packed(ids: np.ndarray, press) -> bytes:
    """A payload: the width of an id in bytes, then the compressed little-endian ids."""
    kind = "<u2" if not len(ids) or ids.max() < 1 << 16 else "<u4"
    return bytes([int(kind[2])]) + press.compress(ids.astype(kind).tobytes())


def unpacked(payload: bytes, press) -> np.ndarray:
    return np.frombuffer(press.decompress(payload[1:]), f"<u{payload[0]}").astype("<u4")


def write_store(docs: DataFrame, path: str, vocabulary: str, *, end_id: int = 0) -> None:
    """Writes the ids of all documents (doc_id, text), each followed by end_id, to a store at path."""
    spark = docs.sparkSession

    def split(batches):
        import zstandard

        enc, press, seen = encoder(vocabulary), zstandard.ZstdCompressor(level=3), set()
        uid, rows = TaskContext.get().partitionId() << 36, []
        for b in batches:
            data, at = text_parts(b.column(1))
            names = b.column(0).to_pylist()
            for lo, hi, ids, offs in enc.batches(data, at):
                offs = offs.tolist()
                for k in range(hi - lo):
                    own, begin, leaves = np.append(ids[offs[k] : offs[k + 1]], np.uint32(end_id)), 0, []
                    for seq, end in enumerate(cuts(own)):
                        part = own[begin:end]
                        a = address(part)
                        leaves.append(a)
                        rows.append(("recipe", uid, uid, None, seq, a, len(part), None))
                        if a not in seen:
                            if len(seen) > 500_000:
                                seen.clear()
                            seen.add(a)
                            rows.append(("chunk", int.from_bytes(a[:8], "little", signed=True), None, None, None, a, len(part), packed(part, press)))
                        begin = end
                    rows.append(("document", uid, uid, names[lo + k], len(leaves), root(leaves), len(own), None))
                    uid += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ROWS, strict=True)], schema=ROWS)
                rows = []

    def once(batches):
        """Passes each chunk of a partition once; all rows of an address are in one partition."""
        seen = set()
        for b in batches:
            kinds, names = b.column(0).to_pylist(), b.column(5).to_pylist()
            keep = []
            for kind, a in zip(kinds, names, strict=True):
                keep.append(kind != "chunk" or a not in seen)
                if kind == "chunk":
                    seen.add(a)
            yield b.filter(pa.array(keep))

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(split, ROWS_SQL)
    rows.repartition("slot").mapInArrow(once, ROWS_SQL).drop("slot").write.partitionBy("kind").parquet(f"{path}/raw")
    raw = spark.read.schema("uid long, doc_id long, seq long, address binary, n long, payload binary, kind string").parquet(f"{path}/raw")
    named = raw.filter("kind = 'document'").select("doc_id", "uid", F.col("n").alias("n_tokens"), F.col("seq").alias("n_chunks"), F.col("address").alias("root"))
    named.repartitionByRange("doc_id", "uid").withColumn("part", F.spark_partition_id().cast("long")).write.parquet(f"{path}/ordered")
    ordered = spark.read.schema("doc_id long, uid long, n_tokens long, n_chunks long, root binary, part long").parquet(f"{path}/ordered")
    totals = ordered.groupBy("part").agg(F.sum("n_tokens").alias("total"))  # a row for each partition
    before = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    own = F.sum("n_tokens").over(Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "uid"))
    manifest = ordered.withColumn("own", own).join(F.broadcast(before), "part").select("doc_id", "uid", (F.col("before") + F.col("own") - F.col("n_tokens")).alias("start"), "n_tokens", "n_chunks", "root")
    manifest.write.parquet(f"{path}/manifest")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("uid long, doc_id long, seq long, address binary, n long, payload binary, kind string").parquet(f"{path}/raw").filter("kind = 'chunk'").select("address", "n", "payload")


def read_recipes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("uid long, doc_id long, seq long, address binary, n long, payload binary, kind string").parquet(f"{path}/raw").filter("kind = 'recipe'").select("uid", "seq", "address", "n")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id long, uid long, start long, n_tokens long, n_chunks long, root binary").parquet(f"{path}/manifest")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the ids of each document as little-endian 32-bit numbers, checked."""

    def whole(batches):
        import zstandard

        press = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for r in b.to_pylist():
                parts = [unpacked(p["payload"], press) for p in sorted(r["parts"] or [], key=lambda p: p["seq"])]
                if root([address(p) for p in parts]) != r["root"]:
                    raise ValueError(f"document {r['doc_id']} differs from its root")
                out.append((r["doc_id"], r["start"], r["n_tokens"], np.concatenate([np.zeros(0, "<u4"), *parts]).tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["doc_id", "start", "n_tokens", "ids"])

    parts = read_recipes(spark, path).join(read_chunks(spark, path).drop("n"), "address").groupBy("uid").agg(F.collect_list(F.struct("seq", "payload")).alias("parts"))
    return read_manifest(spark, path).join(parts, "uid", "left").select("doc_id", "start", "n_tokens", "root", "parts").mapInArrow(whole, "doc_id long, start long, n_tokens long, ids binary")


POLY = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2) modulo that of CRC-32, bits reversed."""
    out = 0
    for i in range(31, -1, -1):
        if a >> i & 1:
            out ^= b
        b = b >> 1 ^ (POLY if b & 1 else 0)
    return out


def _squares() -> list[int]:
    out = [1 << 30]  # x
    while len(out) < 64:
        out.append(_times(out[-1], out[-1]))
    return out


SQUARES = _squares()


def joined_crc(a: int, b: int, n: int) -> int:
    """CRC-32 of two byte strings in a row from theirs; n: bytes of the second."""
    power, k, bits = 1 << 31, 3, n
    while bits:
        if bits & 1:
            power = _times(SQUARES[k], power)
        bits >>= 1
        k += 1
    return _times(power, a) ^ b


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of each document's ids, from the chunks' contents.

    Each chunk is read, checked and digested once where it lies; only digests move to the documents that use it.
    """

    def digest(batches):
        import zstandard

        press = zstandard.ZstdDecompressor()
        for b in batches:
            names, sums, sizes = b.column(0).to_pylist(), [], []
            for name, p in zip(names, b.column(1).to_pylist(), strict=True):
                data = unpacked(p, press).tobytes()
                if hashlib.blake2b(data, digest_size=16).digest() != name:
                    raise ValueError("a chunk differs from its address")
                sums.append(zlib.crc32(data))
                sizes.append(len(data) // 4)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(sums, pa.int64()), pa.array(sizes, pa.int64())], names=["address", "crc", "size"])

    def combine(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                parts, total, n = sorted(r["parts"] or [], key=lambda p: p["seq"]), 0, 0
                if root([p["address"] for p in parts]) != r["root"] or len(parts) != r["n_chunks"]:
                    raise ValueError(f"document {r['doc_id']} differs from its root")
                for p in parts:
                    total = joined_crc(total, p["crc"], 4 * p["size"]) if n else p["crc"]
                    n += p["size"]
                if n != r["n_tokens"]:
                    raise ValueError(f"document {r['doc_id']} differs in length")
                out.append((r["doc_id"], r["start"], n, total, len(parts)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["doc_id", "start", "n_tokens", "ids_crc32", "n_chunks"])

    sums = read_chunks(spark, path).select("address", "payload").mapInArrow(digest, "address binary, crc long, size long")
    parts = read_recipes(spark, path).join(sums, "address").groupBy("uid").agg(F.collect_list(F.struct("seq", "address", "crc", "size")).alias("parts"))
    return read_manifest(spark, path).join(parts, "uid", "left").select("doc_id", "start", "n_tokens", "n_chunks", "root", "parts").mapInArrow(combine, "doc_id long, start long, n_tokens long, ids_crc32 long, n_chunks long")


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-store")
    write_store(table(spark, sf_dir, "documents"), path, vocabulary_path())
    return read_digests(spark, path)
