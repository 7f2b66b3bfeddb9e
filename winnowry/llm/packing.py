"""Bounded-space online packing of documents into token sequences.

Each partition keeps a fixed number of open windows. A document's ids (with the end id) fill whole windows first; what is
left goes to the open window in which it fits best. When it fits none and no more windows may be opened, the fullest window
is emitted; if that would leave more than `waste` of its space empty, the piece is cut to fill it. Windows still open when a
partition ends are merged: their pieces are dealt into groups of bounded size, and each group is cut into full sequences.

Rows: null text is an empty document (its end id alone); null, repeated and clashing doc_ids are kept row by row; further
columns are ignored; an empty table gives no rows. Memory: the open windows and one batch of text.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table, text_parts
from .tokens import encoder

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, rest boolean, ids binary"
ARROW = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")), ("rest", pa.bool_()), ("ids", pa.binary())])


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


class Windows:
    """The open windows of one partition; closed ones come out as lists of (doc_id, start, ids, doc_tokens)."""

    def __init__(self, size: int, most: int, waste: float):
        self.size, self.most, self.waste = size, most, max(1, int(size * waste))
        self.free: list[tuple[int, int]] = []  # (free ids, window), ascending
        self.held: dict[int, list[tuple]] = {}
        self.next = 0

    def add(self, doc, ids: np.ndarray) -> Iterator[list[tuple]]:
        n, at = len(ids), 0
        while n - at >= self.size:
            yield [(doc, at, ids[at : at + self.size], n)]
            at += self.size
        while at < n:
            left = n - at
            if (i := bisect_left(self.free, (left, -1))) < len(self.free):
                room, w = self.free.pop(i)
                take = left
            elif len(self.held) < self.most:
                room, w, take = self.size, self.next, left
                self.next += 1
                self.held[w] = []
            else:
                room, w = self.free.pop(0)  # the fullest
                take = min(left, room) if room > self.waste else 0
            if take:
                self.held[w].append((doc, at, ids[at : at + take].copy(), n))
            at += take
            if room - take and take == left:
                insort(self.free, (room - take, w))
            else:
                yield self.held.pop(w)

    def rest(self) -> Iterator[list[tuple]]:
        yield from self.held.values()
        self.held, self.free = {}, []


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), ARROW, strict=True)], schema=ARROW)


def _rows(window: list[tuple], number: int, rest: bool, with_ids: bool) -> list[tuple]:
    out, off = [], 0
    for doc, at, ids, n in window:
        out.append((doc, at, len(ids), crc(ids), n, number, off, rest, np.ascontiguousarray(ids, "<u4").tobytes() if rest or with_ids else None))
        off += len(ids)
    return out


def pack(docs: DataFrame, vocabulary: str, *, size: int = 2048, end_id: int = 1, open_windows: int = 64, waste: float = 0.01, group: int = 1 << 12, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids where asked for.

    docs: doc_id, text. waste: the part of a window that may stay empty rather than cut a document. group: leftover pieces
    that are merged at once.
    """

    def place(batches):
        enc, windows = encoder(vocabulary), Windows(size, open_windows, waste)
        number, rows = TaskContext.get().partitionId() << 36, []
        for b in batches:
            data, at = text_parts(b.column(1))
            docs_ = b.column(0).to_pylist()
            for lo, hi, ids, offs in enc.batches(data, at):
                offs = offs.tolist()
                for k in range(hi - lo):
                    own = np.append(ids[offs[k] : offs[k + 1]], np.uint32(end_id))
                    for w in windows.add(docs_[lo + k], own):
                        rows += _rows(w, number, False, with_ids)
                        number += 1
                if len(rows) > 2000:
                    yield _batch(rows)
                    rows = []
        for w in windows.rest():
            rows += _rows(w, number, True, with_ids)
            number += 1
        if rows:
            yield _batch(rows)

    def merge(key, t: pa.Table) -> pa.Table:
        """Cuts a group's leftover pieces into sequences; all but the last are full."""
        t = t.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        rows, number, off = [], -1 - (int(key[0].as_py()) << 36), 0
        for r in t.to_pylist():
            ids, at = np.frombuffer(r["ids"], "<u4"), 0
            while at < len(ids):
                part = ids[at : at + size - off]
                rows.append((r["doc_id"], r["start"] + at, len(part), crc(part), r["doc_tokens"], number, off, False, part.tobytes() if with_ids else None))
                at, off = at + len(part), off + len(part)
                if off == size:
                    number, off = number - 1, 0
        return pa.Table.from_batches([_batch(rows)], schema=ARROW)

    placed = cut(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(place, SCHEMA))
    groups = placed.filter("rest").count() // group + 1
    key = F.pmod(F.xxhash64("sequence_id"), F.lit(groups))
    rest = placed.filter("rest").withColumn("part", key).groupBy("part").applyInArrow(lambda k, t: merge(k, t.drop_columns(["part"])), SCHEMA)
    return placed.filter("not rest").unionByName(rest).drop("rest", *([] if with_ids else ["ids"]))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary_path())
