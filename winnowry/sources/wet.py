"""Crawl archives read in byte ranges, member by member, with what can't be read as rows of their own.

An archive is a row of gzip members, most often one for each record. A range of it is an input partition: its task looks for the first
member that begins there with a record, and reads on from member to member until one begins beyond the range; only what a record still
lacks is read from there. So any cut into ranges gives the same records, each once. A task holds one record and a batch of
bounded size, whatever the file's and the members' sizes.

A member's records count once its checksum is found right; only of members of over BATCH bytes, which no task holds, those before the
damage are given. Damage ends no file. A member that can't be inflated, a length that can't be read and a record that ends early give a row with `error` and the
place of the member, and reading goes on at the next member, or the next record of the same one, that begins well. (A member whose first bytes are
destroyed isn't told from data if it is the first of a range: then its row is missing, but no other's.)

Plain archives without compression are one range each. Zero bytes between members are padding.
"""

from __future__ import annotations

import fnmatch
import gzip
import io
import re
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSourceReader, InputPartition

from ..functions import pieces

SCHEMA = "path string, offset long, warc_type string, content_length long, target_uri string, date string, body binary, error string"
KINDS = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("warc_type", pa.string()), ("content_length", pa.int64()), ("target_uri", pa.string()), ("date", pa.string()), ("body", pa.binary()), ("error", pa.string())])
FIELD = re.compile(rb"^([!-9;-~]+)[ \t]*:[ \t]*(.*?)[ \t]*\r?$", re.M)
MAGIC = b"\x1f\x8b\x08"
#: Bytes of a range, read at a time, of a record's header at most; bytes and rows of a batch; bytes of a task of many ranges.
RANGE, STEP, HEADER, BATCH, ROWS, SHARE = 64 << 20, 1 << 16, 1 << 20, 8 << 20, 4096, 16 << 20


def open_any(path: str) -> BinaryIO:
    """A file in any store that Arrow can open."""
    from pyarrow import fs

    if re.match("file:|/", path):
        return fs.LocalFileSystem().open_input_file(unquote("/" + path.removeprefix("file:").lstrip("/")))
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


class Records:
    """Cuts a stream of bytes into records: feed(data) gives rows (fields, body, error); `inside` tells whether one is begun."""

    def __init__(self) -> None:
        self.held, self.fields, self.size, self.lost = bytearray(), None, 0, False

    @property
    def inside(self) -> bool:
        return self.fields is not None or not self.lost and bool(self.held.strip(b"\r\n \t\0"))

    def drop(self) -> None:
        self.held, self.fields, self.lost = bytearray(), None, False

    def feed(self, data: bytes) -> Iterator[tuple[dict[str, str] | None, bytes, str | None]]:
        self.held += data
        while True:
            if self.fields is not None:
                if len(self.held) < self.size:
                    return
                fields, body = self.fields, bytes(self.held[: self.size])
                del self.held[: self.size]
                self.fields = None
                yield fields, body, None
            if self.lost:  # on to the next line that begins a record
                at = self.held.find(b"\nWARC/1.")
                if at < 0:
                    del self.held[: max(0, len(self.held) - 7)]
                    return
                del self.held[: at + 1]
                self.lost = False
            begin = len(self.held) - len(self.held.lstrip(b"\r\n \t\0"))
            del self.held[:begin]
            if len(self.held) < 7:
                return
            if not self.held.startswith(b"WARC/1."):
                self.lost = True
                yield None, b"", "bytes between records"
                continue
            end = self.held.find(b"\r\n\r\n", 0, HEADER)
            if end < 0:
                if len(self.held) < HEADER:
                    return
                self.lost = True
                yield None, b"", "header without end"
                continue
            fields = {k.lower().decode(): v.decode("utf-8", "replace") for k, v in FIELD.findall(self.held[:end])}
            del self.held[: end + 2]  # a line feed stays before a record that follows at once
            if not re.fullmatch("[0-9]{1,15}", fields.get("content-length", "")):
                self.lost = True
                yield None, b"", "unreadable length"
                continue
            del self.held[:2]
            self.fields, self.size = fields, int(fields["content-length"])


def at_offset(f: BinaryIO, at: int, n: int) -> bytes:
    f.seek(at)
    return f.read(n)


def begins_record(f: BinaryIO, at: int) -> bool:
    """Whether a member with a record at its beginning is at this place."""
    data = at_offset(f, at, STEP)
    if not data.startswith(MAGIC) or len(data) < 10 or data[3] & 0xE0:
        return False
    member, out = zlib.decompressobj(31), b""
    try:
        for k in range(0, len(data), 32):  # what comes later may be damaged
            out = (out + member.decompress(data[k : k + 32])).lstrip(b"\r\n \t\0")
            if len(out) >= 7 or member.eof:
                break
    except zlib.error:
        return False
    return out.startswith(b"WARC/1.")


def next_member(f: BinaryIO, begin: int, end: int) -> int | None:
    """Where the first member from begin on, before end, begins with a record."""
    at = begin
    while at < end:
        data = at_offset(f, at, STEP + 2)
        k = data.find(MAGIC)
        while 0 <= k < min(STEP, end - at):
            if begins_record(f, at + k):
                return at + k
            k = data.find(MAGIC, k + 1)
        at += STEP
    return None


def read_range(f: BinaryIO, length: int, begin: int, end: int) -> Iterator[tuple[int, dict[str, str] | None, bytes, str | None]]:
    """offset, fields, body and error of the records whose members begin in a range of a file of `length` bytes."""
    cut = Records()
    if at_offset(f, 0, 2) != MAGIC[:2]:
        if begin == 0:
            f.seek(0)
            while data := f.read(STEP):
                for r in cut.feed(data):
                    yield 0, *r
            if cut.inside:
                yield 0, None, b"", "record ends early"
        return
    at = next_member(f, begin, end)
    while at is not None and at < length and (at < end or cut.inside):
        head = at_offset(f, at, STEP)
        if head.startswith(b"\0"):
            at += len(head) - len(head.lstrip(b"\0"))
            continue
        if cut.inside and begins_record(f, at):
            cut.drop()
            yield at, None, b"", "record ends early"
            continue
        member, place, failed, waiting, size = zlib.decompressobj(31), at, None, [], 0
        try:
            while not member.eof:
                f.seek(place)
                data = member.unconsumed_tail or f.read(STEP)
                place += 0 if member.unconsumed_tail else len(data)
                if not data:
                    failed = "member ends early"
                    break
                for r in cut.feed(member.decompress(data, 1 << 20)):
                    waiting.append((at, *r))
                    size += len(r[1])
                if size > BATCH:
                    yield from waiting
                    waiting = []
        except zlib.error:
            failed = "damaged member"
        if not failed or size > BATCH:
            yield from waiting
        if failed:
            cut.drop()
            yield at, None, b"", failed
            at = next_member(f, at + 1, length)
        else:
            at = place - len(member.unused_data)
    if cut.inside:
        yield at or length, None, b"", "record ends early"


def batches(path: str, found: Iterator[tuple[int, dict[str, str] | None, bytes, str | None]]) -> Iterator[pa.RecordBatch]:
    """Rows of SCHEMA in batches of bounded size."""
    rows, size = [], 0
    for offset, fields, body, error in found:
        if error is None:
            rows.append((path, offset, fields.get("warc-type"), int(fields["content-length"]), fields.get("warc-target-uri"), fields.get("warc-date"), body, None))
        else:
            rows.append((path, offset, None, None, None, None, None, error))
        size += len(body)
        if size > BATCH or len(rows) >= ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True), KINDS, strict=True)], schema=KINDS)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True), KINDS, strict=True)], schema=KINDS)


def ranges(spark: SparkSession, path: str, pattern: str = "*.gz", size: int = RANGE) -> DataFrame:
    """path, length, begin, end: the ranges of all files below path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", "length").filter("length > 0")
    return files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))).alias("begin")).withColumn("end", F.least(F.col("begin") + size, "length"))


def tasks(found: DataFrame) -> int:
    """How many tasks read the ranges: one for each 16 MB, some for each core at least, and no more than there are ranges. Short ranges share a task."""
    n, size = found.agg(F.count("*"), F.coalesce(F.sum(F.col("end") - F.col("begin")), F.lit(0))).first()
    return max(1, min(n, 100_000, max(4 * found.sparkSession.sparkContext.defaultParallelism, -(-size // SHARE))))


def read_records(spark: SparkSession, path: str, pattern: str = "*.gz", *, size: int = RANGE, opener: Callable[[str], BinaryIO] | None = open_any) -> DataFrame:
    """Rows of SCHEMA of all archives below path: records, and with `error` what can't be read.

    opener opens a file in a task, in a store that all workers reach. None: files are read as a whole by Spark's own reader, from any store that it
    knows, one file a task, each below 2 GB.
    """

    def run(parts):
        for b in parts:
            for p, length, begin, end in zip(*(b.column(c).to_pylist() for c in ("path", "length", "begin", "end")), strict=True):
                with opener(p) as f:
                    yield from batches(p, read_range(f, length, begin, end))

    def run_whole(parts):
        for b in parts:
            for p, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                f = io.BytesIO(content.as_buffer())
                yield from batches(p, read_range(f, f.getbuffer().nbytes, 0, f.getbuffer().nbytes))

    if opener is None:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", "content")
        return files.mapInArrow(run_whole, SCHEMA)
    found = ranges(spark, path, pattern, size)
    return found.repartition(tasks(found)).mapInArrow(run, SCHEMA)


def member_index(spark: SparkSession, path: str, pattern: str = "*.gz", *, size: int = RANGE) -> DataFrame:
    """path, offset, records, errors of each member that has any."""
    return read_records(spark, path, pattern, size=size).groupBy("path", "offset").agg(F.count_if(F.col("error").isNull()).alias("records"), F.count("error").alias("errors"))


class Range(InputPartition):
    def __init__(self, path: str, length: int, begin: int, end: int):
        self.path, self.length, self.begin, self.end = path, length, begin, end


class RangeReader(DataSourceReader):
    """Ranges of the files below a path; files are listed and opened with Arrow."""

    def __init__(self, options: dict):
        self.path, self.pattern, self.size = options["path"], options.get("pattern", "*.gz"), int(options.get("range", RANGE))

    def partitions(self) -> list[Range]:
        from pyarrow import fs

        store, root = (fs.LocalFileSystem(), unquote("/" + self.path.removeprefix("file:").lstrip("/"))) if re.match("file:|/", self.path) else fs.FileSystem.from_uri(self.path)
        kind = "" if isinstance(store, fs.LocalFileSystem) else self.path.split("://")[0] + "://"
        files = [store.get_file_info(root)] if store.get_file_info(root).is_file else store.get_file_info(fs.FileSelector(root, recursive=True))
        own = sorted((f.path, f.size) for f in files if f.is_file and fnmatch.fnmatch(f.base_name, self.pattern))
        return [Range(kind + p, n, k, min(n, k + self.size)) for p, n in own for k in range(0, n, self.size)]

    def read(self, partition: Range):
        with open_any(partition.path) as f:
            yield from batches(partition.path, read_range(f, partition.length, partition.begin, partition.end))


def compressed(record: Column) -> Column:
    """A gzip member of each binary value."""
    return pieces.mapped(lambda v: gzip.compress(v, 6, mtime=0), "binary", pa.binary(), record)


def records_of(rows: DataFrame, length: Column | None = None) -> Column:
    """Conversion records, in binary, of rows (uri, date, body); length: what their headers say, if not the body's."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\r\n\x00]", " "), F.lit("\r\n"))
    body = F.coalesce(rows["body"].cast("binary"), F.lit(b""))
    uri = F.when(rows["uri"].isNotNull(), line("WARC-Target-URI", rows["uri"])).otherwise("")
    size = F.octet_length(body).cast("string") if length is None else length
    header = F.concat(F.lit("WARC/1.0\r\nWARC-Type: conversion\r\n"), uri, line("WARC-Date", F.coalesce(rows["date"], F.lit(""))), F.lit("Content-Type: text/plain\r\nContent-Length: "), size, F.lit("\r\n\r\n"))
    return F.concat(header.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))


def write_members(members: DataFrame, path: str, *, files: int = 100_000) -> None:
    """Writes gzip members (one binary column) to archives below path, zero bytes between them; `files` members a file at most."""
    own = members.select(F.col(members.columns[0]).cast("string").alias("value"))  # the cast keeps the bytes as they are
    own.write.option("lineSep", "\0").option("maxRecordsPerFile", files).text(path)


def write_records(rows: DataFrame, path: str, *, files: int = 100_000) -> None:
    """Writes conversion records of rows (uri, date, body) to archives below path, each in a member of its own."""
    write_members(rows.select(compressed(records_of(rows)).alias("member")), path, files=files)
