"""WARC archives with revisit records.

Headers (id, payload digest, length) are shuffled by digest; of equal payloads of at least `least` bytes the record with the
smallest id is the response, and the others are joined to it as revisits. Archives are written with fresh headers: responses
with their payload, revisits with a reference. Files are plain WARC 1.1, concatenated records, written by Spark's own sink
(whose line separator is the end of a record), so they can lie in any store Spark writes to.

Reading parses the files by Content-Length, checks each payload against its digest, and resolves revisits by joining them to
the responses they refer to.

Rows are numbered more than once, so the input must be a table as read, stored or cached, not a plan whose row order may change.

Rows: a null payload is empty; a null url is an empty target; rows with a null id are responses that none refer to; of rows with
one id and equal payloads the first met is the response, the others revisit it; further columns are ignored; an empty
table gives an empty archive. Memory: one archive file of FILE bytes and RECORDS records, or one longer page, at a time.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, stored, table

#: Bytes and records of an archive file at most; a reader holds one file at a time. Payloads of up to LIMITS bytes share files, longer ones have their own.
FILE, RECORDS, LIMITS = 128 << 20, 2000, (64 << 10, 1 << 20, 16 << 20)
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column: 20 bits at a time from its hex form."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def resolve(headers: DataFrame, least: int = 0) -> DataFrame:
    """row, refers_to of the revisits among headers (row, page_id, digest, bytes); row tells rows apart."""
    own = headers.filter(F.col("page_id").isNotNull() & (F.col("bytes") >= least))
    firsts = own.groupBy("digest", "bytes").agg(F.min(F.struct("page_id", "row")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    # a key of another name: both sides are shuffled for the join, so that Spark can split a digest that many rows have
    firsts = firsts.select(F.concat_ws("/", "digest", "bytes").alias("key"), "first")
    keyed = own.select("row", F.concat_ws("/", "digest", "bytes").alias("key"))
    return keyed.join(firsts, "key").filter(F.col("row") != F.col("first.row")).select("row", F.col("first.page_id").alias("refers_to"), F.col("first.row").alias("refers_row"))


def write_archives(pages: DataFrame, path: str, least: int = 0) -> None:
    """Writes a record for each page (page_id, url, html) to archives at path."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    own = pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), payload.alias("payload"))
    own = own.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("bytes", F.octet_length("payload").cast("long"))
    revisits = stored(resolve(own.select("row", "page_id", "digest", "bytes"), least), "revisits")
    rows = own.join(revisits, "row", "left")
    again = F.col("refers_row").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    name = lambda row: F.concat(F.lit("<urn:x-page-row:"), row.cast("string"), F.lit(">"))
    target = F.regexp_replace("url", r"[\r\n\x00]", " ")
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", name(F.col("row"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", target),
        F.when(F.col("page_id").isNull(), "").otherwise(line("X-Page-ID", F.coalesce(F.col("page_id").cast("string"), F.lit("")))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(again, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", F.coalesce(name(F.col("refers_row")), F.lit(""))), line("X-Refers-To-Page", F.coalesce(F.col("refers_to").cast("string"), F.lit(""))))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(again, "0").otherwise(F.col("bytes").cast("string"))),
        F.lit("\r\n"),
    )
    body = F.when(again, F.lit(b"").cast("binary")).otherwise(F.col("payload"))
    record = F.concat(header.cast("binary"), body).cast("string")  # the cast keeps the bytes as they are
    size = F.when(again, 0).otherwise(F.col("bytes"))
    kind = sum(((size > x).cast("int") for x in LIMITS), F.lit(0))
    lines = rows.select(record.alias("value"), kind.alias("kind"))
    kinds = own.select(sum(((F.col("bytes") > x).cast("int") for x in LIMITS), F.lit(0)).alias("kind")).distinct()
    for k in sorted({0, *(r["kind"] for r in kinds.collect())}):  # few
        most = max(1, min(RECORDS, FILE // (LIMITS[k] if k < len(LIMITS) else FILE)))
        lines.filter(F.col("kind") == k).select("value").write.mode("append").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", most).text(path)


FIELD = re.compile(rb"([!-9;-~]+):[ \t]*(.*?)\r\n")


def records(data: bytes):
    """The header fields and the payload of each record of an archive."""
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/1.", at):
            raise ValueError(f"no record begins at byte {at}")
        end = data.index(b"\r\n\r\n", at) + 4
        fields = {k.lower(): v for k, v in FIELD.findall(data[at:end])}
        size = int(fields[b"content-length"])
        yield fields, data[end : end + size]
        at = end + size
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"no record ends at byte {at}")
        at += 4


HEADS = "id string, page_id long, url string, type string, digest string, refers string, refers_page long, bytes long"


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """id, page_id, url, type, digest, refers, refers_page, bytes (null for revisits), and the payload if asked for."""
    names = [x.split()[0] for x in HEADS.split(", ")] + ["payload"] * payloads
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()] + [pa.binary()] * payloads

    def parse(batches):
        for b in batches:
            for data in b.column(0):
                rows = []
                for f, payload in records(data.as_py()):
                    digest, kind = f[b"warc-payload-digest"].decode().removeprefix("sha1:"), f[b"warc-type"].decode()
                    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"record {f[b'warc-record-id']!r} differs from its digest")
                    number = lambda k, f=f: int(f[k]) if f.get(k) else None
                    row = (f[b"warc-record-id"].decode(), number(b"x-page-id"), f[b"warc-target-uri"].decode("utf-8"), kind, digest, f.get(b"warc-refers-to", b"").decode() or None, number(b"x-refers-to-page"), len(payload) if kind == "response" else None)
                    rows.append((*row, payload) if payloads else row)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(parse, HEADS + (", payload binary" if payloads else ""))


def resolved(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of all records; revisits are joined to responses."""
    heads = stored(read_archives(spark, path), "warc-heads")
    responses = heads.filter("type = 'response'").select(F.col("id").alias("refers"), F.col("bytes").alias("full"), F.col("digest").alias("same"), F.col("page_id").alias("first"))
    plain = heads.filter("type = 'response'").select("page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    again = heads.filter("type <> 'response'").join(responses, "refers", "left")
    wrong = F.raise_error(F.concat(F.lit("no equal response for "), "id"))
    again = again.select("page_id", F.when(F.col("same") == F.col("digest"), F.col("full")).otherwise(wrong.cast("long")).alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), F.col("first").alias("refers_to"))
    return plain.unionByName(again)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return resolved(spark, path)
