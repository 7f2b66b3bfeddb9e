"""Crawl archives with damage, in ranges of any size."""

import gzip
import io
import random

import pytest
from pyspark.sql import functions as F

from winnowry.sources import archives, wet

R = random.Random(5)


def record(uri, body, length=None, kind="conversion"):
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nWARC-Date: 2020-01-01\r\nContent-Length: {len(body) if length is None else length}\r\n\r\n".encode() + body + b"\r\n\r\n"


def bodies(n):
    return [bytes(R.choice(b"abc \n") for _ in range(R.choice((0, 5, 300, 3000)))) + b"\x1f\x8b\x08 WARC/1.0" * (k % 3) for k in range(n)]


def damaged():
    """A file of members with damage in its middle, the good uris, and the errors."""
    own = bodies(40)
    own[7] = own[19] = bytes(R.choice(b"abcdefgh \n") for _ in range(4000))
    parts, good = [], []
    for k, body in enumerate(own):
        uri = f"http://a.com/{k}"
        member = gzip.compress(record(uri, body), mtime=0)
        if k == 7:
            member = member[: len(member) // 2] + b"\xff" * 20 + member[len(member) // 2 + 20 :]
        elif k == 13:
            member = gzip.compress(record(uri, body, length="12x"))
        elif k == 19:
            member = gzip.compress(record(uri, body, length=len(body) + 500))
        elif k == 25:
            member = gzip.compress(record(uri, b"first") + record(uri, body, length="") + record(uri, b"after"))
            good += [uri, uri]
        elif k == 30:
            member += b"\0" * 70000
            good.append(uri)
        elif k == 33:  # a record over two members
            whole = record(uri, body)
            member = gzip.compress(whole[:60]) + gzip.compress(whole[60:])
            good.append(uri)
        else:
            good.append(uri)
        parts.append(member)
    return b"".join(parts), good, sorted(["damaged member", "unreadable length", "record ends early", "unreadable length"])


def test_any_ranges_give_each_record_once():
    data, good, errors = damaged()
    for size in (100, 777, 5000, 1 << 20):
        rows = [r for k in range(0, len(data), size) for r in wet.read_range(io.BytesIO(data), len(data), k, min(len(data), k + size))]
        assert [r[1]["warc-target-uri"] for r in rows if r[3] is None] == good
        assert sorted(r[3] for r in rows if r[3]) == errors
    assert all(len(r[2]) == int(r[1]["content-length"]) for r in rows if r[3] is None)


def test_memory_is_bounded_by_a_record():
    """A long member is inflated a piece at a time: what the cutter holds is a record and a piece."""
    data = gzip.compress(b"".join(record(f"http://a.com/{k}", b"x" * 20000) for k in range(2000)))
    most, cut = 0, wet.Records.feed

    def watched(self, piece):
        nonlocal most
        for r in cut(self, piece):
            most = max(most, len(self.held))
            yield r

    wet.Records.feed = watched
    try:
        assert sum(r[3] is None for r in wet.read_range(io.BytesIO(data), len(data), 0, len(data))) == 2000
    finally:
        wet.Records.feed = cut
    assert most < 3 << 20


@pytest.mark.parametrize("opener", [wet.open_any, None])
def test_read_records(spark, tmp_path, opener):
    data, good, errors = damaged()
    (tmp_path / "in" / "a b").mkdir(parents=True)
    (tmp_path / "in" / "a b" / "1.warc.wet.gz").write_bytes(data)
    (tmp_path / "in" / "2.warc.wet.gz").write_bytes(b"".join(record(f"http://b.com/{k}", b"plain") for k in range(3)) + b"WARC/1.0\r\nContent-Length: 9\r\n\r\nx")
    (tmp_path / "in" / "3.warc.wet.gz").write_bytes(b"")
    (tmp_path / "in" / "4.warc.wet.gz").write_bytes(gzip.compress(record("http://c.com/", b"cut"))[:-9])
    (tmp_path / "in" / "5.txt").write_bytes(data)
    found = wet.read_records(spark, str(tmp_path / "in"), size=2000, opener=opener).collect()
    assert sorted(r.target_uri for r in found if r.error is None) == sorted(good + [f"http://b.com/{k}" for k in range(3)])
    assert sorted(r.error for r in found if r.error) == sorted([*errors, "record ends early", "member ends early"])  # a member that isn't whole has no records
    assert archives.read_archives(spark, str(tmp_path / "in")).count() == len(good) + 3
    index = wet.member_index(spark, str(tmp_path / "in"), "1.*", size=1000)
    assert index.agg(F.sum("records"), F.sum("errors")).first()[:] == (len(good), 4)
    archives.register(spark)
    assert spark.read.format("crawl").option("path", str(tmp_path / "in")).option("range", 3000).load().filter("error is null").count() == len(good) + 3


def test_written_records_come_back(spark, tmp_path):
    rows = [(f"http://a.com/{k}", "2020", body) for k, body in enumerate(bodies(30))] + [(None, None, None), ("http://x.com/\r\nWARC-Type: x", "d", b"y")]
    wet.write_records(spark.createDataFrame(rows, "uri string, date string, body binary").coalesce(2), str(tmp_path / "out"), files=9)
    found = wet.read_records(spark, str(tmp_path / "out"), "part-*", size=500).collect()
    assert not [r for r in found if r.error] and len(found) == len(rows)
    assert {(r.target_uri, bytes(r.body)) for r in found} == {(None if u is None else u.replace("\r\n", "  "), b or b"") for u, _, b in rows}
    assert len(list((tmp_path / "out").glob("part-*"))) >= 4
