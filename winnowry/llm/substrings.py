"""Exact removal of repeated substrings by prefix-free parsing.

A rolling hash of every GRAM bytes sets triggers: the trigger of a window of `length` bytes is its gram with the least hash.
A phrase is a maximal run of windows of one trigger with all their bytes, so phrases overlap by length - 1 bytes, each window
lies in exactly one, and equal windows lie in phrases of equal triggers. The parse is the documents' sequence of phrases,
the dictionary the distinct ones. Windows of a phrase that the parse holds twice are repeated. Dictionary phrases of
common triggers are sorted by their suffixes that begin with the trigger, and by their reversed prefixes before it. A window is
so many bytes before its trigger and the rest of `length` from it on, so the LCP arrays of both orders tell which are repeated.
Triggers under which too many phrases lie for one task are compared window by window in a shuffle instead.

Only phrases whose trigger occurs twice move, found with filters of fixed size over all triggers.

Rows are numbered more than once, so the input must be a table as read, stored or cached, not a plan whose row order may change.

Rows: null text is empty; texts under `length` bytes keep all; null, repeated and clashing doc_ids are kept row by row;
further columns are ignored or passed through. Memory: a block of text, or MOST phrases of a trigger.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, ranges, stored, table, text_parts
from .filters import bitmap, has
from .hashing import mix, powers, running, spans_of

LENGTH, GRAM = 200, 64
#: Window starts that one numpy pass works on, so that its arrays stay in the processor's cache.
BLOCK = 1 << 15
#: Bits of a gram's order that hold its place in a block.
PLACES = (1 << 16) - 1
#: Phrases held for counting before they are passed on.
FLUSH = 1 << 20
BITS = 26
#: Phrases of a trigger that one task compares.
MOST = 4096


def least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each width neighbours, by doubling."""
    n, step = len(x) - width + 1, 1
    while step * 2 <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return np.minimum(x[:n], x[width - step :])


def _parsed(part: np.ndarray, good: np.ndarray, length: int, gram: int):
    """trigger, phrase, first window, windows, place of the trigger in the phrase, of a block's phrases; good: which windows lie in one row."""
    sums, (_, down) = running(part), powers(len(part))
    keys = sums[gram:] - sums[:-gram]
    keys *= down[: len(keys)]
    # one round of mix() orders the grams; the low bits are their places, so that of equal grams the first is the least
    order = keys >> np.uint64(32)
    order ^= keys
    order *= np.uint64(0xD6E8FEB86659FD93)
    order &= ~np.uint64(PLACES)
    order |= np.arange(len(order), dtype=np.uint64)
    window = least(order, length - gram + 1)
    changes = np.ones(len(window) + 1, bool)
    np.not_equal(window[1:], window[:-1], out=changes[1:-1])
    # two good windows side by side lie in the same row
    begins, ends = good & changes[:-1], good & changes[1:]
    begins[1:] |= good[1:] & ~good[:-1]
    ends[:-1] |= good[:-1] & ~good[1:]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    place = (window[first] & np.uint64(PLACES)).astype(np.int64)
    return mix(keys[place]), spans_of(sums, first, last + length), first, last - first + 1, place - first


def phrases(text: np.ndarray, at: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """trigger, phrase (64-bit hashes), row, first byte within the row, windows, place of the trigger, of all phrases of rows text[at[k]:at[k + 1]].

    A block is whole rows, or a part of one longer row.
    """
    sizes = np.diff(at)
    windows = np.maximum(sizes - length + 1, 0)
    out = []
    for lo, hi in chunks(at, BLOCK):
        begin, end = int(at[lo]), int(at[hi])
        if end - begin < length:
            continue
        for x in range(begin, end - length + 1, BLOCK):
            part = text[x : min(x + BLOCK + length - 1, end)]
            good = np.ones(len(part), bool) if hi - lo == 1 else np.repeat(np.tile([True, False], hi - lo), np.stack([windows[lo:hi], sizes[lo:hi] - windows[lo:hi]], axis=1).ravel())
            trigger, phrase, first, n, place = _parsed(part, good[: len(part) - length + 1], length, gram)
            first += x
            row = np.searchsorted(at, first, side="right") - 1
            out.append((trigger, phrase, row, first - at[row], n, place))
    if not out:
        z = np.zeros(0, np.int64)
        return z.view(np.uint64), z.view(np.uint64), z, z, z, z
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def trigger_counts(docs: DataFrame, length: int) -> DataFrame:
    """trigger, n: counts of triggers, added up within parts of a partition."""

    def count(batches):
        held, size = [], 0

        def flush():
            v, n = np.unique(np.concatenate(held), return_counts=True)
            for lo in range(0, len(v), 1 << 17):
                yield pa.RecordBatch.from_arrays([_long(v[lo : lo + (1 << 17)]), pa.array(n[lo : lo + (1 << 17)].astype(np.int64))], names=["trigger", "n"])

        for b in batches:
            data, at = text_parts(b.column(0))
            for lo, hi in chunks(at):
                held.append(phrases(data, at[lo : hi + 1], length)[0])
                size += len(held[-1])
                if size > FLUSH:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return docs.select("text").mapInArrow(count, "trigger long, n long")


def occurrences(docs: DataFrame, often: Broadcast, length: int) -> DataFrame:
    """uid, trigger, phrase, at, n of the phrases whose trigger the filter holds."""

    def emit(batches):
        for b in batches:
            data, at = text_parts(b.column(1))
            uid = b.column(0).to_numpy()
            for lo, hi in chunks(at):
                trigger, phrase, row, first, n, _ = phrases(data, at[lo : hi + 1], length)
                own = has(often.value, trigger)
                yield pa.RecordBatch.from_arrays([pa.array(uid[lo + row[own]]), _long(trigger[own]), _long(phrase[own]), pa.array(first[own]), pa.array(n[own])], names=["uid", "trigger", "phrase", "at", "n"])

    return docs.select("uid", "text").mapInArrow(emit, "uid long, trigger long, phrase long, at long, n long")


def exemplar(phrase: np.ndarray, uid: np.ndarray) -> np.ndarray:
    """A key for a phrase in a document."""
    return mix(phrase.view(np.uint64) ^ mix(uid.astype(np.int64).view(np.uint64)))


def exemplars(rows: DataFrame) -> DataFrame:
    """The keys of rows (phrase, uid)."""

    def keys(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([_long(exemplar(b.column(0).to_numpy(), b.column(1).to_numpy()))], names=["key"])

    return rows.select("phrase", "uid").mapInArrow(keys, "key long")


def dictionary(docs: DataFrame, chosen: Broadcast, crowded: Broadcast, length: int) -> DataFrame:
    """Dictionary phrases from the documents chosen for them: kind 0 with their bytes and the trigger's offset, kind 1 as windows (window hash, offset)."""

    def emit(batches):
        seen: set[int] = set()
        for b in batches:
            data, at = text_parts(b.column(1))
            uid = b.column(0).to_numpy()
            for lo, hi in chunks(at):
                trigger, phrase, row, first, n, place = phrases(data, at[lo : hi + 1], length)
                own = np.flatnonzero(has(chosen.value, exemplar(phrase, uid[lo + row])))
                fresh = []
                for i, k in zip(own.tolist(), phrase[own].tolist(), strict=True):
                    if k not in seen:
                        seen.add(k)
                        fresh.append(i)
                if len(seen) > 1_000_000:
                    seen.clear()
                if not fresh:
                    continue
                own = np.array(fresh)
                begin = at[lo : hi + 1][row[own]] + first[own]
                full = has(crowded.value, trigger[own])
                plain = own[~full]
                texts = [data[x : x + m + length - 1].tobytes() for x, m in zip(begin[~full].tolist(), n[plain].tolist(), strict=True)]
                if len(plain):
                    yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(plain), np.int32)), _long(trigger[plain]), _long(phrase[plain]), pa.array(place[plain]), pa.array(texts, pa.binary())], names=["kind", "key", "phrase", "offset", "bytes"])
                for x, i in zip(begin[full].tolist(), own[full].tolist(), strict=True):
                    m = int(n[i])
                    starts = np.arange(m)
                    window = spans_of(running(data[x : x + m + length - 1]), starts, starts + length)
                    yield pa.RecordBatch.from_arrays([pa.array(np.ones(m, np.int32)), _long(window), _long(np.full(m, phrase[i])), pa.array(starts), pa.nulls(m, pa.binary())], names=["kind", "key", "phrase", "offset", "bytes"])

    return docs.select("uid", "text").mapInArrow(emit, "kind int, key long, phrase long, offset long, bytes binary")


def prefix_classes(texts: list[bytes], width: int) -> np.ndarray:
    """classes[d, k]: equal for the texts k whose first d bytes are equal, if they have as many; from the LCP array of the sorted texts."""
    rows = np.array(texts, f"S{width}")
    order = np.argsort(rows)
    cells = rows[order].view(np.uint8).reshape(len(texts), width)
    same = cells[1:] == cells[:-1]
    common = np.where(same.all(axis=1), width, same.argmin(axis=1))
    out = np.zeros((width + 1, len(texts)), np.int32)
    out[:, order[1:]] = np.cumsum(common < np.arange(width + 1)[:, None], axis=1, dtype=np.int32)
    return out


def repeated(texts: list[bytes], places: list[int], length: int) -> list[np.ndarray]:
    """For each of some distinct phrases with triggers at places, which of its windows another one of them also holds.

    Equal windows have their trigger at the same place, so a window is repeated if another phrase has the same bytes from the trigger on to the window's
    end and the same ones before it back to the window's begin. A phrase holds no window twice.
    """
    place, sizes = np.array(places), np.array([len(t) for t in texts])
    after = prefix_classes([t[p:] for t, p in zip(texts, places, strict=True)], length)
    before = prefix_classes([t[:p][::-1] for t, p in zip(texts, places, strict=True)], max(1, int(place.max())))
    windows = sizes - length + 1
    own = np.repeat(np.arange(len(texts)), windows)
    ahead = place[own] - ranges(np.zeros(len(texts), np.int64), windows)  # the window's bytes before the trigger
    key = (ahead * len(texts) + before[ahead, own]) * len(texts) + after[length - ahead, own]
    order = np.argsort(key)
    same = np.zeros(len(key) + 1, bool)
    np.equal(key[order[1:]], key[order[:-1]], out=same[1:-1])
    marks = np.zeros(len(key), bool)
    marks[order] = same[1:] | same[:-1]
    return np.split(marks, np.cumsum(windows)[:-1])


def _runs(marks: np.ndarray) -> list[dict]:
    edge = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
    return [{"lo": x, "hi": y} for x, y in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)]


RUNS = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))


def compared(held: DataFrame, length: int) -> DataFrame:
    """phrase, runs: repeated windows of dictionary phrases with common triggers; whole triggers are sorted together.

    Rows of crowded triggers pass through as window, offset.
    """
    schema = pa.schema([("phrase", pa.int64()), ("runs", RUNS), ("window", pa.int64()), ("offset", pa.int64())])

    def sort(batches):
        own: dict[int, tuple[bytes, int]] = {}
        size, last = 0, None

        def out():
            marks = repeated(*map(list, zip(*own.values(), strict=True)), length)
            names = [k for k, m in zip(own, marks, strict=True) if m.any()]
            n = len(names)
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array([_runs(m) for m in marks if m.any()], RUNS), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], schema=schema)

        for b in batches:
            windows = b.filter(pc.equal(b.column(0), 1))
            if n := windows.num_rows:
                yield pa.RecordBatch.from_arrays([windows.column(2), pa.nulls(n, RUNS), windows.column(1), windows.column(3)], schema=schema)
            plain = b.filter(pc.equal(b.column(0), 0))
            for key, phrase, place, text in zip(*(plain.column(i).to_pylist() for i in (1, 2, 3, 4)), strict=True):
                if key != last and size > 1 << 20:
                    yield from out()
                    own, size = {}, 0
                last = key
                if phrase not in own:
                    own[phrase] = text, place
                    size += len(text)
        if own:
            yield from out()

    return held.repartition("key").sortWithinPartitions("key").mapInArrow(sort, "phrase long, runs array<struct<lo:long,hi:long>>, window long, offset long")


def compared_crowded(found: DataFrame) -> DataFrame:
    """The same for phrases with crowded triggers, by the hashes of their windows."""
    rows = found.filter("window is not null").select("window", "phrase", "offset").distinct()
    many = rows.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").select("window")
    again = rows.join(many, "window").groupBy("phrase").agg(F.array_sort(F.collect_set("offset")).alias("offsets"))
    return again.select("phrase", F.transform("offsets", lambda x: F.struct(x.alias("lo"), (x + 1).alias("hi"))).alias("runs"))


def removals(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """uid and spans (lo, hi) of bytes to remove, for the documents (uid, text) that have any."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    twice = trigger_counts(docs, length).groupBy("trigger").agg(F.sum("n").alias("n")).filter("n > 1").select("trigger")
    found = stored(occurrences(docs, share(bitmap(twice, BITS)), length), "phrases")
    entries = stored(found.groupBy("trigger", "phrase").agg(F.count("*").alias("n"), F.min("uid").alias("uid")), "dictionary")
    # phrases of one trigger are compared only where some of them would else be unique, and read from one document each
    triggers = stored(entries.groupBy("trigger").agg(F.count("*").alias("n"), F.min("n").alias("least")).filter("n > 1 and least = 1"), "triggers")
    chosen = share(bitmap(exemplars(entries.join(triggers.select("trigger"), "trigger", "left_semi")), BITS))
    crowded = share(bitmap(triggers.filter(F.col("n") > MOST).select("trigger"), 20))
    held = stored(compared(dictionary(docs, chosen, crowded, length), length), "compared")
    whole = entries.filter("n > 1").select("phrase", F.lit(None).cast("array<struct<lo:long,hi:long>>").alias("runs"))
    part = held.filter("window is null").select("phrase", "runs").unionByName(compared_crowded(held))
    decided = whole.unionByName(part).groupBy("phrase").agg(F.max(F.col("runs").isNull()).alias("all"), F.first("runs", ignorenulls=True).alias("runs"))
    runs = F.when(F.col("all"), F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.col("n").alias("hi")))).otherwise(F.col("runs"))
    spans = F.transform(runs, lambda r: F.struct((F.col("at") + r["lo"]).alias("lo"), (F.col("at") + r["hi"] + F.lit(length - 1)).alias("hi")))
    return found.join(stored(decided, "decided"), "phrase").select("uid", spans.alias("spans")).groupBy("uid").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _merged(spans: list[dict] | None) -> list[list[int]]:
    out: list[list[int]] = []
    for s in sorted((s["lo"], s["hi"]) for s in spans or []):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return out


def _free(docs: DataFrame, name: str) -> str:
    """name, with underscores until no column of docs has it."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of all documents (doc_id, text)."""

    def sums(batches):
        for b in batches:
            data, at = text_parts(b.column(1))
            rows = []
            for k, (name, spans) in enumerate(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True)):
                cuts, last, raw = _merged(spans), 0, data[at[k] : at[k + 1]]
                kept = hashlib.sha256()
                for x, y in cuts:
                    kept.update(raw[last:x].tobytes())
                    last = y
                kept.update(raw[last:].tobytes())
                rows.append((name, len(raw), sum(y - x for x, y in cuts), len(cuts), kept.hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    own = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cuts = removals(own.select("uid", "text"), length)
    return own.join(cuts, "uid", "left").select("doc_id", "text", "spans").mapInArrow(sums, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs with the repeated bytes cut out of the texts; n_chars, where there, is counted anew.

    Bytes of characters that are cut in part go too.
    """
    names = docs.columns
    where = names.index("text")

    def clean(batches):
        for b in batches:
            texts = b.column(where).to_pylist()
            for k, spans in enumerate(b.column(len(names)).to_pylist()):
                if spans:
                    raw, last, keep = texts[k].encode(), 0, []
                    for x, y in _merged(spans):
                        keep.append(raw[last:x].decode("utf-8", "ignore"))
                        last = y
                    texts[k] = "".join([*keep, raw[last:].decode("utf-8", "ignore")])
            cols = list(b.columns)[: len(names)]
            cols[where] = pa.array(texts, b.schema.field(where).type)
            if "n_chars" in names:
                i = names.index("n_chars")
                cols[i] = pa.array([None if t is None else len(t) for t in texts], b.schema.field(i).type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    uid, spans = _free(docs, "_uid"), _free(docs, "_spans")
    own = docs.withColumn(uid, F.monotonically_increasing_id())
    cuts = removals(own.select(F.col(uid).alias("uid"), F.col("text").cast("string").alias("text")), length).select(F.col("uid").alias(uid), F.col("spans").alias(spans))
    return own.join(cuts, uid, "left").select(*names, spans).mapInArrow(clean, docs.schema)


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))
