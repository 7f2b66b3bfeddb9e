"""Benchmark decontamination with an FM-index of each shard of the documents.

Words are numbered by the benchmark's vocabulary; runs of words that it lacks are one separator. Each shard's symbols are
suffix-sorted, and its Burrows-Wheeler transform is kept in a wavelet matrix. All test windows are searched backwards at
once with ranks in the matrix; occurrences are located by walking to sampled suffix positions; the spans they cover are
merged for each document.

The benchmark is read in blocks of bounded size, each broadcast in turn; with one block, documents are read once.

Rows are numbered more than once, so the input must be a table as read, stored or cached, not a plan whose row order may change.

Rows: null or wordless text has no words and no hits; items without words have no windows; items with a null id count
for hits but aren't listed; repeated ids and rows are kept; further columns are ignored or passed through. Memory: one
batch of text and the index of one shard.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, ranges, table, text_parts
from .words import ALNUM, LOWER, hashes, spans

WINDOW = 10
#: Words of a shard.
SHARD = 1 << 20
#: Bytes of benchmark text in a block.
BLOCK = 8 << 20
SAMPLE = 8


class Windows:
    """The distinct word windows of a block of items, as arrays of symbols from 1 up."""

    def __init__(self, items: list[tuple[int | None, str | None]], width: int = WINDOW):
        data, at = text_parts(pa.array([t for _, t in items], pa.string()))
        lower = LOWER[data]
        begin, end = spans(lower, at, ALNUM)
        keys = hashes(lower, begin, end)
        self.vocabulary, symbols = np.unique(keys, return_inverse=True)
        symbols += 1
        first = np.searchsorted(begin, at)
        found: dict[tuple, set] = {}
        for k, (name, _) in enumerate(items):
            own = symbols[first[k] : first[k + 1]].tolist()
            for i in range(max(0, len(own) - width) + 1 if own else 0):
                names = found.setdefault(tuple(own[i : i + width]), set())
                if name is not None:
                    names.add(name)
        self.lens = np.array([len(w) for w in found], np.int64)
        self.grid = np.zeros((len(found), width), np.int64)
        for k, w in enumerate(found):
            self.grid[k, width - len(w) :] = w
        self.names = [sorted(x) for x in found.values()]


class Bits:
    """A bit vector with ranks."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        words = np.zeros((n // 64 + 1) * 8, np.uint8)
        packed = np.packbits(bits, bitorder="little")
        words[: len(packed)] = packed
        self.words = words.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        w = i >> 6
        return self.before[w] + np.bitwise_count(self.words[w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)))

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0


class Wavelet:
    """A wavelet matrix: ranks of and access to symbols."""

    def __init__(self, text: np.ndarray, bits: int):
        self.levels, self.zeros, self.bits = [], [], bits
        for k in range(bits - 1, -1, -1):
            bit = (text >> k) & 1 != 0
            self.levels.append(Bits(bit))
            zero = text[~bit]
            self.zeros.append(len(zero))
            text = np.concatenate([zero, text[bit]])

    def rank(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol is before each place."""
        lo = np.zeros_like(i)
        for k, (level, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            one = (symbols >> (self.bits - 1 - k)) & 1 != 0
            a, b = level.rank(lo), level.rank(i)
            lo, i = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, i - b)
        return i - lo

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it is before."""
        symbol, lo = np.zeros_like(i), np.zeros_like(i)
        for level, zeros in zip(self.levels, self.zeros, strict=True):
            one = level.get(i)
            a, b = level.rank(lo), level.rank(i)
            lo, i = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, i - b)
            symbol = symbol * 2 + one
        return symbol, i - lo


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of text in order. Symbol 0 stands for separators, of which each is a symbol of its own."""
    n = len(text)
    gaps = text == 0
    key = text + int(gaps.sum())
    key[gaps] = np.arange(int(gaps.sum()))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = start, -1
    single = fresh & np.append(fresh[1:], True)
    todo, step = np.flatnonzero(~single), 1  # places in the order whose suffixes aren't told apart yet
    while len(todo):
        own = order[todo]
        key = rank[own] * (n + 1) + rank[np.minimum(own + step, n)] + 1
        by = np.argsort(key, kind="stable")
        own, key = own[by], key[by]
        order[todo] = own
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        rank[own] = np.maximum.accumulate(np.where(fresh, todo, 0))
        todo = todo[~(fresh & np.append(fresh[1:], True))]
        step *= 2
    return order


class FMIndex:
    """Of symbols 1 .. most, with 0 as separator; the text ends with a separator."""

    def __init__(self, text: np.ndarray, most: int):
        order = suffix_order(text)
        self.last = np.cumsum(np.bincount(text, minlength=most + 2)) - np.bincount(text, minlength=most + 2)
        back = text[order - 1]  # what stands before the first symbol is the last, a separator
        self.tree = Wavelet(back, max(1, int(most).bit_length()))
        marked = (order % SAMPLE == 0) | (back == 0)
        self.marks, self.samples = Bits(marked), order[marked]
        self.n = len(text)

    def search(self, grid: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window, the range of the order whose suffixes begin with it. Windows stand at the right of grid."""
        lo, hi = np.zeros(len(grid), np.int64), np.full(len(grid), self.n, np.int64)
        for k in range(grid.shape[1]):
            on = np.flatnonzero((lens > k) & (lo < hi))
            if not len(on):
                break
            c = grid[on, grid.shape[1] - 1 - k]
            lo[on], hi[on] = self.last[c] + self.tree.rank(c, lo[on]), self.last[c] + self.tree.rank(c, hi[on])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The places in the text of rows of the order."""
        rows = rows.copy()
        out, todo, steps = np.zeros(len(rows), np.int64), np.arange(len(rows)), 0
        while len(todo):
            here = self.marks.get(rows[todo])
            done = todo[here]
            out[done] = self.samples[self.marks.rank(rows[done])] + steps
            todo = todo[~here]
            if len(todo):
                symbol, before = self.tree.access(rows[todo])
                rows[todo] = self.last[symbol] + before
            steps += 1
        return out


def occurrences(symbols: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Places in symbols where windows occur, and the windows' numbers, one shard after another."""
    width, places, which = windows.grid.shape[1], [], []
    for lo in range(0, len(symbols), SHARD):
        own = symbols[lo : lo + SHARD + width - 1]
        keep = own > 0
        keep[1:] |= own[:-1] > 0  # the first separator of each run
        where = np.flatnonzero(keep)
        if not (own > 0).any():
            continue
        index = FMIndex(np.append(own[where], 0), len(windows.vocabulary))
        a, b = index.search(windows.grid, windows.lens)
        hit = np.flatnonzero(a < b)
        if len(hit):
            at = where[index.locate(ranges(a[hit], b[hit] - a[hit]))]
            kind = np.repeat(hit, b[hit] - a[hit])
            fresh = at < SHARD  # the others begin in the next shard
            places.append(at[fresh] + lo)
            which.append(kind[fresh])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(which)


def scan(data: np.ndarray, at: np.ndarray, windows: Windows):
    """For each row: words, hit words, the items that hit, and the spans of bytes to remove."""
    for lo, hi in chunks(at, 3 << 20):
        own = at[lo : hi + 1]
        a, z = int(own[0]), int(own[-1])
        lower = LOWER[data[a:z]]
        begin, end = spans(lower, own - a, ALNUM)
        first = np.searchsorted(begin, own - a)
        keys = hashes(lower, begin, end)
        symbols = np.zeros(len(keys) + hi - lo, np.int64)
        if len(windows.vocabulary):
            place = np.searchsorted(windows.vocabulary, keys)
            place[place == len(windows.vocabulary)] = 0
            row = np.searchsorted(first[1:], np.arange(len(keys)), side="right")
            symbols[np.arange(len(keys)) + row] = np.where(windows.vocabulary[place] == keys, place + 1, 0)
        places, which = occurrences(symbols, windows) if len(windows.vocabulary) else (np.zeros(0, np.int64),) * 2
        cover = np.zeros(len(symbols) + 1, np.int64)
        np.add.at(cover, places, 1)
        np.add.at(cover, places + windows.lens[which], -1)
        hit = np.cumsum(cover[:-1]) > 0
        doc_of = np.searchsorted(first[1:] + np.arange(1, hi - lo + 1), places, side="right")
        items: dict[int, set] = {}
        for d, w in set(zip(doc_of.tolist(), which.tolist(), strict=True)):
            items.setdefault(d, set()).update(windows.names[w])
        for k in range(hi - lo):
            f, g = int(first[k]), int(first[k + 1])
            marks = hit[f + k : g + k]
            cuts = []
            if k in items or marks.any():
                edge = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
                cuts = [(int(begin[f + i]) + a - int(own[k]), int(end[f + j - 1]) + a - int(own[k])) for i, j in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]
            yield lo + k, g - f, int(marks.sum()), items.get(k, set()), cuts


def blocks(benchmark: DataFrame, limit: int = BLOCK):
    """The items in lists of about limit bytes."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // limit + 1
    for k in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r[0], r[1]) for r in part.collect()]


FOUND = "uid long, doc_id long, n_words long, items array<long>, spans array<struct<begin:long,end:long>>, n_hit long"
FOUND_ARROW = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("items", pa.list_(pa.int64())), ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), ("n_hit", pa.int64())])


def find(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """uid, doc_id, n_words, items, spans of bytes and n_hit of each document, for each block of the benchmark in turn."""
    sc = docs.sparkSession.sparkContext
    out = None
    for items in blocks(benchmark):
        windows = sc.broadcast(Windows(items, width))

        def search(batches, windows=windows):
            for b in batches:
                data, at = text_parts(b.column(2))
                uids, names, rows = b.column(0).to_pylist(), b.column(1).to_pylist(), []
                for k, n, n_hit, found, cuts in scan(data, at, windows.value):
                    rows.append((uids[k], names[k], n, sorted(found), [{"begin": x, "end": y} for x, y in cuts], n_hit))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), FOUND_ARROW, strict=True)], schema=FOUND_ARROW)

        part = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(search, FOUND)
        out = part if out is None else out.unionByName(part)
    return out


def report(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each document."""

    def sums(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                names = sorted({str(x) for x in r["items"]})
                rows.append((r["doc_id"], r["n_words"], r["n_hit"], len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), r["n_hit"] > 0))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()), strict=True)], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    found = find(docs, benchmark, width)
    if (benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0) >= BLOCK:  # several blocks: spans of one document meet
        found = merged(docs, found)
    return found.mapInArrow(sums, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def merged(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row for each document from those of all blocks; n_hit counts the words of the merged spans in its text."""

    def join(key, t):
        rows = t.to_pylist()
        cuts = sorted((s["begin"], s["end"]) for r in rows for s in r["spans"])
        out: list[list[int]] = []
        for x, y in cuts:
            if out and x <= out[-1][1]:
                out[-1][1] = max(out[-1][1], y)
            else:
                out.append([x, y])
        text = np.frombuffer((rows[0]["text"] or "").encode(), np.uint8)
        lower = LOWER[text]
        begin, _ = spans(lower, np.array([0, len(text)]), ALNUM)
        hit = sum(int(np.searchsorted(begin, y) - np.searchsorted(begin, x)) for x, y in out)
        own = (rows[0]["uid"], rows[0]["doc_id"], rows[0]["n_words"], sorted({i for r in rows for i in r["items"]}), [{"begin": x, "end": y} for x, y in out], hit)
        return pa.Table.from_arrays([pa.array([c], f.type) for c, f in zip(own, FOUND_ARROW, strict=True)], schema=FOUND_ARROW)

    texts = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("text").cast("string").alias("text"))
    return found.join(texts, "uid").groupBy("uid").applyInArrow(join, FOUND)


def remove(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """docs with the words of test windows cut out of the texts; n_chars, where there, is counted anew.

    All blocks of the benchmark are searched in the texts as they came; their spans are carried along and cut at the end.
    """
    names, schema = docs.columns, docs.schema
    where, kind = names.index("text"), pa.list_(pa.int64())
    held = "spans"
    while held.lower() in {c.lower() for c in names}:
        held += "_"
    out = docs.withColumn(held, F.lit(None).cast("array<long>"))
    wide = out.schema
    parts = blocks(benchmark)
    items = next(parts)
    while items is not None:
        windows, after = docs.sparkSession.sparkContext.broadcast(Windows(items, width)), next(parts, None)

        def search(batches, windows=windows, last=after is None):
            for b in batches:
                data, at = text_parts(b.column(where))
                found = b.column(len(names)).to_pylist()
                for k, _, n_hit, _, cuts in scan(data, at, windows.value):
                    if n_hit:
                        found[k] = [*(found[k] or []), *(x for c in cuts for x in c)]
                if last:
                    yield clean(b, found)
                else:
                    yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(found, kind)], names=[*names, held])

        def clean(b, found):
            texts = b.column(where).to_pylist()
            for k, own in enumerate(found):
                if own:
                    raw, end, keep = texts[k].encode(), 0, []
                    part = ALNUM[LOWER[np.frombuffer(raw, np.uint8)]]
                    for x, y in joined(sorted(zip(own[::2], own[1::2], strict=True)), part):
                        keep.append(raw[end:x])
                        end = y
                    texts[k] = b"".join([*keep, raw[end:]]).decode("utf-8")
            cols = list(b.columns[: len(names)])
            cols[where] = pa.array(texts, b.schema.field(where).type)
            if "n_chars" in names:
                i = names.index("n_chars")
                cols[i] = pa.array([None if t is None else len(t) for t in texts], b.schema.field(i).type)
            return pa.RecordBatch.from_arrays(cols, names=names)

        out = out.mapInArrow(search, schema if after is None else wide)
        items = after
    return out


def joined(cuts: list[tuple[int, int]], part: np.ndarray) -> list[list[int]]:
    """Spans, in order, with those that meet or have no word between them made one; part tells which bytes are of words."""
    out: list[list[int]] = []
    for x, y in cuts:
        if out and (x <= out[-1][1] or not part[out[-1][1] : x].any()):
            out[-1][1] = max(out[-1][1], y)
        else:
            out.append([x, y])
    return out


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
