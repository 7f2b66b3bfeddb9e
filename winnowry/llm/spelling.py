"""Spelling variants: words one edit apart, found in forward and reversed sorted dictionaries.

Of a word of m letters and one of m or m + 1 that differ by one edit, what stands before and after the edit are m - 1 letters or more, so
that the first m // 2 letters are the same or the last m // 2 are. A forward dictionary, sorted by beginnings, and a reversed one, sorted by
endings, hold each word once for each m that it may meet, and words that share such a half lie in a row: a block, which one
scan of a range reads. A block is subdivided by the same rule: in what its words don't share yet, again
one of the halves is intact. Blocks of over MOST words are subdivided by Spark, into the dictionaries of the next round, until none is
left; the others within the scan, until they hold SMALL words at most or one letter is left, whose place may hold each letter
once. Those are verified pair by pair, and only what a word gains from its block goes on: how many
near words, and which of them is seen most often.

A pair is met once: what shares the first half is met there, and blocks of the last half pass it over.

All letters are below U+0100, so that a word is one byte a letter.

Rows: null and empty texts have no words; a null doc_id counts as an empty one in the digest that picks runs; repeated doc_ids are counted row by
row; further columns are ignored; an empty table gives no rows. Runs of any length are counted; a run's bytes are held by one task.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, cut, ranges, stored, table, text_parts
from .hashing import mix, span_hashes
from .token_store import joined_crc
from .words import LOWER

LETTERS, SEEN, RARE = 5, 3, 97
#: Words of a block that one task may read; words of a block that are verified pair by pair; words that a counting task holds; bytes of a pass.
MOST, SMALL, HELD, PASS = 1 << 14, 12, 200_000, 1 << 22
#: A word's beginning by which no pair is passed over.
ALL = 1 << 30
#: What tells blocks apart: letters of the shorter words; pairs that share a beginning of q letters are met elsewhere; what all begin and, reversed, end with.
KEYS = ["m", "q", "head", "tail"]


def runs(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end bytes of the runs of A-Z, a-z and U+00C0 to U+00FF in the rows, whose bytes are text[at[0]:at[-1]]."""
    own = text[at[0] : at[-1]]
    low = own | 0x20
    wide = own == 0xC3  # U+00C0 to U+00FF are C3 80 to C3 BF
    part = ((low >= 0x61) & (low <= 0x7A) & (own < 0x80)) | wide
    part[1:] |= wide[:-1]
    edge = np.zeros(len(part) + 1, bool)
    edge[at - at[0]] = True
    before, after = np.zeros(len(part), bool), np.zeros(len(part), bool)
    before[1:], after[:-1] = part[:-1], part[1:]
    return np.flatnonzero(part & (~before | edge[:-1])) + at[0], np.flatnonzero(part & (~after | edge[1:])) + 1 + at[0]


_shifts: dict[int, np.ndarray] = {}
CRC = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32)
#: One step of CRC-32 for each byte, without the conditioning at both ends.
STEP = CRC ^ CRC[0]


def shifted(crc: np.ndarray, n: int) -> np.ndarray:
    """What n zero bytes make of CRC-32 registers: the linear part that a beginning adds to the CRC of beginning and end."""
    tables = _shifts.get(n)
    if tables is None:
        x = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
        for _ in range(n):
            x = STEP[x & 0xFF] ^ (x >> np.uint32(8))
        if len(_shifts) < 256:
            _shifts[n] = x
        tables = x
    return tables[0][crc & 0xFF] ^ tables[1][crc >> np.uint32(8) & 0xFF] ^ tables[2][crc >> np.uint32(16) & 0xFF] ^ tables[3][crc >> np.uint32(24)]


def picked(names: np.ndarray, ends: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of a beginning and an end in a row, from theirs and the end's length in bytes."""
    out = np.empty(len(names), np.uint32)
    by = np.argsort(size, kind="stable")
    begins = np.flatnonzero(np.concatenate([[True], size[by][1:] != size[by][:-1]])) if len(by) else by
    for lo, hi in zip(begins, [*begins[1:], len(by)], strict=True):
        own, n = by[lo:hi], int(size[by[lo]])
        out[own] = shifted(names[own], n) ^ ends[own] if n < 4096 else [joined_crc(a, b, n) for a, b in zip(names[own].tolist(), ends[own].tolist(), strict=True)]
    return out


def word_counts(docs: DataFrame, letters: int = LETTERS, rare: int = RARE) -> DataFrame:
    """word, n of docs (doc_id, text): lower-cased runs of `letters` letters or more, each `rare`-th by its digest without one of its letters."""

    def count(batches):
        held: dict[bytes, int] = {}

        def flush():
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            ids = [zlib.crc32(b"%d:" % x) if x is not None else zlib.crc32(b":") for x in b.column(0).to_pylist()]
            data, at = text_parts(b.column(1))
            for lo, hi in chunks(at):
                begin, end = runs(data, at[lo : hi + 1])
                if not len(begin):
                    continue
                base = int(at[lo])
                text = LOWER[data[base : int(at[hi])]]
                keys = span_hashes(text, begin - base, end - base)
                _, first, of = np.unique(keys, return_index=True, return_inverse=True)
                raw = text.tobytes()
                words = [raw[i:j] for i, j in zip((begin[first] - base).tolist(), (end[first] - base).tolist(), strict=True)]
                crcs = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
                size = (end - begin)[first]
                row = np.searchsorted(at[lo : hi + 1], begin, side="right") - 1
                names = np.array(ids[lo:hi], np.uint32)[row]
                digest = picked(names, crcs[of], size[of])
                hit = digest % np.uint32(rare) == 0
                times = np.bincount(of[~hit], minlength=len(words))
                words = [w.decode("utf-8").encode("latin-1") for w in words]
                for w, n in zip(words, times.tolist(), strict=True):
                    if n and len(w) >= letters:
                        held[w] = held.get(w, 0) + n
                for k, h in zip(of[hit].tolist(), digest[hit].tolist(), strict=True):
                    w = words[k]
                    w = w[: h % len(w)] + w[h % len(w) + 1 :]
                    if len(w) >= letters:
                        held[w] = held.get(w, 0) + 1
                if len(held) > HELD:
                    yield flush()
                    held.clear()
        if held:
            yield flush()

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def halves(rows: DataFrame) -> DataFrame:
    """The blocks that blocks are subdivided into: rows (KEYS, word, n) with one more half in head, or in tail."""
    k = F.floor((F.col("m") - F.length("head") - F.length("tail")) / 2).cast("int")
    p, s = F.length("head") + k, F.length("tail") + k
    own = rows.select("*", k.alias("k"), p.alias("p"), s.alias("s"))
    forward = own.select("m", "q", F.substr("word", F.lit(1), F.col("p")).alias("head"), "tail", "word", "n")
    backward = own.select("m", F.least("q", "p").alias("q"), "head", F.substr(F.reverse("word"), F.lit(1), F.col("s")).alias("tail"), "word", "n")
    return forward.unionByName(backward).filter(F.length("head") < F.col("q"))


class Block:
    """Words of some blocks in arrays, one byte a letter, subdivided and verified together."""

    def __init__(self, words: list[bytes], m: np.ndarray, p: np.ndarray, s: np.ndarray, q: np.ndarray, block: np.ndarray):
        self.text = np.frombuffer(b"".join(words), np.uint8)
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.at = np.cumsum(self.size) - self.size
        self.rows = (np.arange(len(words)), m, p, s, q, block)

    def pairs(self):
        """Rows a, b of all near pairs, some at a time."""
        word, m, p, s, q, block = self.rows
        while len(word):
            by = np.argsort(block, kind="stable")
            word, m, p, s, q, block = (x[by] for x in (word, m, p, s, q, block))
            begins = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            count = np.diff(np.append(begins, len(block)))
            short = np.add.reduceat((self.size[word] == m).astype(np.int64), begins)
            small = (count <= SMALL) | (m - p - s < 2)[begins]
            done = (count > 1) & (short > 0) & small
            if done.any():
                yield from self.compared(word, m, q, begins[done], count[done])
            more = np.repeat((count > 1) & (short > 0) & ~small, count)
            word, m, p, s, q, block = (x[more] for x in (word, m, p, s, q, block))
            if not len(word):
                return
            k = (m - p - s) // 2
            head = span_hashes(self.text, self.at[word] + p, self.at[word] + p + k)
            ends = self.at[word] + self.size[word] - s
            tail = span_hashes(self.text, ends - k, ends)
            keys = np.concatenate([mix(mix(block.astype(np.uint64)) + head), mix(mix(block.astype(np.uint64) + np.uint64(1 << 40)) + tail)])
            _, block = np.unique(keys, return_inverse=True)
            word, m = np.tile(word, 2), np.tile(m, 2)
            p, s, q = np.concatenate([p + k, p]), np.concatenate([s, s + k]), np.concatenate([q, np.minimum(q, p + k)])

    def compared(self, word: np.ndarray, m: np.ndarray, q: np.ndarray, begins: np.ndarray, count: np.ndarray):
        """The near pairs of the blocks of rows begins .. begins + count; shorter words with words as long or one letter longer."""
        of = np.repeat(np.arange(len(begins)), count)
        left = ranges(begins, count)
        shorter = self.size[word[left]] == m[left]
        left, of = left[shorter], of[shorter]
        total, lo = np.cumsum(count[of]), 0
        while lo < len(left):
            hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + (1 << 18))))
            a, b = np.repeat(left[lo:hi], count[of[lo:hi]]), ranges(begins[of[lo:hi]], count[of[lo:hi]])
            keep = (self.size[word[b]] > self.size[word[a]]) | (a < b)
            a, b = a[keep], b[keep]
            found = self.near(word[a], word[b], q[a])
            yield word[a[found]], word[b[found]]
            lo = hi

    def near(self, a: np.ndarray, b: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Which of the pairs (size of a, the same or one more of b) are one edit apart, and share a beginning of less than q letters."""
        out = np.zeros(len(a), bool)
        by = np.argsort(self.size[b], kind="stable")
        lo = 0
        while lo < len(by):
            hi = min(len(by), lo + max(1, PASS // 16 // int(self.size[b[by[lo]]] + 1)))
            width = int(self.size[b[by[hi - 1]]])
            while hi > lo + 1 and (hi - lo) * width > PASS // 8:
                hi = lo + (hi - lo + 1) // 2
                width = int(self.size[b[by[hi - 1]]])
            own = by[lo:hi]
            x, y = a[own], b[own]
            least = self.size[x]
            first, last = self.same(self.at[x], self.at[y], least, width, 1), self.same(self.at[x] + least - 1, self.at[y] + self.size[y] - 1, least, width, -1)
            out[own] = (first + last >= least - (self.size[y] == least)) & (first < q[own]) & ~((self.size[y] == least) & (first == least))
            lo = hi
        return out

    def same(self, a: np.ndarray, b: np.ndarray, n: np.ndarray, width: int, way: int) -> np.ndarray:
        """How many letters, n at most, are the same from places a and b on, forward or backward."""
        step = np.arange(width)
        inside = step < n[:, None]
        x = self.text[np.where(inside, a[:, None] + way * step, 0)]
        y = self.text[np.where(inside, b[:, None] + way * step, 0)]
        differ = (x != y) | ~inside
        return np.where(differ.any(axis=1), differ.argmax(axis=1), n)


def scanned(rows: DataFrame) -> DataFrame:
    """word, n_near, form_n, form: what each word gains from each of its blocks; rows of a block lie in a row."""

    def work(words: list[str], ns: np.ndarray, m, p, s, q, block) -> pa.RecordBatch | None:
        raw = [w.encode("latin-1") for w in words]
        got: list[tuple[np.ndarray, np.ndarray]] = list(Block(raw, m, p, s, q, block).pairs())
        if not got:
            return None
        a, b = (np.concatenate(x) for x in zip(*got, strict=True))
        a, b = np.concatenate([a, b]), np.concatenate([b, a])
        if not len(a):
            return None
        order = np.argsort(np.array(raw, object), kind="stable")
        rank = np.empty(len(raw), np.int64)
        rank[order] = np.arange(len(raw))
        by = np.lexsort((rank[b], -ns[b], a))
        a, b = a[by], b[by]
        begins = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        count = np.diff(np.append(begins, len(a)))
        a, b = a[begins].tolist(), b[begins]
        return pa.RecordBatch.from_arrays([pa.array([words[i] for i in a]), pa.array(count, pa.int64()), pa.array(ns[b], pa.int64()), pa.array([words[i] for i in b.tolist()])], names=["word", "n_near", "form_n", "form"])

    def scan(batches):
        held: list[pa.RecordBatch] = []
        size, before = 0, None

        def flush(rows: pa.Table):
            if rows.num_rows:
                m, q, p, s, change = (rows.column(c).to_numpy().astype(np.int64) for c in ("m", "q", "p", "s", "change"))
                found = work(rows.column("word").to_pylist(), rows.column("n").to_numpy(), m, p, s, q, np.cumsum(change))
                if found is not None:
                    yield found

        for b in batches:
            names, change = list(zip(*(b.column(c).to_pylist() for c in KEYS), strict=True)), []
            for x in names:
                change.append(int(x != before))
                before = x
            p, s = (pa.array([len(x[i]) for x in names], pa.int32()) for i in (2, 3))
            held.append(pa.RecordBatch.from_arrays([*(b.column(c) for c in ("m", "q", "word", "n")), p, s, pa.array(change, pa.int8())], names=["m", "q", "word", "n", "p", "s", "change"]))
            size += b.num_rows
            if size < 1 << 16:
                continue
            t = pa.Table.from_batches(held)
            last = np.flatnonzero(t.column("change").to_numpy())
            end = int(last[-1]) if len(last) else 0  # the last block may go on
            yield from flush(t.slice(0, end))
            held, size = t.slice(end).combine_chunks().to_batches(), t.num_rows - end
        if held:
            yield from flush(pa.Table.from_batches(held))

    return rows.select(*KEYS, "word", "n").repartitionByRange(*KEYS).sortWithinPartitions(*KEYS).mapInArrow(scan, "word string, n_near long, form_n long, form string")


def near_words(counts: DataFrame, letters: int = LETTERS, most: int = MOST) -> DataFrame:
    """word, n_near, form, form_n of words with near ones, from words and counts (word, n), stored; form is the near word of largest n."""
    size = F.length("word")
    whole = counts.select(F.explode(F.array(size - 1, size)).alias("m"), F.lit(ALL).alias("q"), F.lit("").alias("head"), F.lit("").alias("tail"), "word", "n").filter(F.col("m") >= letters)
    left, gains = halves(whole), []
    while True:
        left = stored(left, "spelling-blocks")
        big = cut(left.groupBy(*KEYS).agg(F.count("*").alias("words")).filter((F.col("words") > most) & (F.col("m") - F.length("head") - F.length("tail") >= 2)).select(*KEYS))
        if big.isEmpty():
            gains.append(scanned(left))
            break
        gains.append(scanned(left.join(big, KEYS, "left_anti")))
        left = halves(left.join(big, KEYS, "left_semi"))
    total = gains[0]
    for g in gains[1:]:
        total = total.unionByName(g)
    top = F.min_by(F.struct("form", "form_n"), F.struct(-F.col("form_n"), F.col("form")))
    return total.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("top")).select("word", "n_near", "top.form", "top.form_n")


def roots(forms: DataFrame) -> DataFrame:
    """word, root of rows (word, form): forms followed to the last, by jumps that double."""
    now = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        far = now.select(F.col("word").alias("root"), F.col("root").alias("far"))
        new = cut(now.join(far, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")))
        now = new.select("word", "root")
        if new.filter("moved").isEmpty():
            return now


def variants(docs: DataFrame, letters: int = LETTERS, seen: int = SEEN, times: int = 2) -> DataFrame:
    """word, n, n_near, form, form_n, root of the words of docs (doc_id, text) that are seen often enough; a form is seen `times` as often as its word."""
    counts = stored(word_counts(docs, letters).filter(F.col("n") >= seen), "spelling-words")
    near = counts.join(near_words(counts, letters), "word", "left").withColumn("strong", F.coalesce(F.col("form_n") >= times * F.col("n"), F.lit(False)))
    own = stored(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("strong"), F.col("form")).alias("form"), F.when(F.col("strong"), F.col("form_n")).alias("form_n")), "spelling-near")
    last = roots(own.filter("form is not null"))
    return own.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
