"""Batch scoring: pieces of many documents packed into batches of one size within each task, and scores brought back to their documents.

A document is cut into pieces (fixed windows of its tokens, or whole sentences), each piece becomes a window of [CLS], its tokens and [SEP] in
three planes: ids, token types, and which places are filled. A batch is full whatever documents its windows are of; a task holds one batch, and
the documents that wait for it.

Rows: null and empty texts have no pieces, an empty list of scores and a null score; repeated ids are scored row by row; all columns are kept, and one that
has the name of an output is replaced; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scores import segments

#: Ids of the tokens that begin, end and fill a window.
CLS, SEP, PAD = 101, 102, 0
#: Ids of hashed words begin here; so many.
FIRST, SIZE = 104, 30_000

Tokenizer = Callable[[str], list[int]]
Scorer = Callable[[np.ndarray], np.ndarray]


def hashed_words(text: str) -> list[int]:
    """A stand-in tokenizer: words between white space, by their MD5."""
    return [FIRST + int(hashlib.md5(w.encode()).hexdigest()[:4], 16) % SIZE for w in re.findall(r"[^ \t\n\x0b\f\r]+", text)]


def hashed_words_of(text: Column) -> Column:
    """hashed_words() as an expression."""
    words = F.regexp_extract_all(text, F.lit(r"[^ \t\n\x0b\f\r]+"), F.lit(0))
    return F.transform(words, lambda w: (F.lit(FIRST) + F.pmod(F.conv(F.substring(F.md5(w.cast("binary")), 1, 4), 16, 10).cast("int"), F.lit(SIZE))).cast("int"))


def windows(rows: DataFrame, length: int = 512, most: int | None = None, tokens: str = "tokens") -> DataFrame:
    """rows, one for each window of their tokens (an array of ids), with seq, ids, types and mask of `length` places; the first `most` windows, if given.

    Expressions only; rows without tokens have no windows.
    """
    room = length - 2
    n = F.ceil(F.size(tokens) / room).cast("int")
    n = n if most is None else F.least(n, F.lit(most))
    own = rows.filter(F.size(tokens) > 0).withColumn("seq", F.explode(F.sequence(F.lit(0), n - 1)))
    part = F.slice(tokens, F.col("seq") * room + 1, room)
    rest = length - 2 - F.size("_part")
    own = own.withColumn("_part", part)
    ids = F.concat(F.array(F.lit(CLS)), "_part", F.array(F.lit(SEP)), F.array_repeat(F.lit(PAD), rest))
    mask = F.concat(F.array_repeat(F.lit(1), F.size("_part") + 2), F.array_repeat(F.lit(0), rest))
    return own.select(*(c for c in rows.columns if c != tokens), "seq", ids.alias("ids"), F.array_repeat(F.lit(0), length).alias("types"), mask.alias("mask"))


def by_window(tokenizer: Tokenizer, length: int, most: int | None = None) -> Callable[[str], tuple[list[str], list[list[int]]]]:
    """Pieces of a text: windows of its tokens, without texts of their own."""

    def pieces(text: str):
        ids = tokenizer(text)
        found = [ids[i : i + length - 2] for i in range(0, len(ids), length - 2)][:most]
        return [], found

    return pieces


def by_segment(tokenizer: Tokenizer, length: int) -> Callable[[str], tuple[list[str], list[list[int]]]]:
    """Pieces of a text: its segments of whole sentences, of which a window holds the first length - 2 tokens."""

    def pieces(text: str):
        parts = segments(text, length)
        return parts, [tokenizer(p)[: length - 2] for p in parts]

    return pieces


class Batches:
    """Windows in, a batch at a time to the scorer, results out in the windows' order."""

    def __init__(self, scorer: Scorer, length: int, size: int):
        self.scorer, self.planes, self.n = scorer, np.zeros((size, 3, length), np.int64), 0
        self.waiting: deque[list] = deque()

    def add(self, ids: list[int], target: list) -> None:
        row = self.planes[self.n]
        row[:] = 0
        k = len(ids)
        row[0, 0], row[0, 1 : k + 1], row[0, k + 1], row[2, : k + 2] = CLS, ids, SEP, 1
        self.waiting.append(target)
        self.n += 1
        if self.n == len(self.planes):
            self.run()

    def run(self) -> None:
        if self.n:
            for target, x in zip(self.waiting, np.asarray(self.scorer(self.planes[: self.n])), strict=True):
                target.append(x)
        self.waiting.clear()
        self.n = 0


def score(docs: DataFrame, pieces: Callable[[str], tuple[list[str], list[list[int]]]], scorer: Scorer, *, length: int = 512, batch: int = 32, text: str = "text", finish: Callable[[list[np.ndarray]], np.ndarray] | None = None) -> DataFrame:
    """docs with pieces (texts of the pieces, if they have any) and scores (a number for each); with `finish`, with score alone, of each document's results.

    scorer maps planes (windows, 3, length) to a number or a vector for each window; finish maps a list of documents' vectors to a number for each.
    """
    outs = [pa.field("pieces", pa.list_(pa.string())), pa.field("scores", pa.list_(pa.float64()))] if finish is None else [pa.field("score", pa.float64())]
    names = {f.name for f in outs}
    kept = [c for c in docs.columns if c.lower() not in names]
    shape = docs.select(*kept)
    for f, kind in zip(outs, ("array<string>", "array<double>") if finish is None else ("double",), strict=True):
        shape = shape.withColumn(f.name, F.lit(None).cast(kind))

    def emit(done: list[tuple[pa.RecordBatch, int, list[str], list]]) -> Iterator[pa.RecordBatch]:
        lo = 0
        while lo < len(done):
            hi = lo + 1
            while hi < len(done) and done[hi][0] is done[lo][0]:
                hi += 1
            rows = done[lo:hi]
            if finish is None:
                cols = [pa.array([r[2] for r in rows], outs[0].type), pa.array([[float(x) for x in r[3]] for r in rows], outs[1].type)]
            else:
                found = np.asarray(finish([np.array(r[3]) for r in rows]), float)
                cols = [pa.array(found, mask=np.isnan(found))]
            own = rows[0][0].slice(rows[0][1], hi - lo).select(kept)
            yield pa.RecordBatch.from_arrays([*own.columns, *cols], names=[*kept, *(f.name for f in outs)])
            lo = hi

    def run(batches):
        packer, held = Batches(scorer, length, batch), deque()
        for b in batches:
            for i, t in enumerate(b.column(text).to_pylist()):
                parts, ids = pieces(t) if t else ([], [])
                target: list = []
                held.append((b, i, parts, target, len(ids)))
                for x in ids:
                    packer.add(x, target)
                if len(held) >= 1024 or packer.n == 0:
                    done = []
                    while held and len(held[0][3]) == held[0][4]:
                        done.append(held.popleft()[:4])
                    yield from emit(done)
        packer.run()
        yield from emit([h[:4] for h in held])

    return docs.mapInArrow(run, shape.schema)


def mean_id(planes: np.ndarray) -> np.ndarray:
    """A stand-in scorer: the mean of the words' ids, in 0 .. 1."""
    ids, inside = planes[:, 0], (planes[:, 2] > 0) & (planes[:, 0] >= FIRST)
    return ((ids - FIRST) * inside).sum(axis=1) / np.maximum(1, inside.sum(axis=1)) / SIZE


def selected(scored: DataFrame, score_filter: float, threshold: float) -> DataFrame:
    """Scored rows with orig_text, the text of the pieces over score_filter in lines, their scores, mean_scores, and bucket: hq over threshold, else lowq.

    Rows without such pieces have no mean and are lowq.
    """
    both = F.filter(F.arrays_zip("pieces", "scores"), lambda x: x["scores"] > score_filter)
    own = scored.withColumn("_kept", both)
    mean = F.aggregate("_kept", F.lit(0.0), lambda a, x: a + x["scores"]) / F.nullif(F.size("_kept"), F.lit(0))
    rest = [c for c in scored.columns if c not in ("text", "pieces", "scores", "orig_text", "mean_scores", "bucket")]
    out = own.select(*rest, F.col("text").alias("orig_text"), F.array_join(F.transform("_kept", lambda x: x["pieces"]), "\n").alias("text"), F.transform("_kept", lambda x: x["scores"]).alias("scores"), mean.alias("mean_scores"))
    return out.withColumn("bucket", F.when(F.col("mean_scores") > threshold, "hq").otherwise("lowq"))
