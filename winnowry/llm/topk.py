"""Exact top-k search by inner product with multi-resolution segment statistics.

Vectors are cut into segments; for each the mean and the deviation are kept, at several resolutions. With equal lengths the
largest inner product is the least distance, and for segments of s components
    q . x  <=  sum over segments of s * (mean(q) * mean(x) + deviation(q) * deviation(x)),
a bound on the distance from below. Candidates whose bound at a coarse resolution can't reach a query's k-th best score so far
are dropped, the others are bounded again at finer ones, and survivors are scored exactly.

Queries are taken in blocks of bounded size, each against all candidates; a task keeps k results for each query of the
block, and these are merged in a shuffle by query.

Rows: vectors that are null or hold null or non-finite components take no part; neither do rows with a null id; repeated ids
are candidates row by row, except for a query's own id; vectors of other lengths than a query's aren't its candidates; further columns
are ignored. Scores are exact 64-bit integers; components whose scores might not fit these raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

#: Queries in a block, candidates that are bounded at a time, and the segments of each resolution.
BLOCK, STEP, LEVELS = 1024, 512, (4, 16)
SCALE = 1024.0


def integers(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a column of float lists: the rows that take part, their lengths, and their components as floor(1024 * x)."""
    rows, lens, parts = [], [], []
    flat = col.flatten() if col.null_count else col.values.slice(col.offsets[0].as_py(), col.offsets[-1].as_py() - col.offsets[0].as_py()) if len(col) else col.flatten()
    sizes = np.array([0 if x is None else x for x in pc.list_value_length(col).to_pylist()], np.int64)
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
    good = np.isfinite(values)
    ends = np.cumsum(sizes)
    begin = ends - sizes
    bad = np.concatenate([[0], np.cumsum(~good)])
    ok = (bad[ends] == bad[begin]) & np.asarray(col.is_valid())
    rows = np.flatnonzero(ok)
    lens = sizes[rows]
    parts = np.floor(np.where(good, values, 0) * SCALE)
    keep = np.repeat(ok, sizes)
    if len(rows) and np.abs(parts[keep]).max(initial=0) ** 2 * lens.max() >= 2.0**63:
        raise ValueError("components so large that a score may not fit 64 bits")
    return rows, lens, parts[keep].astype(np.int64)


class Resolutions:
    """Segment means and deviations of vectors of one length, coarse to fine, ready for bounds by one matrix product."""

    def __init__(self, x: np.ndarray):
        self.levels = []
        n, d = x.shape
        for segments in LEVELS:
            if segments >= d:
                break
            edges = np.linspace(0, d, segments + 1).astype(int)
            size = np.diff(edges)
            mean = np.add.reduceat(x, edges[:-1], axis=1) / size
            square = np.add.reduceat(x * x, edges[:-1], axis=1) / size
            deviation = np.sqrt(np.maximum(0, square - mean * mean)) + 1e-6 * (1 + np.abs(mean))
            self.levels.append(np.concatenate([mean, deviation], axis=1) * np.sqrt(np.concatenate([size, size])))


def search(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, k: int, best: tuple[np.ndarray, np.ndarray, np.ndarray], coarse: Resolutions) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of best (query number, id, score) and of the candidates."""
    fine = Resolutions(x.astype(np.float64))
    least = np.full(len(qids), -np.inf)
    order = np.lexsort((best[1], -best[2], best[0]))
    number, name, score = (v[order] for v in best)
    first = np.searchsorted(number, np.arange(len(qids)))
    full = np.bincount(number, minlength=len(qids)) >= k
    least[full] = score[first[full] + k - 1]
    pairs = None
    slack = 1e-9
    for a, b in zip(coarse.levels, fine.levels, strict=True):
        if pairs is None:
            bound = a @ b.T
            reach = bound + slack * np.abs(bound) + 1 >= least[:, None]
            pairs = np.nonzero(reach)
        else:
            keep = np.empty(len(pairs[0]), bool)
            for lo in range(0, len(keep), 1 << 15):
                i, j = pairs[0][lo : lo + (1 << 15)], pairs[1][lo : lo + (1 << 15)]
                bound = np.einsum("ij,ij->i", a[i], b[j])
                keep[lo : lo + (1 << 15)] = bound + slack * np.abs(bound) + 1 >= least[i]
            pairs = pairs[0][keep], pairs[1][keep]
    if pairs is None:
        pairs = tuple(v.reshape(-1) for v in np.indices((len(qids), len(ids))))
    i, j = pairs
    other = qids[i] != ids[j]
    i, j = i[other], j[other]
    exact = np.empty(len(i), np.int64)
    for lo in range(0, len(i), 1 << 15):
        own = slice(lo, lo + (1 << 15))
        exact[own] = np.einsum("ij,ij->i", q[i[own]], x[j[own]])
    number, name, score = np.concatenate([number, i]), np.concatenate([name, ids[j]]), np.concatenate([score, exact])
    order = np.lexsort((name, -score, number))
    number, name, score = number[order], name[order], score[order]
    place = np.arange(len(number)) - np.searchsorted(number, number)
    return number[place < k], name[place < k], score[place < k]


NONE = (np.zeros(0, np.int64),) * 3


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best candidates; ties to smaller ids. Rows: vec_id, embedding."""
    sc = candidates.sparkSession.sparkContext
    cols = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).filter("vec_id is not null and embedding is not null")
    candidates, queries = cols(candidates), cols(queries)
    blocks = -(-queries.count() * 4 // (3 * block))  # three quarters full on average
    hashed = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(max(1, blocks)))
    out = None
    for number in range(blocks):
        rows = queries.filter(hashed == number).toArrow()
        held, lens, flat = integers(rows.column(1).combine_chunks())
        names = rows.column(0).to_numpy()[held]
        ends = np.cumsum(lens)
        groups = {}
        for d in sorted(set(lens.tolist())):
            own = np.flatnonzero(lens == d)
            q = np.stack([flat[ends[i] - d : ends[i]] for i in own]) if d else np.zeros((len(own), 0), np.int64)
            groups[d] = (names[own], q)
        if not groups:
            continue
        shared = sc.broadcast(groups)

        def scan(batches, shared=shared):
            best = {d: NONE for d in shared.value}
            stats = {d: Resolutions(q.astype(np.float64)) for d, (_, q) in shared.value.items()}
            for b in batches:
                rows_, lens_, flat_ = integers(b.column(1))
                ids, ends_ = b.column(0).to_numpy()[rows_], np.cumsum(lens_)
                for d, (qids, q) in shared.value.items():
                    own = np.flatnonzero(lens_ == d)
                    for lo in range(0, len(own), STEP):
                        some = own[lo : lo + STEP]
                        x = flat_[(ends_[some] - d)[:, None] + np.arange(d)]
                        best[d] = search(ids[some], x, qids, q, k, best[d], stats[d])
            for d, (number_, name, score) in best.items():
                if len(number_):
                    yield pa.RecordBatch.from_arrays([pa.array(shared.value[d][0][number_]), pa.array(name), pa.array(score), pa.array(number_)], names=["query_id", "vec_id", "score", "query_row"])

        part = candidates.mapInArrow(scan, "query_id long, vec_id long, score long, query_row long").withColumn("block", F.lit(number))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return candidates.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("block", "query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.filter("vec_id % 100 = 0"))
