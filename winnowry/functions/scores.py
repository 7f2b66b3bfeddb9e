"""Scores: clamping, squashing, acquisition by disagreement, losses, text segments."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Score ranges of the essay prompts.
RANGES = {1: (2.0, 12.0), 2: (1.0, 6.0), 3: (0.0, 3.0), 4: (0.0, 3.0), 5: (0.0, 4.0), 6: (0.0, 4.0), 7: (0.0, 30.0), 8: (0.0, 60.0), 9: (0.5, 9.0), 10: (1.0, 24.0)}


def clamp(score: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), score))


def prompt_score(score: Column, prompt: int) -> Column:
    """A score within its prompt's range: to the nearest half for prompt 9, whole (halves to even) up to 10, else as it is."""
    if prompt not in RANGES:
        return score
    lo, hi = RANGES[prompt]
    if prompt == 9:
        return clamp(F.floor(score * 2 + F.lit(0.5)) / 2, lo, hi)
    return clamp(F.bround(score), lo, hi)


def bounded_sigmoid(x: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    return F.lit(lo) + F.lit(hi - lo) / (1 + F.exp(-x))


def entropy(p: Column) -> Column:
    """Of a coin, in nats, kept from log(0)."""
    return -(p * F.log(p + F.lit(1e-10)) + (1 - p) * F.log(1 - p + F.lit(1e-10)))


def bald(draws: Column) -> Column:
    """Entropy of the mean draw less the mean entropy, over an array of probabilities."""
    n = F.size(draws)
    mean = F.aggregate(draws, F.lit(0.0), lambda a, x: a + x) / n
    return entropy(mean) - F.aggregate(draws, F.lit(0.0), lambda a, x: a + entropy(x)) / n


#: How many different weights losses() takes: each pair of them has a range of its own.
WEIGHTS = 32


def losses(rows: DataFrame, bias: float = 0.0, weighted: bool = False) -> DataFrame:
    """mse, weighted_mse, cosine_loss, margin_loss of rows (pred, target, weight).

    The margin loss is the mean over all ordered pairs of max(0, bias - r * w * (a - b)), where r is the sign of a - b and, between equal
    predictions, the negative sign of the targets' difference; w is 1 or, if weighted, the mean of the two weights. For bias <= 0 every pair gives
    nothing; for bias > 0 a pair of different predictions gives what w times their distance is short of the bias, and one of equal
    predictions the bias. So only pairs nearer than bias / w count: a range of neighbours in the order of predictions, summed with windows for each
    pair of weights, of which there may be WEIGHTS different positive ones, instead of over all pairs.
    """
    from ..plans.session import stored

    base = rows.select(F.col("pred").cast("double"), F.col("target").cast("double"), F.col("weight").cast("double"))
    sums = base.agg(
        F.avg(F.pow(F.col("pred") - F.col("target"), 2)).alias("mse"),
        F.avg(F.pow(F.col("pred") - F.col("target"), 2) * F.col("weight")).alias("weighted_mse"),
        (1 - F.sum(F.col("pred") * F.col("target")) / F.sqrt(F.sum(F.col("pred") * F.col("pred")) * F.sum(F.col("target") * F.col("target")))).alias("cosine_loss"),
        F.count("*").alias("n"),
    )
    if bias <= 0:
        return sums.select("mse", "weighted_mse", "cosine_loss", F.lit(0.0).alias("margin_loss"))
    base = base.withColumn("weight", F.col("weight") if weighted else F.lit(1.0))
    found = [r[0] for r in base.select("weight").distinct().limit(WEIGHTS + 1).collect()]
    if len(found) > WEIGHTS or any(x is None or x <= 0 for x in found):
        raise ValueError(f"weights must be positive, {WEIGHTS} different ones at most")
    # each prediction p and the ends p - e, p + e of its range (e = bias / w) as points of the line of the other's weight; with C and D that line's running
    # sums of counts and of counts * prediction, the pairs of p are (bias - w p) (C(p) - C(p - e)) + w (D(p) - D(p - e)) and the like above p
    counts = base.groupBy("pred", "weight").agg(F.count("*").cast("double").alias("c")).withColumn("line", F.explode(F.array(*map(F.lit, found))))
    p, c, b, w = F.col("pred"), F.col("c"), F.lit(float(bias)), (F.col("weight") + F.col("line")) / 2
    none, mine = F.lit(0.0), F.when(F.col("weight") == F.col("line"), F.col("c")).otherwise(0.0)
    points = F.array(
        F.struct(p.alias("x"), mine.alias("c"), (mine * p).alias("d"), (-2 * w * p * c).alias("u"), (2 * w * c).alias("v")),
        F.struct((p - b / w).alias("x"), none.alias("c"), none.alias("d"), (c * (w * p - b)).alias("u"), (-w * c).alias("v")),
        F.struct((p + b / w).alias("x"), none.alias("c"), none.alias("d"), (c * (w * p + b)).alias("u"), (-w * c).alias("v")),
    )
    line = stored(counts.select("line", F.explode(points).alias("e")).select("line", "e.*").repartitionByRange("line", "x").withColumn("part", F.spark_partition_id()), "margin")
    totals = line.groupBy("line", "part").agg(F.sum("c").alias("c0"), F.sum("d").alias("d0"))  # a row for each partition and line
    ahead = Window.partitionBy("line").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("line", "part", F.coalesce(F.sum("c0").over(ahead), none).alias("c0"), F.coalesce(F.sum("d0").over(ahead), none).alias("d0"))
    run = Window.partitionBy("line", "part").orderBy("x").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    at = line.select("*", F.sum("c").over(run).alias("cs"), F.sum("d").over(run).alias("ds")).join(before, ["line", "part"])
    near = at.agg(F.sum(F.col("u") * (F.col("cs") + F.col("c0")) + F.col("v") * (F.col("ds") + F.col("d0"))).alias("apart"))
    # equal predictions: r = -sign(target difference) times 0 leaves the bias, whatever r is; a prediction met at its own place counts once
    return sums.crossJoin(F.broadcast(near)).select("mse", "weighted_mse", "cosine_loss", (F.coalesce("apart", none) / (F.col("n") * F.col("n"))).alias("margin_loss"))  # one row each


ENDS = re.compile(r"(?s).*[\n.?!。！？]")


def segments(text: str, most: int) -> list[str]:
    """Pieces of at most most - 2 characters: up to the last line feed (which begins the next piece) or sentence end (which ends its piece) in that room.

    A piece is cut anywhere where the room has no such sign after its first character, and where at most one character more than
    the room is left, which then is a piece of its own.
    """
    out, at, room = [], 0, most - 2
    while at < len(text):
        end = at + room
        if end < len(text) - 1 and (last := ENDS.match(text, at + 1, end)):
            end = last.end() - (text[last.end() - 1] == "\n")
        out.append(text[at:end])
        at = end
    return out


def segmented(text: Column, most: int = 512) -> Column:
    @F.pandas_udf("array<string>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([segments(t, most) if t else [] for t in texts])

    return run(text)


def select_segments(rows: DataFrame, score_filter: float, threshold: float) -> DataFrame:
    """From rows (doc_id, pos, segment, score): kept text, scores, their mean and bucket hq or lowq of each document.

    Documents without segments over score_filter have a null mean and are lowq.
    """
    keep = F.col("score") > score_filter
    own = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.when(keep, F.struct("pos", "segment", "score")))).alias("kept"), F.avg(F.when(keep, F.col("score"))).alias("mean_score"))
    return own.select("doc_id", F.array_join(F.transform("kept", lambda k: k["segment"]), "\n").alias("text"), F.transform("kept", lambda k: k["score"]).alias("scores"), "mean_score", F.when(F.col("mean_score") > threshold, "hq").otherwise("lowq").alias("bucket"))


def contiguous(rows: DataFrame, threshold: float) -> DataFrame:
    """doc_id, run, first, n, text: maximal runs of segments over threshold, from rows (doc_id, pos, segment, score)."""
    good = rows.filter(F.col("score") > threshold)
    runs = good.withColumn("start", F.col("pos") - F.row_number().over(Window.partitionBy("doc_id").orderBy("pos")))
    own = runs.groupBy("doc_id", "start").agg(F.min("pos").alias("first"), F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "segment"))).alias("parts"))
    return own.select("doc_id", "first", "n", F.array_join(F.transform("parts", lambda p: p["segment"]), "").alias("text"))
