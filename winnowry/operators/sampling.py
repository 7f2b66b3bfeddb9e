"""Sampling for training a quality model. Draws are hashes of the key and a seed, so they are the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scores


def draw(key: Column, seed: int = 0) -> Column:
    """A number in (0, 1) for each key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 1) / F.lit(float((1 << 32) + 1))


def bernoulli(rows: DataFrame, key: str, rate: float, seed: int = 0) -> DataFrame:
    return rows.filter(draw(F.col(key), seed) < rate)


def per_class(rows: DataFrame, label: str, key: str, k: int, seed: int = 0) -> DataFrame:
    """k rows of each label, fewer where a label has fewer."""
    order = Window.partitionBy(label).orderBy(draw(F.col(key), seed), key)
    return rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).drop("_n")


def weighted(rows: DataFrame, weight: str, key: str, k: int, seed: int = 0, label: str | None = None) -> DataFrame:
    """k rows, or k of each label, without replacement, with chances by weight (a row's key is u ** (1 / weight))."""
    own = rows.filter(F.col(weight) > 0).withColumn("_rank", F.log(draw(F.col(key), seed)) / F.col(weight))
    if label is None:
        return own.orderBy(F.desc("_rank"), key).limit(k).drop("_rank")
    order = Window.partitionBy(label).orderBy(F.desc("_rank"), key)
    return own.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).drop("_n", "_rank")


def by_disagreement(rows: DataFrame, draws: str, key: str, k: int, seed: int = 0, *, easy: bool = False, label: str | None = None) -> DataFrame:
    """k rows, or k of each label, without replacement, with chances by how much their draws (an array of probabilities) disagree (BALD).

    easy: by how little, 1 less the disagreement; with labels, of disagreement scaled to 0 .. 1 over all rows. Adds weight.
    """
    own = rows.withColumn("weight", scores.bald(F.col(draws)))
    if label is not None:
        own = min_max(own, "weight", "weight_scaled").withColumn("weight", F.col("weight_scaled")).drop("weight_scaled")
    own = own.withColumn("weight", F.greatest(F.lit(0.0), 1 - F.col("weight") if easy else F.col("weight")))
    return weighted(own, "weight", key, k, seed, label)


def by_score(rows: DataFrame, score: str, label: str, key: str, k: int, seed: int = 0) -> DataFrame:
    """k rows of each of the labels 0 and 1, with chances by score in 1 and by 1 less the score in 0. Adds weight."""
    own = rows.withColumn("weight", F.greatest(F.lit(0.0), F.when(F.col(label) == 0, 1 - F.col(score)).otherwise(F.col(score))))
    return weighted(own, "weight", key, k, seed, label)


def two_stage(placed: DataFrame, files: int, k: int, seed: int = 0) -> DataFrame:
    """k rows of `files` files, both drawn without replacement, of rows with file_path and place (see sources.sinks.placed)."""
    name = F.element_at(F.split("file_path", "/"), -1)
    chosen = placed.select("file_path").distinct().orderBy(draw(name, seed), "file_path").limit(files)
    return placed.join(chosen, "file_path", "left_semi").orderBy(draw(F.concat_ws(":", name, F.col("place").cast("string")), seed), "file_path", "place").limit(k)


def with_replacement(rows: DataFrame, weight: str, key: str, k: int, seed: int = 0) -> DataFrame:
    """k draws by weight: key and how often it is drawn.

    Draw i falls at (i + u) / k of the running weight (systematic sampling), so each row's count follows from where its share
    begins and ends. The running sum is per range partition, with the partitions' totals added.
    """
    from ..plans.session import stored

    own = stored(rows.filter(F.col(weight) > 0).select(key, F.col(weight).alias("_w")).repartitionByRange(key).withColumn("_part", F.spark_partition_id()), "draws")
    totals = own.groupBy("_part").agg(F.sum("_w").alias("_t"))  # a row for each partition
    before = totals.select("_part", (F.sum("_t").over(Window.orderBy("_part")) - F.col("_t")).alias("_before"), F.sum("_t").over(Window.partitionBy()).alias("_all"))
    end = F.sum("_w").over(Window.partitionBy("_part").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)) + F.col("_before")
    place = own.join(F.broadcast(before), "_part").withColumn("_end", end)
    u = draw(F.lit("systematic"), seed)
    drawn = lambda x: F.greatest(F.lit(0), F.ceil(x / F.col("_all") * k - u))
    return place.select(key, (drawn(F.col("_end")) - drawn(F.col("_end") - F.col("_w"))).cast("int").alias("times")).filter("times > 0")


def min_max(rows: DataFrame, column: str, out: str = "scaled") -> DataFrame:
    """Scaled to 0 .. 1 over all rows; null where all are equal."""
    ends = rows.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    return rows.crossJoin(F.broadcast(ends)).withColumn(out, F.try_divide(F.col(column) - F.col("_lo"), F.col("_hi") - F.col("_lo"))).drop("_lo", "_hi")  # one row


def share(rows: DataFrame, column: str, label: str, out: str = "share") -> DataFrame:
    """Each row's part of its label's sum."""
    sums = rows.groupBy(label).agg(F.sum(F.greatest(F.lit(0.0), F.col(column))).alias("_sum"))
    return rows.join(sums, label).withColumn(out, F.try_divide(F.greatest(F.lit(0.0), F.col(column)), F.col("_sum"))).drop("_sum")


def balanced(candidates: DataFrame, labels: DataFrame, paradigms: DataFrame, key: str, k: int, ratio: float = 0.0, seed: int = 0) -> DataFrame:
    """Half negative and half positive candidates by their pseudo labels; `ratio` of the positives come from the paradigms."""
    own = candidates.join(labels, key)
    own_positive = int(k // 2 * (1 - ratio))
    neg = per_class(own.filter("pseudo_label = 0"), "pseudo_label", key, k // 2, seed)
    pos = per_class(own.filter("pseudo_label = 1"), "pseudo_label", key, own_positive, seed)
    rest = per_class(paradigms.withColumn("pseudo_label", F.lit(1)), "pseudo_label", key, k // 2 - own_positive, seed)
    return neg.unionByName(pos).unionByName(rest, allowMissingColumns=True)


def batches(rows: DataFrame, key: str, size: int, whole: bool = False) -> DataFrame:
    """rows with a batch number; the last, smaller batch goes if only whole ones are asked for."""
    from ..plans.session import stored

    own = stored(rows.repartitionByRange(key).withColumn("_part", F.spark_partition_id()), "batches")
    totals = own.groupBy("_part").agg(F.count("*").alias("_n"))  # a row for each partition
    before = totals.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1 + F.col("_before")
    out = own.join(F.broadcast(before), "_part").withColumn("_place", place).withColumn("batch", F.floor(F.col("_place") / size))
    if whole:
        out = out.filter(F.col("_place") < F.col("_all") - F.col("_all") % size)
    return out.drop("_part", "_before", "_all", "_place")
