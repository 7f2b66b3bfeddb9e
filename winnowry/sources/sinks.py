"""Sinks that keep groups together, and rows at their places in files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.session import stored


def running(rows: DataFrame, order: list[str], amount: str) -> DataFrame:
    """rows with `before`, the sum of `amount` over all rows before in the order: within range partitions, plus the partitions' totals."""
    ranged = stored(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "running")
    totals = ranged.groupBy("_part").agg(F.sum(amount).alias("_sum"))  # a row for each partition
    ahead = totals.select("_part", (F.sum("_sum").over(Window.orderBy("_part")) - F.col("_sum")).alias("_ahead"))
    own = F.sum(amount).over(Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return ranged.withColumn("_own", own).join(F.broadcast(ahead), "_part").withColumn("before", F.col("_ahead") + F.col("_own") - F.col(amount)).drop("_part", "_own", "_ahead")


def file_numbers(rows: DataFrame, keys: list[str], most: int, salt: Column) -> DataFrame:
    """rows with file: whole groups of equal keys in their order, a file from each `most` rows on; groups of over `most` rows are in pieces of about that many.

    A file has less than most rows before its last group or piece. salt: a number that deals a large group's rows to its pieces. Null keys are a group.
    """
    parts = rows.groupBy(*keys).agg(F.count("*").alias("_n")).select(*(F.col(k).alias(f"_{k}") for k in keys), F.ceil(F.col("_n") / most).cast("long").alias("_parts"))
    large = parts.filter("_parts > 1")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    own = rows.join(large, same, "left").withColumn("_piece", F.pmod(salt, F.coalesce("_parts", F.lit(1)))).drop(*(f"_{k}" for k in keys), "_parts")
    pieces = own.groupBy(*keys, "_piece").agg(F.count("*").alias("_n"))
    files = running(pieces, [*keys, "_piece"], "_n").select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_piece").alias("__piece"), F.floor(F.col("before") / most).alias("file"))
    return own.join(files, [*same, F.col("_piece") == F.col("__piece")]).drop(*(f"_{k}" for k in keys), "_piece", "__piece")


def write_grouped(rows: DataFrame, path: str, keys: list[str], *, most: int = 100_000, salt: Column | None = None, kind: str = "parquet") -> None:
    """Writes rows below file=<number>, one file for each number (see file_numbers); no group is one task's beyond `most` rows."""
    salt = F.xxhash64(*rows.columns) if salt is None else salt
    numbered = file_numbers(rows, keys, most, salt)
    numbered.repartition("file").sortWithinPartitions("file", *keys).write.partitionBy("file").format(kind).save(path)


def placed(rows: DataFrame) -> DataFrame:
    """rows of a file scan with file_path and place, each row's number in its file from 0, however files are split and packed into tasks.

    A split's rows are read in order by one task, so that a row's place is the rows of the file's splits before and its number in its own.
    """
    own = rows.select("*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    splits = own.groupBy("file_path", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    ahead = Window.partitionBy("file_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    return own.join(starts, ["file_path", "_block"]).withColumn("place", F.col("_ahead") + F.col("_id") - F.col("_first")).drop("_block", "_id", "_first", "_ahead")


def gather(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of a file scan at wanted (file_path, place)."""
    return placed(rows).join(wanted.select("file_path", "place"), ["file_path", "place"], "left_semi")


def write_lines(rows: DataFrame, path: str, column: str | None = None) -> None:
    """One column's distinct values as sorted lines."""
    rows.select(F.col(column or rows.columns[0]).cast("string").alias("value")).filter("value is not null").distinct().orderBy("value").write.text(path)


def write_pairs(rows: DataFrame, path: str) -> None:
    """Rows as `key: value` lines, columns in order, with a line between rows."""
    lines = F.concat_ws("\n", *(F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in rows.columns))
    rows.select(F.concat(lines, F.lit("\n")).alias("value")).write.text(path)


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines, gzip or not; with a schema no pass over the data to infer one."""
    return (spark.read if schema is None else spark.read.schema(schema)).option("recursiveFileLookup", "true").json(path)


def append_jsonl(rows: DataFrame, path: str, *, compress: bool = False) -> None:
    """Adds rows to JSON lines at path; nothing is written for no rows."""
    if not rows.isEmpty():
        rows.write.mode("append").option("compression", "gzip" if compress else "none").json(path)
