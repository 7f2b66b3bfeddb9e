"""Incremental runs of the batch steps with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def ingest(spark: SparkSession, source: str, schema: str, step: Callable[[DataFrame], DataFrame], target: str, state: str) -> StreamingQuery:
    """Reads the parquet files that are new below source, applies the step and appends to target, until none are left."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).parquet(source)
    return step(rows).writeStream.format("parquet").option("path", target).option("checkpointLocation", state).trigger(availableNow=True).start()


def first_seen(rows: DataFrame, keys: list[str], time: str | None = None, delay: str = "1 day") -> DataFrame:
    """Rows whose key wasn't seen before; with a time column, keys are forgotten after the delay."""
    if time is None:
        return rows.dropDuplicates(keys)
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
