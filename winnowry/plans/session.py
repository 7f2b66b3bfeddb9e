"""Sessions and shared folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; where it names none, one that was set before or, on a local master alone, one of our own."""
    sc = spark.sparkContext
    there = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if sc.getCheckpointDir() is None:
        if not there and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(there or tempfile.mkdtemp(prefix="winnowry-"))
    return there or sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df behind a reliable checkpoint."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
