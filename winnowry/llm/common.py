"""Helpers that the operators share: shared folders, checkpoints and views of Arrow text columns."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one numpy pass works on at a time.
CHUNK = 1 << 21


def lean() -> None:
    """Has large arrays and Arrow buffers go back to the system when they are freed: a worker is kept for later tasks, and would keep its peak."""
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 1 << 20)  # M_TRIM_THRESHOLD
    except (OSError, AttributeError):  # another C library
        return
    pa.set_memory_pool(pa.system_memory_pool())


lean()


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a local one of our own only where that setting is absent."""
    sc = spark.sparkContext
    there = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not there:
        own = sc.getCheckpointDir()
        if own is None:
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="winnowry-"))
            own = sc.getCheckpointDir()
        return own
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(there)
    return there


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_parts(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its n + 1 offsets into them; null rows are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    _, offs, data = col.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offs, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at


def chunks(at: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges lo, hi of rows whose bytes are at most limit, or single longer rows."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = int(np.searchsorted(at, at[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The indices starts[0], starts[0] + 1, ... of all ranges, one after another."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(total)


def env_single() -> None:
    """Keeps native thread pools of a Python worker to one thread."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    os.environ.setdefault("OMP_NUM_THREADS", "1")


def cast_batch(rows: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in schema], schema=schema)
