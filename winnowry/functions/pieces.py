"""Python functions over Arrow columns, a piece of a batch at a time, in workers that give their memory back.

A batch has 64 MB or 10,000 rows at most; of its values only a piece is held as Python objects at once.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rows of a piece.
ROWS = 128


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


def values(column: pa.Array) -> Iterator:
    """The values of a column; a piece of them is held at once."""
    for at in range(0, len(column), ROWS):
        yield from column.slice(at, ROWS).to_pylist()


def _joined(rows: Iterator, kind: pa.DataType) -> pa.Array:
    done, held = [], []
    for x in rows:
        held.append(x)
        if len(held) == ROWS:
            done.append(pa.array(held, kind))
            held = []
    return pa.concat_arrays([*done, pa.array(held, kind)])


def mapped(f: Callable, sql: str, kind: pa.DataType, *columns: Column) -> Column:
    """f of each row's values, as a column; sql and kind name its type (a struct's values as dictionaries)."""
    if len(columns) == 1:

        @F.arrow_udf(sql)
        def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for p in parts:
                yield _joined(map(f, values(p)), kind)
    else:

        @F.arrow_udf(sql)
        def run(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for p in parts:
                yield _joined(map(f, *map(values, p)), kind)

    return run(*columns)
