"""Small helpers shared by the operators: input tables, scratch tables, Arrow text buffers."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skymart.session import materialize, shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the folder that driver and executors share."""
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there."""
    return materialize(df, scratch(df.sparkSession, name))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, UPPER, LOWER)


#: What Python workers keep from one task to the next, by name.
CACHES: dict[str, dict] = {}


def empty_caches(but: str | None = None) -> None:
    for name, cache in CACHES.items():
        if name != but:
            cache.clear()


@functools.cache
def _trim() -> Callable | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # not glibc
        return None


def give_back() -> None:
    """Return freed memory to the system; glibc and Arrow keep it for later."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def lean(run: Callable, uses: str | None = None) -> Callable:
    """``run``, for mapInArrow, in workers that serve other steps as well and wait between tasks.

    Caches of other steps than ``uses`` are emptied first, and freed memory is given back at the end.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty_caches(uses)
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, end to end, and the row offsets in them. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32) if offsets else np.zeros(1, np.int32)
    ends = ends[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(column):
        ends = np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def rows_by_bytes(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` bytes, one row at least."""
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = max(int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1, row + 1)
        yield row, stop
        row = stop
