"""Exact top-k by inner product over a vector-approximation file.

Components become integers, floor(1024 * x). The file keeps, per vector, one byte per dimension
(the cell of a uniform grid over the dimension's range) beside the exact integers. A search scans
cells only: they bound each score from above and below. Exact vectors are then visited in the
order of their upper bounds, until the kth best score is above every bound left.

Queries go in blocks of bounded size, each block sent to all tasks; every task keeps the k best of
its rows per query, so what is shuffled is k rows per query and task.

Vectors that are null, hold a null or a component that isn't finite, or have a null id take no
part. A vector shorter than others counts as zero in the missing dimensions. Scores are 64-bit
integers. Repeated rows are candidates each; a query id that occurs on several rows is asked once,
with the smallest of its vectors, and never finds rows of its own id. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skymart.llm.common import keep, scratch

CELLS = 256
#: Queries sent to all tasks at once.
QUERY_BLOCK = 1024
#: Candidates whose bounds are computed at once.
BATCH = 4096
RESULT = "query_id bigint, vec_id bigint, score bigint"


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id and v, the integer components, of the vectors that take part."""
    x = F.col("embedding")
    usable = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    v = F.transform(x, lambda e: F.floor(F.lit(1024.0) * e.cast("double")).cast("bigint"))
    return vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & usable).select(
        F.col("vec_id").cast("bigint"), v.alias("v")
    )


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(np.asarray(lists.offsets)).astype(np.int64)
    out = np.zeros((len(lists), width), np.int64)
    rows = np.repeat(np.arange(len(lists)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def grid(vectors: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Lowest value and cell width of every dimension, over all vectors."""
    dims = (
        vectors.select(F.posexplode("v").alias("d", "e")).groupBy("d").agg(F.min("e"), F.max("e")).orderBy("d").collect()
    )
    low = np.array([min(r[1], 0) for r in dims], np.int64)
    high = np.array([max(r[2], 0) for r in dims], np.int64)
    return low, np.maximum((high - low) // CELLS + 1, 1)


def build(vectors: DataFrame, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Write the file: vec_id, cells (one byte a dimension), v. Returns its grid."""
    low, step = grid(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = ((_matrix(batch.column(1), len(low)) - low) // step).astype(np.uint8)
            rows = pa.array([r.tobytes() for r in cells], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), rows, batch.column(1)], names=["vec_id", "cells", "v"])

    vectors.mapInArrow(run, "vec_id bigint, cells binary, v array<bigint>").write.parquet(path)
    return low, step


class Best:
    """The k best (score, smallest id first among equals) of every query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), np.iinfo(np.int64).min)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)
        self.filled = np.zeros(queries, np.int64)

    def least(self, q: int) -> int | None:
        return int(self.score[q, -1]) if self.filled[q] == self.k else None

    def add(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        n = self.filled[q]
        ids, scores = np.append(self.id[q, :n], ids), np.append(self.score[q, :n], scores)
        order = np.lexsort((ids, -scores))[: self.k]
        n = self.filled[q] = len(order)
        self.id[q, :n], self.score[q, :n] = ids[order], scores[order]


def visit(best: Best, q: int, query: np.ndarray, upper: np.ndarray, ids: np.ndarray, exact: np.ndarray) -> None:
    """Read exact vectors in the order of their bounds until the kth best score is certain."""
    least = best.least(q)
    open_ = np.flatnonzero(upper >= least) if least is not None else np.arange(len(upper))
    order, at, step = open_[np.argsort(-upper[open_], kind="stable")], 0, 4 * best.k
    while at < len(order):
        least = best.least(q)
        if least is not None and upper[order[at]] < least:
            return
        some = order[at : at + step]
        best.add(q, ids[some], exact[some] @ query)
        at, step = at + step, 2 * step


def _search(path: str, spark, low, step, asked: list[tuple[int, list[int]]], k: int) -> DataFrame:
    width = len(low)
    queries = np.zeros((len(asked), width), np.int64)
    for i, (_, v) in enumerate(asked):
        queries[i, : len(v)] = v
    query_ids = np.array([i for i, _ in asked], np.int64)
    sent = spark.sparkContext.broadcast((query_ids, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = sent.value
        best = Best(len(query_ids), k)
        plus, minus = np.maximum(queries, 0).astype(float), np.minimum(queries, 0).astype(float)
        for whole in batches:
            for begin in range(0, whole.num_rows, BATCH):
                batch = whole.slice(begin, BATCH)
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                raw = b"".join(batch.column(1).to_pylist())
                cells = np.frombuffer(raw, np.uint8).reshape(len(ids), width).astype(np.int64)
                floor = (low + cells * step).astype(float)
                upper = plus @ (floor + (step - 1)).T + minus @ floor.T
                # Sums in floating point may be off by a few units in the last place.
                upper += 1 + np.abs(upper) * 1e-9
                exact = _matrix(batch.column(2), width)
                for q, own in enumerate(query_ids):
                    bounds = np.where(ids == own, -np.inf, upper[q])
                    there = np.flatnonzero(bounds > -np.inf)
                    visit(best, q, queries[q], bounds[there], ids[there], exact[there])
        q = np.repeat(np.arange(len(query_ids)), best.filled)
        r = np.arange(len(q)) - np.repeat(np.cumsum(best.filled) - best.filled, best.filled)
        yield pa.RecordBatch.from_arrays(
            [pa.array(query_ids[q]), pa.array(best.id[q, r]), pa.array(best.score[q, r])],
            names=["query_id", "vec_id", "score"],
        )

    return spark.read.parquet(path).mapInArrow(run, RESULT)


def search(vectors: DataFrame, asked: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of all other rows for each row that ``asked`` picks."""
    spark = vectors.sparkSession
    rows = integers(vectors)
    path, found = scratch(spark, "va-file"), scratch(spark, "found")
    low, step = build(rows, path)
    spark.createDataFrame([], RESULT).write.parquet(found)
    queries = keep(rows.filter(asked).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    block: list[tuple[int, list[int]]] = []

    def flush() -> None:
        _search(path, spark, low, step, block, k).write.mode("append").parquet(found)
        block.clear()

    for row in queries.toLocalIterator():
        block.append((row.vec_id, row.v))
        if len(block) == QUERY_BLOCK:
            flush()
    if block:
        flush()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = spark.read.schema(RESULT).parquet(found).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
