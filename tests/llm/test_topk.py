"""Exact top-k against brute force."""

import math
import random

import numpy as np
import pytest
from compare import difference, duck
from pyspark.sql import functions as F

from skymart.llm import catalog, topk

SCHEMA = "vec_id bigint, embedding array<float>, score int"
SF = "/root/testdata/sf0.001"


def brute(rows, k):
    ints = []
    for i, e, *_ in rows:
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            ints.append((i, [math.floor(1024 * float(np.float32(x))) for x in e]))
    queries = {}
    for i, v in ints:
        if i % 100 == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ints if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def search(spark, rows, k=10):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 100 == 0, k).collect())


@pytest.mark.parametrize("block", [3, 1024])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)], 0) for i in range(0, 3000, 4)]
    rows += [(i, [0.5] * 8, 0) for i in range(1, 400, 4)]  # ties
    rows += [(100, [0.1] * 8, 0), (7, [0.1] * 8, 0), (7, [0.1] * 8, 0)]  # repeated ids and rows
    assert search(spark, rows) == brute(rows, 10)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0], 1),
        (100, [-1.0, 500.0], 1),
        (None, [9.0, 9.0], 1),
        (1, None, 1),
        (2, [1.0, None], 1),
        (3, [1.0, float("nan")], 1),
        (4, [float("inf"), 0.0], 1),
        (5, [3.0], 1),
        (6, [], 1),
        (8, [0.0001, -0.0001], 1),
    ]
    assert search(spark, rows) == brute(rows, 10)


def test_fewer_rows_than_k_and_none(spark):
    assert search(spark, [(0, [1.0], 0), (1, [2.0], 0)]) == [(0, 1, 1, 2048 * 1024)]
    assert search(spark, [(0, [1.0], 0)]) == []
    assert search(spark, []) == []


def test_bounds_hold_and_stop_early():
    rng = np.random.default_rng(0)
    exact = rng.integers(-1000, 1000, (500, 4))
    query = np.array([3, -2, 0, 5])
    read = []

    class Rows(np.ndarray):
        def __getitem__(self, at):
            read.append(len(at))
            return np.asarray(self)[at]

    best = topk.Best(1, 5)
    topk.visit(best, 0, query, (exact @ query + 1).astype(float), np.arange(500), exact.view(Rows))
    assert best.score[0].tolist() == sorted((exact @ query).tolist(), reverse=True)[:5]
    assert sum(read) < 100


def test_query_against_sql(spark):
    result = catalog.op5_topk(spark, SF).toPandas()
    assert difference(result, duck(SF).execute(catalog.ORACLES["op5_topk"]).df()) is None
