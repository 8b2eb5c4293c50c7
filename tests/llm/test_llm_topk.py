"""Exact search, against all products."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterline.llm import topk

SCHEMA = "vec_id long, embedding array<double>, id long, v string, shard int"


def brute(rows, k=5):
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in fine:
        if i % 50 == 0:
            asked[i] = min(v, asked.get(i, v))
    out = []
    for i, q in asked.items():
        best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in fine if j != i)[:k]
        out += [(i, n, j, -s) for n, (s, j) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [100_000, 400])
def test_search(spark, shard_rows):
    """Ties, repeated rows, invalid and short and huge vectors, queries among them."""
    rnd = random.Random(4)
    rows = [(i, [rnd.choice([-1.5, 0.25, 0.5, 2.0, 0.0]) for _ in range(6)]) for i in range(2500)]
    rows += [(50, rows[7][1]), (3001, None), (3002, [1.0, None]), (3003, [float("nan")]), (3006, [float("inf")]), (None, [1.0]), (3050, []),
             (3100, [1.0]), (3005, [2.0] * 9), (3005, [2.0] * 9), (3007, [3e6, -2.0]), (3150, [3e6, 1.0]), (-50, [0.1] * 6)]
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)
    got = topk.top_k(df, "vec_id", "embedding", F.col("vec_id") % 50 == 0, shard_rows=shard_rows)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_fewer_than_k(spark):
    df = spark.createDataFrame([(0, [1.0], 1, "x", 2), (1, [2.0], 1, "x", 2)], SCHEMA)
    got = topk.top_k(df, "vec_id", "embedding", F.col("vec_id") % 50 == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(df.where("false"), "vec_id", "embedding", F.col("vec_id") % 50 == 0).isEmpty()


def vectors(seed, n, dims):
    """Clustered, some sparse, with ties and copies."""
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(12, dims))
    rows = np.floor(256 * (centres[rnd.integers(0, 12, n)] * rnd.uniform(0.2, 2, (n, 1)) + 0.2 * rnd.normal(size=(n, dims))))
    rows[rnd.random((n, dims)) < 0.3] = 0
    rows[n // 2:n // 2 + 200] = rows[7]
    return rnd.permutation(np.arange(n)), rows


def best_of(ids, rows, own, query, k):
    scores = rows @ query
    return sorted(((-int(s), int(i)) for s, i in zip(scores, ids) if i != own))[:k]


@pytest.mark.parametrize("kind", [np.float64, object])
def test_blocks_are_pruned(kind):
    """Shards far above a block: the scores of most rows are never finished, and the rest is exact."""
    n = 5000 if kind is np.float64 else 2300
    ids, rows = vectors(3, n, 16)
    shard = topk.Shard(ids, rows.astype(np.int64).astype(kind))
    assert len(shard.starts) > 2
    own = np.arange(0, n, 97)
    queries = np.stack([rows[np.flatnonzero(ids == i)[0]] for i in own]).astype(np.int64).astype(kind)
    for k in (1, 5):
        for i, q, got in zip(own, queries, shard.search(own, queries, k), strict=True):
            assert [(-s, j) for s, j in got] == best_of(ids, rows, i, q, k)
    assert 0 < shard.probed < shard.passed / 4


def test_every_threshold():
    """Small shards, few distinct scores, negative ones and queries of zeros."""
    rnd = np.random.default_rng(5)
    for n in (1, 2, 5, 6, 7, 40, 1500):
        ids, rows = np.arange(n) * 3, rnd.integers(-2, 3, (n, 3)).astype(np.float64) - (rnd.random() < 0.5)
        shard = topk.Shard(ids, rows)
        queries = np.array([[0, 0, 0], [1, 0, -1], [-2, -2, -2], [2, 1, 1]], np.float64)
        for own in (0, 1):
            for q, got in zip(queries, shard.search(np.full(4, own), queries, 5), strict=True):
                assert [(-s, i) for s, i in got] == best_of(ids, rows, own, q, 5)


def test_search_in_large_shards(spark):
    """Four shards of over 2,000 rows."""
    ids, rows = vectors(8, 9000, 8)
    df = spark.createDataFrame([(int(i), (r / 256).tolist()) for i, r in zip(ids, rows)], "vec_id long, embedding array<double>")
    got = topk.top_k(df, "vec_id", "embedding", F.col("vec_id") % 450 == 0)
    want = [(own, n, i, -s) for own in range(0, 9000, 450)
            for n, (s, i) in enumerate(best_of(ids, rows, own, rows[np.flatnonzero(ids == own)[0]], 5), 1)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
