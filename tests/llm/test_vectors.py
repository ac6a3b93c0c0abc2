"""Nearest neighbours and exact top-k, against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import blocks, neighbours, topk

SCHEMA = "vec_id long, embedding array<float>, _v string, block int"


def frame(spark, vectors, **odd):
    rows = [(int(i), None if v is None else [None if x is None else float(x) for x in v], "v", 1) for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA)


def product(q, x):
    total = 0.0  # sum() would add more exactly than one number after the other
    for a, b in zip(q, x):
        total += a * b
    return total


def brute(vectors, asked, k, zero, exact=product):
    def good(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))

    kept = [(i, v) for i, v in vectors if i is not None and good(v)]
    out = []
    for q, v in kept:
        if q % asked == 0:
            scores = sorted((-exact(v, x), i) for i, x in kept if i != q and len(x) == len(v))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def some_vectors(seed, n=400, dim=16, whole=False):
    draw = np.random.default_rng(seed)
    made = draw.integers(-40, 40, (n, dim)) if whole else draw.normal(size=(n, dim)).astype(np.float32)
    made[n // 2 : n // 2 + n // 3] = made[0]  # a vector that a third of the rows share
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(made)]
    vectors[5] = (5, None)
    vectors[10] = (10, [float("nan")] + [1.0] * (dim - 1))
    vectors[15] = (15, [0.0] * dim)
    vectors[20] = (20, [1.0] * 3)
    vectors[25] = (25, [None] * dim)
    vectors[30] = (30, [float("inf")] * dim)
    vectors[40] = (40, [0.5, 2.0, 1.0])
    return vectors


@pytest.mark.parametrize("seed", range(2))
def test_neighbours_are_those_of_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(neighbours, "ROWS_PER_BLOCK", 90)
    monkeypatch.setattr(neighbours, "QUERIES_PER_BLOCK", 20)
    vectors = some_vectors(seed)
    got = neighbours.nearest(frame(spark, vectors), F.col("_id") % 5 == 0, 7)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(vectors, 5, 7, zero=False)


@pytest.mark.parametrize("seed", range(2))
def test_top_k_is_that_of_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(topk, "ROWS_PER_SHARD", 120)
    monkeypatch.setattr(topk, "QUERIES_PER_BLOCK", 20)
    monkeypatch.setattr(topk, "LEAF", 8)
    vectors = some_vectors(seed, whole=True)
    got = topk.top_k(frame(spark, vectors), F.col("_id") % 5 == 0, 6)
    assert sorted(map(tuple, got.collect())) == brute(vectors, 5, 6, zero=True)


def test_few_vectors_repeated_ids_and_none(spark):
    few = frame(spark, [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (3, [2.0, 2.0])])
    for found in (neighbours.nearest(few, F.col("_id") % 5 == 0, 9), topk.top_k(few, F.col("_id") % 5 == 0, 9)):
        assert [tuple(r) for r in found.collect()] == [(0, 1, 3, 6.0)]
    none = few.limit(0)
    assert neighbours.nearest(none, F.col("_id") % 5 == 0, 9).count() == topk.top_k(none, F.col("_id") % 5 == 0, 9).count() == 0
    assert neighbours.nearest(few, F.col("_id") == 7, 9).count() == 0


def test_whole_numbers(spark):
    got = topk.whole_numbers(frame(spark, [(1, [0.1, -0.1, 1.0]), (2, [float("nan"), None, 2.0]), (3, None)])).collect()
    assert got[0]["embedding"] == [25.0, -26.0, 256.0] and math.isnan(got[1]["embedding"][0]) and got[2]["embedding"] is None


def test_error_bounds_hold():
    draw = np.random.default_rng(1)
    q, x = draw.normal(size=(50, 24)), draw.normal(size=(60, 24)) * draw.lognormal(size=(60, 1))
    (qi, qs, qk, ql), (xi, xs, xk, xl) = neighbours.quantised(q), neighbours.quantised(x)
    about = (qi.astype(float) @ xi.T.astype(float)) * qs[:, None] * xs[None]
    error = qk[:, None] * xl[None] + ql[:, None] * (xk + xl)[None]
    assert (np.abs(q @ x.T - about) <= error + 1e-9).all()


def test_trees_hold_every_row_in_tight_boxes():
    import pickle

    draw = np.random.default_rng(2)
    matrix = draw.integers(-9, 9, (500, 5)).astype(float)
    ids, rows, extra = topk.grown_tree(np.arange(500), matrix)
    spans, low, high = pickle.loads(extra)
    leaves = [s for s in spans if s[2] < 0]
    assert sorted(ids) == list(range(500)) and sum(e - s for s, e, *_ in leaves) == 500
    for (start, end, *_), a, b in zip(spans, low, high):
        assert (rows[start:end].min(axis=0) == a).all() and (rows[start:end].max(axis=0) == b).all()
    assert (rows == matrix[ids]).all() and blocks.exact_products(rows[:2], rows[:2])[0] == (rows[0] ** 2).sum()
