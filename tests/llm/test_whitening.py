"""Whitening against a dense eigendecomposition."""

import math

import numpy as np
import pytest

from millrace.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, dim int, x string, n string"


def frame(spark, vectors):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], 1, "x", "n") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA)


def whole(vectors):
    return [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]


def check(rows, vectors, wanted):
    """Every property of the result, from a dense covariance in exact sums."""
    x, n = whole([v for _, v in vectors]), len(vectors)
    sums = [sum(c) for c in zip(*x)]
    far = np.array([[n * c - s for c, s in zip(r, sums)] for r in x], object)
    centred = (far / n).astype(np.float64)
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1], turn[:, ::-1]
    k = min(wanted, int((values > 1e-10 * values[0]).sum()))
    assert len(rows) == n * k
    by = {}
    for r in rows:
        by.setdefault(r["component"], []).append(r)
    ids = sorted(i for i, _ in vectors)
    deviations = {i: int(sum(c * c for c in f)) for (i, _), f in zip(vectors, far)}
    place = {i: at for at, (i, _) in enumerate(vectors)}
    got = np.zeros((n, k))
    for component, part in by.items():
        part.sort(key=lambda r: r["vec_id"])
        assert [r["vec_id"] for r in part] == ids
        for r in part:
            assert r["n"] == n and r["deviation"] == deviations[r["vec_id"]] and r["identity_error"] <= 1e-6
            assert r["explained"] == pytest.approx(values[component - 1] / values.sum(), rel=1e-9)
            got[place[r["vec_id"]], component - 1] = r["whitened"]
    assert np.abs(got.T @ got / n - np.eye(k)).max() < 1e-7
    for c in range(k):
        gap = min([abs(values[c] - values[d]) for d in range(len(values)) if d != c] or [1.0])
        if gap > 1e-3 * values[0]:
            want = centred @ turn[:, c] / math.sqrt(values[c])
            sign = np.sign(got[:, c] @ want)
            assert np.abs(got[:, c] - sign * want).max() < 1e-6


@pytest.mark.parametrize("seed, n, dim, wanted", [(1, 300, 12, 32), (2, 150, 40, 8), (3, 9, 20, 32), (4, 40, 1, 32)])
def test_whitened_vectors(spark, seed, n, dim, wanted):
    draw = np.random.default_rng(seed)
    data = draw.normal(size=(n, dim)) * np.linspace(3, 0.3, dim)
    vectors = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(data)]
    check(whitening.whiten(frame(spark, vectors), wanted=wanted).collect(), vectors, wanted)


def test_equal_variances_and_rank(spark):
    """A start alone would find one direction of equal ones; a constant dimension has no component."""
    vectors = [(i, [4.0 if j == i // 2 and i % 2 else -4.0 if j == i // 2 else 0.0 for j in range(6)] + [7.0]) for i in range(12)]
    rows = whitening.whiten(frame(spark, vectors)).collect()
    assert {r["component"] for r in rows} == set(range(1, 7)) and len(rows) == 72
    assert all(r["explained"] == pytest.approx(1 / 6) and r["identity_error"] < 1e-9 for r in rows)


def test_a_third_of_equal_rows_and_odd_vectors(spark):
    draw = np.random.default_rng(5)
    data = [[float(np.float32(c)) for c in v] for v in draw.normal(size=(90, 5))]
    data[30:60] = [data[0]] * 30
    good = [(i, v) for i, v in enumerate(data)]
    odd = [(100, None), (101, []), (102, [1.0, None, 1, 1, 1]), (103, [math.nan] * 5), (104, [math.inf] * 5), (105, [1e30] * 5)]
    check(whitening.whiten(frame(spark, good + odd)).collect(), good, 32)


def test_lengths_apart_equal_rows_and_no_rows(spark):
    mixed = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, [1.0, 1.0, 1.0]), (4, [2.0, 1.0, 5.0]), (4, [2.0, 1.0, 5.0])]
    rows = whitening.whiten(frame(spark, mixed)).collect()
    assert sorted((r["vec_id"], r["component"], r["n"]) for r in rows) == [(1, 1, 2), (2, 1, 2), (3, 1, 3), (4, 1, 3), (4, 1, 3)]
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(frame(spark, [])).count() == 0


def test_spread_is_exact_for_large_numbers():
    x = np.array([[2**55, 3], [-(2**55), 5], [1, 7]], np.int64)
    centre = whitening.Centre(3, tuple(int(s) for s in x.astype(object).sum(axis=0)))
    want = [[3 * int(c) - s for c, s in zip(r, centre.sums)] for r in x]
    assert centre.spread(x).tolist() == want
    assert centre.deviation(x) == [None, None, sum(c * c for c in want[2])]
