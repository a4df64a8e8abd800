"""Embedding whitening against plain linear algebra, and its exact parts against exact ones."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import whiten

VECTORS = "vec_id long, embedding array<float>, label int"


def made(dims=7, n=60, seed=3):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, dims)) @ rng.normal(size=(dims, dims))
    return [[i, [float(np.float32(x)) for x in v], i % 3] for i, v in enumerate(mixed)]


def whole(vector):
    return tuple(math.floor(64 * c) + 1_000_000 for c in vector)


def brute(vectors):
    """Exact deviations, and the coordinates up to their signs."""
    x = [whole(v) for v in vectors]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums)] for v in fit])
    e, w = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-e)
    rows = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums)] for v in x])
    return n, deviation, e[order], rows @ w[:, order]


def table(df, id_col="vec_id"):
    out = {}
    for r in df.collect():
        out.setdefault(r[id_col], {})[r.component] = r
    return out


def test_whitening_is_that_of_linear_algebra(spark):
    rows = made()
    rows += [[100 + i, rows[5][1], 0] for i in range(40)]  # copies count once in the fit
    got = table(whiten.whiten(spark.createDataFrame(rows, VECTORS).repartition(5)))
    n, deviation, values, coordinates = brute([r[1] for r in rows])
    assert n == 60 and sorted(got) == sorted(r[0] for r in rows)
    for (key, _, _), dev, at in zip(rows, deviation, coordinates, strict=True):
        assert sorted(got[key]) == list(range(1, 8))
        for k, r in got[key].items():
            assert r.n == n and r.deviation == dev and r.identity_error < 1e-9
            assert r.explained == pytest.approx(values[k - 1] / values.sum(), rel=1e-9)
            assert abs(r.whitened) == pytest.approx(abs(at[k - 1]) / math.sqrt(values[k - 1]), rel=1e-7, abs=1e-9)
    signs = {k: {math.copysign(1, got[r[0]][k].whitened * at[k - 1]) for r, at in zip(rows, coordinates) if abs(at[k - 1]) > 1e-6} for k in range(1, 8)}
    assert all(len(s) == 1 for s in signs.values())


def test_odd_vectors(spark):
    rows = made(4, 30)
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [1.0, None, 2.0, 3.0], [nan, 0.0, 0.0, 0.0], [inf, 0.0, 0.0, 0.0], [1.0, 2.0], [3e38, 0.0, 0.0, 0.0]]
    odd = rows + [[200 + i, v, None] for i, v in enumerate(bad)] + [[None, rows[0][1], 1], [7, rows[1][1], 1]]
    df = spark.createDataFrame(odd, VECTORS).withColumns({c: F.lit(1) for c in ("component", "n", "whitened", "__x", "v")})
    out = whiten.whiten(df, components=3).collect()
    assert sorted((-1 if r.vec_id is None else r.vec_id) for r in out) == sorted([*range(30), -1, 7] * 3)
    n, deviation, _, _ = brute([r[1] for r in rows])
    assert {r.deviation for r in out if r.vec_id == 3} == {deviation[3]} and out[0].n == n


def test_nothing_to_whiten(spark):
    empty = spark.createDataFrame([], VECTORS)
    one = spark.createDataFrame([[1, [1.0, 2.0], 0], [2, [1.0, 2.0], 0]], VECTORS)
    nulls = spark.createDataFrame([[1, None, 0]], VECTORS)
    for df in (empty, one, nulls):
        out = whiten.whiten(df)
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert out.count() == 0


def test_equal_eigenvalues_and_missing_rank(spark):
    """A cross in the first two dimensions, the third the sum of both, the fourth constant."""
    points = [(1, 0), (-1, 0), (0, 1), (0, -1)]
    rows = [[i, [float(a), float(b), 0.0, 5.0], 0] for i, (a, b) in enumerate(points)]
    out = table(whiten.whiten(spark.createDataFrame(rows, VECTORS)))
    assert all(sorted(v) == [1, 2] for v in out.values())
    w = np.array([[out[i][k].whitened for k in (1, 2)] for i in range(4)])
    assert np.allclose(w.T @ w / 4, np.eye(2)) and out[0][1].identity_error < 1e-12
    assert out[0][1].explained == pytest.approx(0.5) == out[0][2].explained


def test_nearly_equal_eigenvalues_and_large_entries(spark):
    """Two variances apart by a few parts in 10**9, and sums that no double holds."""
    side = [float(2**20)] * 2
    rows = [[i, [a * (1 + (0.0 if k else 2.0**-22)) if k == j else 0.0 for k, a in enumerate(side)], 0] for i, (j, s) in enumerate([(0, 1), (1, 1)])]
    rows += [[r[0] + 2, [-x for x in r[1]], 0] for r in rows]
    out = table(whiten.whiten(spark.createDataFrame(rows, VECTORS)))
    assert out[0][1].explained > out[0][2].explained
    assert abs(out[0][1].whitened) == pytest.approx(math.sqrt(2)) and abs(out[1][1].whitened) < 1e-6


def test_polynomial_and_roots(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(-50, 50, (9, 6))
    m = [[int(v) for v in row] for row in x.T @ x]
    poly = whiten.characteristic_polynomial(spark, m)
    assert poly[-1] == 1 and poly[-2] == -sum(m[i][i] for i in range(6))
    minors = [[Fraction(v) for v in row] for row in m]
    det = Fraction(1)
    for k in range(6):
        det *= minors[k][k]
        for i in range(k + 1, 6):
            q = minors[i][k] / minors[k][k]
            minors[i] = [a - q * b for a, b in zip(minors[i], minors[k], strict=True)]
    assert poly[0] == det
    roots = whiten.largest_roots(poly, 6)
    assert np.allclose([float(r) for r, _ in roots], sorted(np.linalg.eigvalsh(np.array(m, float)), reverse=True))
    # (x - 3)^2 (x - 2) x and one root just above another
    assert [(round(float(r)), t) for r, t in whiten.largest_roots([0, -18, 21, -8, 1], 4)] == [(3, 2), (2, 1)]
    assert [t for _, t in whiten.largest_roots([(10**12 + 1) * 10**12, -(2 * 10**12 + 1), 1], 2)] == [1, 1]


def test_sums_that_need_wide_integers():
    x = np.array([[2**40, -(2**40)], [3, 2**40 + 1]], np.int64)
    assert whiten._exact_products(x).tolist() == [[2**80 + 9, -(2**80) + 3 * (2**40 + 1)], [-(2**80) + 3 * (2**40 + 1), 2**80 + (2**40 + 1) ** 2]]
    assert whiten._exact_products(np.zeros((0, 2), np.int64)).tolist() == [[0, 0], [0, 0]]
