import math
import random
from fractions import Fraction

import numpy as np
import pytest

from orderloom.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, c string, w string, component string, n string, i string"


def table(spark, vectors, ids=None):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x", "x", "x") for i, v in zip(ids or range(len(vectors)), vectors)], SCHEMA)


def brute(vectors):
    """n, exact deviations, eigenvalues of the covariance of x, falling, and eigenvectors."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(row, sums)] for row in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, deviations, values[::-1], vectors[:, ::-1].T, centred


def test_against_brute_force(spark):
    rng = np.random.default_rng(5)
    spread = np.diag([5, 3, 2, 1.5, 1, 0.7, 0.5, 0.3, 0.2, 0.1]) @ np.linalg.qr(rng.normal(size=(10, 10)))[0]
    vectors = (rng.normal(size=(300, 10)) @ spread).astype(np.float32).tolist()
    n, deviations, values, axes, centred = brute(vectors)
    got = W.whiten(table(spark, vectors).repartition(5)).collect()
    assert len(got) == 300 * 8
    by = {(r.vec_id, r.component): r for r in got}
    for k in range(8):
        want = centred @ axes[k] / math.sqrt(values[k])
        mine = np.array([by[i, k + 1].whitened for i in range(300)])
        assert min(abs(mine - want).max(), abs(mine + want).max()) < 1e-8
        assert by[0, k + 1].explained == pytest.approx(values[k] / values.sum(), rel=1e-9)
    for r in got:
        assert (r.n, r.deviation, r.deviation_digits) == (n, deviations[r.vec_id], str(deviations[r.vec_id]))
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_rows_that_take_no_part_and_large_entries(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0, -3.0], [4.0, 1.0, 0.5], [4.0, 1.0, 0.5], [-2.0, 0.25, 8.0], [1e30, -7.0, 3e5]]
    odd = [None, [], [nan, 1.0, 1.0], [1.0, None, 1.0], [inf, 0.0, 0.0], [1.0, 2.0], [1.0] * 4]
    got = W.whiten(table(spark, odd + good, [None] * len(odd) + [1, 2, 2, None, 9])).collect()
    assert len(got) == 5 * 3 and {r.n for r in got} == {5}
    x = [[max(-(1 << 62), min(1 << 62, math.floor(1024 * Fraction(float(np.float32(c)))))) for c in v] for v in good]
    sums = [sum(c) for c in zip(*x)]
    want = sorted(str(sum((5 * a - s) ** 2 for a, s in zip(row, sums))) for row in x)
    assert sorted(r.deviation_digits for r in got if r.component == 1) == want
    assert all(r.deviation is None or str(r.deviation) == r.deviation_digits for r in got)
    assert got[0].identity_error < 1e-4


def test_no_rows_and_no_variance(spark):
    for vectors in ([], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5):
        found = W.whiten(table(spark, vectors))
        assert found.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert found.count() == 0


def test_equal_eigenvalues_and_missing_rank(spark):
    vectors = [[float(s * (i == j)) for j in range(3)] + [0.0] for i in range(3) for s in (1, -1)]
    got = W.whiten(table(spark, vectors)).collect()
    assert {r.component for r in got} == {1, 2, 3}  # the fourth dimension has no variance
    assert all(abs(r.explained - 1 / 3) < 1e-12 for r in got) and got[0].identity_error < 1e-12


def test_polynomial_and_roots(spark):
    rng = random.Random(3)
    for n in (1, 2, 3, 7):
        half = [[rng.randrange(-50, 50) for _ in range(n)] for _ in range(n)]
        m = [[sum(a * b for a, b in zip(r, s)) for s in half] for r in half]
        m[-1] = [0] * n if n == 3 else m[-1]
        m = [[0 if n == 3 and n - 1 in (i, j) else v for j, v in enumerate(row)] for i, row in enumerate(m)]
        poly = W.characteristic_polynomial(spark, m)
        for at in range(-3, n + 3):  # as many values as decide it
            square = [[Fraction((at if i == j else 0) - v) for j, v in enumerate(row)] for i, row in enumerate(m)]
            assert sum(c * at ** k for k, c in enumerate(poly)) == determinant(square)
        found, scale = W.largest_roots(poly, n)
        want = [v for v in sorted(np.linalg.eigvalsh(np.array(m, float)), reverse=True) if v > 1e-6]
        assert np.allclose([place / 2 ** scale for place, k in found for _ in range(k)], want, rtol=1e-9)


def determinant(m):
    m, out = [list(r) for r in m], Fraction(1)
    for k in range(len(m)):
        p = next((i for i in range(k, len(m)) if m[i][k]), None)
        if p is None:
            return Fraction(0)
        if p != k:
            m[k], m[p], out = m[p], m[k], -out
        out *= m[k][k]
        for i in range(k + 1, len(m)):
            f = m[i][k] / m[k][k]
            m[i] = [a - f * b for a, b in zip(m[i], m[k])]
    return out


def test_repeated_and_close_roots():
    poly = [1]
    for root in (5, 5, 5, 2, 10 ** 30, 10 ** 30 + 1, 0):  # close ones are told apart, equal ones counted
        poly = [a - root * b for a, b in zip([0, *poly], [*poly, 0])]
    found, scale = W.largest_roots(poly, 7)
    assert [(round(place / 2 ** scale) if place >> scale < 100 else place >> scale, n) for place, n in found] == [
        (10 ** 30 + 1, 1), (10 ** 30, 1), (5, 3), (2, 1)]
