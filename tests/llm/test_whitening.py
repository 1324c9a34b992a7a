from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from prepframe.llm import whitening
from prepframe.llm.queries import QUERIES
from prepframe.llm.whitening import characteristic_polynomial, fit_whitening, largest_roots, polynomial_modulo, primes, products, roots_above


def polynomial(a):
    """By Faddeev and LeVerrier's recurrence in fractions: e_0 .. e_d."""
    d = len(a)
    a = [[Fraction(x) for x in row] for row in a]
    m = [[Fraction(0)] * d for _ in range(d)]
    c, out = Fraction(1), [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(d)) + (c if i == j else 0) for j in range(d)] for i in range(d)]
        c = -sum(a[i][t] * m[t][i] for i in range(d) for t in range(d)) / k
        out.append(c)
    return [x if k % 2 == 0 else -x for k, x in enumerate(out)]


def gram(rows, d, seed=0):
    x = np.random.default_rng(seed).integers(-9, 9, (rows, d)).astype(object)
    return (x.T @ x).tolist()


@pytest.mark.parametrize("rows, d", [(9, 6), (3, 6), (1, 4), (5, 1), (2, 2)])
def test_polynomial(spark, rows, d):
    a = gram(rows, d)
    assert characteristic_polynomial(spark, a) == polynomial(a)


def test_polynomial_of_special_matrices(spark):
    for a in ([[0, 0], [0, 0]], [[2, 0, 0], [0, 2, 0], [0, 0, 5]], [[0]], [[10**30, 0], [0, 1]], [[4, 0, 2, 0], [0, 0, 0, 0], [2, 0, 1, 0], [0, 0, 0, 9]]):
        assert characteristic_polynomial(spark, a) == polynomial(a)
    assert polynomial_modulo(np.array([[0, 1], [1, 0]], object), 7) == [6, 0, 1]


def test_primes():
    found = primes(5)
    assert found[0] == 2**31 - 1 and all(all(p % q for q in range(2, 47000)) for p in found)


def test_roots():
    # (t - 7)^2 (t - 3) (t - 1/2) t: e from the roots
    roots = [Fraction(7), Fraction(7), Fraction(3), Fraction(1, 2), Fraction(0)]
    e = [Fraction(1)]
    for r in roots:
        e = [a + r * b for a, b in zip([*e, 0], [0, *e], strict=True)]
    scaled = [int(x * 2**k) for k, x in enumerate(e)]  # roots twice as large are whole
    found, shift = largest_roots(scaled, 4)
    assert [m for _, m in found] == [2, 1, 1]
    assert all(abs(Fraction(r, 1 << shift) / want - 1) < Fraction(1, 2**190) for (r, _), want in zip(found, (14, 6, 1), strict=True))
    poly = [x if k % 2 == 0 else -x for k, x in enumerate(scaled)]
    assert [roots_above(poly, t) for t in (0, 1, 5, 6, 13, 14)] == [4, 3, 3, 2, 2, 0]
    assert largest_roots([1, 0, 0], 4) == ([], 0)


def test_products_are_exact():
    draw = np.random.default_rng(1)
    for low, high in ((-300, 300), (-(2**40), 2**40), (-(2**63), 2**63 - 1)):
        x = draw.integers(low, high, (57, 3))
        z = np.column_stack([np.ones(57, object), x.astype(object)])
        assert (products(x) == z.T @ z).all()


def compare(rows, plain, components=4):
    """The result against numpy's eigenvectors, from the integers of the distinct vectors."""
    whole = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in plain]
    fit = np.array(sorted({v for _, v in whole}), np.float64)
    n, s = len(fit), fit.sum(axis=0)
    off = fit - s / n
    values, vectors = np.linalg.eigh(off.T @ off / n)
    want = {}
    for i, v in whole:
        deviation = sum((n * a - int(b)) ** 2 for a, b in zip(v, s, strict=True))
        want.setdefault(i, []).append((deviation, (np.array(v) - s / n) @ vectors))
    assert len(rows) == len(whole) * components
    for r in rows:
        k = r["component"]
        e = values[-k]
        assert r["n"] == n and r["identity_error"] < 1e-9 and abs(r["explained"] / (e / values.sum()) - 1) < 1e-9
        assert any(r["deviation"] == d and abs(abs(r["whitened"]) - abs(y[-k]) / math.sqrt(e)) < 1e-7 for d, y in want[r["vec_id"]])


def test_query(spark, sf_dir):
    plain = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = QUERIES["op13_whitening"](spark, sf_dir)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = found.collect()
    compare(rows, plain)
    assert len({r["identity_error"] for r in rows}) == 1
    # the whitened distinct vectors have unit covariance
    by = {}
    for r in rows:
        by.setdefault(r["vec_id"], {})[r["component"]] = r["whitened"]
    w = np.array([[own[k] for k in (1, 2, 3, 4)] for own in by.values()])
    if len(by) == rows[0]["n"]:
        assert np.abs(np.cov(w.T, bias=True) - np.eye(4)).max() < 1e-9


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.1, 0.2, 0.3]), (2, [0.1, 0.2, 0.3]), (2, [0.5, -0.25, 0.0]), (None, [1.0, 1.0, -1.0]), (4, [0.0, 0.7, 0.1]), (5, [3.0, 0.0, 0.0])]
    bad = [(6, None), (7, [0.1, None, 0.2]), (8, [0.1, nan, 0.2]), (9, [inf, 0.0, 0.0]), (10, [-inf, 0.0, 0.0])]
    short = [(11, [0.5, -0.25]), (12, []), (13, [0.5, -0.25, 0.0])]
    df = spark.createDataFrame(good + bad + short, "vec_id long, embedding array<double>").selectExpr("*", "1 AS x", "2 AS component", "3 AS `a.b`")
    rows = fit_whitening(df).transform(df).collect()
    filled = [(i, [*v, 0.0, 0.0, 0.0][:3]) for i, v in good + short]
    compare(rows, filled, 3)
    assert {r["n"] for r in rows} == {6}
    for none in (df.limit(0), df.where("vec_id IN (6, 7, 8, 9, 10)"), df.where("vec_id = 1"), df.where("vec_id = 12")):
        model = fit_whitening(none)
        assert model.transform(none).count() == 0 and len(model.roots) == 0


def test_equal_eigenvalues_and_large_entries(spark):
    corners = [(i, [float(v) for v in row]) for i, row in enumerate([[1, 0, 0], [-1, 0, 0], [0, 1, 0], [0, -1, 0], [0, 0, 2], [0, 0, -2]])]
    df = spark.createDataFrame(corners, "vec_id long, embedding array<float>")
    model = fit_whitening(df)
    assert np.allclose(model.components @ model.components.T, np.eye(3)) and model.identity_error < 1e-9
    assert np.allclose(model.explained, [4 / 6, 1 / 6, 1 / 6])
    huge = spark.createDataFrame([(1, [1e15, 0.0]), (2, [-1e15, 1.0]), (3, [0.0, 2e15]), (4, [1e300, 0.0])], "vec_id long, embedding array<double>")
    found = fit_whitening(huge)
    rows = found.transform(huge).collect()
    assert len(rows) == 8 and found.identity_error < 1e-6 and all(r["deviation"] is None for r in rows)
    assert whitening.fit_whitening(huge.where("vec_id < 3")).identity_error < 1e-6
