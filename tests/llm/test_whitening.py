from __future__ import annotations

from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest

from millrace.llm import whitening as W
from millrace.llm import workload


def brute(rows, most=4):
    """Whole numbers, exact sums, and numpy's eigenvectors, row by row."""
    usable = [(i, tuple(floor(256 * float(c)) for c in v)) for i, v in rows if v and all(c is not None and isfinite(c) for c in v)]
    fit = sorted({x for _, x in usable})
    n, total = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, total, strict=True)] for x in fit])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    out = []
    for i, x in usable:
        moved = [n * a - s for a, s in zip(x, total, strict=True)]
        out.append((i, n, sum(m * m for m in moved), np.array([float(Fraction(m, n)) for m in moved]) @ vectors / np.sqrt(values)))
    return out, values / np.trace(covariance)


def test_query_agrees_with_numpy(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    expected, explained = brute(rows)
    got: dict = {}
    for r in workload.QUERIES["op11_whitening"](spark, folder).collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    assert set(got) == {i for i, *_ in expected}
    signs = np.ones(4)
    for number, (i, n, deviation, whitened) in enumerate(expected):
        assert sorted(got[i]) == [1, 2, 3, 4]
        values = np.array([got[i][c].whitened for c in (1, 2, 3, 4)])
        if not number:
            signs = np.sign(values * whitened)
        assert np.allclose(values, signs * whitened, rtol=1e-9, atol=1e-9)
        assert {(r.n, r.deviation) for r in got[i].values()} == {(n, deviation)}
        assert np.allclose([got[i][c].explained for c in (1, 2, 3, 4)], explained, rtol=1e-9)
        assert max(r.identity_error for r in got[i].values()) < 1e-9


@pytest.mark.parametrize("d,rank", [(1, 1), (2, 2), (7, 3), (16, 16), (33, 20)])
def test_principal_directions_of_any_rank(d, rank):
    draw = np.random.default_rng(d)
    factor = draw.normal(size=(d, rank)) * 10.0 ** draw.uniform(-3, 3, rank)
    scatter = factor @ factor.T
    vectors, values = W.principal(scatter, d)
    assert np.allclose(vectors.T @ vectors, np.eye(vectors.shape[1]), atol=1e-9)
    assert np.allclose(values[:3], np.linalg.eigvalsh(scatter)[::-1][:3], rtol=1e-10)
    assert np.allclose(vectors * values @ vectors.T, scatter, atol=1e-12 * np.abs(scatter).max() * d)


def test_pivoted_cholesky_gives_the_matrix_back():
    a = np.random.default_rng(3).normal(size=(9, 6))
    lower, order = W.pivoted_cholesky(a @ a.T)
    assert lower.shape == (9, 6) and np.allclose(lower, np.tril(lower))
    assert np.allclose(lower @ lower.T, (a @ a.T)[np.ix_(order, order)])
    assert W.pivoted_cholesky(np.zeros((3, 3)))[0].shape == (3, 0)


def whitened(df, most=4):
    model = W.fit(df, "v", most)
    return model, W.whiten(df, "v", model).collect()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (None, [-0.0, 2.0]), (3, None), (4, []), (5, [1.0, None]), (6, [nan, 0.0]), (7, [1.0, -inf]),
            (8, [1.0, 2.0, 3.0]), (9, [1e300, 0.0]), (10, [-3.25, 0.001]), (10, [-3.25, 0.001])]
    df = spark.createDataFrame([(i, v, "mine") for i, v in data], "i long, v array<double>, whitened string")
    model, rows = whitened(df)
    used = [(i, v) for i, v in data if i in (1, 2, None, 10)]
    expected, explained = brute(used)
    assert model.size == 3 and np.allclose(model.explained, explained)
    for row in rows:
        fits = [e for e, (i, v) in zip(expected, used, strict=True) if i == row.i and row.v == v]
        assert (row.whitened is None) == (not fits)
        if fits:
            assert row.deviation == fits[0][2] and np.allclose(np.abs(row.whitened), np.abs(fits[0][3]))


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "i long, v array<float>")
    assert whitened(empty)[1] == []
    model, rows = whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "i long, v array<float>"))
    assert model.size == 1 and [(r.whitened, r.deviation) for r in rows] == [([], 0), ([], 0)]
    model, rows = whitened(spark.createDataFrame([(1, None)], "i long, v array<float>"))
    assert [(r.whitened, r.deviation) for r in rows] == [(None, None)]


def test_whole_numbers_of_any_size(spark):
    """Sums beyond 64 bits are exact; a deviation beyond 64 bits is null."""
    big = 2.0 ** 54
    df = spark.createDataFrame([(1, [big, 1.0]), (2, [-big, 2.0]), (3, [big / 2, 3.0])], "i long, v array<double>")
    model, rows = whitened(df, 2)
    assert model.total == [int(128 * big), 256 * 6] and all(r.deviation is None for r in rows)
    assert np.isfinite([r.whitened for r in rows]).all()
    small = spark.createDataFrame([(i, [2.0 ** 40 + i / 256, 1.0]) for i in range(5)], "i long, v array<double>")
    assert [r.deviation for r in whitened(small)[1]] == [(5 * i - 10) ** 2 for i in range(5)]
