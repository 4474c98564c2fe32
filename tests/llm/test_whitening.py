"""Whitening against a dense eigensolver."""

import numpy as np
import pytest
from pyspark.sql import types as T

from patio.llm.plans.pairs import op12_embedding_whitening
from patio.llm.whitening import deviations, largest_eigenpairs, minres, whiten

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("label", T.IntegerType())])


def dense(x, k):
    """n, sums, eigenvalues, eigenvectors and trace of the distinct rows."""
    fit = np.unique(x, axis=0)
    v = np.cov(fit.T.astype(float), bias=True).reshape(x.shape[1], -1)
    values, vectors = np.linalg.eigh(v)
    return len(fit), fit.sum(axis=0), values[::-1][:k], vectors[:, ::-1][:, :k], np.trace(v)


def check(got, rows, k=4):
    x = np.array([np.floor(np.array(v, np.float32).astype(float) * 256).astype(np.int64) for _, v in rows])
    n, sums, values, vectors, trace = dense(x, k)
    k = len(values)
    assert len(got) == len(rows) * k and {r.component for r in got} == set(range(1, k + 1))
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    want = (x - sums / n) @ (vectors / np.sqrt(values))
    signs = {}
    for (i, _), row, exact in zip(rows, want, x):
        for c in range(k):
            r = by[i, c + 1][0]
            sign = signs.setdefault(c, np.sign(r.whitened * row[c])) if abs(row[c]) > 1e-6 else 1
            assert r.whitened * sign == pytest.approx(row[c], abs=1e-9)
            assert r.n == n and r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(exact, sums))
            assert r.explained == pytest.approx(values[c] / trace, rel=1e-9)
            assert r.identity_error < 1e-10


def test_query(spark, sf):
    got = op12_embedding_whitening(spark, sf)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(got.collect(), rows)


def test_copies_and_odd_rows(spark):
    rng = np.random.default_rng(5)
    base = (rng.standard_normal((40, 5)) * [3, 2, 1.5, 1, 0.5]).round(3)
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(100 + i, base[0].tolist()) for i in range(60)]
    odd = [(200, None), (201, []), (202, [1.0, None, 0.0, 0.0, 0.0]), (203, [float("nan")] * 5),
           (204, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (205, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], VECTORS)
    check(whiten(df, keep=["vec_id"]).collect(), rows)
    wide = whiten(df.withColumnRenamed("label", "N").withColumnRenamed("vec_id", "_x"))
    assert wide.columns == ["_x", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert wide.count() == 400


def test_few_distinct_vectors(spark):
    build = lambda rows: whiten(spark.createDataFrame([(i, v, 1) for i, v in rows], VECTORS), keep=["vec_id"])
    assert build([]).count() == 0
    assert build([(1, [1.0, 2.0]), (2, [1.0, 2.0])]).count() == 0  # no variance
    assert build([(1, None)]).count() == 0
    line = build([(1, [0.0, 0.0, 1.0]), (2, [1.0, 1.0, 1.0]), (None, [2.0, 2.0, 1.0])]).collect()
    assert [r.component for r in line] == [1, 1, 1] and line[0].explained == pytest.approx(1)
    assert sorted(round(r.whitened ** 2, 9) for r in line) == [0, 1.5, 1.5]


@pytest.mark.parametrize("shape", [(50, 70), (400, 64), (2000, 49), (300, 3), (200, 1)])
def test_eigenpairs(shape):
    rng = np.random.default_rng(shape[1])
    m = rng.standard_normal(shape) @ np.diag(rng.uniform(0.5, 2, shape[1]))
    v = np.cov(m.T, bias=True).reshape(shape[1], -1)
    values, vectors = largest_eigenpairs(lambda q: v @ q, shape[1], 4)
    want = np.linalg.eigvalsh(v)[::-1][:4]
    np.testing.assert_allclose(values, want, rtol=1e-12)
    assert np.abs(v @ vectors - vectors * values).max() < 1e-12 * want[0]
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)


def test_equal_eigenvalues():
    v = np.diag([3.0] * 6 + [1.0] * 60)
    values, vectors = largest_eigenpairs(lambda q: v @ q, 66, 4)
    np.testing.assert_allclose(values, 3)
    assert np.abs(v @ vectors - 3 * vectors).max() < 1e-12


def test_minres_on_indefinite_systems():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    a = q @ np.diag(np.concatenate([-np.arange(1, 11), np.arange(1, 21)])) @ q.T
    b = rng.standard_normal((30, 3))
    b[:, 1] = 0
    x = minres(lambda t, j: a @ t, b, 60, 1e-13)
    np.testing.assert_allclose(a @ x, b, atol=1e-10)


def test_deviations_are_exact():
    x = np.array([[3, -5], [2 ** 20, 7]])
    sums = np.array([2 ** 31 + 1, -9])
    want = [sum((1000 * int(a) - int(s)) ** 2 for a, s in zip(r, sums)) for r in x]
    assert deviations(x, 1000, sums).tolist() == want
    with pytest.raises(OverflowError):
        deviations(x, 10 ** 13, sums)
