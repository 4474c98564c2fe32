import itertools
import math
import random
import time

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from patio.operators import clustering, regression
from patio.sources.views import listings

COLUMNS = ["a", "b"]


def blobs(spark, n=60):
    r = random.Random(5)
    centers = [(0, 0), (10, 0), (0, 10)]
    rows = [(f"p{i}", *(c + r.gauss(0, 1) for c in centers[i % 3]), i % 3) for i in range(n)]
    return rows, spark.createDataFrame(rows, "key string, a double, b double, truth int")


def test_kmeans_finds_separate_blobs(spark):
    rows, df = blobs(spark)
    assigned, centers = clustering.kmeans_assign(df, "key", [3], restarts=3, columns=COLUMNS)
    pairs = {(r.truth, r.cluster_km) for r in assigned.collect()}
    assert len(pairs) == 3 and len(centers) == 3
    sweep = clustering.kmeans_sweep(df, "key", range(2, 5), restarts=3, columns=COLUMNS).collect()
    assert [r.k for r in sweep if r.melhor] == [3]
    assert all(a.inercia > b.inercia for a, b in itertools.pairwise(sweep))


@pytest.mark.parametrize("chunk", [1000, 17])
def test_silhouette_against_brute_force(spark, chunk):
    rows, df = blobs(spark, 40)
    rows.append(("single", 50.0, 50.0, 9))
    df = spark.createDataFrame(rows, df.schema)

    def dist(p, q):
        return math.dist(p[1:3], q[1:3])

    total = 0.0
    for p in rows:
        mine = [q for q in rows if q[3] == p[3] and q is not p]
        if mine:
            a = sum(dist(p, q) for q in mine) / len(mine)
            b = min(np.mean([dist(p, q) for q in rows if q[3] == c])
                    for c in {q[3] for q in rows} - {p[3]})
            total += (b - a) / max(a, b)
    got = clustering.silhouette_euclid(df, "key", COLUMNS, ["truth"], chunk=chunk).first()
    assert got.silhouette == pytest.approx(total / len(rows))


def test_cluster_labels_use_quartiles(spark):
    entities = spark.createDataFrame(
        [(float(m), f) for m, f in zip(range(1, 9), [1, 1, 1, 1, 2, 2, 9, 9])],
        "monetary double, frequency int")
    profile = spark.createDataFrame([(0, 7.0, 1.0), (1, 5.0, 9.0), (2, 2.0, 1.0), (3, 4.0, 1.0)],
                                    "cluster_km int, M double, F double")
    out = [r.cluster_km_label for r in clustering.cluster_label(profile, entities).orderBy(
        "cluster_km").collect()]
    assert out == ["KM-Premium", "KM-Alto Volume", "KM-Econômico", "KM-Médio"]


def test_pca_matches_svd(spark):
    rows, df = blobs(spark)
    assigned, centers = clustering.kmeans_assign(df, "key", [3], restarts=2, columns=COLUMNS)
    out = clustering.pca_2d(assigned, "key", centers, COLUMNS).collect()
    x = np.array([r[1:3] for r in rows])
    x = x - x.mean(axis=0)
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    got = {r.chave: r for r in out if r.tipo == "entidade"}
    for i, r in enumerate(rows):
        assert abs(got[r[0]].pc1) == pytest.approx(abs((u * s)[i, 0]), abs=1e-6)
    assert out[0].var1 == pytest.approx(s[0] ** 2 / (s ** 2).sum())
    assert sum(r.tipo == "centroide" for r in out) == 3


def numeric_rows(spark, n=200):
    r = random.Random(6)
    rows = []
    for i in range(n):
        x = [r.gauss(0, 1), r.gauss(0, 2), r.gauss(0, 1)]
        rows.append((i, *x, 300 * x[0] - 50 * x[1] + r.gauss(0, 30) + 1000))
    df = spark.createDataFrame(rows, "id long, x0 double, x1 double, x2 double, label double")
    raw = VectorAssembler(inputCols=["x0", "x1", "x2"], outputCol="raw").transform(df)
    data = np.array([r[1:] for r in rows])
    z = (data[:, :3] - data[:, :3].mean(axis=0)) / data[:, :3].std(axis=0)
    return regression.scale_features(raw).apply(raw), z, data[:, 3]


def test_ridge_matches_normal_equations(spark):
    train, z, y = numeric_rows(spark)
    model, _ = regression.predict("ridge", train, train)
    want = np.linalg.solve(z.T @ z + np.eye(3), z.T @ (y - y.mean()))
    assert model.coefficients.toArray() == pytest.approx(want, rel=1e-6)


def test_lasso_satisfies_optimality(spark):
    train, z, y = numeric_rows(spark)
    model, _ = regression.predict("lasso", train, train)
    beta = model.coefficients.toArray()
    grad = z.T @ (y - y.mean() - z @ beta) / len(y)
    for b, g in zip(beta, grad):
        if abs(b) > 1e-8:
            assert g == pytest.approx(10.0 * np.sign(b), abs=1e-3)
        else:
            assert abs(g) <= 10.0 + 1e-3


def test_centred_scaling(spark):
    train, z, _ = numeric_rows(spark)
    scaler = regression.scale_features(train.drop("features"))
    from pyspark.ml.functions import vector_to_array
    got = scaler.apply(train.drop("features"), center=True).select(
        "id", vector_to_array("features").alias("f")).orderBy("id").collect()
    assert np.allclose([r.f for r in got], z)


def test_features_drop_first_level(spark, sf):
    engineered = regression.engineer(listings(spark, sf))
    space = regression.feature_matrix(engineered)
    assert "combustivel_Diesel" not in space.names and "combustivel_Flex" in space.names
    row = space.transform(engineered).first()
    assert row.raw.size == len(space.names)
    one = engineered.filter((F.col("combustivel") == "Flex")).limit(1)
    vector = space.transform(one).first().raw
    assert vector[space.names.index("combustivel_Flex")] == 1.0
    assert vector[space.names.index("combustivel_Gasolina")] == 0.0


def test_split_is_stable(spark, sf):
    df = listings(spark, sf).select("id")
    train, test = regression.split_train_test(df)
    again = regression.split_train_test(df.repartition(9))[1]
    assert {r.id for r in test.collect()} == {r.id for r in again.collect()}
    assert train.count() + test.count() == df.count()
    assert 0.15 < test.count() / df.count() < 0.25


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([("m", 1.0, 2.0), ("m", 3.0, 3.0), ("m", 5.0, 3.0)],
                               "modelo string, label double, prediction double")
    row = regression.regression_metrics(df).first()
    assert (row.r2, row.mae, row.rmse) == pytest.approx(
        (1 - 5 / 8, 1.0, math.sqrt(5 / 3)), abs=1e-4)


def test_kfold_covers_every_row(spark):
    train, _, _ = numeric_rows(spark)
    out = regression.kfold_cv(train, ["linear"]).collect()
    assert sorted(r.fold for r in out) == [1, 2, 3, 4, 5] and all(r.r2 > 0.9 for r in out)


def test_gram_models_match_normal_equations(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 3)) * [1, 50, 0.1] + [5, -3, 0]
    y = x @ [2.0, 0.3, -40.0] + 7 + rng.normal(size=300)
    df = spark.createDataFrame([(i, *map(float, r), 4.0, float(v)) for i, (r, v) in enumerate(zip(x, y))],
                               "id long, a double, b double, c double, flat double, label double")
    names = ["a", "b", "c", "flat"]
    gram = regression.gram_table(df, [*names, "label"])
    for alpha in (0.0, 25.0):
        coefficients = regression.gram_coefficients(gram, names, "label", {"m": alpha})
        got = {r.feature: r.coeficiente for r in coefficients.collect()}
        z = (x - x.mean(axis=0)) / x.std(axis=0)
        want = np.linalg.solve(z.T @ z + alpha * np.eye(3), z.T @ (y - y.mean()))
        assert [got[c] for c in names] == pytest.approx([*want, 0.0])
        predicted = {r.id: r.prediction for r in regression.predict_gram(df, gram, coefficients, names).collect()}
        assert [predicted[i] for i in range(300)] == pytest.approx(z @ want + y.mean())
    none = regression.gram_table(df.filter("id < 0"), [*names, "label"])
    assert {r.coeficiente for r in regression.gram_coefficients(none, names, "label", {"m": 1.0}).collect()} == {0.0, None}


def test_long_features_equal_vectors(spark, sf):
    engineered = regression.engineer(listings(spark, sf))
    space = regression.feature_matrix(engineered)
    want = {(r.id, space.names[i], v) for r in space.transform(engineered).collect()
            for i, v in zip(*map(list, (r.raw.toArray().nonzero()[0], r.raw.toArray()[r.raw.toArray().nonzero()])))}
    assert {tuple(r) for r in regression.long_features(engineered).collect()} == want


def test_long_scaling_counts_zeros(spark):
    long = spark.createDataFrame([(1, "a", 2.0), (2, "a", 4.0), (2, "b", 1.0), (3, "c", 1.0), (9, "b", 8.0)],
                                 "id long, feature string, valor double")
    got = {(r.id, r.feature): r.valor for r in regression.scale_long(long, F.col("id") < 9).collect()}
    a, b = np.std([2, 4, 0]), np.std([0, 1, 0])
    assert got == pytest.approx({(1, "a"): 2 / a, (2, "a"): 4 / a, (2, "b"): 1 / b, (3, "c"): 1 / b, (9, "b"): 8 / b})


def test_folds_are_whole(spark):
    train, _, _ = numeric_rows(spark)
    out = regression.kfold_cv(train, ["linear"]).collect()
    assert sum(r.linhas for r in out) == train.count()


def test_folds_fit_equal_features_once(spark, monkeypatch):
    """Fits read two rows at most per fold and feature vector, trees are grown one at a time, and the scores are those of
    fits on all rows."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 4, size=(600, 2))
    y = x @ [30.0, -8.0] + 5 * x[:, 0] * x[:, 1] + rng.normal(size=600)
    train = spark.createDataFrame([(i, Vectors.dense(list(map(float, r))), float(v)) for i, (r, v) in enumerate(zip(x, y))],
                                  ["id", "features", "label"])
    read, at_once, trees = [], [], []
    plain, fit = regression.estimator, DecisionTreeRegressor._fit

    def estimator(name, rows, *more):
        read.append(rows.count())
        return plain(name, rows, *more)

    def grow(self, rows):
        trees.append(1)
        at_once.append(len(trees))
        time.sleep(0.2)
        try:
            return fit(self, rows)
        finally:
            trees.pop()

    monkeypatch.setattr(regression, "estimator", estimator)
    monkeypatch.setattr(DecisionTreeRegressor, "_fit", grow)
    got = {(r.modelo, r.fold): (r.linhas, r.r2) for r in regression.kfold_cv(train).collect()}
    assert len(read) == 20 and max(read) <= 2 * 16 * 4
    assert len(at_once) == 5 and max(at_once) == 1
    monkeypatch.undo()
    fold = regression.hash_bucket(43, 5)
    for name in regression.MODELS:
        for i in (0, 3):
            _, predicted = regression.predict(name, train.filter(fold != i), train.filter(fold == i))
            want = regression.regression_metrics(predicted, rows=True).first()
            assert got[name, i + 1] == (want.linhas, pytest.approx(want.r2, abs=2e-6))


def test_folds_refuse_null_labels(spark):
    rows = [(i, Vectors.dense([float(i % 3)]), None if i == 7 else float(i)) for i in range(40)]
    train = spark.createDataFrame(rows, ["id", "features", "label"])
    with pytest.raises(Exception, match="(?i)null"):
        regression.kfold_cv(train, ["linear"])
