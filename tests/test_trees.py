"""Trees as tables and lasso optimality against plain NumPy."""

import numpy as np
import pytest

from patio.operators import regression, trees

NAMES = ["a", "twin", "b", "c"]


def data(n=400):
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.integers(0, 6, n), np.zeros(n), rng.integers(0, 2, n), rng.normal(size=n).round(3)])
    x[:, 1] = x[:, 0]  # the same column again: every split of it ties with one of the first
    return x, 100 * (x[:, 0] > 2) + 30 * x[:, 2] * (x[:, 0] > 2) + rng.normal(size=n)


def frame(spark, x, y):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], None if v is None else float(v))
            for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, twin double, b double, c double, label double")


def brute(x, y, points, depth, least):
    """{node: (feature, threshold, rows, mean)} and the leaf of each row; NaN counts as large."""
    x = np.where(np.isnan(x), np.inf, x)
    whole, found, leaf = ((y - y.mean()) ** 2).sum(), {}, np.ones(len(y), int)
    todo = [(1, np.ones(len(y), bool))]
    while todo:
        node, mine = todo.pop()
        leaf[mine] = node
        best = None
        for j, c in enumerate(NAMES):
            for t in points[c]:
                low = mine & (x[:, j] <= t)
                high = mine & ~low
                if min(low.sum(), high.sum()) < least or node.bit_length() > depth:
                    continue
                fall = sum(((y[p] - y[p].mean()) ** 2).sum() * s for p, s in ((mine, 1), (low, -1), (high, -1)))
                gain = round(fall / whole, 9)
                if gain > 0 and (best is None or gain > best[0]):
                    best = (gain, c, t, low, high)
        found[node] = (*(best[1:3] if best else (None, None)), int(mine.sum()), y[mine].mean())
        if best:
            todo += [(2 * node, best[3]), (2 * node + 1, best[4])]
    return found, leaf


@pytest.mark.parametrize("depth, least, holes", [(1, 1, False), (3, 20, False), (4, 5, True)])
def test_tree_against_brute_force(spark, depth, least, holes):
    x, y = data()
    if holes:
        x[::7, 0], x[::11, 3] = np.nan, np.nan
    df = frame(spark, x, y)
    points = trees.split_points(df, NAMES, 8)
    tree = trees.grow_tree(df, NAMES, "label", depth, least, points)
    want, leaf = brute(x, y, points, depth, least)
    got = {r.no: (r.variavel, r.limiar, r.linhas, pytest.approx(r.media)) for r in tree.collect()}
    assert got == want
    assert "twin" not in {v[0] for v in want.values()} or holes
    predicted = {r.id: (r.no, r.prediction) for r in trees.predict_tree(df, tree, ["id"]).collect()}
    assert [predicted[i][0] for i in range(len(y))] == leaf.tolist()
    assert [predicted[i][1] for i in range(len(y))] == pytest.approx([want[n][3] for n in leaf])
    shares = [r.importancia for r in trees.tree_importance(tree).collect()]
    assert sum(shares) == pytest.approx(1)


def test_tree_odd_tables(spark):
    x, y = data(50)
    df = frame(spark, x, y)
    none = trees.grow_tree(df.filter("id < 0"), NAMES, "label")
    assert none.count() == 0 and trees.tree_importance(none).count() == 0
    assert {r.prediction for r in trees.predict_tree(df, none, ["id"]).collect()} == {None}
    flat = trees.grow_tree(frame(spark, x, np.full(50, 4.0)), NAMES, "label", 3, 1).collect()
    assert [(r.no, r.variavel, r.linhas, r.media, r.desvio) for r in flat] == [(1, None, 50, 4.0, 0.0)]
    gaps = trees.grow_tree(frame(spark, x, [None if i % 2 else v for i, v in enumerate(y)]), NAMES, "label", 0).collect()
    assert [(r.no, r.linhas) for r in gaps] == [(1, 25)]
    holes = trees.grow_tree(frame(spark, np.full((50, 4), np.nan), y), NAMES, "label", 2, 1).collect()
    assert [(r.no, r.variavel, r.linhas) for r in holes] == [(1, None, 50)]


def test_lasso_by_gram_table(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(300, 4)) * [1, 20, 0.5, 0] + [0, 3, 1, 4]
    x[:, 2] += 0.4 * x[:, 0]
    y = 50 * x[:, 0] + 2 * x[:, 1] + rng.normal(size=300)
    df = frame(spark, x, y)
    gram = regression.gram_table(df, [*NAMES, "label"])
    z = (x[:, :3] - x[:, :3].mean(axis=0)) / x[:, :3].std(axis=0)
    for alpha in (0.0, 10.0, 45.0, 1e6):
        found = {r.feature: r for r in regression.lasso_optimality(gram, NAMES, "label", alpha).collect()}
        beta = np.array([found[c].coeficiente for c in NAMES[:3]])
        gradient = z.T @ (y - y.mean() - z @ beta) / len(y)
        assert [found[c].gradiente for c in NAMES[:3]] == pytest.approx(gradient, abs=1e-8)
        for b, g, c in zip(beta, gradient, NAMES):
            assert found[c].ativa == (b != 0)
            assert g == pytest.approx(alpha * np.sign(b), abs=1e-8) if b else abs(g) <= alpha + 1e-8
        assert (found["c"].coeficiente, found["c"].ativa) == (0.0, False)
        assert found[""].coeficiente == pytest.approx(y.mean() - (beta * x[:, :3].mean(axis=0) / x[:, :3].std(axis=0)).sum())
    none = regression.gram_table(df.filter("id < 0"), [*NAMES, "label"])
    assert {r.coeficiente for r in regression.lasso_optimality(none, NAMES, "label", 1.0).collect()} == {0.0, None}
