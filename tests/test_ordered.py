"""Distributed orderings equal plain single-task ones, for any data and partitioning."""

import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from patio.operators import quantiles as quantiles_module
from patio.operators import ranking, stats
from patio.operators.ordered import number_rows, with_neighbours
from patio.operators.quantiles import quantile_row, quantile_table, quantiles, quantiles_by

SHAPES = {
    "spread": lambda r, i: round(r.uniform(0, 1000), 2),
    "hot": lambda r, i: 5.0 if r.random() < 0.4 else float(r.randint(0, 9)),
    "constant": lambda r, i: 1.0,
    "nulls": lambda r, i: None if r.random() < 0.3 else float(r.randint(0, 4)),
}


def exact(v, p):
    h = (len(v) - 1) * p
    lo = int(h)
    hi = min(lo + 1, len(v) - 1)
    return v[lo] + (v[hi] - v[lo]) * (h - lo)


def frame(spark, shape, n=120, parts=5):
    r = random.Random(n)
    rows = [(i * 3, "a" if r.random() < 0.5 else r.choice("bc"), SHAPES[shape](r, i), i % 7 + 0.5)
            for i in range(n)]
    r.shuffle(rows)
    return spark.createDataFrame(rows, "id long, g string, x double, v double").repartition(parts)


@pytest.mark.parametrize("shape", list(SHAPES))
@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("within", [[], ["g"]])
def test_number_rows(spark, tiny, shape, descending, within):
    df = frame(spark, shape)
    x = F.col("x").desc_nulls_last() if descending else F.col("x").asc_nulls_first()
    w = Window.partitionBy(*within).orderBy(x, "id")
    peers = Window.partitionBy(*within).orderBy(x)
    want = df.select(
        "id", F.row_number().over(w).alias("p"), F.rank().over(peers).alias("r"),
        F.count("*").over(Window.partitionBy(*within, "x")).alias("t"),
        F.count("*").over(Window.partitionBy(*within)).alias("n"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
    got = number_rows(df, "x", "id", within, descending, sums=["v"]).select(
        "id", "_pos", "_rank", "_ties", "_n", "_sum_v")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("shape", ["spread", "hot"])
def test_no_single_partition_over_rows(spark, tiny, shape):
    df = frame(spark, shape)
    plan = number_rows(df, "x", "id")._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    windows = [line for line in physical.splitlines() if "Window [row_number" in line]
    assert windows and all("_off" in line for line in windows)


def test_offsets_of_many_cells(spark, tiny):
    """Offsets are added down the tree of cells; no window orders all cells."""
    df = spark.range(3000).select("id", (F.col("id") * 7919 % 3001).cast("double").alias("x"))
    numbered = number_rows(df, "x", "id", sums=["x"])
    plan = numbered._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_off" in line or "_node" in line for line in windows)
    got = sorted((r._pos, r.x, r._sum_x) for r in numbered.collect())
    total = 0
    for i, (pos, x, running) in enumerate(got):
        total += x
        assert (pos, running) == (i + 1, total)


@pytest.mark.parametrize("shape", list(SHAPES))
def test_many_columns_at_once(spark, tiny, shape):
    """All columns in one chain give what each gives by itself."""
    df = frame(spark, shape).withColumn("y", F.col("x") * F.col("v"))
    names = {"x": ["x1", "x2"], "v": ["v1", "v2"], "y": ["y1", "y2"]}
    for keys in (["g"], ["g", "id"]):
        got = quantile_table(df, keys, names, [0.1, 0.75], [F.count("x").alias("n")])
        want = {}
        for r in df.collect():
            want.setdefault(tuple(r[k] for k in keys), []).append(r)
        assert got.count() == len(want)
        for r in got.collect():
            for c, (first, second) in names.items():
                own = sorted(w[c] for w in want[tuple(r[k] for k in keys)] if w[c] is not None)
                assert (r[first], r[second]) == (exact(own, 0.1), exact(own, 0.75)) if own else (None, None)


@pytest.mark.parametrize("shape", list(SHAPES))
def test_narrowed_brackets(spark, tiny, monkeypatch, shape):
    """Brackets from a coarse sketch are narrowed until few rows are left."""
    monkeypatch.setattr(quantiles_module, "ACCURACY", 100)
    monkeypatch.setattr(quantiles_module, "REACH", 0.03)
    df = frame(spark, shape, n=2000)
    probs = [0.0, 0.01, 0.37, 0.5, 0.999, 1.0]
    row = quantile_row(df, ["x", "v"], probs).first()
    for c in ("x", "v"):
        own = sorted(r[c] for r in df.collect() if r[c] is not None)
        assert [row[f"{c}_q{i}"] for i in range(6)] == [pytest.approx(exact(own, p)) for p in probs]


@pytest.mark.parametrize("shape", ["spread", "hot", "constant"])
def test_neighbours(spark, tiny, shape):
    df = frame(spark, shape)

    def around(w):
        return [F.sum("v").over(w.rowsBetween(-6, 0)).alias("a"), F.lag("v").over(w).alias("b"),
                F.lead("v").over(w).alias("c")]

    want = df.select("id", *around(Window.orderBy("x", "id")))
    got = with_neighbours(df, "x", "id", 6, 1, around).select("id", "a", "b", "c")
    key = lambda r: r[0]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


@pytest.mark.parametrize("shape", list(SHAPES))
def test_quantiles(spark, tiny, shape):
    df = frame(spark, shape)
    values = sorted(r.x for r in df.collect() if r.x is not None)
    probs = [0.0, 0.2, 0.25, 0.5, 0.9, 1.0]

    got = {r.p: r.valor for r in quantiles(df, "x", probs).collect()}
    assert got == pytest.approx({p: exact(values, p) for p in probs})
    groups = {r.g: r for r in quantiles_by(df, ["g"], "x", [0.3, 0.5], ["a", "b"],
                                           aggs=[F.count("x").alias("n")]).collect()}
    for g, row in groups.items():
        mine = sorted(r.x for r in df.filter(F.col("g") == g).collect() if r.x is not None)
        assert (row.n, row.a, row.b) == pytest.approx((len(mine), exact(mine, .3), exact(mine, .5)))
    wide = quantile_row(df, ["x", "v"], [0.5], [F.count("v").alias("n")]).first()
    assert wide.x_q0 == pytest.approx(statistics.median(values)) and wide.n == 120


@pytest.mark.parametrize("k, n", [(4, 3), (4, 4), (10, 103), (4, 1), (10, 7)])
def test_ntile(spark, k, n):
    from patio.operators.ordered import ntile_of
    df = spark.range(1, n + 1).withColumn("n", F.lit(n))
    got = df.select(ntile_of(F.col("id"), F.col("n"), k).alias("a"),
                    F.ntile(k).over(Window.orderBy("id")).alias("b")).collect()
    assert all(r.a == r.b for r in got)


def test_top_ranks_with_ties(spark, tiny):
    rows = [(i, "a", 9.0) for i in range(20)] + [(100, "a", 10.0), (101, "a", 1.0),
                                                (102, "b", 3.0), (103, "b", 2.0)]
    df = spark.createDataFrame(rows, "id long, g string, x double")
    out = ranking.rank_triplet(df, "g", "x", "id").collect()
    a = sorted((r for r in out if r.g == "a"), key=lambda r: r.row_num)
    assert [r.id for r in a] == [100, *range(20)]
    assert [r.rank_preco for r in a] == [1] + [2] * 20
    assert [r.dense_rank_preco for r in a] == [1] + [2] * 20
    assert [r.row_num for r in a] == list(range(1, 22))
    assert len(ranking.top_by_rank(df, "g", "x").collect()) == 23


@pytest.mark.parametrize("shape", ["spread", "hot"])
def test_average_ranks(spark, tiny, shape):
    df = frame(spark, shape)
    values = {c: [r[c] for r in df.collect()] for c in ("x", "v")}
    got = stats.average_ranks(df, ["x", "v"], "id").collect()
    assert {(r.id, r.x, r.v) for r in got} == {(r.id, r.x, r.v) for r in df.collect()}
    for r in got:
        for c in values:
            assert r[f"{c}_rank"] == sum(v < r[c] for v in values[c]) + (values[c].count(r[c]) + 1) / 2


def test_average_ranks_order_distinct_values(spark, monkeypatch):
    """The ordering holds a row per column and distinct value, whatever the number of rows; ids stay one row each."""
    ordered_rows, plain = [], stats.number_rows

    def number_rows(df, *more, **named):
        ordered_rows.append(df.count())
        return plain(df, *more, **named)

    monkeypatch.setattr(stats, "number_rows", number_rows)
    rows = [(i, float(i % 7), float(i % 3) - 1, None if i % 50 == 0 else 0.5 * (i % 11)) for i in range(1000)]
    rows.append((1, 1.0, 0.0, 0.5))  # a row that comes twice counts twice in the ranks
    got = stats.average_ranks(spark.createDataFrame(rows, "id long, x double, y double, z double"), ["x", "y", "z"], "id").collect()
    assert ordered_rows == [7 + 3 + 11]
    full = [r for r in rows if r[3] is not None]
    assert sorted(r.id for r in got) == sorted({r[0] for r in full})
    for r in got:
        for c, i in (("x", 1), ("y", 2), ("z", 3)):
            assert r[f"{c}_rank"] == sum(v[i] < r[c] for v in full) + (sum(v[i] == r[c] for v in full) + 1) / 2


def test_ranking_reports_match_whole_tables(spark, sf):
    from patio.plans import QUERIES
    for name in ("moving_average", "running_totals", "price_neighbors"):
        whole = {r.id: r for r in QUERIES[name](spark, sf).collect()}
        report = QUERIES[f"{name}_report"](spark, sf).collect()
        assert report and all(whole[r.id] == r for r in report)


def test_running_sums_start_null(spark, tiny):
    rows = [(i, float(i) if i < 10 or i % 9 == 0 else None) for i in range(60)]
    for shift in (0, 30):  # nulls after and before the first values
        df = spark.createDataFrame([((i + shift) % 60, v) for i, v in rows], "id long, x double")
        w = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
        want = df.select("id", F.sum("x").over(w).alias("s")).collect()
        got = number_rows(df, "id", "id", sums=["x"]).select("id", "_sum_x").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_groups_without_values_stay(spark, tiny):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None), (None, 2.0)], "g string, x double")
    got = {r.g: r.m for r in quantiles_by(df, ["g"], "x", [0.5], ["m"]).collect()}
    assert got == {"a": 2.0, "b": None, None: 2.0}
    empty = df.filter("g = 'z'")
    assert [r.valor for r in quantiles(empty, "x", [0.5]).collect()] == [None]


def test_top_ranks_with_nulls(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (2, "a", 5.0), (3, None, 1.0), (4, None, None)], "id long, g string, x double")
    w = Window.partitionBy("g").orderBy(F.desc_nulls_last("x"))
    want = df.withColumn("r", F.rank().over(w)).filter("r <= 3").select("id", "r").collect()
    got = ranking.top_by_rank(df, "g", "x").select("id", "rank_preco").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    numbered = ranking.rank_triplet(df, "g", "x", "id").collect()
    assert {(r.id, r.row_num) for r in numbered} == {(2, 1), (1, 2), (3, 1), (4, 2)}


def test_density_of_equal_values(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "x double")
    rows = stats.kde_curve(df, "x", points=3).collect()
    assert len(rows) == 3 and all(r.densidade is None for r in rows)


def test_fliers(spark):
    df = spark.createDataFrame([(i, "g", float(v)) for i, v in enumerate([1, 2, 3, 4, 100])], "id long, g string, x double")
    assert [r.id for r in stats.boxplot_fliers(df, "g", "x", ["id"]).collect()] == [4]
