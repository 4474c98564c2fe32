import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from patio.operators import comparing, dashboard, stats, summaries
from patio.plans import QUERIES


def values(spark, xs):
    return spark.createDataFrame([(i, "g", float(x)) for i, x in enumerate(xs)],
                                 "id long, g string, x double")


def test_constant_column(spark):
    df = values(spark, [3.0] * 12)
    assert stats.zscore_outliers(df, "x").count() == 0
    assert stats.iqr_outliers(df, "x").count() == 0
    row = stats.outlier_agreement(df, "x").first()
    assert row.normais == 12 and row.concordancia_pct is None
    bins = stats.histogram(df, "x", 5).collect()
    assert sum(r.n for r in bins) == 12 and len(bins) == 5


def test_histogram_keeps_every_row(spark):
    r = random.Random(1)
    xs = [r.gauss(0, 1) for _ in range(500)]
    bins = stats.histogram(values(spark, xs), "x", 20).collect()
    assert sum(b.n for b in bins) == 500 and [b.faixa for b in sorted(bins)] == list(range(20))


def test_kde_matches_full_sum(spark):
    r = random.Random(2)
    xs = [r.expovariate(1) for _ in range(150)] + [400.0]  # far point: kernels miss most of the grid
    n, sd = len(xs), statistics.stdev(xs)
    h = sd * n ** -0.2
    for row in stats.kde_curve(values(spark, xs), "x", 50).collect():
        x = min(xs) + (max(xs) - min(xs)) / 49 * row.ponto
        want = sum(math.exp(-0.5 * ((x - v) / h) ** 2) for v in xs) / (n * h * math.sqrt(2 * math.pi))
        assert row.densidade == pytest.approx(want, abs=1e-9)


def test_shape_and_normality(spark):
    r = random.Random(3)
    normal = values(spark, [r.gauss(10, 2) for _ in range(400)])
    skewed = values(spark, [r.expovariate(1) for _ in range(400)])
    assert stats.normality_test(normal, "x").first().normal
    assert not stats.normality_test(skewed, "x").first().normal
    assert stats.shape_stats(skewed, "x").first().forma_assimetria == "assimetria positiva"


def test_qq_line_of_normal_data(spark):
    r = random.Random(4)
    df = values(spark, [r.gauss(10, 2) for _ in range(800)])
    fit = stats.qq_fit(stats.qq_points(df, "x", "id")).first()
    assert fit.r > 0.99 and fit.inclinacao == pytest.approx(2, abs=0.2)
    assert fit.intercepto == pytest.approx(10, abs=0.3)


def test_sigma_rule_uses_population_std(spark):
    xs = [0.0] * 9 + [10.0]
    row = comparing.sigma_outliers(values(spark, xs), "x", ["id"]).first()
    assert row.z_score == pytest.approx((10 - 1) / statistics.pstdev(xs), abs=0.005)


def test_spearman_agrees_with_pearson_on_ranks(spark, tiny):
    df = values(spark, [1, 2, 3, 4, 5, 6, 7, 8, 9, 10]).withColumn("y", F.col("x") ** 3)
    out = {(r.x, r.y): r.r for r in stats.spearman_matrix(df, ["x", "y"], "id").collect()}
    assert out[("x", "y")] == 1.0


def test_empty_filter_gives_zero_kpis(spark, sf):
    from patio.sources.views import listings
    df = summaries.with_brand(listings(spark, sf))
    empty = dashboard.filter_listings(df, brands=[])
    assert tuple(dashboard.kpi_summary(empty).first()) == (0.0, 0.0, 0.0, 0.0, 0, 0, 0, 0)
    kpi = dashboard.kpi_summary(dashboard.filter_listings(df, brands=["Building"])).first()
    assert kpi.conversao_pct + kpi.churn_pct == pytest.approx(100)
    assert kpi.total == kpi.vendidos + kpi.disponiveis + kpi.reservados


def test_every_query_is_lazy_on_a_stable_schema(spark, sf):
    for name in ("entity_price_summary", "kpi_summary", "band_conversion", "monthly_trend"):
        df = QUERIES[name](spark, sf)
        assert df.columns and df.count() > 0
