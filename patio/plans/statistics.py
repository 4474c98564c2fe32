"""Descriptive statistics, outliers, correlation, tests and chart data."""

from pyspark.sql import functions as F

from patio.columns import FUEL, FUEL_CODES, ID, PRICE, STATUS, STATUS_CODES, YEAR
from patio.functions.labels import ordinal_encode
from patio.functions.numeric import round_stable
from patio.operators import comparing, stats
from patio.operators.quantiles import quantiles
from patio.plans.registry import LISTINGS, query, rnd
from patio.sources.views import events, listings

EVENT = ("event_id", "event_type")


def _plain(spark, sf):
    return listings(spark, sf, entity=False)


def _values(spark, sf):
    return events(spark, sf).select("event_id", "event_type", "value")


def _describe(c):
    return f"""SELECT '{c}' AS variavel, {rnd(f'avg({c})', 4)} AS media, {rnd(f'median({c})', 4)} AS mediana,
  {rnd(f'stddev_samp({c})', 4)} AS desvio_padrao, CAST(min({c}) AS DOUBLE) AS minimo,
  CAST(max({c}) AS DOUBLE) AS maximo FROM listings"""


@query("describe_numeric", f"WITH {LISTINGS} {_describe('preco_brl')} UNION ALL {_describe('ano_fabricacao')}")
def _(spark, sf):
    return stats.describe_numeric(_plain(spark, sf))


@query("shape_stats", f"""WITH s AS (SELECT skewness(value) AS s, kurtosis(value) AS k FROM events)
SELECT {rnd('s', 6)} AS assimetria, {rnd('k', 6)} AS curtose,
  CASE WHEN s > 0.5 THEN 'assimetria positiva' WHEN s < -0.5 THEN 'assimetria negativa' ELSE 'simétrica' END
  AS forma_assimetria, CASE WHEN k > 1 THEN 'leptocúrtica' WHEN k < -1 THEN 'platicúrtica'
  ELSE 'mesocúrtica' END AS forma_curtose FROM s""")
def _(spark, sf):
    return stats.shape_stats(_values(spark, sf), "value")


_K2 = """
m AS (SELECT count(value)::DOUBLE AS n, avg(value) AS mu, var_pop(value) AS v FROM {src}),
g AS (SELECT any_value(n) AS n, avg(pow(value - mu, 3)) / pow(any_value(v), 1.5) AS g1,
             avg(pow(value - mu, 4)) / pow(any_value(v), 2) AS b2 FROM {src}, m),
a AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
  sqrt(2 * (3 * (n*n + 27*n - 70) * (n+1) * (n+3) / ((n-2) * (n+5) * (n+7) * (n+9)) - 1)) - 1 AS w2,
  (b2 - 3 * (n-1) / (n+1)) / sqrt(24 * n * (n-2) * (n-3) / ((n+1) * (n+1) * (n+3) * (n+5))) AS x,
  6 * (n*n - 5*n + 2) / ((n+7) * (n+9)) * sqrt(6 * (n+3) * (n+5) / (n * (n-2) * (n-3))) AS b3 FROM g),
b AS (SELECT *, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(w2)) AS z1,
  6 + 8 / b3 * (2 / b3 + sqrt(1 + 4 / (b3 * b3))) AS d FROM a),
c AS (SELECT z1, (1 - 2 / (9 * d) - sign(1 + x * sqrt(2 / (d - 4)))
  * pow((1 - 2 / d) / abs(1 + x * sqrt(2 / (d - 4))), 1.0 / 3)) / sqrt(2 / (9 * d)) AS z2 FROM b),
k AS (SELECT z1 * z1 + z2 * z2 AS k2 FROM c)
"""


@query("normality_test", f"""WITH {_K2.format(src='events')}
SELECT {rnd('k2', 4)} AS k2, {rnd('exp(-k2 / 2)', 8)} AS p, exp(-k2 / 2) >= 0.05 AS normal FROM k""")
def _(spark, sf):
    return stats.normality_test(_values(spark, sf), "value")


_PROBS = [0.05, 0.25, 0.5, 0.75, 0.95]


@query("quantiles", f"""WITH {LISTINGS} {' UNION ALL '.join(
    f"SELECT {p}::DOUBLE AS p, {rnd(f'quantile_cont(preco_brl, {p})', 4)} AS valor FROM listings"
    for p in _PROBS)}""")
def _(spark, sf):
    return quantiles(_plain(spark, sf), PRICE, _PROBS).select(
        "p", round_stable(F.col("valor"), 4).alias("valor"))


_FENCES = """q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
l AS (SELECT q1, q3, q1 - 1.5::DOUBLE * (q3 - q1) AS lo, q3 + 1.5::DOUBLE * (q3 - q1) AS hi FROM q)"""


@query("iqr_fences", f"""WITH {_FENCES},
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE value < lo OR value > hi) AS o FROM events, l)
SELECT {rnd('q1', 4)} AS q1, {rnd('q3', 4)} AS q3, {rnd('q3 - q1', 4)} AS iqr,
  {rnd('lo', 4)} AS limite_inferior, {rnd('hi', 4)} AS limite_superior, o AS outliers,
  {rnd('o * 100.0 / n')} AS pct, n - o AS normais FROM l, c""")
def _(spark, sf):
    return stats.iqr_fences(_values(spark, sf), "value")


@query("iqr_outliers", f"""WITH {_FENCES}
SELECT event_id, event_type, value, value < lo OR value > hi AS outlier_iqr FROM events, l""")
def _(spark, sf):
    return stats.iqr_split(_values(spark, sf), "value")


_Z = """s AS (SELECT avg(value) AS mu, stddev_pop(value) AS sd FROM events),
z AS (SELECT event_id, event_type, value, abs(value - mu) / sd AS z FROM events, s)"""


@query("zscore_outliers", f"""WITH {_Z}
SELECT event_id, event_type, value, {rnd('z', 4)} AS z_score FROM z WHERE z > 3""")
def _(spark, sf):
    return stats.zscore_outliers(_values(spark, sf), "value")


@query("sigma_limits", f"""SELECT {rnd('avg(value) - 3 * stddev_samp(value)', 4)} AS limite_inferior,
  {rnd('avg(value) + 3 * stddev_samp(value)', 4)} AS limite_superior FROM events""")
def _(spark, sf):
    return stats.sigma_limits(_values(spark, sf), "value")


@query("sigma_outliers", f"""WITH s AS (SELECT avg(value) AS mu, stddev_pop(value) AS sd FROM events)
SELECT event_id, event_type, round(value, 2) AS value, {rnd('mu')} AS media_geral,
  {rnd('sd')} AS desvio_padrao, {rnd('(value - mu) / sd')} AS z_score,
  CASE WHEN value > mu + 2 * sd THEN 'Outlier alto' WHEN value < mu - 2 * sd THEN 'Outlier baixo' END
  AS tipo_outlier
FROM events, s WHERE abs(value - mu) > 2 * sd""")
def _(spark, sf):
    return comparing.sigma_outliers(_values(spark, sf), "value", EVENT)


@query("outlier_label", """WITH s AS (SELECT avg(value) AS mu, stddev_pop(value) AS sd FROM events)
SELECT event_id, CASE WHEN value > mu + 2 * sd THEN 'Outlier alto'
  WHEN value < mu - 2 * sd THEN 'Outlier baixo' END AS tipo_outlier FROM events, s""")
def _(spark, sf):
    from patio.functions.labels import outlier_label
    from patio.session import scalar_struct
    df = _values(spark, sf)
    s = scalar_struct(df.agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("d")))
    return df.select("event_id", outlier_label(F.col("value"), s["m"], s["d"]).alias("tipo_outlier"))


@query("nlargest_outliers", f"""WITH {_FENCES}
SELECT event_id, event_type, value FROM events, l WHERE value < lo OR value > hi
ORDER BY value DESC, event_id LIMIT 10""")
def _(spark, sf):
    return stats.nlargest_outliers(_values(spark, sf), "value", "event_id")


@query("nlargest_outliers_z", f"""WITH {_Z}
SELECT event_id, event_type, value, {rnd('z', 4)} AS z_score FROM z WHERE z > 3
ORDER BY z_score DESC, event_id LIMIT 10""")
def _(spark, sf):
    return stats.nlargest_outliers(_values(spark, sf), "value", "event_id", method="z")


@query("outlier_agreement", f"""WITH {_FENCES}, {_Z},
f AS (SELECT (value < lo OR value > hi) AS i, z > 3 AS z FROM z, l),
c AS (SELECT count(*) FILTER (WHERE i AND NOT z) AS so_iqr, count(*) FILTER (WHERE z AND NOT i) AS so_z,
  count(*) FILTER (WHERE i AND z) AS ambos, count(*) FILTER (WHERE NOT i AND NOT z) AS normais FROM f)
SELECT *, {rnd('ambos * 100.0 / nullif(so_iqr + so_z + ambos, 0)', 1)} AS concordancia_pct FROM c""")
def _(spark, sf):
    return stats.outlier_agreement(_values(spark, sf), "value")


CODED = ["preco_brl", "ano_fabricacao", "combustivel_cod", "status_cod"]
CODES_SQL = f"""{LISTINGS},
coded AS (SELECT id, preco_brl, ano_fabricacao::DOUBLE AS ano_fabricacao,
  (CASE combustivel WHEN 'Gasolina' THEN 1 WHEN 'Flex' THEN 2 WHEN 'Diesel' THEN 3
    WHEN 'Híbrido' THEN 4 WHEN 'Elétrico' THEN 5 END)::DOUBLE AS combustivel_cod,
  (CASE status WHEN 'Disponível' THEN 1 WHEN 'Reservado' THEN 2 WHEN 'Vendido' THEN 3 END)::DOUBLE
    AS status_cod FROM listings)"""
STRENGTH_SQL = """CASE WHEN abs(r) >= 0.7 THEN 'FORTE' WHEN abs(r) >= 0.4 THEN 'MODERADA'
  WHEN abs(r) >= 0.2 THEN 'FRACA' ELSE 'DESPREZÍVEL' END AS forca"""


def coded(spark, sf):
    return _plain(spark, sf).select(
        ID, PRICE, YEAR, ordinal_encode(F.col(FUEL), FUEL_CODES).alias("combustivel_cod"),
        ordinal_encode(F.col(STATUS), STATUS_CODES).alias("status_cod"))


def _matrix_sql(source):
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, {rnd('max(1)' if a == b else f'corr({a}, {b})', 6)} AS r FROM {source}"
        for a in CODED for b in CODED)
    return f"SELECT *, {STRENGTH_SQL} FROM ({cells})"


@query("pearson_matrix", f"WITH {CODES_SQL} {_matrix_sql('coded')}")
def _(spark, sf):
    return stats.pearson_matrix(coded(spark, sf), CODED)


_RANKED = f"""{CODES_SQL},
ranked AS (SELECT id, {', '.join(
    f'rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS {c}'
    for c in CODED)} FROM coded)"""


@query("spearman_matrix", f"WITH {_RANKED} {_matrix_sql('ranked')}")
def _(spark, sf):
    return stats.spearman_matrix(coded(spark, sf), CODED, ID)


@query("corr_significance", f"""WITH {_RANKED},
r AS (SELECT 'pearson' AS metodo, corr(preco_brl, ano_fabricacao) AS r, count(*) - 2 AS v FROM coded
      UNION ALL SELECT 'spearman', corr(preco_brl, ano_fabricacao), count(*) - 2 FROM ranked),
t AS (SELECT *, abs(r) * sqrt(v / (1 - r * r)) AS t FROM r),
w AS (SELECT metodo, sum((CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
        * exp(lgamma((v + 1) / 2.0) - lgamma(v / 2.0)) / sqrt(v * pi())
        * pow(1 + pow(t * i / 2000, 2) / v, -(v + 1) / 2.0)) * t / 2000 / 3 AS half
      FROM t, generate_series(0, 2000) AS g(i) GROUP BY metodo, t)
SELECT metodo, {rnd('r', 6)} AS r, {rnd('1 - 2 * half', 6)} AS p, {STRENGTH_SQL}
FROM r JOIN w USING (metodo)""")
def _(spark, sf):
    return stats.corr_significance(coded(spark, sf), PRICE, YEAR, ID)


def _anova_sql(source, group, value):
    """The p-value uses the closed form of the F tail for 2 or 4 between-group degrees."""
    return f"""g AS (SELECT {group}, count({value})::DOUBLE AS n, avg({value}) AS m, var_pop({value}) AS v
  FROM {source} GROUP BY {group}),
o AS (SELECT sum(n * m) / sum(n) AS mu, sum(n) AS n, count(*)::DOUBLE AS k FROM g),
f AS (SELECT (sum(g.n * pow(m - mu, 2)) / (any_value(k) - 1))
        / (sum(g.n * v) / (any_value(o.n) - any_value(k))) AS f,
      any_value(k) - 1 AS d1, any_value(o.n) - any_value(k) AS d2 FROM g, o),
y AS (SELECT *, d2 / (d2 + d1 * f) AS y FROM f)
SELECT {rnd('f', 6)} AS f, {rnd('pow(y, d2 / 2) * CASE d1 WHEN 2 THEN 1 ELSE 1 + d2 / 2 * (1 - y) END', 6)} AS p,
  CAST(d1 AS BIGINT) AS gl_entre, CAST(d2 AS BIGINT) AS gl_dentro FROM y"""


@query("anova_oneway", f"WITH {LISTINGS}, {_anova_sql('listings', 'combustivel', 'preco_brl')}")
def _(spark, sf):
    return stats.anova_oneway(_plain(spark, sf), FUEL)


@query("anova_status", f"WITH {LISTINGS}, {_anova_sql('listings', 'status', 'preco_brl')}")
def _(spark, sf):
    return stats.anova_oneway(_plain(spark, sf), STATUS, exclude=["Desconhecido"])


_OLS = """t AS (SELECT regr_slope(preco_brl / 1000, ano_fabricacao) AS m,
  regr_intercept(preco_brl / 1000, ano_fabricacao) AS b, min(ano_fabricacao)::DOUBLE AS lo,
  max(ano_fabricacao)::DOUBLE AS hi FROM listings)"""


@query("ols_trend", f"""WITH {LISTINGS}, {_OLS}
SELECT {rnd('m', 6)} AS inclinacao, {rnd('b', 4)} AS intercepto, lo AS x_min, hi AS x_max FROM t""")
def _(spark, sf):
    return stats.ols_trend(_plain(spark, sf)).select(
        round_stable(F.col("inclinacao"), 6).alias("inclinacao"),
        round_stable(F.col("intercepto"), 4).alias("intercepto"), "x_min", "x_max")


@query("ols_line", f"""WITH {LISTINGS}, {_OLS},
p AS (SELECT CAST(i AS INTEGER) AS ponto, lo + (hi - lo) * i / 99 AS x, m, b FROM t, range(100) AS r(i))
SELECT ponto, {rnd('x', 6)} AS x, {rnd('m * x + b', 4)} AS y FROM p""")
def _(spark, sf):
    line = stats.ols_line(stats.ols_trend(_plain(spark, sf)))
    return line.select("ponto", round_stable(F.col("x"), 6).alias("x"),
                       round_stable(F.col("y"), 4).alias("y"))


def _hist_sql(source, value, bins):
    return f"""h AS (SELECT min({value}) AS lo, max({value}) AS hi FROM {source}),
c AS (SELECT least(floor(({value} - lo) * {bins} / (hi - lo)), {bins - 1})::BIGINT AS faixa, count(*) AS n
      FROM {source}, h GROUP BY 1)
SELECT i AS faixa, {rnd(f'lo + (hi - lo) / {bins} * i', 6)} AS inicio,
  {rnd(f'lo + (hi - lo) / {bins} * (i + 1)', 6)} AS fim, coalesce(n, 0) AS n
FROM h, range({bins}) AS r(i) LEFT JOIN c ON c.faixa = i"""


@query("histogram", f"""WITH {LISTINGS}, d AS (SELECT preco_brl / 1000 AS x FROM listings), {_hist_sql('d', 'x', 50)}""")
def _(spark, sf):
    return stats.histogram(_plain(spark, sf), PRICE, 50, 1000.0)


@query("histogram_skewed", f"WITH {_hist_sql('events', 'value', 60)}")
def _(spark, sf):
    return stats.histogram(_values(spark, sf), "value", 60)


@query("kde_curve", f"""WITH s AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n,
  stddev_samp(value) * pow(count(value), -0.2::DOUBLE) AS h FROM events),
g AS (SELECT i AS ponto, lo + (hi - lo) / 299 * i AS x, n, h FROM s, range(300) AS r(i))
SELECT ponto, {rnd('any_value(x)', 6)} AS x,
  {rnd('sum(exp(-0.5 * pow((x - value) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi()))', 9)}
  AS densidade FROM g, events GROUP BY ponto""")
def _(spark, sf):
    return stats.kde_curve(_values(spark, sf), "value")


@query("boxplot_stats", f"""WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, median(value) AS m,
  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
SELECT event_type, {rnd('any_value(q1)', 4)} AS q1, {rnd('any_value(m)', 4)} AS mediana,
  {rnd('any_value(q3)', 4)} AS q3,
  min(value) FILTER (WHERE value >= q1 - 1.5::DOUBLE * (q3 - q1)) AS bigode_inferior,
  max(value) FILTER (WHERE value <= q3 + 1.5::DOUBLE * (q3 - q1)) AS bigode_superior,
  count(*) FILTER (WHERE value < q1 - 1.5::DOUBLE * (q3 - q1) OR value > q3 + 1.5::DOUBLE * (q3 - q1)) AS fora
FROM events JOIN q USING (event_type) GROUP BY event_type""")
def _(spark, sf):
    return stats.boxplot_stats(_values(spark, sf), "event_type", "value")


@query("boxplot_fliers", """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1,
  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
SELECT event_id, event_type, value FROM events JOIN q USING (event_type)
WHERE value < q1 - 1.5::DOUBLE * (q3 - q1) OR value > q3 + 1.5::DOUBLE * (q3 - q1)""")
def _(spark, sf):
    return stats.boxplot_fliers(_values(spark, sf), "event_type", "value", ["event_id", "event_type", "value"])


@query("qq_points")
def _(spark, sf):
    return stats.qq_points(_values(spark, sf), "value", "event_id")


@query("qq_fit")
def _(spark, sf):
    return stats.qq_fit(stats.qq_points(_values(spark, sf), "value", "event_id"))
