"""Clustering and regression queries."""

from functools import reduce

from pyspark.sql import functions as F

from patio.columns import ENTITY, FUEL, FUELS, ID, PRICE, YEAR
from patio.functions.numeric import round_stable
from patio.operators import clustering, comparing, regression, rfm, stats, summaries
from patio.plans.registry import LISTINGS, count_if, query, rfm_cte, rnd
from patio.plans.segmentation import entities
from patio.session import durable
from patio.sources.views import listings

def _clustered(spark, sf):
    return clustering.kmeans_assign(entities(spark, sf), ENTITY)


def _labelled(spark, sf):
    assigned, _ = _clustered(spark, sf)
    assigned = durable(assigned)
    labels = clustering.cluster_label(clustering.cluster_profile(assigned), assigned)
    return comparing.label_lookup(assigned, "cluster_km", labels, "cluster_km_label")


@query("kmeans_sweep")
def _(spark, sf):
    return clustering.kmeans_sweep(entities(spark, sf), ENTITY)


@query("kmeans_assign")
def _(spark, sf):
    return _clustered(spark, sf)[0].select(ENTITY, "cluster_km", *clustering.NORMS)


@query("silhouette_euclid")
def _(spark, sf):
    assigned = durable(_clustered(spark, sf)[0])
    return clustering.silhouette_euclid(assigned, ENTITY, clustering.NORMS, ["cluster_km"])


@query("silhouette_squared")
def _(spark, sf):
    assigned, _ = _clustered(spark, sf)
    features = clustering.with_features(assigned).withColumnRenamed("cluster_km", "prediction")
    return spark.range(1).select(
        F.lit(clustering.silhouette_squared(features)).alias("silhouette_quadratica"))


@query("silhouette_by_segment", f"""WITH {rfm_cte('marca_modelo')},
d AS (SELECT a.marca_modelo, a.segmento_rfm AS own, b.segmento_rfm AS other,
        sum(sqrt(pow(a.R_norm - b.R_norm, 2) + pow(a.F_norm - b.F_norm, 2) + pow(a.M_norm - b.M_norm, 2))) AS t,
        count(*) AS n FROM seg a, seg b GROUP BY 1, 2, 3),
w AS (SELECT marca_modelo, max(n) FILTER (WHERE own = other) AS size,
        max(t / nullif(n - 1, 0)) FILTER (WHERE own = other) AS a,
        min(t / n) FILTER (WHERE own <> other) AS b FROM d GROUP BY 1)
SELECT {rnd('avg(CASE WHEN size = 1 THEN 0 ELSE coalesce((b - a) / greatest(a, b), 0) END)', 6)} AS silhouette
FROM w""")
def _(spark, sf):
    """Same measure on a partition that SQL can reproduce: the rule-based segments."""
    segmented = entities(spark, sf)
    coded = segmented.withColumn("grupo", F.array_position(
        F.array(*[F.lit(name) for name in rfm.SEGMENTS]), F.col("segmento_rfm")))
    return clustering.silhouette_euclid(coded, ENTITY, clustering.NORMS, ["grupo"]).select(
        round_stable(F.col("silhouette"), 6).alias("silhouette"))


@query("cluster_profile")
def _(spark, sf):
    return clustering.cluster_profile(_clustered(spark, sf)[0])


@query("cluster_label")
def _(spark, sf):
    assigned = durable(_clustered(spark, sf)[0])
    return clustering.cluster_label(clustering.cluster_profile(assigned), assigned)


@query("label_lookup")
def _(spark, sf):
    return _labelled(spark, sf).select(ENTITY, "cluster_km", "cluster_km_label")


@query("rfm_kmeans_crosstab")
def _(spark, sf):
    return summaries.crosstab(_labelled(spark, sf), "segmento_rfm", "cluster_km_label", [
        clustering.KM_PREMIUM, clustering.KM_VOLUME, clustering.KM_ECONOMY, clustering.KM_MIDDLE])


_CODED = f"""{rfm_cte('marca_modelo')},
coded AS (SELECT *, CAST(list_position([{', '.join(f"'{n}'" for n in rfm.SEGMENTS)}], segmento_rfm) AS INTEGER)
  AS cluster_km FROM seg)"""
_PROFILE = f"""{_CODED},
profile AS (SELECT cluster_km, count(*) AS n, {rnd('avg(recency)')} AS "R", {rnd('avg(frequency)')} AS "F",
  {rnd('avg(monetary)')} AS "M", {rnd('avg(RFM_score)')} AS rfm FROM coded GROUP BY 1),
named AS (SELECT *, CASE WHEN "M" >= (SELECT quantile_cont(monetary, 0.75) FROM coded) THEN '{clustering.KM_PREMIUM}'
  WHEN "F" >= (SELECT quantile_cont(frequency, 0.75) FROM coded) THEN '{clustering.KM_VOLUME}'
  WHEN "M" <= (SELECT quantile_cont(monetary, 0.25) FROM coded) THEN '{clustering.KM_ECONOMY}'
  ELSE '{clustering.KM_MIDDLE}' END AS cluster_km_label FROM profile)"""


def _coded_segments(spark, sf):
    """Rule segments in the place of clusters: a partition that SQL can reproduce."""
    return durable(entities(spark, sf).withColumn("cluster_km", F.array_position(
        F.array(*[F.lit(name) for name in rfm.SEGMENTS]), F.col("segmento_rfm")).cast("int")))


def _named_segments(spark, sf):
    coded = _coded_segments(spark, sf)
    labels = clustering.cluster_label(clustering.cluster_profile(coded), coded)
    return comparing.label_lookup(coded, "cluster_km", labels, "cluster_km_label")


@query("cluster_profile_by_segment", f"WITH {_PROFILE} SELECT * FROM profile")
def _(spark, sf):
    return clustering.cluster_profile(_coded_segments(spark, sf))


@query("cluster_label_by_segment", f"WITH {_PROFILE} SELECT * FROM named")
def _(spark, sf):
    coded = _coded_segments(spark, sf)
    return clustering.cluster_label(clustering.cluster_profile(coded), coded)


@query("label_lookup_by_segment", f"""WITH {_PROFILE}
SELECT marca_modelo, cluster_km, cluster_km_label FROM coded LEFT JOIN named USING (cluster_km)""")
def _(spark, sf):
    return _named_segments(spark, sf).select(ENTITY, "cluster_km", "cluster_km_label")


_KM_LABELS = [clustering.KM_PREMIUM, clustering.KM_VOLUME, clustering.KM_ECONOMY, clustering.KM_MIDDLE]


@query("rfm_segment_crosstab", f"""WITH {_PROFILE}
SELECT segmento_rfm, {', '.join(f"{count_if(f"cluster_km_label = '{v}'")} AS \"{v}\"" for v in _KM_LABELS)}
FROM coded LEFT JOIN named USING (cluster_km) GROUP BY 1""")
def _(spark, sf):
    return summaries.crosstab(_named_segments(spark, sf), "segmento_rfm", "cluster_km_label", _KM_LABELS)


@query("pca_2d")
def _(spark, sf):
    assigned, centers = _clustered(spark, sf)
    return clustering.pca_2d(durable(assigned), ENTITY, centers)


def _engineered(spark, sf):
    return regression.engineer(listings(spark, sf))


def _matrix(spark, sf):
    """Feature rows written once to the checkpoint folder: every fit reads them."""
    engineered = _engineered(spark, sf)
    space = regression.feature_matrix(engineered)
    return space, durable(space.transform(engineered))


def _scaled(spark, sf):
    space, matrix = _matrix(spark, sf)
    train, test = regression.split_train_test(matrix)
    scaler = regression.scale_features(train)
    return space, scaler.apply(train), scaler.apply(test)


def _predictions(spark, sf, names):
    _, train, test = _scaled(spark, sf)
    return reduce(lambda a, b: a.unionByName(b),
                  [regression.predict(n, train, test)[1] for n in names])


@query("onehot_drop_first")
def _(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    engineered = _engineered(spark, sf)
    model = Pipeline(stages=regression.onehot_drop_first()).fit(engineered)
    return model.transform(engineered).select(ID, *[
        vector_to_array(f"{c}_vec").alias(c) for c in regression.CATEGORIES])


@query("feature_matrix")
def _(spark, sf):
    engineered = _engineered(spark, sf)
    return regression.feature_matrix(engineered).transform(engineered)


@query("engineered_features", f"""WITH {LISTINGS}
SELECT id, ano_fabricacao::DOUBLE AS ano_fabricacao,
  (year(data_anuncio) - ano_fabricacao)::DOUBLE AS idade, month(data_anuncio)::DOUBLE AS mes,
  quarter(data_anuncio)::DOUBLE AS trimestre,
  round(sin(2 * pi() * month(data_anuncio) / 12), 9) + 0.0::DOUBLE AS sin_mes,
  round(cos(2 * pi() * month(data_anuncio) / 12), 9) + 0.0::DOUBLE AS cos_mes,
  combustivel, status, marca_modelo, preco_brl AS label FROM listings""")
def _(spark, sf):
    df = _engineered(spark, sf)
    return df.withColumns({c: F.round(c, 9) + 0.0 for c in ("sin_mes", "cos_mes")})


def _bucket_sql(seed, buckets):
    """SQL twin of hash_bucket."""
    return f"(('0x' || md5('{seed}:' || id)[1:8])::BIGINT % {buckets})"


@query("split_train_test", f"""WITH {LISTINGS}
SELECT id, preco_brl, CASE WHEN {_bucket_sql(42, 100)} >= 20 THEN 'treino' ELSE 'teste' END AS parte FROM listings""")
def _(spark, sf):
    train, test = regression.split_train_test(listings(spark, sf).select(ID, PRICE))
    return train.withColumn("parte", F.lit("treino")).unionByName(
        test.withColumn("parte", F.lit("teste")))


@query("scale_features")
def _(spark, sf):
    _, matrix = _matrix(spark, sf)
    train, test = regression.split_train_test(matrix)
    scaler = regression.scale_features(train)
    return scaler.apply(train, center=True).unionByName(scaler.apply(test, center=True)).select(
        ID, "features")


def _one_model(name):
    def run(spark, sf):
        return _predictions(spark, sf, [name])
    return run


for _key, _name in (("linear_regression", "linear"), ("ridge_regression", "ridge"),
                    ("lasso_regression", "lasso"), ("tree_regression", "arvore")):
    query(_key)(_one_model(_name))


@query("model_comparison")
def _(spark, sf):
    return regression.regression_metrics(_predictions(spark, sf, regression.MODELS))


_TREND = f"""{LISTINGS},
t AS (SELECT regr_slope(preco_brl, ano_fabricacao) AS m, regr_intercept(preco_brl, ano_fabricacao) AS b
      FROM listings WHERE id % 5 <> 0),
p AS (SELECT preco_brl AS y, m * ano_fabricacao + b AS f FROM listings, t WHERE id % 5 = 0)"""


@query("regression_metrics", f"""WITH {_TREND}
SELECT 'linear' AS modelo, {rnd('1 - sum(pow(y - f, 2)) / (var_pop(y) * count(*))', 6)} AS r2,
  {rnd('avg(abs(y - f))', 4)} AS mae, {rnd('sqrt(avg(pow(y - f, 2)))', 4)} AS rmse FROM p""")
def _(spark, sf):
    """The least-squares model on the manufacture year alone, split by id, so SQL can follow it."""
    from pyspark.ml.feature import VectorAssembler
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        listings(spark, sf, entity=False).select(
            ID, F.col(YEAR).cast("double").alias("x"), F.col(PRICE).alias("label")))
    _, predicted = regression.predict(
        "linear", rows.filter(F.col(ID) % 5 != 0), rows.filter(F.col(ID) % 5 == 0))
    return regression.regression_metrics(predicted)


@query("kfold_cv")
def _(spark, sf):
    _, train, _ = _scaled(spark, sf)
    return regression.kfold_cv(train)


@query("kfold_trend", f"""WITH {LISTINGS},
t AS (SELECT ano_fabricacao AS x, preco_brl AS y, {_bucket_sql(43, 5)} AS f FROM listings WHERE {_bucket_sql(42, 100)} >= 20),
fit AS (SELECT i, regr_slope(y, x) AS m, regr_intercept(y, x) AS b
        FROM t JOIN (SELECT unnest(range(5)) AS i) ON f <> i GROUP BY i)
SELECT 'linear' AS modelo, CAST(i + 1 AS INTEGER) AS fold, count(*) AS linhas,
  {rnd('1 - sum(pow(y - m * x - b, 2)) / (var_pop(y) * count(*))', 6)} AS r2 FROM t JOIN fit ON f = i GROUP BY i""")
def _(spark, sf):
    """Folds of the training rows with the line on the manufacture year, which SQL can follow."""
    from pyspark.ml.feature import VectorAssembler
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(listings(spark, sf, entity=False).select(
        ID, F.col(YEAR).cast("double").alias("x"), F.col(PRICE).alias("label")))
    return regression.kfold_cv(regression.split_train_test(rows)[0], ["linear"])


# Linear and ridge models on the numeric and fuel columns: a Gram table, and elimination in the twin.

_LEVELS = sorted(FUELS)[1:]
_FEATURES = [*regression.NUMERIC, *[f"{FUEL}_{v}" for v in _LEVELS]]
_ALPHAS = {"linear": 0.0, "ridge": 1.0}
_K = range(1, len(_FEATURES) + 1)
_ENGINEERED = f"""{LISTINGS},
eng AS (SELECT id, preco_brl AS y, [ano_fabricacao::DOUBLE, (year(data_anuncio) - ano_fabricacao)::DOUBLE,
  month(data_anuncio)::DOUBLE, quarter(data_anuncio)::DOUBLE, sin(2 * pi() * month(data_anuncio) / 12),
  cos(2 * pi() * month(data_anuncio) / 12), {', '.join(f"(combustivel = '{v}')::INT::DOUBLE" for v in _LEVELS)}] AS x,
  {_bucket_sql(42, 100)} AS bucket FROM listings)"""


def _pairs_sql(of):
    return "[" + ", ".join("[" + ", ".join(of(i, j) for j in _K) + "]" for i in _K) + "]"


_SOLVED = f"""RECURSIVE {_ENGINEERED},
train AS (SELECT * FROM eng WHERE bucket >= 20),
s AS (SELECT [{', '.join(f'stddev_pop(x[{i}])' for i in _K)}] AS sd, [{', '.join(f'avg(x[{i}])' for i in _K)}] AS mu,
  avg(y) AS my, count(*) AS n, {_pairs_sql(lambda i, j: f'covar_pop(x[{i}], x[{j}]) * count(*)')} AS g,
  [{', '.join(f'covar_pop(x[{i}], y) * count(*)' for i in _K)}] AS gy FROM train),
elim AS (
  SELECT modelo, 1 AS k, {_pairs_sql(lambda i, j: f"g[{i}][{j}] / (sd[{i}] * sd[{j}])" + (" + alpha" if i == j else ""))
} AS m,
    [{', '.join(f'gy[{i}] / sd[{i}]' for i in _K)}] AS t
  FROM s, (VALUES ('linear', 0.0::DOUBLE), ('ridge', 1.0::DOUBLE)) a(modelo, alpha)
  UNION ALL
  SELECT modelo, k + 1,
    [{', '.join('[' + ', '.join(f'CASE WHEN k = {i} THEN m[{i}][{j}] / m[k][k] ELSE m[{i}][{j}] - m[{i}][k] * m[k][{j}] / m[k][k] END' for j in _K) + ']' for i in _K)}],
    [{', '.join(f'CASE WHEN k = {i} THEN t[{i}] / m[k][k] ELSE t[{i}] - m[{i}][k] * t[k] / m[k][k] END' for i in _K)}]
  FROM elim WHERE k <= {len(_FEATURES)}),
b AS (SELECT modelo, t AS beta, my - ({' + '.join(f't[{i}] * mu[{i}] / sd[{i}]' for i in _K)}) AS base, sd
      FROM elim, s WHERE k = {len(_FEATURES) + 1}),
p AS (SELECT modelo, id, y, base + {' + '.join(f'x[{i}] * beta[{i}] / sd[{i}]' for i in _K)} AS f
      FROM eng, b WHERE bucket < 20)"""


def _gram(spark, sf):
    """Training and test rows with fuel columns, and the training rows' Gram table."""
    wide, _ = regression.level_columns(_engineered(spark, sf), FUEL, FUELS)
    train, test = regression.split_train_test(durable(wide.select(ID, "label", *_FEATURES)))
    return test, durable(regression.gram_table(train, [*_FEATURES, "label"]))


def _gram_predictions(spark, sf, alphas):
    test, gram = _gram(spark, sf)
    coefficients = regression.gram_coefficients(gram, _FEATURES, "label", alphas)
    return regression.predict_gram(test, gram, coefficients, _FEATURES)


_CELLS = [("", "", "count(*)")] + [("", c, f"sum(x[{i}])") for i, c in zip(_K, _FEATURES)] + [("", "label", "sum(y)")] + [
    (a, b, f"covar_pop(x[{i}], {f'x[{j}]' if j <= len(_FEATURES) else 'y'}) * count(*)")
    for i, a in zip(_K, _FEATURES) for j, b in enumerate([*_FEATURES, "label"], 1) if j >= i] + [
    ("label", "label", "var_pop(y) * count(*)")]


@query("gram_table", f"""WITH {_ENGINEERED}, c AS (
  SELECT [{', '.join(f"{{'x': '{a}', 'y': '{b}', 'soma': ({v})::DOUBLE}}" for a, b, v in _CELLS)}] AS cells
  FROM eng WHERE bucket >= 20)
SELECT u.x, u.y, {rnd('u.soma', 3)} AS soma FROM (SELECT unnest(cells) AS u FROM c)""")
def _(spark, sf):
    return _gram(spark, sf)[1].withColumn("soma", round_stable(F.col("soma"), 3))


@query("linear_coefficients", f"""WITH {_SOLVED},
long AS (SELECT modelo, unnest([{', '.join(f"'{c}'" for c in _FEATURES)}, '']) AS feature,
  unnest(list_append(beta, base)) AS v FROM b)
SELECT modelo, feature, {rnd('v', 4)} AS coeficiente FROM long""")
def _(spark, sf):
    found = regression.gram_coefficients(_gram(spark, sf)[1], _FEATURES, "label", _ALPHAS)
    return found.withColumn("coeficiente", round_stable(F.col("coeficiente"), 4))


@query("coef_ranking_fuel", f"""WITH {_SOLVED},
long AS (SELECT unnest([{', '.join(f"'{c}'" for c in _FEATURES)}]) AS feature, unnest(beta) AS v FROM b WHERE modelo = 'ridge')
SELECT feature, {rnd('v', 4)} AS coeficiente,
  CASE WHEN v > 0 THEN '{regression.UP}' ELSE '{regression.DOWN}' END AS sentido
FROM long ORDER BY abs(v) DESC, feature LIMIT 5""")
def _(spark, sf):
    found = regression.gram_coefficients(_gram(spark, sf)[1], _FEATURES, "label", {"ridge": 1.0})
    return regression.rank_coefficients(found.filter("feature != ''").drop("modelo"), 5).withColumn(
        "coeficiente", round_stable(F.col("coeficiente"), 4))


@query("residual_points_fuel", f"""WITH {_SOLVED}
SELECT modelo, id, {rnd('f', 4)} AS previsto, {rnd('y - f', 4)} AS residuo FROM p WHERE modelo = 'ridge'""")
def _(spark, sf):
    points = regression.residual_points(_gram_predictions(spark, sf, {"ridge": 1.0}))
    return points.withColumns({c: round_stable(F.col(c), 4) for c in ("previsto", "residuo")})


@query("pred_vs_actual_fuel", f"""WITH {_SOLVED}
SELECT modelo, id, {rnd('y / 1000', 6)} AS real, {rnd('f / 1000', 6)} AS previsto,
  {rnd('min(least(y, f)) OVER w / 1000', 6)} AS eixo_min, {rnd('max(greatest(y, f)) OVER w / 1000', 6)} AS eixo_max
FROM p WINDOW w AS (PARTITION BY modelo)""")
def _(spark, sf):
    pairs = regression.pred_vs_actual(_gram_predictions(spark, sf, _ALPHAS))
    return pairs.withColumns({c: round_stable(F.col(c), 6) for c in ("real", "previsto", "eixo_min", "eixo_max")})


# The sparse matrix in long form.

_LONG = f"""{LISTINGS},
eng AS (SELECT id, ano_fabricacao, (year(data_anuncio) - ano_fabricacao)::DOUBLE AS idade, month(data_anuncio) AS mes,
  quarter(data_anuncio) AS trimestre, sin(2 * pi() * month(data_anuncio) / 12) AS sin_mes,
  cos(2 * pi() * month(data_anuncio) / 12) AS cos_mes, combustivel, status, marca_modelo FROM listings),
long AS ({' UNION ALL '.join(f"SELECT id, '{c}' AS feature, {c}::DOUBLE AS valor FROM eng" for c in regression.NUMERIC)}
  UNION ALL {' UNION ALL '.join(f"SELECT id, '{c}_' || {c}, 1.0 FROM eng WHERE {c} <> (SELECT min({c}) FROM eng)"
                                for c in regression.CATEGORIES)}),
cells AS (SELECT * FROM long WHERE valor <> 0)"""


@query("feature_matrix_long", f"WITH {_LONG} SELECT id, feature, {rnd('valor', 9)} AS valor FROM cells")
def _(spark, sf):
    return regression.long_features(_engineered(spark, sf)).withColumn("valor", round_stable(F.col("valor"), 9))


@query("scale_features_long", f"""WITH {_LONG},
n AS (SELECT count(*) AS n FROM eng WHERE {_bucket_sql(42, 100)} >= 20),
d AS (SELECT feature, sqrt(sum(valor * valor) / max(n) - pow(sum(valor) / max(n), 2)) AS d
      FROM cells, n WHERE {_bucket_sql(42, 100)} >= 20 GROUP BY 1)
SELECT id, feature, {rnd('CASE WHEN d > 0 THEN valor / d ELSE valor END', 6)} AS valor
FROM cells LEFT JOIN d USING (feature)""")
def _(spark, sf):
    long = durable(regression.long_features(_engineered(spark, sf)))
    scaled = regression.scale_long(long, regression.hash_bucket(42, 100) >= 20)
    return scaled.withColumn("valor", round_stable(F.col("valor"), 6))


@query("coef_ranking")
def _(spark, sf):
    space, train, _ = _scaled(spark, sf)
    return regression.coef_ranking(train, space.names)


@query("feature_importance")
def _(spark, sf):
    space, train, _ = _scaled(spark, sf)
    return regression.feature_importance(train, space.names)


@query("residual_points")
def _(spark, sf):
    return regression.residual_points(_predictions(spark, sf, ["ridge"]))


@query("residual_histogram")
def _(spark, sf):
    residuals = regression.residual_points(_predictions(spark, sf, ["ridge"]))
    return stats.histogram(residuals, "residuo", 50, 1000.0)


@query("residual_qq")
def _(spark, sf):
    residuals = regression.residual_points(_predictions(spark, sf, ["ridge"]))
    return stats.qq_points(residuals, "residuo", ID)


@query("pred_vs_actual")
def _(spark, sf):
    return regression.pred_vs_actual(_predictions(spark, sf, regression.MODELS))
