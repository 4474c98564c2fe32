"""Models whose parts SQL can follow: lasso optimality, a tree as a table, a projection, Q-Q points, the bundle."""

import numpy as np
from pyspark.sql import functions as F

from patio.columns import BRAND, DATE, ENTITY, FUEL, FUELS, ID, PRICE, STATUS, YEAR
from patio.functions import special
from patio.functions.numeric import round_stable
from patio.operators import clustering, regression, stats, trees
from patio.operators.summaries import with_brand
from patio.plans.modelling import _CODED, _ENGINEERED, _FEATURES, _K, _coded_segments, _engineered, _gram, _pairs_sql
from patio.plans.registry import LISTINGS, ORACLES, query, rnd
from patio.plans.segmentation import customers
from patio.session import durable, scratch_folder
from patio.sources import tables
from patio.sources.views import events, listings

# Lasso: the twin descends along one coordinate after the other in recursive SQL.

ALPHA, SWEEPS = 10.0, 1500


def _sweep_sql():
    """One sweep over all coordinates: each step sees the new values of those before it."""
    source = f"SELECT k, {', '.join(f'b{i}' for i in _K)}, g, t FROM descent, scaled WHERE k < {SWEEPS}"
    done = []
    for j in _K:
        rest = " + ".join(f"g[{j}][{i}] * {'n' if i in done else 'b'}{i}" for i in _K if i != j)
        source = f"SELECT *, t[{j}] - ({rest}) AS r{j} FROM ({source})"
        source = f"SELECT *, sign(r{j}) * greatest(abs(r{j}) - {ALPHA}, 0) / g[{j}][{j}] AS n{j} FROM ({source})"
        done.append(j)
    return f"SELECT k + 1, {', '.join(f'n{i}' for i in _K)} FROM ({source})"


_LASSO = f"""RECURSIVE {_ENGINEERED},
train AS (SELECT * FROM eng WHERE bucket >= 20),
s AS (SELECT [{', '.join(f'stddev_pop(x[{i}])' for i in _K)}] AS sd, [{', '.join(f'avg(x[{i}])' for i in _K)}] AS mu,
  avg(y) AS my, {_pairs_sql(lambda i, j: f'covar_pop(x[{i}], x[{j}])')} AS c,
  [{', '.join(f'covar_pop(x[{i}], y)' for i in _K)}] AS cy FROM train),
scaled AS (SELECT {_pairs_sql(lambda i, j: f'c[{i}][{j}] / (sd[{i}] * sd[{j}])')} AS g,
  [{', '.join(f'cy[{i}] / sd[{i}]' for i in _K)}] AS t FROM s),
descent AS (SELECT 0 AS k, {', '.join(f'0.0::DOUBLE AS b{i}' for i in _K)} UNION ALL {_sweep_sql()}),
fit AS (SELECT [{', '.join(f'b{i}' for i in _K)}] AS beta, g, t FROM descent, scaled WHERE k = {SWEEPS}),
found AS (
  SELECT unnest([{', '.join(f"'{c}'" for c in _FEATURES)}, '']) AS feature,
    unnest(list_append(beta, my - ({' + '.join(f'beta[{i}] * mu[{i}] / sd[{i}]' for i in _K)}))) AS coeficiente,
    unnest([{', '.join('t[%d] - (%s)' % (j, ' + '.join(f'g[{j}][{i}] * beta[{i}]' for i in _K)) for j in _K)}, 0.0::DOUBLE])
      AS gradiente, unnest([{', '.join(f'{ALPHA}::DOUBLE' for _ in _K)}, 0.0::DOUBLE]) AS limite
  FROM fit, s)"""


@query("lasso_optimality", f"""WITH {_LASSO}
SELECT feature, {rnd('coeficiente', 4)} AS coeficiente, {rnd('gradiente', 4)} AS gradiente, limite,
  coeficiente <> 0 AS ativa FROM found""")
def _(spark, sf):
    found = regression.lasso_optimality(_gram(spark, sf)[1], _FEATURES, "label", ALPHA)
    return found.withColumns({c: round_stable(F.col(c), 4) for c in ("coeficiente", "gradiente")})


# The tree as a table: the twin finds every split again from the rows.

DEPTH, LEAST, BINS = 3, 20, 16


def _tree_sql():
    """Node of every training and test row after DEPTH levels, and the splits, each level from its rows."""
    cyclic = [regression.NUMERIC.index(c) + 1 for c in ("sin_mes", "cos_mes")]
    x = ", ".join(f"round(x[{i}], 6) + 0.0" if i in cyclic else f"x[{i}]" for i in _K)
    parts = [f"""{_ENGINEERED},
data AS (SELECT id, y, [{x}] AS x, bucket >= 20 AS train FROM eng),
total AS (SELECT var_pop(y) * count(*) AS sse FROM data WHERE train),
long AS (SELECT id, y, unnest(range(1, {len(_FEATURES) + 1})) AS f, unnest(x) AS v FROM data WHERE train),
points AS (SELECT DISTINCT f, round(t, 6) AS t FROM (SELECT f, unnest(
  quantile_cont(v, [{', '.join(str(i / BINS) for i in range(1, BINS))}])) AS t FROM long GROUP BY f)),
at0 AS (SELECT id, y, x, train, 1 AS node FROM data)"""]
    for d in range(DEPTH):
        parts.append(f"""
sides{d} AS (SELECT node, f, t, count(*) FILTER (v <= t) AS nl, count(*) FILTER (v > t) AS nr,
    avg(y) FILTER (v <= t) AS ml, avg(y) FILTER (v > t) AS mr
  FROM (SELECT node, f, v, l.y FROM long l JOIN at{d} USING (id)) JOIN points USING (f) GROUP BY ALL),
gain{d} AS (SELECT node, f, t, round(nl * nr / (nl + nr) * pow(ml - mr, 2) / sse, 9) AS gain FROM sides{d}, total
  WHERE nl >= {LEAST} AND nr >= {LEAST}),
best{d} AS (SELECT * FROM gain{d} WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, t) = 1),
at{d + 1} AS (SELECT id, y, x, train, CASE WHEN t IS NULL THEN node ELSE 2 * node + (x[f] > t)::INT END AS node
  FROM at{d} LEFT JOIN best{d} USING (node))""")
    steps = " UNION ".join(f"SELECT * FROM best{d}" for d in range(DEPTH))
    nodes = " UNION ".join(f"SELECT id, y, node FROM at{d} WHERE train" for d in range(DEPTH + 1))
    parts.append(f"""
splits AS ({steps}),
nodes AS (SELECT node, count(*) AS n, avg(y) AS mean, stddev_pop(y) AS spread FROM ({nodes}) GROUP BY node),
names AS (SELECT unnest(range(1, {len(_FEATURES) + 1})) AS f, unnest([{', '.join(f"'{c}'" for c in _FEATURES)}]) AS name)""")
    return ",".join(parts)


_TREE = _tree_sql()


def _tree(spark, sf):
    """Training and test rows with fuel columns, and the tree of the training rows."""
    wide, _ = regression.level_columns(_engineered(spark, sf), FUEL, FUELS)
    wide = wide.withColumns({c: F.round(c, 6) + 0.0 for c in ("sin_mes", "cos_mes")})
    train, test = regression.split_train_test(durable(wide.select(ID, "label", *_FEATURES)))
    points = trees.split_points(train, _FEATURES, BINS)
    return test, trees.grow_tree(train, _FEATURES, "label", DEPTH, LEAST, points)


@query("tree_table", f"""WITH {_TREE}
SELECT node AS no, CAST(floor(log2(node)) AS INTEGER) AS profundidade, name AS variavel, t AS limiar, n AS linhas,
  {rnd('mean', 4)} AS media, {rnd('spread', 4)} AS desvio, round(gain, 8) AS ganho
FROM nodes LEFT JOIN splits USING (node) LEFT JOIN names USING (f)""")
def _(spark, sf):
    tree = _tree(spark, sf)[1]
    return tree.withColumns({c: round_stable(F.col(c), 4) for c in ("media", "desvio")}).withColumn(
        "ganho", F.round("ganho", 8))


@query("tree_importance", f"""WITH {_TREE}
SELECT name AS feature, {rnd('sum(gain) / (SELECT sum(gain) FROM splits)', 6)} AS importancia
FROM splits JOIN names USING (f) GROUP BY 1""")
def _(spark, sf):
    return trees.tree_importance(_tree(spark, sf)[1]).withColumn("importancia", round_stable(F.col("importancia"), 6))


@query("tree_predictions", f"""WITH {_TREE}
SELECT 'arvore' AS modelo, id, node AS no, {rnd('mean', 4)} AS previsto, {rnd('y - mean', 4)} AS residuo
FROM at{DEPTH} JOIN nodes USING (node) WHERE NOT train""")
def _(spark, sf):
    test, tree = _tree(spark, sf)
    found = trees.predict_tree(test, tree, [ID, "label"])
    return found.select("modelo", ID, "no", round_stable(F.col("prediction"), 4).alias("previsto"),
                        round_stable(F.col("label") - F.col("prediction"), 4).alias("residuo"))


# Projection of the rule segments: the twin squares the covariance matrix until one direction is left.

_AXES = range(1, 4)
_SQUARED = ", ".join("[" + ", ".join("(%s) / size" % " + ".join(f"m[{i}][{h}] * m[{h}][{j}]" for h in _AXES) for j in _AXES) + "]"
                     for i in _AXES)
_SIZE = " + ".join(f"m[{i}][{j}] * m[{i}][{j}]" for i in _AXES for j in _AXES)


def _power_sql(step, start):
    """The main direction of a symmetric matrix (column ``m`` of ``start``) as a list ``v``, largest entry positive."""
    top = "CASE " + " ".join(
        f"WHEN {' AND '.join(f'm[{i}][{i}] >= m[{j}][{j}]' for j in _AXES)} THEN {i}" for i in _AXES) + " END"
    return f"""{step}_power AS (SELECT 0 AS k, m FROM {start} UNION ALL
  SELECT k + 1, [{_SQUARED}] FROM (SELECT *, {_SIZE} AS size FROM {step}_power WHERE k < 60)),
{step} AS (SELECT [{', '.join(f'm[{i}][top] / sqrt(m[top][top])' for i in _AXES)}] AS v
  FROM (SELECT m, {top} AS top FROM {step}_power WHERE k = 60))"""


def _along(v):
    return " + ".join(f"{v}[{i}] * {v}[{j}] * m[{i}][{j}]" for i in _AXES for j in _AXES)


_PCA = f"""RECURSIVE {_CODED},
spots AS (SELECT 'entidade' AS tipo, marca_modelo AS chave, cluster_km, [R_norm, F_norm, M_norm] AS x FROM coded),
mean AS (SELECT [{', '.join(f'avg(x[{i}])' for i in _AXES)}] AS mu FROM spots),
cov AS (SELECT [{', '.join('[' + ', '.join(f'covar_pop(x[{i}], x[{j}])' for j in _AXES) + ']' for i in _AXES)}] AS m FROM spots),
{_power_sql('first', 'cov')},
e1 AS (SELECT v AS v1, {_along('v')} AS l1 FROM first, cov),
rest AS (SELECT [{', '.join('[' + ', '.join(f'm[{i}][{j}] - l1 * v1[{i}] * v1[{j}]' for j in _AXES) + ']' for i in _AXES)}] AS m
  FROM cov, e1),
{_power_sql('second', 'rest')},
e2 AS (SELECT v AS v2, {_along('v')} AS l2 FROM second, cov),
every AS (SELECT * FROM spots UNION ALL
  SELECT 'centroide', CAST(row_number() OVER (ORDER BY cluster_km) - 1 AS VARCHAR),
    CAST(row_number() OVER (ORDER BY cluster_km) - 1 AS INTEGER), x
  FROM (SELECT cluster_km, [{', '.join(f'avg(x[{i}])' for i in _AXES)}] AS x FROM spots GROUP BY 1))"""


@query("pca_by_segment", f"""WITH {_PCA}
SELECT tipo, chave, cluster_km, {rnd(' + '.join(f'(x[{i}] - mu[{i}]) * v1[{i}]' for i in _AXES), 6)} AS pc1,
  {rnd(' + '.join(f'(x[{i}] - mu[{i}]) * v2[{i}]' for i in _AXES), 6)} AS pc2,
  {rnd('l1 / (m[1][1] + m[2][2] + m[3][3])', 6)} AS var1, {rnd('l2 / (m[1][1] + m[2][2] + m[3][3])', 6)} AS var2
FROM every, mean, cov, e1, e2""")
def _(spark, sf):
    coded = _coded_segments(spark, sf)
    means = coded.groupBy("cluster_km").agg(*[F.avg(c).alias(c) for c in clustering.NORMS]).orderBy("cluster_km")
    centres = np.array([[r[c] for c in clustering.NORMS] for r in means.collect()])
    found = clustering.pca_2d(coded, ENTITY, centres)
    return found.withColumns({c: round_stable(F.col(c), 6) for c in ("pc1", "pc2", "var1", "var2")})


# Normal quantile plots: the twin has the rational functions in SQL.


def _horner_sql(values, x):
    out = f"{values[-1]!r}::DOUBLE"
    for v in reversed(values[:-1]):
        out = f"({out} * ({x}) + {v!r}::DOUBLE)"
    return out


def _rational_sql(table, x):
    return f"{_horner_sql(table[0], x)} / {_horner_sql(table[1], x)}"


_QQ = f"""numbered AS (SELECT value, row_number() OVER (ORDER BY value, event_id) AS i, count(*) OVER () AS n
  FROM events WHERE value IS NOT NULL),
chance AS (SELECT *, CASE WHEN i = n THEN pow(0.5, 1.0 / n) WHEN i = 1 THEN 1 - pow(0.5, 1.0 / n)
  ELSE (i - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS p FROM numbered),
tail AS (SELECT *, p - 0.5::DOUBLE AS q, sqrt(-ln(least(p, 1 - p))) AS r FROM chance),
qq AS (SELECT i AS ordem, value AS observado, CASE
    WHEN abs(q) <= 0.425::DOUBLE THEN q * {_rational_sql(special.CENTRAL, '0.180625::DOUBLE - q * q')}
    WHEN r <= 5 THEN sign(q) * {_rational_sql(special.MIDDLE, 'r - 1.6::DOUBLE')}
    ELSE sign(q) * {_rational_sql(special.TAIL, 'r - 5')} END AS teorico FROM tail)"""


def _qq(spark, sf):
    return stats.qq_points(events(spark, sf).select("event_id", "value"), "value", "event_id")


@query("qq_points_rounded", f"WITH {_QQ} SELECT ordem, {rnd('teorico', 9)} AS teorico, observado FROM qq")
def _(spark, sf):
    return _qq(spark, sf).withColumn("teorico", round_stable(F.col("teorico"), 9))


@query("qq_fit_rounded", f"""WITH {_QQ} SELECT {rnd('regr_slope(observado, teorico)', 6)} AS inclinacao,
  {rnd('regr_intercept(observado, teorico)', 6)} AS intercepto, {rnd('corr(observado, teorico)', 9)} AS r FROM qq""")
def _(spark, sf):
    fit = stats.qq_fit(_qq(spark, sf))
    return fit.select(*[round_stable(F.col(c), d).alias(c) for c, d in (("inclinacao", 6), ("intercepto", 6), ("r", 9))])


# The written dashboard bundle, read back part by part.


def _bundle(spark, sf, part, schema):
    path = scratch_folder(spark, "painel")
    tables.write_dashboard_bundle(with_brand(listings(spark, sf)), customers(spark, sf), path)
    return spark.read.schema(schema).json(f"{path}/{part}")


@query("dashboard_bundle_filters", ORACLES["filter_domains"])
def _(spark, sf):
    out = _bundle(spark, sf, "filters", "date_min date, date_max date, marcas array<string>, "
                                        "combustiveis array<string>, status array<string>")
    return out.withColumns({c: F.array_join(c, "|") for c in ("marcas", "combustiveis", "status")})


@query("dashboard_bundle_rows", f"""WITH {LISTINGS}
SELECT marca_modelo, marca, ano_fabricacao, preco_brl, strftime(data_anuncio, '%Y-%m-%d') AS data_anuncio, ano_mes,
  combustivel, status FROM listings""")
def _(spark, sf):
    return _bundle(spark, sf, "raw", f"{ENTITY} string, {BRAND} string, {YEAR} int, {PRICE} double, {DATE} string, "
                                     f"ano_mes string, {FUEL} string, {STATUS} string")


@query("dashboard_bundle_cards", ORACLES["rfm_cards"])
def _(spark, sf):
    return _bundle(spark, sf, "rfm_seg", "segmento_rfm string, n long, score double")
