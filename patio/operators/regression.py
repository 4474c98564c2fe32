"""Price regression: features, split, scaling, four models, metrics and diagnostics.

One-hot vectors stay sparse. Columns are divided by their training standard deviation; centring
would only move the intercept of the linear models and no split of a tree, so fits leave it out.
"""

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (ElementwiseProduct, OneHotEncoder, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patio.columns import DATE, ENTITY, FUEL, ID, PRICE, STATUS, YEAR
from patio.functions.dates import cyclic_month, vehicle_age
from patio.functions.numeric import round_stable
from patio.session import durable, scalar_struct

NUMERIC = [YEAR, "idade", "mes", "trimestre", "sin_mes", "cos_mes"]
CATEGORIES = [FUEL, STATUS, ENTITY]
# The two directions of a coefficient.
UP, DOWN = "↑ preço mais alto", "↓ preço mais baixo"
MODELS = ["linear", "ridge", "lasso", "arvore"]


def engineer(df: DataFrame) -> DataFrame:
    """Calendar and age features next to the categories and the target."""
    sin, cos = cyclic_month(F.col(DATE))
    return df.select(
        ID, F.col(YEAR).cast("double").alias(YEAR),
        vehicle_age(F.col(DATE), F.col(YEAR)).cast("double").alias("idade"),
        F.month(DATE).cast("double").alias("mes"), F.quarter(DATE).cast("double").alias("trimestre"),
        sin.alias("sin_mes"), cos.alias("cos_mes"), *CATEGORIES, F.col(PRICE).alias("label"))


def onehot_drop_first(columns: Sequence[str] = CATEGORIES) -> list:
    """Stages that one-hot encode and drop the alphabetically first level."""
    indexed = [f"{c}_idx" for c in columns]
    return [
        StringIndexer(inputCols=list(columns), outputCols=indexed,
                      stringOrderType="alphabetDesc", handleInvalid="error"),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_vec" for c in columns], dropLast=True),
    ]


@dataclass
class FeatureSpace:
    pipeline: PipelineModel
    names: list[str]

    def transform(self, engineered: DataFrame) -> DataFrame:
        return self.pipeline.transform(engineered).select(ID, "label", "raw")


def feature_matrix(engineered: DataFrame) -> FeatureSpace:
    """Numeric columns and one-hot columns assembled into the vector column ``raw``."""
    assembler = VectorAssembler(
        inputCols=NUMERIC + [f"{c}_vec" for c in CATEGORIES], outputCol="raw")
    model = Pipeline(stages=[*onehot_drop_first(), assembler]).fit(engineered)
    levels = model.stages[0].labelsArray
    names = NUMERIC + [f"{c}_{v}" for c, lv in zip(CATEGORIES, levels) for v in list(lv)[:-1]]
    return FeatureSpace(model, names)


def hash_bucket(seed: int, buckets: int) -> Column:
    """Bucket from the row id, by digits of a hash that SQL engines share: the same for any partitioning
    and on every retry."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col(ID))), 1, 8)
    return F.conv(digits, 16, 10).cast("long") % buckets


def split_train_test(df: DataFrame, test_pct: int = 20, seed: int = 42
                     ) -> tuple[DataFrame, DataFrame]:
    bucket = hash_bucket(seed, 100)
    return df.filter(bucket >= test_pct), df.filter(bucket < test_pct)


@dataclass
class Scaler:
    mean: list[float]
    std: list[float]
    rows: int

    def apply(self, df: DataFrame, center: bool = False) -> DataFrame:
        """Divide by the population standard deviation (and centre, when a dense result is wanted)."""
        inverse = Vectors.dense([1.0 / s if s > 0 else 1.0 for s in self.std])
        scaled = ElementwiseProduct(
            scalingVec=inverse, inputCol="raw", outputCol="features").transform(df)
        if not center:
            return scaled
        from pyspark.ml.functions import array_to_vector, vector_to_array
        offset = F.array(*[F.lit(m * i) for m, i in zip(self.mean, inverse)])
        return scaled.withColumn("features", array_to_vector(
            F.zip_with(vector_to_array("features"), offset, lambda x, o: x - o)))


def scale_features(train: DataFrame) -> Scaler:
    """Fit on the training rows only; population standard deviations."""
    n = train.count()
    model = StandardScaler(withMean=True, withStd=True, inputCol="raw", outputCol="_s").fit(train)
    shrink = ((n - 1) / n) ** 0.5
    return Scaler(list(model.mean), [s * shrink for s in model.std], n)


def estimator(name: str, train: DataFrame, weight: str | None = None):
    """Ridge with alpha 1 and lasso with alpha 10 in the scale of the sum-of-squares objective. ``weight``
    names the column that counts how many rows a row stands for."""
    linear = LinearRegression(solver="auto", standardization=False, maxIter=5000, tol=1e-9)
    tree = DecisionTreeRegressor(maxDepth=8, maxBins=256, seed=42)
    if weight is not None:
        linear, tree = linear.setWeightCol(weight), tree.setWeightCol(weight)
    if name == "linear":
        return linear
    if name == "ridge":
        sd, n = F.stddev_pop("label"), F.count("label")
        if weight is not None:
            w, y = F.col(weight), F.col("label")
            n, mean = F.sum(w), F.sum(w * y) / F.sum(w)
            sd = F.sqrt(F.greatest(F.sum(w * y * y) / n - mean * mean, F.lit(0.0)))
        s = train.agg(sd.alias("sd"), n.alias("n")).first()
        return linear.copy({linear.regParam: 1.0 * s["sd"] / s["n"], linear.elasticNetParam: 0.0})
    if name == "lasso":
        return linear.copy({linear.regParam: 10.0, linear.elasticNetParam: 1.0})
    if name == "arvore":
        return tree
    raise ValueError(name)


def predict(name: str, train: DataFrame, test: DataFrame):
    model = estimator(name, train).fit(train)
    predicted = model.transform(test).select(
        F.lit(name).alias("modelo"), ID, "label", "prediction")
    return model, predicted


def regression_metrics(predicted: DataFrame, by: Sequence[str] = ("modelo",), rows: bool = False) -> DataFrame:
    """R2 (negative when worse than the mean), MAE and RMSE per group in one aggregate; ``rows`` adds the
    group's size."""
    error = F.col("label") - F.col("prediction")
    sse = F.sum(error * error)
    sst = F.var_pop("label") * F.count("label")
    size = [F.count(F.lit(1)).alias("linhas")] if rows else []
    return predicted.groupBy(*by).agg(
        *size, round_stable(F.lit(1.0) - sse / sst, 6).alias("r2"),
        round_stable(F.avg(F.abs(error)), 4).alias("mae"),
        round_stable(F.sqrt(F.avg(error * error)), 4).alias("rmse"))


def fold_cells(train: DataFrame, fold: Column) -> DataFrame:
    """The rows of one fold and feature vector as one or two rows with a weight ``n``, of the same count, sum and
    sum of squares of ``label`` (null if one of them is null).

    Least squares and variance splits read no more than these of the labels of equal vectors, so fits on these
    rows are the fits on all rows.
    """
    y, n, s = F.col("label"), F.count(F.lit(1)), F.col("_s")
    cells = train.groupBy(fold.alias("fold"), "features").agg(
        n.cast("double").alias("n"), F.when(F.count(y) == n, F.avg(y)).alias("label"), F.stddev_pop(y).alias("_s"))
    return cells.select("fold", "features", F.inline(F.when(s > 0, F.array(*[
        F.struct((y + side).alias("label"), (F.col("n") / 2).alias("n")) for side in (-s, s)])).otherwise(
            F.array(F.struct(y.alias("label"), F.col("n").alias("n"))))))


def kfold_cv(train: DataFrame, names: Sequence[str] = MODELS, folds: int = 5, seed: int = 43,
             parallelism: int = 4) -> DataFrame:
    """Rows and R2 per model and fold on the already scaled training rows.

    Rows of equal features are brought together once and stored; all fits read those. Fits run as concurrent
    jobs, except that a tree, which keeps its rows in memory, is grown alone.
    """
    fold = hash_bucket(seed, folds)
    totals = {r["fold"]: r for r in train.groupBy(fold.alias("fold")).agg(
        F.count(F.lit(1)).alias("n"), (F.var_pop("label") * F.count("label")).alias("sst")).collect()}
    cells = durable(fold_cells(train, fold))

    def score(job: tuple[str, int]) -> tuple[str, int, int, float]:
        name, i = job
        rest = cells.filter(F.col("fold") != i)
        model = estimator(name, rest, "n").fit(rest)
        if i not in totals:
            return name, i + 1, 0, None
        error = F.col("label") - F.col("prediction")
        sse = F.sum(F.col("n") * error * error)
        found = model.transform(cells.filter(F.col("fold") == i)).agg(
            round_stable(F.lit(1.0) - sse / F.lit(totals[i]["sst"]), 6).alias("r2")).first()
        return name, i + 1, totals[i]["n"], found["r2"]

    scores = {}
    for together, own in ((parallelism, [m for m in names if m != "arvore"]), (1, [m for m in names if m == "arvore"])):
        jobs = [(m, i) for m in own for i in range(folds)]
        with ThreadPoolExecutor(together) as pool:
            scores |= zip(jobs, pool.map(score, jobs))
    return train.sparkSession.createDataFrame(
        [scores[m, i] for m in names for i in range(folds)], "modelo string, fold int, linhas long, r2 double")


def level_columns(df: DataFrame, column: str, levels: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Adds a 0/1 column for every level but the alphabetically first; returns their names."""
    kept = sorted(levels)[1:]
    names = [f"{column}_{v}" for v in kept]
    return df.withColumns({n: (F.col(column) == v).cast("double") for n, v in zip(names, kept)}), names


def long_features(engineered: DataFrame, numeric: Sequence[str] = NUMERIC, categories: Sequence[str] = CATEGORIES
                  ) -> DataFrame:
    """The feature matrix as (id, feature, valor) rows, zeros left out: numeric columns, and 1 for the level
    of each category unless it is the alphabetically first one."""
    firsts = scalar_struct(engineered.agg(*[F.min(c).alias(c) for c in categories]))
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("valor")) for c in numeric]
    cells += [F.struct(F.concat(F.lit(f"{c}_"), F.col(c)).alias("feature"), F.when(
        F.col(c) != firsts[c], F.lit(1.0)).otherwise(F.lit(0.0)).alias("valor")) for c in categories]
    return engineered.select(ID, F.inline(F.array(*cells))).filter("valor != 0")


def scale_long(long: DataFrame, fit: Column) -> DataFrame:
    """(id, feature, valor) rows divided by each feature's population standard deviation over the rows
    where ``fit`` holds, left-out zeros counted; a feature without variance there stays as it is."""
    n = long.filter(fit).select(F.count_distinct(ID)).scalar()
    sums = long.filter(fit).groupBy("feature").agg(
        F.sum("valor").alias("_s"), F.sum(F.col("valor") * F.col("valor")).alias("_q"))
    mean = F.col("_s") / n
    spread = sums.select("feature", F.sqrt(F.col("_q") / n - mean * mean).alias("_d"))
    return long.join(spread, "feature", "left").select(
        ID, "feature", F.when(F.col("_d") > 0, F.col("valor") / F.col("_d")).otherwise(F.col("valor")).alias("valor"))


def gram_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x, y, soma) rows from one aggregate: the row count under ("", ""), each column's sum under ("", y),
    and the centred sums of products of every pair of columns."""
    columns = list(columns)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    n = F.count(F.lit(1))
    cells = [("", "", n.cast("double"))] + [("", c, F.sum(c)) for c in columns]
    cells += [(a, b, F.covar_pop(a, b) * n) for a, b in pairs]
    return df.agg(*[v.cast("double").alias(f"_{i}") for i, (_, _, v) in enumerate(cells)]).select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"_{i}").alias("soma"))
        for i, (a, b, _) in enumerate(cells)])))


def _standardised(gram: DataFrame, features: Sequence[str], label: str) -> tuple:
    """From a Gram table: row count, means, features with variance, their deviations, and the products of
    the standardised features with each other and with the label."""
    sums = {(r.x, r.y): r.soma for r in gram.collect()}
    n = sums["", ""] or 0.0
    mean = {c: sums["", c] / n for c in (*features, label)} if n else {}
    kept = [c for c in features if n and sums[c, c] > 1e-12 * max(n, sums["", c] ** 2 / n)]
    spread = np.array([(sums[c, c] / n) ** 0.5 for c in kept])
    pair = lambda a, b: sums[(a, b) if (a, b) in sums else (b, a)]
    products = np.array([[pair(a, b) for b in kept] for a in kept]).reshape(len(kept), len(kept)) / np.outer(spread, spread)
    target = np.array([pair(c, label) for c in kept]) / spread
    return n, mean, kept, spread, products, target


def gram_coefficients(gram: DataFrame, features: Sequence[str], label: str, alphas: Mapping[str, float]) -> DataFrame:
    """(modelo, feature, coeficiente) rows of ridge models solved from a Gram table, which holds a few numbers
    per pair of features. Coefficients are those of features divided by their standard deviation; the
    intercept is the row without a feature name. Features without variance get 0."""
    n, mean, kept, spread, products, target = _standardised(gram, features, label)
    rows = []
    for name, alpha in alphas.items():
        beta = dict(zip(kept, np.linalg.solve(products + alpha * np.eye(len(kept)), target))) if kept else {}
        rows += [(name, c, float(beta.get(c, 0.0))) for c in features]
        shift = sum(beta[c] * mean[c] / s for c, s in zip(kept, spread))
        rows.append((name, "", float(mean[label] - shift) if n else None))
    return gram.sparkSession.createDataFrame(rows, "modelo string, feature string, coeficiente double")


def lasso_optimality(gram: DataFrame, features: Sequence[str], label: str, alpha: float, sweeps: int = 20_000,
                     tolerance: float = 1e-13) -> DataFrame:
    """(feature, coeficiente, gradiente, limite, ativa) rows of a lasso model, solved by coordinate descent on
    a Gram table, which holds a few numbers per pair of features.

    Coefficients are those of standardised features under squared error / 2n + alpha x |coefficients|. At the
    optimum the gradient of the error is alpha with the coefficient's sign where the feature is active and
    between -alpha and alpha elsewhere, so the table shows by itself whether the fit is right. Features
    without variance get 0; the row without a feature name is the intercept.
    """
    n, mean, kept, spread, products, target = _standardised(gram, features, label)
    beta = np.zeros(len(kept))
    if kept:
        products, target = products / n, target / n
    for _ in range(sweeps if kept else 0):
        before = beta.copy()
        for j in range(len(kept)):
            rest = target[j] - products[j] @ beta + products[j, j] * beta[j]
            beta[j] = np.sign(rest) * max(abs(rest) - alpha, 0.0) / products[j, j]
        if np.abs(beta - before).max() <= tolerance * max(np.abs(beta).max(), 1e-300):
            break
    gradient = dict(zip(kept, target - products @ beta)) if kept else {}
    found = dict(zip(kept, beta))
    table = [(c, float(found.get(c, 0.0)), float(gradient.get(c, 0.0)), alpha, bool(found.get(c, 0.0) != 0)) for c in features]
    shift = sum(b * mean[c] / s for c, b, s in zip(kept, beta, spread))
    table.append(("", float(mean[label] - shift) if n else None, 0.0, 0.0, True))
    return gram.sparkSession.createDataFrame(
        table, "feature string, coeficiente double, gradiente double, limite double, ativa boolean")


def predict_gram(df: DataFrame, gram: DataFrame, coefficients: DataFrame, features: Sequence[str]) -> DataFrame:
    """(modelo, id, label, prediction) rows of all models of a coefficient table."""
    sums = {(r.x, r.y): r.soma for r in gram.collect()}
    spread = {c: (sums[c, c] / sums["", ""]) ** 0.5 if sums["", ""] else 0.0 for c in features}
    models = {}
    for r in coefficients.collect():
        models.setdefault(r.modelo, {})[r.feature] = r.coeficiente
    cells = []
    for name, beta in models.items():
        value = F.lit(beta[""])
        for c in features:
            if beta[c]:
                value = value + F.col(c) * F.lit(beta[c] / spread[c])
        cells.append(F.struct(F.lit(name).alias("modelo"), value.alias("prediction")))
    return df.select(ID, "label", F.inline(F.array(*cells))).select("modelo", ID, "label", "prediction")


def coef_ranking(train: DataFrame, names: Sequence[str], n: int = 15) -> DataFrame:
    """Ridge coefficients by magnitude with the direction of their effect."""
    model = estimator("ridge", train).fit(train)
    table = train.sparkSession.createDataFrame(
        [(f, float(v)) for f, v in zip(names, model.coefficients.toArray())], "feature string, coeficiente double")
    return rank_coefficients(table, n)


def rank_coefficients(table: DataFrame, n: int = 15) -> DataFrame:
    """The first n (feature, coeficiente) rows by magnitude with the direction of their effect."""
    top = table.orderBy(F.desc(F.abs("coeficiente")), "feature").limit(n)
    return top.withColumn("sentido", F.when(F.col("coeficiente") > 0, UP).otherwise(DOWN))


def feature_importance(train: DataFrame, names: Sequence[str], n: int = 15) -> DataFrame:
    model = estimator("arvore", train).fit(train)
    table = train.sparkSession.createDataFrame(
        [(f, float(v)) for f, v in zip(names, model.featureImportances.toArray())], "feature string, importancia double")
    return table.orderBy(F.desc("importancia"), "feature").limit(n)


def residual_points(predicted: DataFrame) -> DataFrame:
    return predicted.select(
        "modelo", ID, F.col("prediction").alias("previsto"),
        (F.col("label") - F.col("prediction")).alias("residuo"))


def pred_vs_actual(predicted: DataFrame) -> DataFrame:
    """Pairs in thousands, and the shared axis limits per model."""
    pairs = predicted.select(
        "modelo", ID, (F.col("label") / 1000).alias("real"),
        (F.col("prediction") / 1000).alias("previsto"))
    limits = pairs.groupBy("modelo").agg(
        F.least(F.min("real"), F.min("previsto")).alias("eixo_min"),
        F.greatest(F.max("real"), F.max("previsto")).alias("eixo_max"))
    return pairs.join(limits, "modelo")
