"""K-means over standardised entity metrics, silhouettes, profiles and projection.

All restarts of all k advance together: one pass over the rows per iteration, whatever the number
of fits. Tasks return sums per (run, cluster); the driver only sees those few rows.
"""

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patio.functions.numeric import round_stable
from patio.operators.quantiles import quantile_scalars
from patio.operators.summaries import rows

NORMS = ["R_norm", "F_norm", "M_norm"]
CHUNK = 20_000
MAX_ITERATIONS = 300  # fixed value, like the tolerance below
TOLERANCE = 1e-4

# Cluster labels.
KM_PREMIUM, KM_VOLUME = "KM-Premium", "KM-Alto Volume"
KM_ECONOMY, KM_MIDDLE = "KM-Econômico", "KM-Médio"


@dataclass
class Fit:
    """Cluster centres of one run and their within-cluster sum of squares."""

    k: int
    centers: np.ndarray
    cost: float


def with_features(df: DataFrame, columns: Sequence[str] = NORMS) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def nearest(columns: Sequence[str], centers: np.ndarray) -> Column:
    """0-based index of the closest centre; the first one on ties."""
    distances = F.array(*[
        sum(((F.col(c) - F.lit(float(v))) ** 2 for c, v in zip(columns, center)), F.lit(0.0))
        for center in centers])
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def _draw(points: DataFrame, columns: list[str], runs: dict[int, np.ndarray], seed: int) -> dict[int, np.ndarray]:
    """One more centre for every run, drawn from all rows by squared distance to the run's centres.

    Every row takes part in a race: an exponential time from a hash of its key and the run, divided by
    its squared distance; the first one wins. Tasks return their winners, one row per run.
    """
    schema = "run int, far boolean, time double, " + ", ".join(f"x{j} double" for j in range(len(columns)))

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, tuple] = {}
        for batch in batches:
            x, keys = batch[columns].to_numpy(), batch["_key"].to_numpy().view(np.uint64)
            for run, centers in runs.items():
                mixed = (keys ^ np.uint64((seed * 1_000_003 + run) * 64 + len(centers))) * np.uint64(0x9E3779B97F4A7C15)
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                mixed ^= mixed >> np.uint64(32)
                time = -np.log(((mixed >> np.uint64(11)) + np.uint64(1)) / 2.0 ** 53)
                far = np.ones(len(x), bool)
                if len(centers):
                    gap = ((x[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2).min(axis=1)
                    far = gap > 0
                    time = np.where(far, time / np.where(far, gap, 1.0), time)
                at = np.lexsort((time, ~far))[0] if len(x) else None
                if at is not None:
                    row = (not far[at], time[at], *x[at])
                    best[run] = min(best.get(run, row), row)
        yield pd.DataFrame([(run, not r[0], *r[1:]) for run, r in best.items()], columns=[
            "run", "far", "time", *[f"x{j}" for j in range(len(columns))]])

    values = [f"x{j}" for j in range(len(columns))]
    won = (
        points.select(F.xxhash64("_id").alias("_key"), *columns).mapInPandas(part, schema)
        .groupBy("run").agg(F.min(F.struct((~F.col("far")).alias("near"), "time", *values)).alias("w")))
    return {r["run"]: np.array([[r["w"][v] for v in values]]) for r in won.collect()}


def _cluster_sums(points: DataFrame, columns: list[str], runs: list[np.ndarray]) -> pd.DataFrame:
    """Count, coordinate sums and cost per (run, cluster), one pass."""
    schema = "run int, cluster int, n long, cost double, " + ", ".join(
        f"s{j} double" for j in range(len(columns)))

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[columns].to_numpy()
            out = []
            for run, centers in enumerate(runs):
                squared = ((x[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)
                label = squared.argmin(axis=1)
                best = squared[np.arange(len(x)), label]
                for c in np.unique(label):
                    mine = label == c
                    out.append((run, c, mine.sum(), best[mine].sum(), *x[mine].sum(axis=0)))
            yield pd.DataFrame(out, columns=["run", "cluster", "n", "cost"] + [
                f"s{j}" for j in range(len(columns))])

    sums = points.select(*columns).mapInPandas(part, schema)
    return sums.groupBy("run", "cluster").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"),
        *[F.sum(f"s{j}").alias(f"s{j}") for j in range(len(columns))]).toPandas()


def fit_runs(points: DataFrame, key: str, ks: Sequence[int], restarts: int = 10, seed: int = 42,
             columns: Sequence[str] = NORMS) -> dict[int, Fit]:
    """Lowest-cost fit per k over several starts, all runs advancing in the same passes."""
    columns = list(columns)
    named = points.select(F.col(key).alias("_id"), *columns)
    sizes = [k for k in ks for _ in range(restarts)]
    runs = [np.zeros((0, len(columns))) for _ in sizes]
    for step in range(max(sizes)):
        drawn = _draw(named, columns, {i: runs[i] for i, k in enumerate(sizes) if k > step}, seed)
        for i, centre in drawn.items():
            runs[i] = np.concatenate([runs[i], centre])
    costs = [math.inf] * len(runs)
    spread = points.agg(*[F.var_pop(c).alias(c) for c in columns]).first()
    scale = float(np.mean([spread[c] or 0.0 for c in columns])) or 1.0
    active = list(range(len(runs)))
    for _ in range(MAX_ITERATIONS):
        sums = _cluster_sums(points, columns, [runs[i] for i in active])
        moving = []
        for at, i in enumerate(active):
            mine = sums[sums["run"] == at]
            costs[i] = float(mine["cost"].sum())
            centers = runs[i].copy()
            index = mine["cluster"].to_numpy()
            centers[index] = mine[[f"s{j}" for j in range(len(columns))]].to_numpy() / mine[
                ["n"]].to_numpy()
            shift = float(((centers - runs[i]) ** 2).sum())
            runs[i] = centers
            if shift > TOLERANCE * scale:
                moving.append(i)
        active = moving
        if not active:
            break
    sums = _cluster_sums(points, columns, runs)
    costs = sums.groupby("run")["cost"].sum().reindex(range(len(runs))).tolist()
    best: dict[int, Fit] = {}
    for i, k in enumerate(k for k in ks for _ in range(restarts)):
        if k not in best or costs[i] < best[k].cost:
            best[k] = Fit(k, runs[i], costs[i])
    return best


def silhouette_squared(predicted: DataFrame) -> float:
    """Mean silhouette on squared Euclidean distance; linear in the number of rows."""
    return ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(predicted)


def silhouette_euclid(points: DataFrame, key: str, columns: Sequence[str],
                      clusters: Sequence[str], chunk: int = CHUNK) -> DataFrame:
    """Mean silhouette on Euclidean distance, one row per clustering column.

    It needs every point's distance sum to every cluster, so its work is quadratic by definition. The
    points are cut into hash chunks of about ``chunk`` rows, and each pair of chunks is a task, which
    returns sums. No pair of points becomes a row, nothing passes through the driver, and any number of
    chunks gives the same answer.
    """
    columns, clusters = list(columns), list(clusters)
    base = points.select(F.col(key).cast("string").alias("_k"),
                         *[F.col(c).cast("double").alias(c) for c in columns],
                         *[F.col(c).cast("int").alias(c) for c in clusters])
    n_chunks = max(1, math.ceil(base.count() / chunk))
    slot = F.pmod(F.xxhash64("_k"), F.lit(n_chunks))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_chunks - 1).cast("long")))
    dealt = base.select("*", F.lit(True).alias("_own"), slot.alias("_i"), every.alias("_j")).unionByName(
        base.select("*", F.lit(False).alias("_own"), every.alias("_i"), slot.alias("_j")))
    schema = "_k string, clustering string, own int, other int, total double"

    def sums(block: pd.DataFrame) -> pd.DataFrame:
        mine, there = block[block["_own"]], block[~block["_own"]]
        points_there, out = there[columns].to_numpy(), []
        for at in range(0, len(mine), 256):
            own = mine.iloc[at:at + 256]
            diff = own[columns].to_numpy()[:, None, :] - points_there[None, :, :]
            distance = np.sqrt((diff * diff).sum(axis=2))
            for c in clusters:
                for v in sorted(there[c].unique()):
                    out.append(pd.DataFrame({
                        "_k": own["_k"], "clustering": c, "own": own[c], "other": int(v),
                        "total": distance @ (there[c] == v).to_numpy(float)}))
        return pd.concat(out) if out else pd.DataFrame(columns=["_k", "clustering", "own", "other", "total"])

    distances = dealt.groupBy("_i", "_j").applyInPandas(sums, schema)
    named = base.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("clustering"), F.col(c).alias("other")) for c in clusters])))
    sizes = named.groupBy("clustering", "other").agg(rows().alias("size"))
    own = F.col("own") == F.col("other")
    means = (
        distances.groupBy("_k", "clustering", "own", "other").agg(F.sum("total").alias("total"))
        .join(sizes, ["clustering", "other"]).groupBy("_k", "clustering").agg(
            F.max(F.when(own, F.col("size"))).alias("own_size"),
            F.max(F.when(own, F.try_divide(F.col("total"), F.col("size") - 1))).alias("a"),
            F.min(F.when(~own, F.col("total") / F.col("size"))).alias("b")))
    width = F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b"))
    value = F.when(F.col("own_size") == 1, 0.0).otherwise(F.coalesce(width, F.lit(0.0)))
    return means.groupBy("clustering").agg(F.avg(value).alias("silhouette"))


def _scored(df: DataFrame, key: str, ks: Sequence[int], restarts: int, seed: int,
            columns: Sequence[str]) -> list[tuple[Fit, float]]:
    """The best fit of each k and its silhouette on squared distance, which is linear in the rows."""
    points = df.select(key, *columns).persist()
    try:
        fits = fit_runs(points, key, ks, restarts, seed, columns)
        features = with_features(points, columns)
        return [(fits[k], silhouette_squared(
            features.withColumn("prediction", nearest(columns, fits[k].centers)))) for k in ks]
    finally:
        points.unpersist()


def _best(scored: list[tuple[Fit, float]]) -> Fit:
    return max(scored, key=lambda s: (s[1], -s[0].k))[0]


def kmeans_sweep(df: DataFrame, key: str, ks: Sequence[int] = range(2, 9), restarts: int = 10,
                 seed: int = 42, columns: Sequence[str] = NORMS) -> DataFrame:
    """Inertia and silhouette (squared distance) per k; the best k is the first with the largest
    silhouette. It may differ from the best k by Euclidean silhouettes."""
    scored = _scored(df, key, list(ks), restarts, seed, columns)
    best = _best(scored).k
    return df.sparkSession.createDataFrame(
        [(fit.k, fit.cost, width, fit.k == best) for fit, width in scored],
        "k int, inercia double, silhouette double, melhor boolean")


def kmeans_assign(df: DataFrame, key: str, ks: Sequence[int] = range(2, 9), restarts: int = 10, seed: int = 42,
                  columns: Sequence[str] = NORMS) -> tuple[DataFrame, np.ndarray]:
    """Cluster id per row (``cluster_km``) and the centres of the best fit of the best k."""
    ks = list(ks)
    if len(ks) > 1:
        centers = _best(_scored(df, key, ks, restarts, seed, columns)).centers
    else:
        centers = fit_runs(df.select(key, *columns), key, ks, restarts, seed, columns)[ks[0]].centers
    return df.withColumn("cluster_km", nearest(columns, centers)), centers


def cluster_profile(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("cluster_km").agg(
        rows().alias("n"), *[
            round_stable(F.avg(c)).alias(n) for c, n in (
                ("recency", "R"), ("frequency", "F"), ("monetary", "M"), ("RFM_score", "rfm"))
        ]).orderBy(F.desc("M"), "cluster_km")


def cluster_label(profile: DataFrame, entities: DataFrame) -> DataFrame:
    """Label per cluster: its rounded means against the entities' unrounded quartiles."""
    m25, m75 = quantile_scalars(entities, "monetary", [0.25, 0.75])
    (f75,) = quantile_scalars(entities, "frequency", [0.75])
    label: Column = (
        F.when(F.col("M") >= m75, KM_PREMIUM).when(F.col("F") >= f75, KM_VOLUME)
        .when(F.col("M") <= m25, KM_ECONOMY).otherwise(KM_MIDDLE))
    return profile.withColumn("cluster_km_label", label)


def pca_2d(df: DataFrame, key: str, centers: np.ndarray, columns: Sequence[str] = NORMS) -> DataFrame:
    """Two principal components of the rows and of the cluster centres, with variance shares.

    The data are centred first. The sign of a component is arbitrary; its largest loading is made
    positive.
    """
    columns = list(columns)
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    spark = df.sparkSession
    points = df.select(
        F.lit("entidade").alias("tipo"), F.col(key).cast("string").alias("chave"), "cluster_km",
        *[F.col(c).cast("double").alias(c) for c in columns])
    centres = spark.createDataFrame(
        [("centroide", str(i), i, *[float(v) for v in c])
         for i, c in enumerate(centers)],
        f"tipo string, chave string, cluster_km int, {', '.join(f'{c} double' for c in columns)}")

    def centred(part: DataFrame) -> DataFrame:
        return with_features(part.select("tipo", "chave", "cluster_km", *[
            (F.col(c) - F.lit(means[c])).alias(c) for c in columns]), columns)

    fitted = PCA(k=2, inputCol="features", outputCol="pc").fit(centred(points))
    loadings = fitted.pc.toArray()
    signs = [1.0 if loadings[np.argmax(np.abs(loadings[:, j])), j] >= 0 else -1.0 for j in (0, 1)]
    share = fitted.explainedVariance.toArray()
    xy = vector_to_array(F.col("pc"))
    return fitted.transform(centred(points.unionByName(centres))).select(
        "tipo", "chave", "cluster_km", (xy[0] * signs[0]).alias("pc1"),
        (xy[1] * signs[1]).alias("pc2"), F.lit(float(share[0])).alias("var1"),
        F.lit(float(share[1])).alias("var2"))
