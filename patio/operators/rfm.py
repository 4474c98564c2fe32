"""Recency, frequency, monetary segmentation of any entity key."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patio.columns import BRAND, DATE, ENTITY, ID, PRICE, YEAR
from patio.functions.numeric import round_stable
from patio.functions.text import brand_of
from patio.operators.quantiles import quantile_row, quantile_table
from patio.operators.summaries import rows, share_of_total
from patio.session import durable, scalar_struct

# Weights, rule bounds and segment names.
WEIGHTS = {"R_score": 0.25, "F_score": 0.30, "M_score": 0.45}
PREMIUM, VOLUME, ECONOMY = "Premium", "Alto Volume", "Econômico"
EMERGING, LOW = "Emergente", "Baixa Relevância"
SEGMENTS = [PREMIUM, VOLUME, ECONOMY, EMERGING, LOW]
QUINTILES = [0.2, 0.4, 0.6, 0.8]


def rfm_metrics(df: DataFrame, key: str = ENTITY) -> DataFrame:
    """One row per key. Recency counts days to the day after the latest listing of all.

    The grouped rows are written to the checkpoint folder, so the listings are scanned once
    whatever is computed from them afterwards.
    """
    per_key = durable(df.groupBy(key).agg(
        F.max(DATE).alias("_last"), F.count(ID).alias("frequency"), F.avg(PRICE).alias("monetary"),
        F.max(PRICE).alias("preco_max"), F.min(PRICE).alias("preco_min"),
        F.avg(YEAR).alias("ano_medio")))
    ref = per_key.agg(F.date_add(F.max("_last"), 1)).scalar()
    out = per_key.select(
        key, F.date_diff(ref, F.col("_last")).cast("long").alias("recency"), "frequency",
        "monetary", "preco_max", "preco_min", "ano_medio")
    return out.withColumn(BRAND, brand_of(F.col(key))) if key == ENTITY else out


def _score(x: Column, edges: Sequence[float], inverse: bool) -> Column:
    above = F.lit(0)
    for e in edges:
        above = above + F.when(x > F.lit(e), 1).otherwise(0)
    return (F.lit(len(edges) + 1) - above) if inverse else (above + 1)


def rfm_scores(rfm: DataFrame, on_ties: str = "raise") -> DataFrame:
    """Quintile scores 1-5 by right-closed quantile edges; recency inverted.

    Equal edges leave fewer than five classes: an error by default, with ``on_ties='collapse'``
    the classes between equal edges stay empty.
    """
    metrics = ["recency", "frequency", "monetary"]
    row = quantile_row(rfm, metrics, [0.0, *QUINTILES, 1.0]).first()
    edges = {m: [row[f"{m}_q{i}"] for i in range(len(QUINTILES) + 2)] for m in metrics}
    if on_ties == "raise":
        for m, values in edges.items():
            if len(set(values)) < len(values):
                raise ValueError(f"quintile edges of {m} repeat: {values}")
    scores = [("R_score", "recency", True), ("F_score", "frequency", False),
              ("M_score", "monetary", False)]
    return rfm.select("*", *[
        _score(F.col(m), edges[m][1:-1], inverse).cast("long").alias(name)
        for name, m, inverse in scores])


def rfm_composite(rfm: DataFrame, weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    total = sum((F.col(c) * F.lit(w) for c, w in weights.items()), F.lit(0.0))
    return rfm.withColumn("RFM_score", round_stable(total, 3))


def rfm_segment(rfm: DataFrame) -> DataFrame:
    """First matching rule names the segment."""
    r, f, m, s = (F.col(c) for c in ("R_score", "F_score", "M_score", "RFM_score"))
    return rfm.withColumn(
        "segmento_rfm",
        F.when((m >= 4) & (s >= 3.2), PREMIUM).when((f >= 4) & (m <= 3), VOLUME)
        .when((m <= 2) & (s <= 2.5), ECONOMY).when((r >= 4) & (f <= 2) & (m >= 3), EMERGING)
        .otherwise(LOW))


def rfm_standardize(rfm: DataFrame) -> DataFrame:
    """Population z-scores; recency negated, so larger is better everywhere."""
    metrics = {"R_norm": "recency", "F_norm": "frequency", "M_norm": "monetary"}
    s = scalar_struct(rfm.agg(
        *[F.avg(m).alias(f"{m}_a") for m in metrics.values()],
        *[F.stddev_pop(m).alias(f"{m}_d") for m in metrics.values()]))

    def z(m: str) -> Column:
        spread = F.when(s[f"{m}_d"] == 0, F.lit(1.0)).otherwise(s[f"{m}_d"])
        return (F.col(m) - s[f"{m}_a"]) / spread

    return rfm.select("*", *[
        (-z(m) if name == "R_norm" else z(m)).alias(name) for name, m in metrics.items()])


def segment_entities(df: DataFrame, key: str = ENTITY, on_ties: str = "raise") -> DataFrame:
    """Metrics, scores, composite, segment and standardised columns in one table."""
    scored = rfm_composite(rfm_scores(rfm_metrics(df, key), on_ties))
    return rfm_standardize(rfm_segment(scored))


def rfm_segment_share(segmented: DataFrame) -> DataFrame:
    counts = segmented.groupBy("segmento_rfm").agg(rows().alias("n"))
    return counts.select("*", share_of_total("n", 1).alias("pct")).orderBy(
        F.desc("n"), "segmento_rfm")


def segment_stats(segmented: DataFrame) -> DataFrame:
    """Size, median metrics and mean score per segment, best score first."""
    medians = {"recency": ["recency_med"], "frequency": ["freq_med"], "monetary": ["preco_med"]}
    out = quantile_table(segmented, ["segmento_rfm"], medians, [0.5], [
        rows().alias("n"), round_stable(F.avg("RFM_score")).alias("rfm_medio")])
    return out.select("segmento_rfm", "n", *[
        round_stable(F.col(c)).alias(c) for c in ("recency_med", "freq_med", "preco_med")],
        "rfm_medio").orderBy(F.desc("rfm_medio"))


def rfm_segment_profile(segmented: DataFrame) -> DataFrame:
    return segmented.groupBy("segmento_rfm").agg(*[
        round_stable(F.avg(c)).alias(c) for c in ("R_score", "F_score", "M_score")])


def rfm_top_per_segment(segmented: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First n entities of each segment by the sort key of that segment."""
    s = F.col("segmento_rfm")
    strength = (
        F.when(s == PREMIUM, F.col("RFM_score")).when(s == VOLUME, F.col("frequency"))
        .when(s == ECONOMY, -F.col("monetary")).when(s == EMERGING, F.col("R_score"))
        .otherwise(-F.col("RFM_score")).cast("double"))
    return _first_per_segment(segmented.withColumn("_k", strength), key, n)


def rfm_best_per_segment(segmented: DataFrame, key: str, n: int = 6) -> DataFrame:
    """First n entities of each segment by composite score."""
    return _first_per_segment(segmented.withColumn("_k", F.col("RFM_score")), key, n)


def _first_per_segment(keyed: DataFrame, key: str, n: int) -> DataFrame:
    w = Window.partitionBy("segmento_rfm").orderBy(F.desc("_k"), key)
    return keyed.withColumn("posicao", F.row_number().over(w).cast("long")).filter(
        F.col("posicao") <= n).select("segmento_rfm", "posicao", key, "recency", "frequency",
                                      round_stable(F.col("monetary")).alias("monetary"), "RFM_score")


def rfm_premium_brands(segmented: DataFrame) -> DataFrame:
    return segmented.filter(F.col("segmento_rfm") == PREMIUM).groupBy(BRAND).agg(
        rows().alias("modelos")).orderBy(F.desc("modelos"), BRAND)


def rfm_score_table(segmented: DataFrame, key: str, n: int = 20) -> DataFrame:
    top = segmented.orderBy(F.desc("RFM_score"), key).limit(n)
    return top.select(
        F.col(key).alias("Modelo"), F.col("R_score").alias("R"), F.col("F_score").alias("F"),
        F.col("M_score").alias("M"), F.col("RFM_score").alias("Score"),
        F.col("recency").alias("Recency"), F.col("frequency").alias("Freq"),
        F.bround(F.col("monetary"), 0).cast("long").alias("Ticket"),
        F.col("segmento_rfm").alias("Segmento"))
