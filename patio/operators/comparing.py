"""Listings against reduced statistics: bands, entity means, sigma rules."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patio.columns import AVAILABLE, BAND_CUTS, ENTITY, FUEL, ID, PRICE, STATUS, YEAR
from patio.functions.labels import outlier_label, price_band, relative_label
from patio.functions.numeric import round_stable
from patio.session import scalar_struct

BAND = "faixa_preco"


def band_detail_top(df: DataFrame, cuts: Sequence[float] = BAND_CUTS, n: int = 50) -> DataFrame:
    """Dearest listings with their band; the band is a projection, so no self-join is needed."""
    return df.select(
        ID, ENTITY, YEAR, FUEL, STATUS, F.round(PRICE, 2).alias(PRICE),
        price_band(F.col(PRICE), cuts).alias(BAND)).orderBy(F.desc(PRICE), ID).limit(n)


def band_deviation(df: DataFrame, cuts: Sequence[float] = BAND_CUTS,
                   n: int | None = 60) -> DataFrame:
    """Each listing against the rounded mean of its band. ``n=None`` returns every listing."""
    banded = df.withColumn(BAND, price_band(F.col(PRICE), cuts))
    means = banded.groupBy(BAND).agg(round_stable(F.avg(PRICE)).alias("media_da_faixa"))
    # at most one row per label
    out = banded.join(F.broadcast(means), BAND).select(
        ID, ENTITY, FUEL, F.round(PRICE, 2).alias(PRICE), BAND, "media_da_faixa",
        round_stable(F.col(PRICE) - F.col("media_da_faixa")).alias("desvio_da_media"),
        relative_label(F.col(PRICE), F.col("media_da_faixa")).alias("posicao_relativa"))
    return out if n is None else out.orderBy(BAND, F.desc("desvio_da_media"), ID).limit(n)


def value_score(df: DataFrame, n: int = 20, base_year: int = 2010,
                status: str = AVAILABLE) -> DataFrame:
    """Available listings under their entity's rounded mean, by discount and recency score."""
    means = df.groupBy(ENTITY).agg(round_stable(F.avg(PRICE)).alias("preco_medio_modelo"))
    mean, price = F.col("preco_medio_modelo"), F.col(PRICE)
    discount = (mean - price) / mean * 100.0
    return (
        df.filter(F.col(STATUS) == status).join(means, ENTITY).filter(price < mean)
        .select(
            ID, ENTITY, YEAR, FUEL, F.round(price, 2).alias(PRICE), "preco_medio_modelo",
            round_stable(discount, 1).alias("desconto_vs_media_pct"),
            round_stable(discount + (F.col(YEAR) - base_year) * 0.5).alias("score_custo_beneficio"))
        .orderBy(F.desc("score_custo_beneficio"), ID).limit(n)
    )


def sigma_outliers(df: DataFrame, value: str = PRICE, keep: Sequence[str] = (ID, ENTITY, FUEL),
                   k: float = 2.0) -> DataFrame:
    """Rows further than k population standard deviations from the mean."""
    s = scalar_struct(df.agg(F.avg(value).alias("m"), F.stddev_pop(value).alias("d")))
    x, mean, std = F.col(value), s["m"], s["d"]
    return df.filter(F.abs(x - mean) > F.lit(k) * std).select(
        *keep, F.round(x, 2).alias(value), round_stable(mean).alias("media_geral"),
        round_stable(std).alias("desvio_padrao"), round_stable((x - mean) / std).alias("z_score"),
        outlier_label(x, mean, std, k).alias("tipo_outlier"),
    ).orderBy(F.desc("z_score"), *keep[:1])


def label_lookup(df: DataFrame, key: str, labels: DataFrame, label: str) -> DataFrame:
    """Attach a label from a small key -> label table; unmatched keys get null."""
    return df.join(labels.select(key, label), key, "left")
