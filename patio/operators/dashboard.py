"""Metrics of the listings dashboard; all take the output of ``filter_listings``."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patio.columns import AVAILABLE, BRAND, DATE, ENTITY, FUEL, PRICE, RESERVED, SOLD, STATUS
from patio.functions.dates import year_month
from patio.functions.numeric import round_half_up, round_stable, safe_ratio
from patio.operators.summaries import flag_sum, rows, share_of_total

HIGH_CONVERSION = 26  # fixed value: percent above which a brand is highlighted


def filter_listings(df: DataFrame, date_min: date | None = None, date_max: date | None = None,
                    brands: Sequence[str] | None = None, fuels: Sequence[str] | None = None,
                    statuses: Sequence[str] | None = None) -> DataFrame:
    """Conjunction of an inclusive date range and value sets; None is no restriction, an empty
    set selects nothing."""
    if date_min is not None:
        df = df.filter(F.col(DATE) >= F.lit(date_min))
    if date_max is not None:
        df = df.filter(F.col(DATE) <= F.lit(date_max))
    for column, chosen in ((BRAND, brands), (FUEL, fuels), (STATUS, statuses)):
        if chosen is not None:
            df = df.filter(F.col(column).isin(list(chosen)) if chosen else F.lit(False))
    return df


def filter_domains(df: DataFrame) -> DataFrame:
    """Available filter values, from the distinct (brand, fuel, status) combinations."""
    combos = df.groupBy(BRAND, FUEL, STATUS).agg(F.min(DATE).alias("lo"), F.max(DATE).alias("hi"))

    def values(c: str) -> Column:
        return F.sort_array(F.collect_set(c))

    return combos.agg(
        F.min("lo").alias("date_min"), F.max("hi").alias("date_max"),
        values(BRAND).alias("marcas"), values(FUEL).alias("combustiveis"),
        values(STATUS).alias("status"))


def _sold_price() -> Column:
    return F.when(F.col(STATUS) == SOLD, F.coalesce(F.col(PRICE), F.lit(0.0))).otherwise(0.0)


def _mean_price() -> Column:
    """Mean with null as zero, over all rows of the group."""
    return F.sum(F.coalesce(F.col(PRICE), F.lit(0.0))) / rows()


def kpi_summary(df: DataFrame) -> DataFrame:
    status = F.col(STATUS)
    base = df.agg(
        rows().alias("total"), F.coalesce(flag_sum(status == SOLD), F.lit(0)).alias("vendidos"),
        F.coalesce(flag_sum(status == AVAILABLE), F.lit(0)).alias("disponiveis"),
        F.coalesce(flag_sum(status == RESERVED), F.lit(0)).alias("reservados"),
        F.coalesce(F.sum(_sold_price()), F.lit(0.0)).alias("_rev"))
    sold, total = F.col("vendidos"), F.col("total")
    return base.select(
        round_stable(F.col("_rev")).alias("faturamento"),
        round_stable(safe_ratio(F.col("_rev"), sold)).alias("ticket_vendidos"),
        round_stable(safe_ratio(sold, total) * 100.0, 4).alias("conversao_pct"),
        round_stable(safe_ratio(total - sold, total) * 100.0, 4).alias("churn_pct"),
        "total", "vendidos", "disponiveis", "reservados")


def monthly_volume_ma(df: DataFrame) -> DataFrame:
    months = df.groupBy(year_month(F.col(DATE)).alias("ano_mes")).agg(rows().alias("anuncios"))
    w = Window.orderBy("ano_mes").rowsBetween(-2, 0)
    return months.select(
        "*", round_stable(F.avg("anuncios").over(w), 4).alias("mm3")).orderBy("ano_mes")


def monthly_ticket_ma(df: DataFrame) -> DataFrame:
    """Monthly mean over all rows, rounded; trailing means of the rounded values, rounded again."""
    months = df.groupBy(year_month(F.col(DATE)).alias("ano_mes")).agg(
        round_half_up(_mean_price()).alias("ticket_medio"))
    w = Window.orderBy("ano_mes")

    def trailing(k: int) -> Column:
        return round_half_up(F.avg("ticket_medio").over(w.rowsBetween(1 - k, 0)))

    return months.select(
        "*", trailing(3).alias("mm3"), trailing(7).alias("mm7")).orderBy("ano_mes")


def monthly_revenue(df: DataFrame) -> DataFrame:
    return df.groupBy(year_month(F.col(DATE)).alias("ano_mes")).agg(
        round_half_up(F.sum(_sold_price())).alias("faturamento")).orderBy("ano_mes")


def brand_revenue(df: DataFrame) -> DataFrame:
    return df.groupBy(BRAND).agg(
        round_half_up(F.sum(_sold_price())).alias("faturamento")
    ).orderBy(F.desc("faturamento"), BRAND)


def status_share(df: DataFrame) -> DataFrame:
    counts = df.groupBy(STATUS).agg(rows().alias("qtd"))
    return counts.select("*", share_of_total("qtd", 1).alias("pct"))


def fuel_avg_price(df: DataFrame) -> DataFrame:
    means = df.groupBy(FUEL).agg(_mean_price().alias("_m"))
    return means.orderBy(F.desc("_m")).select(FUEL, round_half_up(F.col("_m")).alias("preco_medio"))


def brand_conversion(df: DataFrame) -> DataFrame:
    rates = df.groupBy(BRAND).agg(round_stable(
        flag_sum(F.col(STATUS) == SOLD) / rows() * 100.0, 1).alias("conversao_pct"))
    return rates.select("*", (F.col("conversao_pct") > HIGH_CONVERSION).alias("destaque")).orderBy(
        BRAND)


def model_table(df: DataFrame, n: int = 15) -> DataFrame:
    """Most listed entities: volume against the largest, mean price, conversion, usual status.

    One aggregate per (entity, status) feeds everything else.
    """
    cells = df.groupBy(ENTITY, STATUS).agg(
        rows().alias("c"), F.sum(F.coalesce(F.col(PRICE), F.lit(0.0))).alias("s"))
    models = cells.groupBy(ENTITY).agg(
        F.sum("c").alias("qtd"), (F.sum("s") / F.sum("c")).alias("_m"),
        F.sum(F.when(F.col(STATUS) == SOLD, F.col("c")).otherwise(0)).alias("_v"),
        F.min_by(STATUS, F.struct(-F.col("c"), F.col(STATUS))).alias("status_frequente"))
    top = models.orderBy(F.desc("qtd"), ENTITY).limit(n)
    largest = F.max("qtd").over(Window.partitionBy())
    return top.select(
        ENTITY, "qtd", round_half_up(F.col("qtd") * 100.0 / largest).alias("volume_pct"),
        round_half_up(F.col("_m")).alias("preco_medio"),
        round_stable(F.col("_v") * 100.0 / F.col("qtd"), 1).alias("conversao_pct"),
        "status_frequente").orderBy(F.desc("qtd"), ENTITY)


def rfm_cards(segmented: DataFrame) -> DataFrame:
    return segmented.groupBy("segmento_rfm").agg(
        rows().alias("n"), round_stable(F.avg("RFM_score")).alias("score"))
