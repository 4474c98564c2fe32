"""Group-by summaries of listings."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patio.columns import (AVAILABLE, BAND_CUTS, BRAND, DATE, ENTITY, FUEL, FUELS, ID, PRICE,
                           RESERVED, SOLD, STATUS, YEAR)
from patio.functions.dates import year_month
from patio.functions.labels import price_band
from patio.functions.numeric import round_stable
from patio.functions.text import brand_of
from patio.operators.quantiles import quantile_scalars, quantiles_by
from patio.session import durable


def rows() -> Column:
    return F.count(F.lit(1))


def with_brand(df: DataFrame) -> DataFrame:
    return df.withColumn(BRAND, brand_of(F.col(ENTITY)))


def flag_sum(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def share_of_total(count: str, digits: int) -> Column:
    """Percent of the grand total over already grouped rows of a small domain (years, fuels, bands,
    statuses, segments): the source is scanned once."""
    total = F.sum(count).over(Window.partitionBy())
    return round_stable(F.col(count) * F.lit(100.0) / total, digits)


def share_of_stored(stored: DataFrame, count: str, digits: int) -> Column:
    """Percent of the grand total of stored counts, for domains of any size."""
    total = stored.agg(F.sum(count)).scalar()
    return round_stable(F.col(count) * F.lit(100.0) / total, digits)


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(rows().alias("total"))


def entity_price_summary(df: DataFrame) -> DataFrame:
    return df.groupBy(ENTITY).agg(
        rows().alias("total_anuncios"),
        round_stable(F.avg(PRICE)).alias("preco_medio"),
        F.round(F.min(PRICE), 2).alias("preco_minimo"),
        F.round(F.max(PRICE), 2).alias("preco_maximo"),
        round_stable(F.max(PRICE) - F.min(PRICE)).alias("amplitude_preco"),
    ).orderBy(F.desc("preco_medio"), ENTITY)


def year_share(df: DataFrame) -> DataFrame:
    by_year = df.groupBy(YEAR).agg(
        rows().alias("total_anuncios"), round_stable(F.avg(PRICE)).alias("preco_medio"))
    return by_year.select(
        YEAR, "total_anuncios", share_of_total("total_anuncios", 2).alias("pct_do_total"),
        "preco_medio").orderBy(YEAR)


def fuel_summary(df: DataFrame) -> DataFrame:
    by_fuel = df.groupBy(FUEL).agg(
        rows().alias("qtd"),
        round_stable(F.avg(PRICE)).alias("preco_medio"),
        F.round(F.min(PRICE), 2).alias("preco_min"),
        F.round(F.max(PRICE), 2).alias("preco_max"))
    return by_fuel.select(
        "*", share_of_total("qtd", 1).alias("pct_estoque")
    ).orderBy(F.desc("preco_medio"))


def band_distribution(df: DataFrame, cuts: Sequence[float] = BAND_CUTS) -> DataFrame:
    by_band = df.groupBy(price_band(F.col(PRICE), cuts).alias("faixa_preco")).agg(
        rows().alias("total"), round_stable(F.avg(PRICE)).alias("preco_medio"))
    return by_band.select(
        "*", share_of_total("total", 1).alias("pct")).orderBy("faixa_preco")


def band_conversion(df: DataFrame, cuts: Sequence[float] = BAND_CUTS) -> DataFrame:
    status = F.col(STATUS)
    return df.groupBy(price_band(F.col(PRICE), cuts).alias("faixa_preco")).agg(
        rows().alias("total"),
        flag_sum(status == SOLD).alias("vendidos"),
        flag_sum(status == AVAILABLE).alias("disponiveis"),
        flag_sum(status == RESERVED).alias("reservados"),
        round_stable(flag_sum(status == SOLD).cast("double") / rows() * 100.0, 1)
        .alias("taxa_venda_pct"),
    ).orderBy("faixa_preco")


def monthly_trend(df: DataFrame) -> DataFrame:
    """Per month present in the data; the change compares with the previous month row."""
    month = year_month(F.col(DATE))
    by_month = df.groupBy(month.alias("ano_mes")).agg(
        rows().alias("total_anuncios"), F.avg(PRICE).alias("_avg"),
        F.round(F.min(PRICE), 2).alias("preco_min"), F.round(F.max(PRICE), 2).alias("preco_max"))
    previous = F.lag("_avg").over(Window.orderBy("ano_mes"))
    return by_month.select(
        F.substring("ano_mes", 1, 4).alias("ano"), F.substring("ano_mes", 6, 2).alias("mes"),
        "ano_mes", "total_anuncios", round_stable(F.col("_avg")).alias("preco_medio"),
        "preco_min", "preco_max",
        round_stable(F.col("_avg") - previous).alias("variacao_vs_mes_anterior"),
    ).orderBy("ano_mes")


def fuel_pivot_year(df: DataFrame, fuels: Sequence[str] = FUELS) -> DataFrame:
    """Mean price per year, one column per fuel and one overall."""
    names = ["media_" + f.lower().translate(str.maketrans("éí", "ei")) for f in fuels]
    return df.groupBy(F.date_format(DATE, "yyyy").alias("ano")).agg(
        *[round_stable(F.avg(F.when(F.col(FUEL) == f, F.col(PRICE)))).alias(n)
          for f, n in zip(fuels, names)],
        round_stable(F.avg(PRICE)).alias("media_geral"),
    ).orderBy("ano")


def freq_table(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Count and percent per value, most frequent first, ties by value."""
    counts = durable(df.groupBy(F.col(column).alias("valor")).agg(rows().alias("qtd")))
    out = counts.select("*", share_of_stored(counts, "qtd", 1).alias("pct")).orderBy(
        F.desc("qtd"), "valor")
    return out if n is None else out.limit(n)


def freq_tables(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frequency tables of several columns from one scan: the counts of their combinations are
    stored, and every table and the total come from those."""
    combos = durable(df.groupBy(*columns).agg(rows().alias("n")))
    values = combos.select("n", F.inline(F.array(*[
        F.struct(F.lit(c).alias("coluna"), F.col(c).alias("valor")) for c in columns])))
    counts = values.groupBy("coluna", "valor").agg(F.sum("n").alias("qtd"))
    total = combos.agg(F.sum("n")).scalar()
    return counts.select(
        "*", round_stable(F.col("qtd") * F.lit(100.0) / total, 1).alias("pct"))


def top_entities(df: DataFrame, n: int = 10, column: str = ENTITY) -> DataFrame:
    return df.groupBy(column).agg(rows().alias("total")).orderBy(F.desc("total"), column).limit(n)


def listing_volume(df: DataFrame) -> DataFrame:
    """Listings per month and per year, in one pass over monthly counts."""
    months = df.groupBy(year_month(F.col(DATE)).alias("periodo")).agg(rows().alias("anuncios"))
    years = months.groupBy(F.substring("periodo", 1, 4).alias("periodo")).agg(
        F.sum("anuncios").alias("anuncios"))
    return (
        months.select(F.lit("mes").alias("nivel"), "*")
        .unionByName(years.select(F.lit("ano").alias("nivel"), "*"))
        .orderBy("nivel", "periodo")
    )


def peak_trough_month(df: DataFrame) -> DataFrame:
    months = df.groupBy(F.trunc(DATE, "month").alias("m")).agg(rows().alias("n"))
    early = -F.unix_date("m")
    ends = months.agg(
        F.max_by("m", F.struct(F.col("n"), early)).alias("hi_m"), F.max("n").alias("hi_n"),
        F.min_by("m", F.struct(F.col("n"), -early)).alias("lo_m"), F.min("n").alias("lo_n"))
    return ends.select(F.inline(F.array(
        F.struct(F.lit("pico").alias("tipo"), year_month(F.col("hi_m")).alias("ano_mes"),
                 F.col("hi_n").alias("anuncios")),
        F.struct(F.lit("vale").alias("tipo"), year_month(F.col("lo_m")).alias("ano_mes"),
                 F.col("lo_n").alias("anuncios")))))


def median_by_period(df: DataFrame, pattern: str = "yyyy-MM") -> DataFrame:
    dated = df.select(F.date_format(DATE, pattern).alias("periodo"), PRICE)
    return quantiles_by(dated, ["periodo"], PRICE, [0.5], ["preco_mediano"]).select(
        "periodo", round_stable(F.col("preco_mediano")).alias("preco_mediano")).orderBy("periodo")


def trend_direction(df: DataFrame, from_year: int = 2022) -> DataFrame:
    """Last yearly median against the first one, from a start year on."""
    dated = df.select(F.year(DATE).alias("ano"), PRICE).filter(F.col("ano") >= from_year)
    years = quantiles_by(dated, ["ano"], PRICE, [0.5], ["m"])
    return years.agg(
        F.min_by("m", "ano").alias("f"), F.max_by("m", "ano").alias("l")
    ).select(
        round_stable(F.col("f")).alias("primeira_mediana"),
        round_stable(F.col("l")).alias("ultima_mediana"),
        F.when(F.col("l") > F.col("f"), "crescente").otherwise("decrescente").alias("tendencia"))


def topk_values(df: DataFrame, column: str, k: int) -> DataFrame:
    return top_entities(df, k, column).select(column)


def topk_membership(df: DataFrame, column: str = BRAND, k: int = 5) -> DataFrame:
    """Rows whose value is among the k most frequent ones."""
    # the right side has k rows
    return df.join(F.broadcast(topk_values(df, column, k)), column, "left_semi")


def brand_year_median(df: DataFrame, brands: Sequence[str]) -> DataFrame:
    """Year by brand matrix of median prices."""
    kept = df.filter(F.col(BRAND).isin(list(brands))).select(
        F.year(DATE).alias("ano"), BRAND, PRICE)
    medians = quantiles_by(kept, ["ano", BRAND], PRICE, [0.5], ["m"])
    return medians.groupBy("ano").agg(*[
        round_stable(F.max(F.when(F.col(BRAND) == b, F.col("m")))).alias(b) for b in brands
    ]).orderBy("ano")


def group_dispersion(df: DataFrame, column: str, value: str = PRICE,
                     exclude: Sequence[str] = ()) -> DataFrame:
    kept = df.filter(~F.col(column).isin(list(exclude))) if exclude else df
    stats = quantiles_by(
        kept, [column], value, [0.5], ["_med"],
        aggs=[F.avg(value).alias("_avg"), F.stddev_samp(value).alias("_sd"),
              F.count(value).alias("n")])
    return stats.select(
        column, round_stable(F.col("_avg")).alias("media"),
        round_stable(F.col("_med")).alias("mediana"), round_stable(F.col("_sd")).alias("dp"), "n",
        round_stable(F.col("_sd") / F.col("_avg") * 100.0, 1).alias("cv_pct"),
    ).orderBy(F.desc("media"), column)


def dataset_overview(df: DataFrame) -> DataFrame:
    """Rows, reference date, distinct brands and entities, from per-entity counts."""
    per_entity = df.groupBy(ENTITY).agg(rows().alias("n"), F.max(DATE).alias("d"))
    return per_entity.agg(
        F.sum("n").alias("registros"), F.date_add(F.max("d"), 1).alias("data_ref"),
        F.countDistinct(brand_of(F.col(ENTITY))).alias("marcas"), rows().alias("modelos"))


def market_insights(df: DataFrame) -> DataFrame:
    """Interquartile range and its share, leading brands and entity, status shares."""
    q1, q3 = quantile_scalars(df, PRICE, [0.25, 0.75])
    price, status = F.col(PRICE), F.col(STATUS)
    base = df.agg(
        rows().alias("n"),
        flag_sum((price >= q1) & (price <= q3)).alias("dentro"),
        flag_sum(status == AVAILABLE).alias("disp"), flag_sum(status == SOLD).alias("vend"))
    per_entity = df.groupBy(ENTITY).agg(rows().alias("n"))
    first = per_entity.agg(F.min_by(ENTITY, F.struct(-F.col("n"), F.col(ENTITY))).alias("modelo"),
                           F.max("n").alias("n"))
    entity = first.select(F.struct("modelo", "n")).scalar()
    brands = per_entity.groupBy(brand_of(F.col(ENTITY)).alias(BRAND)).agg(F.sum("n").alias("n"))
    top2 = brands.orderBy(F.desc("n"), BRAND).limit(2).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col(BRAND).alias("b"))))
        .alias("t")).scalar()

    def pct(x: Column) -> Column:
        return round_stable(x * F.lit(100.0) / F.col("n"), 1)

    return base.select(
        round_stable(q1).alias("q1"), round_stable(q3).alias("q3"),
        pct(F.col("dentro")).alias("pct_faixa"),
        top2[0]["b"].alias("marca1"), top2[1]["b"].alias("marca2"),
        pct(-top2[0]["k"]).alias("pct_marca1"),
        pct(-(top2[0]["k"] + top2[1]["k"])).alias("pct_top2"),
        entity["modelo"].alias("modelo_top"), pct(entity["n"]).alias("pct_modelo"),
        pct(F.col("disp")).alias("disponivel_pct"), pct(F.col("vend")).alias("vendido_pct"))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Contingency table, absent pairs as 0."""
    return df.groupBy(row).agg(*[
        flag_sum(F.col(column) == v).alias(str(v)) for v in values]).orderBy(row)


def group_mode(df: DataFrame, key: str = ENTITY, value: str = STATUS) -> DataFrame:
    """Most frequent value per key; the smallest one when several tie."""
    counts = df.groupBy(key, value).agg(rows().alias("n"))
    return counts.groupBy(key).agg(
        F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(value),
        F.max("n").alias("n"))


def latest_listings(df: DataFrame, n: int = 5) -> DataFrame:
    return df.orderBy(F.desc(DATE), ID).limit(n)
