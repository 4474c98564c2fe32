"""Group-by summaries, frequency tables and period reports."""

from pyspark.sql import functions as F

from patio.columns import BRAND, DATE, ENTITY, FUEL, ID, PRICE, STATUS
from patio.operators import comparing, summaries
from patio.plans.registry import (CUTS, LISTINGS, TREND_FROM, band, count_if, query, rnd)
from patio.sources.views import listings


def _plain(spark, sf):
    return listings(spark, sf, entity=False)


@query("scan_listings", f"""WITH {LISTINGS}
SELECT id, marca_modelo, ano_fabricacao, preco_brl, data_anuncio, combustivel, status FROM listings""")
def _(spark, sf):
    return listings(spark, sf).drop("o_custkey")


@query("count_rows", f"WITH {LISTINGS} SELECT count(*) AS total FROM listings")
def _(spark, sf):
    return summaries.count_rows(_plain(spark, sf))


@query("entity_price_summary", f"""WITH {LISTINGS}
SELECT marca_modelo, count(*) AS total_anuncios, {rnd('avg(preco_brl)')} AS preco_medio,
       round(min(preco_brl), 2) AS preco_minimo, round(max(preco_brl), 2) AS preco_maximo,
       {rnd('max(preco_brl) - min(preco_brl)')} AS amplitude_preco
FROM listings GROUP BY marca_modelo""")
def _(spark, sf):
    return summaries.entity_price_summary(listings(spark, sf))


@query("year_share", f"""WITH {LISTINGS}
SELECT ano_fabricacao, count(*) AS total_anuncios,
       {rnd('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct_do_total,
       {rnd('avg(preco_brl)')} AS preco_medio
FROM listings GROUP BY ano_fabricacao""")
def _(spark, sf):
    return summaries.year_share(_plain(spark, sf))


@query("fuel_summary", f"""WITH {LISTINGS}
SELECT combustivel, count(*) AS qtd, {rnd('avg(preco_brl)')} AS preco_medio,
       round(min(preco_brl), 2) AS preco_min, round(max(preco_brl), 2) AS preco_max,
       {rnd('count(*) * 100.0 / sum(count(*)) OVER ()', 1)} AS pct_estoque
FROM listings GROUP BY combustivel""")
def _(spark, sf):
    return summaries.fuel_summary(_plain(spark, sf))


@query("band_distribution", f"""WITH {LISTINGS}
SELECT {band()} AS faixa_preco, count(*) AS total, {rnd('avg(preco_brl)')} AS preco_medio,
       {rnd('count(*) * 100.0 / sum(count(*)) OVER ()', 1)} AS pct
FROM listings GROUP BY 1""")
def _(spark, sf):
    return summaries.band_distribution(_plain(spark, sf), CUTS)


@query("band_conversion", f"""WITH {LISTINGS}
SELECT {band()} AS faixa_preco, count(*) AS total, {count_if("status = 'Vendido'")} AS vendidos,
       {count_if("status = 'Disponível'")} AS disponiveis,
       {count_if("status = 'Reservado'")} AS reservados,
       {rnd("count(*) FILTER (WHERE status = 'Vendido') / count(*) * 100.0", 1)} AS taxa_venda_pct
FROM listings GROUP BY 1""")
def _(spark, sf):
    return summaries.band_conversion(_plain(spark, sf), CUTS)


@query("monthly_trend", f"""WITH {LISTINGS}
SELECT ano_mes[1:4] AS ano, ano_mes[6:7] AS mes, ano_mes, count(*) AS total_anuncios,
       {rnd('avg(preco_brl)')} AS preco_medio, round(min(preco_brl), 2) AS preco_min,
       round(max(preco_brl), 2) AS preco_max,
       {rnd('avg(preco_brl) - lag(avg(preco_brl)) OVER (ORDER BY ano_mes)')} AS variacao_vs_mes_anterior
FROM listings GROUP BY ano_mes""")
def _(spark, sf):
    return summaries.monthly_trend(_plain(spark, sf))


@query("agg_over_agg", f"""WITH {LISTINGS}
SELECT ano, count(*) AS total_anuncios,
       {rnd('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct_do_total,
       {rnd('lag(avg(preco_brl)) OVER (ORDER BY ano)')} AS preco_medio_anterior
FROM listings GROUP BY ano""")
def _(spark, sf):
    from pyspark.sql import Window
    from patio.functions.numeric import round_stable
    by_year = _plain(spark, sf).groupBy(F.date_format(DATE, "yyyy").alias("ano")).agg(
        summaries.rows().alias("total_anuncios"), F.avg(PRICE).alias("m"))
    return by_year.select(
        "ano", "total_anuncios",
        summaries.share_of_total("total_anuncios", 2).alias("pct_do_total"),
        round_stable(F.lag("m").over(Window.orderBy("ano"))).alias("preco_medio_anterior"))


@query("fuel_pivot_year", f"""WITH {LISTINGS}
SELECT ano, {rnd("avg(preco_brl) FILTER (WHERE combustivel = 'Gasolina')")} AS media_gasolina,
       {rnd("avg(preco_brl) FILTER (WHERE combustivel = 'Flex')")} AS media_flex,
       {rnd("avg(preco_brl) FILTER (WHERE combustivel = 'Diesel')")} AS media_diesel,
       {rnd("avg(preco_brl) FILTER (WHERE combustivel = 'Elétrico')")} AS media_eletrico,
       {rnd("avg(preco_brl) FILTER (WHERE combustivel = 'Híbrido')")} AS media_hibrido,
       {rnd('avg(preco_brl)')} AS media_geral
FROM listings GROUP BY ano""")
def _(spark, sf):
    return summaries.fuel_pivot_year(_plain(spark, sf))


def _freq_sql(column: str) -> str:
    return f"""SELECT '{column}' AS coluna, {column} AS valor, count(*) AS qtd,
       {rnd('count(*) * 100.0 / sum(count(*)) OVER ()', 1)} AS pct FROM listings GROUP BY {column}"""


@query("freq_table", f"""WITH {LISTINGS} {_freq_sql('marca')}
UNION ALL {_freq_sql('combustivel')} UNION ALL {_freq_sql('status')}""")
def _(spark, sf):
    df = summaries.with_brand(listings(spark, sf))
    return summaries.freq_tables(df, [BRAND, FUEL, STATUS])


@query("freq_table_entities", f"""WITH {LISTINGS}
SELECT marca_modelo AS valor, count(*) AS qtd,
       {rnd('count(*) * 100.0 / sum(count(*)) OVER ()', 1)} AS pct
FROM listings GROUP BY marca_modelo ORDER BY qtd DESC, valor LIMIT 10""")
def _(spark, sf):
    return summaries.freq_table(listings(spark, sf), ENTITY, 10)


@query("top_entities", f"""WITH {LISTINGS}
SELECT marca_modelo, count(*) AS total FROM listings GROUP BY 1 ORDER BY total DESC, 1 LIMIT 10""")
def _(spark, sf):
    return summaries.top_entities(listings(spark, sf), 10)


@query("listing_volume", f"""WITH {LISTINGS}
SELECT 'mes' AS nivel, ano_mes AS periodo, count(*) AS anuncios FROM listings GROUP BY 2
UNION ALL SELECT 'ano', ano, count(*) FROM listings GROUP BY 2""")
def _(spark, sf):
    return summaries.listing_volume(_plain(spark, sf))


@query("peak_trough_month", f"""WITH {LISTINGS},
m AS (SELECT ano_mes, count(*) AS anuncios FROM listings GROUP BY 1)
(SELECT 'pico' AS tipo, ano_mes, anuncios FROM m ORDER BY anuncios DESC, ano_mes LIMIT 1)
UNION ALL (SELECT 'vale', ano_mes, anuncios FROM m ORDER BY anuncios, ano_mes LIMIT 1)""")
def _(spark, sf):
    return summaries.peak_trough_month(_plain(spark, sf))


@query("median_by_period", f"""WITH {LISTINGS}
SELECT ano_mes AS periodo, {rnd('median(preco_brl)')} AS preco_mediano FROM listings GROUP BY 1""")
def _(spark, sf):
    return summaries.median_by_period(_plain(spark, sf))


@query("median_by_year", f"""WITH {LISTINGS}
SELECT ano AS periodo, {rnd('median(preco_brl)')} AS preco_mediano FROM listings GROUP BY 1""")
def _(spark, sf):
    return summaries.median_by_period(_plain(spark, sf), "yyyy")


@query("trend_direction", f"""WITH {LISTINGS},
y AS (SELECT CAST(ano AS INTEGER) AS a, median(preco_brl) AS m FROM listings
      WHERE CAST(ano AS INTEGER) >= {TREND_FROM} GROUP BY 1),
e AS (SELECT arg_min(m, a) AS f, arg_max(m, a) AS l FROM y)
SELECT {rnd('f')} AS primeira_mediana, {rnd('l')} AS ultima_mediana,
       CASE WHEN l > f THEN 'crescente' ELSE 'decrescente' END AS tendencia FROM e""")
def _(spark, sf):
    return summaries.trend_direction(_plain(spark, sf), TREND_FROM)


BRANDS = ["Automobile", "Building", "Furniture", "Household", "Machinery"]


@query("brand_year_median", f"""WITH {LISTINGS}
SELECT CAST(ano AS INTEGER) AS ano, {', '.join(
    rnd(f"median(preco_brl) FILTER (WHERE marca = '{b}')") + f' AS "{b}"' for b in BRANDS)}
FROM listings GROUP BY 1""")
def _(spark, sf):
    df = summaries.with_brand(listings(spark, sf))
    top = [r[0] for r in summaries.topk_values(df, BRAND, 5).collect()]
    return summaries.brand_year_median(df, sorted(top))


@query("topk_membership", f"""WITH {LISTINGS}
SELECT id, marca, marca_modelo, preco_brl FROM listings WHERE marca IN (
  SELECT marca FROM listings GROUP BY marca ORDER BY count(*) DESC, marca LIMIT 3)""")
def _(spark, sf):
    df = summaries.with_brand(listings(spark, sf))
    return summaries.topk_membership(df, BRAND, 3).select(ID, BRAND, ENTITY, PRICE)


def _dispersion_sql(column: str) -> str:
    return f"""WITH {LISTINGS}
SELECT {column}, {rnd('avg(preco_brl)')} AS media, {rnd('median(preco_brl)')} AS mediana,
       {rnd('stddev_samp(preco_brl)')} AS dp, count(preco_brl) AS n,
       {rnd('stddev_samp(preco_brl) / avg(preco_brl) * 100.0', 1)} AS cv_pct
FROM listings WHERE {column} <> 'Desconhecido' GROUP BY {column}"""


@query("group_dispersion", _dispersion_sql("combustivel"))
def _(spark, sf):
    return summaries.group_dispersion(_plain(spark, sf), FUEL)


@query("group_dispersion_status", _dispersion_sql("status"))
def _(spark, sf):
    return summaries.group_dispersion(_plain(spark, sf), STATUS, exclude=["Desconhecido"])


@query("dataset_overview", f"""WITH {LISTINGS}
SELECT CAST(count(*) AS BIGINT) AS registros, CAST(max(data_anuncio) + 1 AS DATE) AS data_ref,
       count(DISTINCT marca) AS marcas, count(DISTINCT marca_modelo) AS modelos FROM listings""")
def _(spark, sf):
    return summaries.dataset_overview(listings(spark, sf))


@query("market_insights", f"""WITH {LISTINGS},
q AS (SELECT quantile_cont(preco_brl, 0.25) AS q1, quantile_cont(preco_brl, 0.75) AS q3,
             count(*) AS n FROM listings),
b AS (SELECT marca, count(*) AS c, row_number() OVER (ORDER BY count(*) DESC, marca) AS r
      FROM listings GROUP BY marca),
e AS (SELECT marca_modelo, count(*) AS c FROM listings GROUP BY 1 ORDER BY c DESC, 1 LIMIT 1)
SELECT {rnd('q1')} AS q1, {rnd('q3')} AS q3,
  {rnd('(SELECT count(*) FROM listings WHERE preco_brl BETWEEN q1 AND q3) * 100.0 / n', 1)} AS pct_faixa,
  (SELECT marca FROM b WHERE r = 1) AS marca1, (SELECT marca FROM b WHERE r = 2) AS marca2,
  {rnd('(SELECT c FROM b WHERE r = 1) * 100.0 / n', 1)} AS pct_marca1,
  {rnd('(SELECT sum(c) FROM b WHERE r <= 2) * 100.0 / n', 1)} AS pct_top2,
  (SELECT marca_modelo FROM e) AS modelo_top, {rnd('(SELECT c FROM e) * 100.0 / n', 1)} AS pct_modelo,
  {rnd("(SELECT count(*) FROM listings WHERE status = 'Disponível') * 100.0 / n", 1)} AS disponivel_pct,
  {rnd("(SELECT count(*) FROM listings WHERE status = 'Vendido') * 100.0 / n", 1)} AS vendido_pct
FROM q""")
def _(spark, sf):
    return summaries.market_insights(listings(spark, sf))


@query("crosstab", f"""WITH {LISTINGS}
SELECT combustivel, {count_if("status = 'Disponível'")} AS "Disponível",
       {count_if("status = 'Vendido'")} AS "Vendido", {count_if("status = 'Reservado'")} AS "Reservado"
FROM listings GROUP BY combustivel""")
def _(spark, sf):
    return summaries.crosstab(_plain(spark, sf), FUEL, STATUS, ["Disponível", "Vendido", "Reservado"])


@query("group_mode", f"""WITH {LISTINGS},
c AS (SELECT marca_modelo, status, count(*) AS n FROM listings GROUP BY 1, 2)
SELECT marca_modelo, status, n FROM c
QUALIFY row_number() OVER (PARTITION BY marca_modelo ORDER BY n DESC, status) = 1""")
def _(spark, sf):
    return summaries.group_mode(listings(spark, sf))


@query("latest_listings", f"""WITH {LISTINGS}
SELECT id, marca_modelo, preco_brl, data_anuncio, status FROM listings
ORDER BY data_anuncio DESC, id LIMIT 5""")
def _(spark, sf):
    return summaries.latest_listings(listings(spark, sf)).select(ID, ENTITY, PRICE, DATE, STATUS)


@query("band_detail_top", f"""WITH {LISTINGS}
SELECT id, marca_modelo, ano_fabricacao, combustivel, status, round(preco_brl, 2) AS preco_brl,
       {band()} AS faixa_preco FROM listings ORDER BY preco_brl DESC, id LIMIT 50""")
def _(spark, sf):
    return comparing.band_detail_top(listings(spark, sf), CUTS)


_DEVIATION = f"""WITH {LISTINGS},
f AS (SELECT *, {band()} AS faixa_preco FROM listings),
m AS (SELECT faixa_preco, {rnd('avg(preco_brl)')} AS media_da_faixa FROM f GROUP BY 1),
d AS (
  SELECT id, marca_modelo, combustivel, round(preco_brl, 2) AS preco_brl, faixa_preco,
         media_da_faixa, {rnd('preco_brl - media_da_faixa')} AS desvio_da_media,
         CASE WHEN preco_brl > media_da_faixa THEN 'Acima da média' ELSE 'Abaixo da média' END
         AS posicao_relativa
  FROM f JOIN m USING (faixa_preco))
SELECT * FROM d"""


@query("band_deviation", _DEVIATION + " ORDER BY faixa_preco, desvio_da_media DESC, id LIMIT 60")
def _(spark, sf):
    return comparing.band_deviation(listings(spark, sf), CUTS)


@query("relative_label", _DEVIATION)
def _(spark, sf):
    return comparing.band_deviation(listings(spark, sf), CUTS, n=None)


@query("value_score", f"""WITH {LISTINGS},
m AS (SELECT marca_modelo, {rnd('avg(preco_brl)')} AS preco_medio_modelo FROM listings GROUP BY 1)
SELECT id, marca_modelo, ano_fabricacao, combustivel, round(preco_brl, 2) AS preco_brl,
       preco_medio_modelo,
       {rnd('(preco_medio_modelo - preco_brl) / preco_medio_modelo * 100.0', 1)} AS desconto_vs_media_pct,
       {rnd('(preco_medio_modelo - preco_brl) / preco_medio_modelo * 100.0 + (ano_fabricacao - 2010) * 0.5::DOUBLE')}
       AS score_custo_beneficio
FROM listings JOIN m USING (marca_modelo)
WHERE status = 'Disponível' AND preco_brl < preco_medio_modelo
ORDER BY score_custo_beneficio DESC, id LIMIT 20""")
def _(spark, sf):
    return comparing.value_score(listings(spark, sf))


@query("multi_key_sort", f"""WITH {LISTINGS}
SELECT id, combustivel, ano_fabricacao, preco_brl FROM listings
ORDER BY combustivel, ano_fabricacao DESC, preco_brl DESC, id LIMIT 100""")
def _(spark, sf):
    return _plain(spark, sf).select(ID, FUEL, "ano_fabricacao", PRICE).orderBy(
        FUEL, F.desc("ano_fabricacao"), F.desc(PRICE), ID).limit(100)
