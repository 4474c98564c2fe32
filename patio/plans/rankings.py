"""Ranks, moving windows and running totals."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from patio.columns import BRAND, DATE, ENTITY, FUEL, ID, PRICE, SOLD, STATUS, YEAR
from patio.functions.numeric import pct_change, round_stable
from patio.operators import ranking
from patio.operators.summaries import with_brand
from patio.plans.registry import LISTINGS, query, rnd
from patio.sources.views import listings

RANKED = f"""WITH {LISTINGS}
SELECT id, marca, marca_modelo, ano_fabricacao, combustivel, preco_brl,
       rank() OVER (PARTITION BY marca ORDER BY preco_brl DESC) AS rank_preco"""


@query("rank_triplet", RANKED + """,
       dense_rank() OVER (PARTITION BY marca ORDER BY preco_brl DESC) AS dense_rank_preco,
       row_number() OVER (PARTITION BY marca ORDER BY preco_brl DESC, id) AS row_num
FROM listings QUALIFY rank_preco <= 3""")
def _(spark, sf):
    return ranking.rank_triplet(with_brand(listings(spark, sf))).select(
        ID, BRAND, ENTITY, YEAR, FUEL, PRICE, "rank_preco", "dense_rank_preco", "row_num")


@query("top3_by_brand", RANKED + " FROM listings QUALIFY rank_preco <= 3")
def _(spark, sf):
    return ranking.top_by_rank(with_brand(listings(spark, sf))).select(
        ID, BRAND, ENTITY, YEAR, FUEL, PRICE, "rank_preco")


@query("top5_by_fuel", f"""WITH {LISTINGS}
SELECT combustivel, row_number() OVER (PARTITION BY combustivel ORDER BY preco_brl DESC, id) AS posicao,
       id, marca_modelo, ano_fabricacao, status, preco_brl
FROM listings QUALIFY posicao <= 5""")
def _(spark, sf):
    return ranking.top_by_row(listings(spark, sf)).select(
        FUEL, "posicao", ID, ENTITY, YEAR, STATUS, PRICE)


_BASE = [ID, ENTITY, DATE, PRICE]
_MA = f"""WITH {LISTINGS}
SELECT id, marca_modelo, data_anuncio, preco_brl,
  {rnd('avg(preco_brl) OVER (ORDER BY data_anuncio, id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS media_movel_7,
  {rnd('avg(preco_brl) OVER (ORDER BY data_anuncio, id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)')} AS media_movel_30
FROM listings"""


@query("moving_average", _MA)
def _(spark, sf):
    return ranking.moving_average(listings(spark, sf).select(*_BASE))


@query("moving_average_report", _MA + " ORDER BY data_anuncio, id LIMIT 100")
def _(spark, sf):
    return ranking.moving_average(ranking.first_rows(listings(spark, sf).select(*_BASE), 100))


_NB = f"""WITH {LISTINGS}
SELECT id, marca_modelo, data_anuncio, preco_brl,
  round(lag(preco_brl) OVER w, 2) AS preco_anterior, round(lead(preco_brl) OVER w, 2) AS preco_proximo,
  {rnd('preco_brl - lag(preco_brl) OVER w')} AS delta_anterior,
  {rnd('(preco_brl - lag(preco_brl) OVER w) * 100.0 / nullif(lag(preco_brl) OVER w, 0)')} AS variacao_pct
FROM listings WINDOW w AS (ORDER BY data_anuncio, id)"""


@query("price_neighbors", _NB)
def _(spark, sf):
    return ranking.price_neighbors(listings(spark, sf).select(*_BASE))


@query("price_neighbors_report", _NB + " ORDER BY data_anuncio, id LIMIT 60")
def _(spark, sf):
    # the last report row still looks one row ahead
    first = ranking.first_rows(listings(spark, sf).select(*_BASE), 61)
    return ranking.first_rows(ranking.price_neighbors(first), 60)


@query("safe_pct_change", f"""WITH {LISTINGS},
d AS (SELECT data_anuncio, sum(CASE WHEN status = 'Vendido' AND combustivel = 'Flex'
        THEN preco_brl ELSE 0 END) AS v FROM listings GROUP BY 1)
SELECT data_anuncio, {rnd('v')} AS vendas, {rnd('(v - lag(v) OVER w) * 100.0 / nullif(lag(v) OVER w, 0)')} AS variacao_pct
FROM d WINDOW w AS (ORDER BY data_anuncio)""")
def _(spark, sf):
    """Daily sales against the previous day; days without sales have no change after them."""
    sold = (F.col(STATUS) == SOLD) & (F.col(FUEL) == "Flex")
    days = listings(spark, sf, entity=False).groupBy(DATE).agg(
        F.sum(F.when(sold, F.col(PRICE)).otherwise(0.0)).alias("v"))
    before = F.lag("v").over(Window.orderBy(DATE))
    return days.select(DATE, round_stable(F.col("v")).alias("vendas"),
                       round_stable(pct_change(F.col("v"), before)).alias("variacao_pct"))


_RT = f"""WITH {LISTINGS}
SELECT id, data_anuncio, marca_modelo, preco_brl,
  {rnd('sum(preco_brl) OVER (ORDER BY data_anuncio, id ROWS UNBOUNDED PRECEDING)')} AS receita_acumulada,
  count(*) OVER (ORDER BY data_anuncio, id ROWS UNBOUNDED PRECEDING) AS anuncios_acumulados
FROM listings"""


@query("running_totals", _RT)
def _(spark, sf):
    return ranking.running_totals(listings(spark, sf).select(*_BASE))


@query("running_totals_skewed", f"""WITH {LISTINGS}, skewed AS (
  SELECT id, preco_brl, CASE WHEN id % 3 = 0 THEN DATE '1998-01-01' ELSE data_anuncio END AS data_anuncio FROM listings)
SELECT id, data_anuncio, preco_brl,
  {rnd('sum(preco_brl) OVER (ORDER BY data_anuncio, id ROWS UNBOUNDED PRECEDING)')} AS receita_acumulada,
  count(*) OVER (ORDER BY data_anuncio, id ROWS UNBOUNDED PRECEDING) AS anuncios_acumulados
FROM skewed""")
def _(spark, sf):
    """The same over a copy in which a third of the rows share one date."""
    one_day = F.when(F.col(ID) % 3 == 0, F.lit("1998-01-01").cast("date")).otherwise(F.col(DATE))
    return ranking.running_totals(
        listings(spark, sf, entity=False).select(ID, one_day.alias(DATE), PRICE))


@query("running_totals_report", _RT + " ORDER BY data_anuncio, id LIMIT 80")
def _(spark, sf):
    return ranking.running_totals(ranking.first_rows(listings(spark, sf).select(*_BASE), 80))


_PB = f"""WITH {LISTINGS}
SELECT id, marca_modelo, combustivel, preco_brl,
  round(percent_rank() OVER (ORDER BY preco_brl), 4) AS percent_rank,
  ntile(4) OVER (ORDER BY preco_brl, id) AS quartil, ntile(10) OVER (ORDER BY preco_brl, id) AS decil,
  CASE ntile(4) OVER (ORDER BY preco_brl, id) WHEN 1 THEN 'Q1 — Mais baratos'
    WHEN 2 THEN 'Q2 — Abaixo da mediana' WHEN 3 THEN 'Q3 — Acima da mediana'
    WHEN 4 THEN 'Q4 — Mais caros' END AS quartil_label
FROM listings"""


@query("percentile_buckets", _PB)
def _(spark, sf):
    return ranking.percentile_buckets(listings(spark, sf).select(ID, ENTITY, FUEL, PRICE))


@query("quartile_label", f"SELECT quartil, quartil_label, count(*) AS n FROM ({_PB}) GROUP BY 1, 2")
def _(spark, sf):
    return ranking.percentile_buckets(listings(spark, sf, entity=False).select(ID, PRICE)).groupBy(
        "quartil", "quartil_label").agg(F.count(F.lit(1)).alias("n"))


@query("percentile_buckets_report", _PB + " ORDER BY preco_brl DESC, id LIMIT 80")
def _(spark, sf):
    return ranking.percentile_buckets(listings(spark, sf).select(ID, ENTITY, FUEL, PRICE)).orderBy(
        F.desc(PRICE), ID).limit(80)
