"""Dashboard metrics over a filtered table."""

from datetime import date

from pyspark.sql import functions as F

from patio.columns import BRAND, DATE, ENTITY, FUEL, ID, PRICE, STATUS
from patio.operators import dashboard
from patio.operators.summaries import with_brand
from patio.plans.registry import LISTINGS, count_if, half_up, query, rnd
from patio.sources.views import listings

FROM, TO = date(1996, 1, 1), date(2000, 12, 31)
CHOSEN_BRANDS = ["Automobile", "Building", "Machinery", "Furniture"]
CHOSEN_FUELS = ["Flex", "Diesel", "Elétrico", "Gasolina"]
CHOSEN_STATUS = ["Vendido", "Disponível", "Reservado"]


def _in(column, values):
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


FILTERED = f"""{LISTINGS},
f AS (SELECT * FROM listings WHERE data_anuncio BETWEEN DATE '{FROM}' AND DATE '{TO}'
      AND {_in('marca', CHOSEN_BRANDS)} AND {_in('combustivel', CHOSEN_FUELS)}
      AND {_in('status', CHOSEN_STATUS)})"""
SOLD = "sum(CASE WHEN status = 'Vendido' THEN preco_brl ELSE 0 END)"
N_SOLD = "count(*) FILTER (WHERE status = 'Vendido')"


def filtered(spark, sf):
    return dashboard.filter_listings(
        with_brand(listings(spark, sf)), FROM, TO, CHOSEN_BRANDS, CHOSEN_FUELS, CHOSEN_STATUS)


@query("filter_listings", f"""WITH {FILTERED}
SELECT id, marca_modelo, marca, data_anuncio, combustivel, status, preco_brl FROM f""")
def _(spark, sf):
    return filtered(spark, sf).select(ID, ENTITY, BRAND, DATE, FUEL, STATUS, PRICE)


@query("filter_domains", f"""WITH {LISTINGS}
SELECT min(data_anuncio) AS date_min, max(data_anuncio) AS date_max,
  array_to_string(list_sort(list(DISTINCT marca)), '|') AS marcas,
  array_to_string(list_sort(list(DISTINCT combustivel)), '|') AS combustiveis,
  array_to_string(list_sort(list(DISTINCT status)), '|') AS status FROM listings""")
def _(spark, sf):
    out = dashboard.filter_domains(with_brand(listings(spark, sf)))
    return out.select("date_min", "date_max", *[
        F.array_join(c, "|").alias(c) for c in ("marcas", "combustiveis", "status")])


def _kpi_sql(source):
    return f"""SELECT {rnd(f'coalesce({SOLD}, 0)')} AS faturamento,
  {rnd(f'coalesce({SOLD} / nullif({N_SOLD}, 0), 0)')} AS ticket_vendidos,
  {rnd(f'coalesce({N_SOLD} / nullif(count(*), 0) * 100.0, 0)', 4)} AS conversao_pct,
  {rnd(f'coalesce((count(*) - {N_SOLD}) / nullif(count(*), 0) * 100.0, 0)', 4)} AS churn_pct,
  count(*) AS total, {count_if("status = 'Vendido'")} AS vendidos,
  {count_if("status = 'Disponível'")} AS disponiveis, {count_if("status = 'Reservado'")} AS reservados
FROM {source}"""


@query("kpi_summary", f"WITH {FILTERED} {_kpi_sql('f')}")
def _(spark, sf):
    return dashboard.kpi_summary(filtered(spark, sf))


@query("kpi_summary_unfiltered", f"WITH {LISTINGS} {_kpi_sql('listings')}")
def _(spark, sf):
    return dashboard.kpi_summary(listings(spark, sf, entity=False))


@query("monthly_volume_ma", f"""WITH {FILTERED}
SELECT ano_mes, count(*) AS anuncios,
  {rnd('avg(count(*)) OVER (ORDER BY ano_mes ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 4)} AS mm3
FROM f GROUP BY ano_mes""")
def _(spark, sf):
    return dashboard.monthly_volume_ma(filtered(spark, sf))


@query("monthly_ticket_ma", f"""WITH {FILTERED},
m AS (SELECT ano_mes, {half_up('sum(preco_brl) / count(*)')} AS ticket_medio FROM f GROUP BY 1)
SELECT ano_mes, ticket_medio,
  {half_up('avg(ticket_medio) OVER (ORDER BY ano_mes ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)')} AS mm3,
  {half_up('avg(ticket_medio) OVER (ORDER BY ano_mes ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS mm7
FROM m""")
def _(spark, sf):
    return dashboard.monthly_ticket_ma(filtered(spark, sf))


@query("round_half_up_js", f"""WITH {LISTINGS}
SELECT id, CAST(floor(CAST(preco_brl / 1000 AS DECIMAL(38,6)) + 0.5) AS DOUBLE) AS inteiro,
  CAST(floor(CAST(preco_brl / 1000 * 10 AS DECIMAL(38,6)) + 0.5) / 10 AS DOUBLE) AS uma_casa
FROM listings""")
def _(spark, sf):
    from patio.functions.numeric import round_half_up
    x = F.col(PRICE) / 1000
    return listings(spark, sf, entity=False).select(
        ID, round_half_up(x).alias("inteiro"), round_half_up(x, 1).alias("uma_casa"))


@query("monthly_revenue", f"""WITH {FILTERED}
SELECT ano_mes, {half_up(SOLD)} AS faturamento FROM f GROUP BY ano_mes""")
def _(spark, sf):
    return dashboard.monthly_revenue(filtered(spark, sf))


@query("brand_revenue", f"""WITH {FILTERED}
SELECT marca, {half_up(SOLD)} AS faturamento FROM f GROUP BY marca""")
def _(spark, sf):
    return dashboard.brand_revenue(filtered(spark, sf))


@query("status_share", f"""WITH {FILTERED}
SELECT status, count(*) AS qtd, {rnd('count(*) * 100.0 / sum(count(*)) OVER ()', 1)} AS pct
FROM f GROUP BY status""")
def _(spark, sf):
    return dashboard.status_share(filtered(spark, sf))


@query("fuel_avg_price", f"""WITH {FILTERED}
SELECT combustivel, {half_up('sum(preco_brl) / count(*)')} AS preco_medio FROM f GROUP BY 1""")
def _(spark, sf):
    return dashboard.fuel_avg_price(filtered(spark, sf))


@query("brand_conversion", f"""WITH {FILTERED}, r AS (
SELECT marca, {rnd(f'{N_SOLD} / count(*) * 100.0', 1)} AS conversao_pct FROM f GROUP BY marca)
SELECT marca, conversao_pct, conversao_pct > 26 AS destaque FROM r""")
def _(spark, sf):
    return dashboard.brand_conversion(filtered(spark, sf))


@query("model_table", f"""WITH {FILTERED},
s AS (SELECT marca_modelo, status, row_number() OVER (
        PARTITION BY marca_modelo ORDER BY count(*) DESC, status) AS r FROM f GROUP BY 1, 2),
m AS (SELECT marca_modelo, count(*) AS qtd, sum(preco_brl) / count(*) AS p, {N_SOLD} AS v
      FROM f GROUP BY 1 ORDER BY qtd DESC, marca_modelo LIMIT 15)
SELECT marca_modelo, qtd, {half_up('qtd * 100.0 / max(qtd) OVER ()')} AS volume_pct,
  {half_up('p')} AS preco_medio, {rnd('v * 100.0 / qtd', 1)} AS conversao_pct,
  status AS status_frequente
FROM m JOIN s USING (marca_modelo) WHERE r = 1""")
def _(spark, sf):
    return dashboard.model_table(filtered(spark, sf))
