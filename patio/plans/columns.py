"""Scalar functions and labels over whole tables."""

from pyspark.sql import functions as F

from patio.columns import DATE, FUEL, FUEL_CODES, ID, PRICE, STATUS, STATUS_CODES, YEAR
from patio.functions import dates, labels
from patio.functions.numeric import round_stable
from patio.plans.registry import CUTS, LISTINGS, band, query, rnd
from patio.sources.views import events, listings


def _plain(spark, sf):
    return listings(spark, sf, entity=False)


@query("price_band", f"WITH {LISTINGS} SELECT id, {band()} AS faixa_preco FROM listings")
def _(spark, sf):
    return _plain(spark, sf).select(ID, labels.price_band(F.col(PRICE), CUTS).alias("faixa_preco"))


@query("calendar_parts", f"""WITH {LISTINGS}
SELECT id, ano, ano_mes[6:7] AS mes, ano_mes, CAST(quarter(data_anuncio) AS INTEGER) AS trimestre
FROM listings""")
def _(spark, sf):
    parts = dates.calendar_parts(F.col(DATE))
    return _plain(spark, sf).select(ID, *[c.alias(n) for n, c in parts.items()])


@query("vehicle_age", f"""WITH {LISTINGS}
SELECT id, CAST(year(data_anuncio) - ano_fabricacao AS INTEGER) AS idade FROM listings""")
def _(spark, sf):
    return _plain(spark, sf).select(
        ID, dates.vehicle_age(F.col(DATE), F.col(YEAR)).alias("idade"))


@query("cyclic_month", f"""WITH {LISTINGS}
SELECT id, round(sin(2 * pi() * month(data_anuncio) / 12), 9) + 0.0::DOUBLE AS sin_mes,
  round(cos(2 * pi() * month(data_anuncio) / 12), 9) + 0.0::DOUBLE AS cos_mes FROM listings""")
def _(spark, sf):
    sin, cos = dates.cyclic_month(F.col(DATE))
    return _plain(spark, sf).select(
        ID, (F.round(sin, 9) + 0.0).alias("sin_mes"), (F.round(cos, 9) + 0.0).alias("cos_mes"))


@query("ordinal_encode", f"""WITH {LISTINGS}
SELECT id, CASE combustivel WHEN 'Gasolina' THEN 1 WHEN 'Flex' THEN 2 WHEN 'Diesel' THEN 3
    WHEN 'Híbrido' THEN 4 WHEN 'Elétrico' THEN 5 END AS combustivel_cod,
  CASE status WHEN 'Disponível' THEN 1 WHEN 'Reservado' THEN 2 WHEN 'Vendido' THEN 3 END AS status_cod
FROM listings""")
def _(spark, sf):
    return _plain(spark, sf).select(
        ID, labels.ordinal_encode(F.col(FUEL), FUEL_CODES).alias("combustivel_cod"),
        labels.ordinal_encode(F.col(STATUS), STATUS_CODES).alias("status_cod"))


@query("corr_strength", f"""WITH u AS (
  SELECT user_id, corr(value, CAST(event_id AS DOUBLE)) AS r FROM events
  GROUP BY user_id HAVING count(*) >= 3)
SELECT user_id, {rnd('r', 6)} AS r, CASE WHEN abs(r) >= 0.7 THEN 'FORTE' WHEN abs(r) >= 0.4 THEN 'MODERADA'
  WHEN abs(r) >= 0.2 THEN 'FRACA' ELSE 'DESPREZÍVEL' END AS forca FROM u""")
def _(spark, sf):
    by_user = events(spark, sf).groupBy("user_id").agg(
        F.corr("value", F.col("event_id").cast("double")).alias("r0"),
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= 3)
    return by_user.select("user_id", round_stable(F.col("r0"), 6).alias("r"),
                          labels.corr_strength(F.col("r0")).alias("forca"))


@query("shape_label", """WITH u AS (
  SELECT user_id, skewness(value) AS s, kurtosis(value) AS k FROM events GROUP BY user_id
  HAVING count(*) >= 8)
SELECT user_id, CASE WHEN s > 0.5 THEN 'assimetria positiva' WHEN s < -0.5 THEN 'assimetria negativa'
  ELSE 'simétrica' END AS forma_assimetria,
  CASE WHEN k > 1 THEN 'leptocúrtica' WHEN k < -1 THEN 'platicúrtica' ELSE 'mesocúrtica' END AS forma_curtose
FROM u""")
def _(spark, sf):
    n, g1, g2 = F.col("n"), F.col("g1"), F.col("g2")
    by_user = events(spark, sf).groupBy("user_id").agg(
        F.count("value").alias("n"), F.skewness("value").alias("g1"),
        F.kurtosis("value").alias("g2")).filter(n >= 8)
    skew = g1 * F.sqrt(n * (n - 1)) / (n - 2)
    kurt = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)
    a, b = labels.shape_label(skew, kurt)
    return by_user.select("user_id", a.alias("forma_assimetria"), b.alias("forma_curtose"))
