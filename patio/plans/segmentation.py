"""RFM scoring and segmentation by customer and by entity."""

from pyspark.sql import functions as F

from patio.columns import ENTITY
from patio.functions.numeric import round_stable
from patio.operators import dashboard, rfm, stats, summaries
from patio.plans.registry import count_if, query, rfm_cte, rnd
from patio.sources.views import listings

KEY = "o_custkey"
SEG = rfm_cte(KEY)


def customers(spark, sf):
    return rfm.segment_entities(listings(spark, sf, entity=False), KEY)


def entities(spark, sf):
    return rfm.segment_entities(listings(spark, sf), ENTITY, on_ties="collapse")


@query("rfm_metrics", f"""WITH {SEG}
SELECT o_custkey, recency, frequency, {rnd('monetary')} AS monetary, preco_max, preco_min,
  {rnd('ano_medio', 4)} AS ano_medio FROM rfm""")
def _(spark, sf):
    return rfm.rfm_metrics(listings(spark, sf, entity=False), KEY).select(
        KEY, "recency", "frequency", round_stable(F.col("monetary")).alias("monetary"),
        "preco_max", "preco_min", round_stable(F.col("ano_medio"), 4).alias("ano_medio"))


@query("rfm_scores", f"WITH {SEG} SELECT o_custkey, R_score, F_score, M_score FROM scored")
def _(spark, sf):
    return customers(spark, sf).select(KEY, "R_score", "F_score", "M_score")


@query("rfm_composite", f"WITH {SEG} SELECT o_custkey, RFM_score FROM seg")
def _(spark, sf):
    return customers(spark, sf).select(KEY, "RFM_score")


@query("rfm_segment", f"WITH {SEG} SELECT o_custkey, segmento_rfm FROM seg")
def _(spark, sf):
    return customers(spark, sf).select(KEY, "segmento_rfm")


@query("rfm_segment_share", f"""WITH {SEG}
SELECT segmento_rfm, count(*) AS n, {rnd('count(*) * 100.0 / sum(count(*)) OVER ()', 1)} AS pct
FROM seg GROUP BY 1""")
def _(spark, sf):
    return rfm.rfm_segment_share(customers(spark, sf))


@query("rfm_standardize", f"""WITH {SEG}
SELECT o_custkey, {rnd('R_norm', 6)} AS R_norm, {rnd('F_norm', 6)} AS F_norm, {rnd('M_norm', 6)} AS M_norm
FROM seg""")
def _(spark, sf):
    return customers(spark, sf).select(KEY, *[
        round_stable(F.col(c), 6).alias(c) for c in ("R_norm", "F_norm", "M_norm")])


@query("segment_stats", f"""WITH {SEG}
SELECT segmento_rfm, count(*) AS n, {rnd('median(recency)')} AS recency_med,
  {rnd('median(frequency)')} AS freq_med, {rnd('median(monetary)')} AS preco_med,
  {rnd('avg(RFM_score)')} AS rfm_medio FROM seg GROUP BY 1""")
def _(spark, sf):
    return rfm.segment_stats(customers(spark, sf))


@query("rfm_segment_profile", f"""WITH {SEG}
SELECT segmento_rfm, {', '.join(f"{rnd(f'avg({c})')} AS {c}" for c in ('R_score', 'F_score', 'M_score'))}
FROM seg GROUP BY 1""")
def _(spark, sf):
    return rfm.rfm_segment_profile(customers(spark, sf))


def _top_sql(strength, n):
    return f"""WITH {SEG}
SELECT segmento_rfm, row_number() OVER (PARTITION BY segmento_rfm ORDER BY {strength} DESC, o_custkey)
  AS posicao, o_custkey, recency, frequency, {rnd('monetary')} AS monetary, RFM_score
FROM seg QUALIFY posicao <= {n}"""


@query("rfm_top_per_segment", _top_sql("""CASE segmento_rfm WHEN 'Premium' THEN RFM_score
  WHEN 'Alto Volume' THEN frequency::DOUBLE WHEN 'Econômico' THEN -monetary
  WHEN 'Emergente' THEN R_score::DOUBLE ELSE -RFM_score END""", 5))
def _(spark, sf):
    return rfm.rfm_top_per_segment(customers(spark, sf), KEY)


@query("rfm_best_per_segment", _top_sql("RFM_score", 6))
def _(spark, sf):
    return rfm.rfm_best_per_segment(customers(spark, sf), KEY)


@query("rfm_premium_brands", f"""WITH {rfm_cte('marca_modelo')}
SELECT split_part(marca_modelo, ' ', 1) AS marca, count(*) AS modelos FROM seg
WHERE segmento_rfm = 'Premium' GROUP BY 1""")
def _(spark, sf):
    return rfm.rfm_premium_brands(entities(spark, sf))


@query("rfm_score_table", f"""WITH {SEG}
SELECT o_custkey AS "Modelo", R_score AS "R", F_score AS "F", M_score AS "M", RFM_score AS "Score",
  recency AS "Recency", frequency AS "Freq", CAST(round_even(monetary, 0) AS BIGINT) AS "Ticket",
  segmento_rfm AS "Segmento" FROM seg ORDER BY RFM_score DESC, o_custkey LIMIT 20""")
def _(spark, sf):
    return rfm.rfm_score_table(customers(spark, sf), KEY)


@query("rfm_cards", f"""WITH {SEG}
SELECT segmento_rfm, count(*) AS n, {rnd('avg(RFM_score)')} AS score FROM seg GROUP BY 1""")
def _(spark, sf):
    return dashboard.rfm_cards(customers(spark, sf))


_FULL = {"count": "count(RFM_score)::DOUBLE", "mean": "avg(RFM_score)",
         "std": "stddev_samp(RFM_score)", "min": "min(RFM_score)",
         "25%": "quantile_cont(RFM_score, 0.25)", "50%": "median(RFM_score)",
         "75%": "quantile_cont(RFM_score, 0.75)", "max": "max(RFM_score)"}


@query("describe_full", f"""WITH {SEG} {' UNION ALL '.join(
    f"SELECT '{k}' AS estatistica, {rnd(v, 3)} AS valor FROM seg" for k, v in _FULL.items())}""")
def _(spark, sf):
    return stats.describe_full(customers(spark, sf), "RFM_score")


@query("describe_rfm", f"WITH {SEG} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS variavel, {rnd(f'avg({c})', 4)} AS media, {rnd(f'median({c})', 4)} AS mediana,
  {rnd(f'stddev_samp({c})', 4)} AS desvio_padrao, {rnd(f'min({c})', 4)} AS minimo,
  {rnd(f'max({c})', 4)} AS maximo FROM seg""" for c in ("recency", "frequency", "monetary")))
def _(spark, sf):
    out = stats.describe_numeric(customers(spark, sf), ["recency", "frequency", "monetary"])
    return out.select("variavel", "media", "mediana", "desvio_padrao", *[
        round_stable(F.col(c), 4).alias(c) for c in ("minimo", "maximo")])


@query("rfm_recency_crosstab", f"""WITH {SEG}
SELECT segmento_rfm, {count_if('R_score >= 4')} AS "recente", {count_if('R_score < 4')} AS "antigo"
FROM seg GROUP BY 1""")
def _(spark, sf):
    flagged = customers(spark, sf).withColumn(
        "quando", F.when(F.col("R_score") >= 4, "recente").otherwise("antigo"))
    return summaries.crosstab(flagged, "segmento_rfm", "quando", ["recente", "antigo"])
