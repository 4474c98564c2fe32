"""Registered queries: a Spark callable per key and, where SQL can say it, its DuckDB twin."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from patio.columns import FUELS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CUTS = [125_000, 250_000, 375_000]
TREND_FROM = 1996
MAX_YEAR = 2026


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def rnd(expression: str, digits: int = 2) -> str:
    """SQL twin of round_stable."""
    return f"CAST(round(CAST(({expression}) AS DECIMAL(38,{digits + 6})), {digits}) AS DOUBLE)"


def half_up(expression: str) -> str:
    """SQL twin of round_half_up to whole numbers."""
    return f"CAST(floor(CAST(({expression}) AS DECIMAL(38,6)) + 0.5) AS DOUBLE)"


def band(column: str = "preco_brl") -> str:
    return (f"CASE WHEN {column} < {CUTS[0]} THEN '1_Econômico' WHEN {column} < {CUTS[1]} THEN "
            f"'2_Intermediário' WHEN {column} < {CUTS[2]} THEN '3_Premium' ELSE '4_Luxo' END")


def count_if(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


_FUEL_CASE = " ".join(
    f"WHEN '{p}' THEN '{f}'" for p, f in zip(
        ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], FUELS))

LISTINGS = f"""
listings AS (
  SELECT o_orderkey AS id,
         CASE WHEN n_name IS NULL THEN 'Desconhecido' ELSE concat(
           upper(c_mktsegment[1]), lower(c_mktsegment[2:]), ' ', replace(n_name, 'NATION_', 'N')) END AS marca_modelo,
         CAST(year(o_orderdate) - o_custkey % 15 AS INTEGER) AS ano_fabricacao,
         o_totalprice AS preco_brl, CAST(o_orderdate AS DATE) AS data_anuncio,
         CASE o_orderpriority {_FUEL_CASE} END AS combustivel,
         CASE o_orderstatus WHEN 'F' THEN 'Vendido' WHEN 'O' THEN 'Disponível'
              WHEN 'P' THEN 'Reservado' END AS status,
         CASE WHEN n_name IS NULL THEN 'Desconhecido' ELSE concat(
           upper(c_mktsegment[1]), lower(c_mktsegment[2:])) END AS marca,
         strftime(o_orderdate, '%Y-%m') AS ano_mes, strftime(o_orderdate, '%Y') AS ano,
         o_custkey
  FROM orders LEFT JOIN (customer JOIN nation ON c_nationkey = n_nationkey) ON o_custkey = c_custkey)
"""

RAW = LISTINGS + """,
noisy AS (
  SELECT id, marca_modelo,
    CASE WHEN id % 103 >= 3 THEN CAST(ano_fabricacao AS VARCHAR) END AS ano_fabricacao,
    CASE WHEN id % 100 < 4 THEN NULL
         WHEN id % 100 < 6 THEN '-' || CAST(CAST(preco_brl AS DECIMAL(18,2)) AS VARCHAR)
         WHEN id % 100 < 8 THEN 'R$ ' || translate(format('{:,.2f}', preco_brl), ',.', '.,')
         WHEN id % 100 < 10 THEN '$' || CAST(CAST(preco_brl AS DECIMAL(18,2)) AS VARCHAR)
         ELSE CAST(CAST(preco_brl AS DECIMAL(18,2)) AS VARCHAR) END AS preco_brl,
    CASE WHEN id % 101 < 4 THEN NULL
         WHEN id % 101 < 7 THEN strftime(data_anuncio, '%d/%m/%Y')
         WHEN id % 101 < 10 THEN strftime(data_anuncio, '%Y/%m/%d')
         WHEN id % 101 < 12 THEN strftime(data_anuncio, '%m-%d-%Y')
         ELSE strftime(data_anuncio, '%Y-%m-%d') END AS data_anuncio,
    CASE id % 7 WHEN 0 THEN NULL WHEN 1 THEN lower(combustivel) WHEN 2 THEN upper(combustivel)
         WHEN 3 THEN replace(combustivel, 'Elétrico', 'Eletrico')
         WHEN 4 THEN '  ' || combustivel || ' ' ELSE combustivel END AS combustivel,
    CASE id % 11 WHEN 0 THEN NULL WHEN 1 THEN lower(status) WHEN 2 THEN upper(status)
         WHEN 3 THEN replace(status, 'Disponível', 'disponivel') ELSE status END AS status
  FROM listings),
raw AS (
  SELECT CAST(id AS VARCHAR) AS id, * EXCLUDE (id) FROM noisy
  UNION ALL SELECT CAST(id AS VARCHAR) AS id, * EXCLUDE (id) FROM noisy WHERE id % 97 < 3)
"""


def title(x: str, default: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(trim(coalesce({x}, '{default}')), "
            r"'(\p{L}+|[^\p{L}]+)'), lambda v: concat(upper(v[1]), lower(v[2:]))), '')")


PRICE_SQL = r"""
  TRY_CAST(CASE WHEN regexp_matches(regexp_replace({x}, '[R$\s]', '', 'g'), '\d{{1,3}}(\.\d{{3}})+,\d{{2}}')
       THEN replace(replace(regexp_replace({x}, '[R$\s]', '', 'g'), '.', ''), ',', '.')
       WHEN regexp_matches(regexp_replace({x}, '[R$\s]', '', 'g'), '\d{{1,3}}(,\d{{3}})+\.\d{{2}}')
       THEN replace(regexp_replace({x}, '[R$\s]', '', 'g'), ',', '')
       ELSE replace(regexp_replace({x}, '[R$\s]', '', 'g'), ',', '.') END AS DOUBLE)
"""
DATE_SQL = """
  coalesce(CAST(try_strptime(trim({x}), '%Y-%m-%d') AS DATE), CAST(try_strptime(trim({x}), '%d/%m/%Y') AS DATE),
           CAST(try_strptime(trim({x}), '%Y/%m/%d') AS DATE), CAST(try_strptime(trim({x}), '%m-%d-%Y') AS DATE))
"""

PARSED = RAW + f""",
parsed AS (
  SELECT CAST(id AS BIGINT) AS id, {title('marca_modelo', 'Desconhecido')} AS marca_modelo,
    TRY_CAST(ano_fabricacao AS DOUBLE) AS ano_fabricacao, {PRICE_SQL.format(x='preco_brl')} AS preco_brl,
    {DATE_SQL.format(x='data_anuncio')} AS data_anuncio,
    CASE {title('combustivel', 'Não Informado')} WHEN 'Eletrico' THEN 'Elétrico'
         WHEN 'Electrico' THEN 'Elétrico' ELSE {title('combustivel', 'Não Informado')} END AS combustivel,
    CASE {title('status', 'Desconhecido')} WHEN 'Disponivel' THEN 'Disponível'
         ELSE {title('status', 'Desconhecido')} END AS status
  FROM (SELECT DISTINCT * FROM raw))
"""

CLEAN = PARSED + f""",
aged AS (
  SELECT * REPLACE (CAST(trunc(coalesce(ano_fabricacao,
      (SELECT median(ano_fabricacao) FROM parsed))) AS INTEGER) AS ano_fabricacao) FROM parsed),
in_range AS (SELECT * FROM aged WHERE ano_fabricacao BETWEEN 1980 AND {MAX_YEAR}),
positive AS (SELECT * FROM in_range WHERE preco_brl IS NULL OR preco_brl > 0),
priced AS (
  SELECT * REPLACE (round_even(coalesce(preco_brl, (SELECT median(preco_brl) FROM positive)), 2)
      AS preco_brl) FROM positive),
clean AS (
  SELECT * REPLACE (coalesce(data_anuncio, (
      SELECT data_anuncio FROM priced WHERE data_anuncio IS NOT NULL GROUP BY data_anuncio
      ORDER BY count(*) DESC, data_anuncio LIMIT 1)) AS data_anuncio) FROM priced)
"""


def rfm_cte(key: str) -> str:
    """Segmented table for an entity key, as CTEs ending in ``seg``."""
    def score(metric: str, inverse: bool) -> str:
        above = " + ".join(
            f"CASE WHEN {metric} > (SELECT quantile_cont({metric}, {q}) FROM rfm) THEN 1 ELSE 0 END"
            for q in (0.2, 0.4, 0.6, 0.8))
        return f"CAST(5 - ({above}) AS BIGINT)" if inverse else f"CAST(1 + {above} AS BIGINT)"

    def z(metric: str) -> str:
        return (f"({metric} - (SELECT avg({metric}) FROM rfm)) / "
                f"(SELECT stddev_pop({metric}) FROM rfm)")

    return f"""{LISTINGS},
rfm AS (
  SELECT {key}, date_diff('day', max(data_anuncio), (SELECT max(data_anuncio) FROM listings) + 1)
         AS recency, count(id) AS frequency, avg(preco_brl) AS monetary,
         max(preco_brl) AS preco_max, min(preco_brl) AS preco_min,
         avg(ano_fabricacao) AS ano_medio
  FROM listings GROUP BY {key}),
scored AS (
  SELECT *, {score('recency', True)} AS R_score, {score('frequency', False)} AS F_score,
         {score('monetary', False)} AS M_score FROM rfm),
composed AS (
  SELECT *, {rnd('0.25 * R_score + 0.30 * F_score + 0.45 * M_score', 3)} AS RFM_score FROM scored),
seg AS (
  SELECT *, CASE WHEN M_score >= 4 AND RFM_score >= 3.2::DOUBLE THEN 'Premium'
      WHEN F_score >= 4 AND M_score <= 3 THEN 'Alto Volume'
      WHEN M_score <= 2 AND RFM_score <= 2.5::DOUBLE THEN 'Econômico'
      WHEN R_score >= 4 AND F_score <= 2 AND M_score >= 3 THEN 'Emergente'
      ELSE 'Baixa Relevância' END AS segmento_rfm,
      -({z('recency')}) AS R_norm, {z('frequency')} AS F_norm, {z('monetary')} AS M_norm
  FROM composed)
"""
