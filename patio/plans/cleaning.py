"""Noise, cleaning pipeline, formatting and text repair."""

from pyspark.sql import functions as F

from patio.columns import (DATE, ENTITY, FUEL, FUEL_SYNONYMS, ID, PRICE, RAW_COLUMNS, STATUS,
                           STATUS_SYNONYMS, UNKNOWN_FUEL, UNKNOWN_STATUS, YEAR)
from patio.functions import dates, money, text
from patio.operators import cleaning
from patio.plans.registry import (CLEAN, DATE_SQL, LISTINGS, MAX_YEAR, PARSED, PRICE_SQL, RAW,
                                  query, title)
from patio.session import durable
from patio.sources.noise import append_sample, inject_noise
from patio.sources.views import listings, table


def raw_listings(spark, sf):
    return inject_noise(listings(spark, sf).drop("o_custkey"))


@query("inject_noise", f"""WITH {RAW}
SELECT id, marca_modelo, ano_fabricacao, preco_brl, data_anuncio, combustivel, status FROM raw""")
def _(spark, sf):
    return raw_listings(spark, sf)


@query("append_sample", f"""WITH {LISTINGS}
SELECT id, preco_brl FROM listings UNION ALL
SELECT id, preco_brl FROM listings WHERE id % 97 < 3""")
def _(spark, sf):
    return append_sample(listings(spark, sf, entity=False).select(ID, PRICE))


_PROFILE = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS coluna, CAST(count(*) - count({c}) AS BIGINT) AS nulos, count(*) AS linhas,
  CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS BIGINT) AS duplicatas
FROM raw""" for c in RAW_COLUMNS)


@query("profile_nulls", f"WITH {RAW} {_PROFILE}")
def _(spark, sf):
    return cleaning.profile_nulls(raw_listings(spark, sf))


@query("dedup_rows", f"""WITH {RAW} SELECT DISTINCT id, marca_modelo, ano_fabricacao, preco_brl,
  data_anuncio, combustivel, status FROM raw""")
def _(spark, sf):
    return cleaning.dedup_rows(raw_listings(spark, sf))


@query("normalize_text", f"""WITH {RAW}
SELECT id, {title('marca_modelo', 'Desconhecido')} AS marca_modelo,
  {title('combustivel', 'Não Informado')} AS combustivel, {title('status', 'Desconhecido')} AS status
FROM raw""")
def _(spark, sf):
    return raw_listings(spark, sf).select(
        ID, text.normalize_text(F.col(ENTITY), UNKNOWN_STATUS).alias(ENTITY),
        text.normalize_text(F.col(FUEL), UNKNOWN_FUEL).alias(FUEL),
        text.normalize_text(F.col(STATUS), UNKNOWN_STATUS).alias(STATUS))


@query("title_case_text", """SELECT doc_id, md5(array_to_string(list_transform(
  regexp_extract_all(trim(text, ' \t\n\r'), '(\\p{L}+|[^\\p{L}]+)'),
  lambda v: replace(concat(upper(v[1]), lower(v[2:])), 'ẞ', 'Ss')), '')) AS texto FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(text.normalize_text(F.col("text"), "").cast("binary")).alias("texto"))


@query("unify_synonyms", f"""WITH {PARSED}
SELECT combustivel, status, count(*) AS n FROM parsed GROUP BY 1, 2""")
def _(spark, sf):
    raw = cleaning.dedup_rows(raw_listings(spark, sf))
    fuel = text.unify_synonyms(text.normalize_text(F.col(FUEL), UNKNOWN_FUEL), FUEL_SYNONYMS)
    status = text.unify_synonyms(
        text.normalize_text(F.col(STATUS), UNKNOWN_STATUS), STATUS_SYNONYMS)
    return raw.groupBy(fuel.alias(FUEL), status.alias(STATUS)).agg(F.count(F.lit(1)).alias("n"))


@query("coerce_number", f"""WITH {RAW}
SELECT id, TRY_CAST(ano_fabricacao AS DOUBLE) AS ano, TRY_CAST(preco_brl AS DOUBLE) AS preco FROM raw""")
def _(spark, sf):
    return raw_listings(spark, sf).select(
        ID, money.coerce_number(F.col(YEAR)).alias("ano"),
        money.coerce_number(F.col(PRICE)).alias("preco"))


@query("parse_price", f"WITH {RAW} SELECT id, {PRICE_SQL.format(x='preco_brl')} AS preco_brl FROM raw")
def _(spark, sf):
    return raw_listings(spark, sf).select(ID, money.parse_price(F.col(PRICE)).alias(PRICE))


@query("parse_date_multi", f"WITH {RAW} SELECT id, {DATE_SQL.format(x='data_anuncio')} AS data_anuncio FROM raw")
def _(spark, sf):
    return raw_listings(spark, sf).select(ID, dates.parse_date_multi(F.col(DATE)).alias(DATE))


def _parsed(spark, sf):
    return cleaning.parse_listings(raw_listings(spark, sf))


@query("impute_median_int", f"""WITH {CLEAN} SELECT id, ano_fabricacao FROM aged""")
def _(spark, sf):
    return cleaning.impute_median_int(durable(_parsed(spark, sf).select(ID, YEAR)))


@query("filter_year_range", f"""WITH {CLEAN}
SELECT id, ano_fabricacao FROM aged WHERE ano_fabricacao BETWEEN 1985 AND 1998""")
def _(spark, sf):
    aged = cleaning.impute_median_int(durable(_parsed(spark, sf).select(ID, YEAR)))
    return cleaning.filter_year_range(aged, 1998, 1985)


@query("filter_positive_or_null", f"""WITH {PARSED}
SELECT id, preco_brl FROM parsed WHERE preco_brl IS NULL OR preco_brl > 0""")
def _(spark, sf):
    return cleaning.filter_positive_or_null(durable(_parsed(spark, sf).select(ID, PRICE)))


@query("impute_median_price", f"WITH {CLEAN} SELECT id, preco_brl FROM priced")
def _(spark, sf):
    parsed = durable(_parsed(spark, sf).select(ID, YEAR, PRICE))
    in_range = cleaning.filter_year_range(cleaning.impute_median_int(parsed), MAX_YEAR)
    return cleaning.impute_median_price(cleaning.filter_positive_or_null(in_range)).select(ID, PRICE)


@query("impute_mode_date", f"""WITH {PARSED}
SELECT id, coalesce(data_anuncio, (
  SELECT data_anuncio FROM parsed WHERE data_anuncio IS NOT NULL GROUP BY data_anuncio
  ORDER BY count(*) DESC, data_anuncio LIMIT 1)) AS data_anuncio FROM parsed""")
def _(spark, sf):
    return cleaning.impute_mode_date(durable(_parsed(spark, sf).select(ID, DATE)))


_CLEAN_COLUMNS = "id, marca_modelo, ano_fabricacao, preco_brl, data_anuncio, combustivel, status"


@query("clean_listings", f"WITH {CLEAN} SELECT {_CLEAN_COLUMNS} FROM clean")
def _(spark, sf):
    return cleaning.clean_listings(raw_listings(spark, sf), MAX_YEAR)


@query("format_date_br", f"WITH {LISTINGS} SELECT id, strftime(data_anuncio, '%d/%m/%Y') AS data_anuncio FROM listings")
def _(spark, sf):
    return listings(spark, sf, entity=False).select(
        ID, dates.format_date_br(F.col(DATE)).alias(DATE))


@query("format_date_iso", f"WITH {LISTINGS} SELECT id, strftime(data_anuncio, '%Y-%m-%d') AS data_anuncio FROM listings")
def _(spark, sf):
    return listings(spark, sf, entity=False).select(
        ID, dates.format_date_iso(F.col(DATE)).alias(DATE))


@query("format_brl", f"""WITH {LISTINGS}
SELECT id, 'R$ ' || translate(format('{{:,.2f}}', preco_brl), ',.', '.,') AS preco_brl FROM listings""")
def _(spark, sf):
    return listings(spark, sf, entity=False).select(
        ID, money.format_brl(F.col(PRICE)).alias(PRICE))


@query("format_brl_short", f"""WITH {LISTINGS}
SELECT id, CASE WHEN p >= 1e6 THEN 'R$ ' || CAST(CAST(p / 1e6 AS DECIMAL(18,1)) AS VARCHAR) || 'M'
  WHEN p >= 1e3 THEN 'R$ ' || CAST(CAST(p / 1e3 AS DECIMAL(18,0)) AS VARCHAR) || 'k'
  ELSE 'R$ ' || CAST(CAST(p AS DECIMAL(18,0)) AS VARCHAR) END AS valor
FROM (SELECT id, preco_brl * CASE id % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 10.0 ELSE 0.001 END::DOUBLE AS p
      FROM listings)""")
def _(spark, sf):
    scale = F.when(F.col(ID) % 3 == 0, 1.0).when(F.col(ID) % 3 == 1, 10.0).otherwise(0.001)
    return listings(spark, sf, entity=False).select(
        ID, money.format_brl_short(F.col(PRICE) * scale).alias("valor"))


_PAIRS = [("an", "ân"), ("ânt", "ant"), ("er", "êr")]


@query("repair_text", """SELECT doc_id, md5(replace(replace(replace(replace(
  text, chr(65533), ''), 'an', 'ân'), 'ânt', 'ant'), 'er', 'êr')) AS texto FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(text.repair_text(F.col("text"), _PAIRS).cast("binary")).alias("texto"))


def _broken(labels):
    """Labels as they come after their accents were lost: dropped, replaced, or decoded three times."""
    lost = F.regexp_replace(labels, r"[^\x00-\x7F]", "")
    marked = F.regexp_replace(labels, r"[^\x00-\x7F]", text.REPLACEMENT_CHAR)
    thrice = F.replace(labels, F.lit("é"), F.lit("ï¿½" * 3))
    return {"perdido": lost, "marcado": marked, "triplo": F.when(labels == "Elétrico", thrice).otherwise(lost)}


@query("repair_text_default", f"""WITH {LISTINGS}, b AS (
  SELECT id, combustivel AS c, regexp_replace(combustivel, '[^\x00-\x7F]', '', 'g') AS lost FROM listings),
f AS (SELECT id, CASE WHEN c = 'Elétrico' THEN 'Elétrico' WHEN c = 'Híbrido' THEN 'Híbrido' ELSE lost END AS fixo FROM b)
SELECT id, fixo AS perdido, fixo AS marcado, fixo AS triplo FROM f""")
def _(spark, sf):
    rows = listings(spark, sf, entity=False)
    return rows.select(ID, *[text.repair_text(x).alias(n) for n, x in _broken(F.col(FUEL)).items()])


@query("decode_text", "SELECT doc_id, md5(text) AS utf8, md5(text) AS ocidental FROM documents")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    # Western bytes where the text fits one byte per character, so the second decoder is used
    western = F.when(F.col("text").rlike(r"^[\x00-\x7F\xA0-\xFF]*$"), F.encode("text", "ISO-8859-1"))
    decoded = {"utf8": F.encode("text", "UTF-8"),
               "ocidental": F.coalesce(western, F.encode("text", "UTF-8"))}
    return docs.select("doc_id", *[
        F.md5(text.decode_text(raw).cast("binary")).alias(n) for n, raw in decoded.items()])


@query("brand_of", f"WITH {LISTINGS} SELECT id, marca FROM listings")
def _(spark, sf):
    return listings(spark, sf).select(ID, text.brand_of(F.col(ENTITY)).alias("marca"))
