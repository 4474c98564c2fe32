"""Sinks: typed table, query layout, CSV exports, dashboard bundle."""

from functools import reduce

from pyspark.sql import functions as F

from patio.columns import ENTITY, FUEL, ID, PRICE, RAW_COLUMNS, STATUS, YEAR
from patio.operators.summaries import with_brand
from patio.plans.registry import LISTINGS, query
from patio.plans.segmentation import SEG, customers
from patio.session import scratch_folder
from patio.sources import tables
from patio.sources.views import listings

TYPED = "id, marca_modelo, ano_fabricacao, preco_brl, data_anuncio, combustivel, status"


def _clean(spark, sf):
    return listings(spark, sf).select(*RAW_COLUMNS)


@query("load_typed_table", f"WITH {LISTINGS} SELECT {TYPED} FROM listings")
def _(spark, sf):
    return tables.load_typed_table(_clean(spark, sf), scratch_folder(spark, "anuncios"))


@query("layout_listings", f"""WITH {LISTINGS} SELECT id, marca_modelo, ano_fabricacao, preco_brl, status, ano_mes
FROM listings WHERE ano_mes = '1997-03' AND combustivel = 'Flex'""")
def _(spark, sf):
    laid_out = tables.layout_listings(_clean(spark, sf), scratch_folder(spark, "layout"))
    return laid_out.filter((F.col("ano_mes") == "1997-03") & (F.col(FUEL) == "Flex")).select(
        ID, ENTITY, YEAR, PRICE, STATUS, F.col("ano_mes").cast("string").alias("ano_mes"))


@query("write_clean_csv", f"""WITH {LISTINGS}
SELECT marca_modelo, CAST(ano_fabricacao AS VARCHAR) AS ano_fabricacao,
  'R$ ' || translate(format('{{:,.2f}}', preco_brl), ',.', '.,') AS preco_brl,
  strftime(data_anuncio, '%d/%m/%Y') AS data_anuncio, combustivel, status FROM listings""")
def _(spark, sf):
    path = scratch_folder(spark, "csv")
    clean = _clean(spark, sf)
    tables.write_clean_csv(clean, path)
    columns = tables.clean_text_form(clean).columns
    return spark.read.schema(", ".join(f"{c} string" for c in columns)).option(
        "header", True).csv(path)


@query("write_rfm_csv", f"""WITH {SEG}
SELECT o_custkey, recency, frequency, R_score, F_score, M_score, RFM_score, segmento_rfm FROM seg""")
def _(spark, sf):
    path = scratch_folder(spark, "rfm")
    segmented = customers(spark, sf)
    tables.write_rfm_csv(segmented, path)
    back = spark.read.schema(segmented.schema).option("header", True).csv(path)
    return back.select("o_custkey", "recency", "frequency", "R_score", "F_score", "M_score",
                       "RFM_score", "segmento_rfm")


@query("dashboard_bundle")
def _(spark, sf):
    path = scratch_folder(spark, "painel")
    names = tables.write_dashboard_bundle(with_brand(listings(spark, sf)), customers(spark, sf), path)
    return reduce(lambda a, b: a.unionByName(b), [
        spark.read.text(f"{path}/{name}").select(F.lit(name).alias("secao"), "value") for name in names])
