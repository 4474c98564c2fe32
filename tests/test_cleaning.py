import datetime as dt

import pytest
from pyspark.sql import functions as F

from patio.columns import RAW_COLUMNS
from patio.operators import cleaning, ordered
from patio.sources import tables
from patio.sources.noise import inject_noise
from patio.sources.views import listings

RAW = "id string, marca_modelo string, ano_fabricacao string, preco_brl string, " \
      "data_anuncio string, combustivel string, status string"


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_pipeline_order(spark):
    rows = [
        ("1", "honda HR-V", "2010", "R$ 100,00", "2022-01-01", "DIESEL", "VENDIDO"),
        ("1", "honda HR-V", "2010", "R$ 100,00", "2022-01-01", "DIESEL", "VENDIDO"),
        ("2", None, "2013", "$300.00", "02/01/2022", None, None),
        ("3", "ford ka", None, None, "2022/01/02", "eletrico", "disponivel"),
        ("4", "ford ka", "1950", "900", None, "flex", "Disponivel"),
        ("5", "ford ka", "2012", "-5", None, "flex", "reservado"),
        ("6", "ford ka", "2011", "200", None, " Flex ", "reservado"),
        ("7", "fiat uno", "2012", "bad", "bad", "Flex", "reservado"),
    ]
    out = {r.id: r for r in cleaning.clean_listings(raw(spark, rows), 2024).collect()}
    # year median over deduplicated rows: 1950 2010 2011 2012 2012 2013 -> 2011.5 -> 2011
    assert out[3].ano_fabricacao == 2011
    # 4 leaves by year, 5 by price; the price median is taken over what remains
    assert sorted(out) == [1, 2, 3, 6, 7]
    assert out[3].preco_brl == 200.0 and out[7].preco_brl == 200.0
    # 2022-01-02 appears twice among the remaining rows
    assert out[6].data_anuncio == dt.date(2022, 1, 2)
    assert (out[2].marca_modelo, out[2].combustivel, out[2].status) == (
        "Desconhecido", "Não Informado", "Desconhecido")
    assert (out[3].combustivel, out[3].status) == ("Elétrico", "Disponível")


def test_mode_ties_take_the_earliest(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, d),) for d in (3, 3, 2, 2, 1)], "d date")
    assert df.select(cleaning.mode_of(df, "d").alias("m")).first().m == dt.date(2022, 1, 2)


def test_profile_counts_copies(spark):
    rows = [("1", "a", None, "1", "x", None, "s")] * 3 + [("2", "a", "1", "1", "x", None, "s")]
    out = {r.coluna: r for r in cleaning.profile_nulls(raw(spark, rows)).collect()}
    assert out["ano_fabricacao"].nulos == 3 and out["combustivel"].nulos == 4
    assert out["id"].linhas == 4 and out["id"].duplicatas == 2


def test_clean_same_result_for_any_cells(spark, sf, monkeypatch):
    noisy = inject_noise(listings(spark, sf).select(*RAW_COLUMNS))
    small = sorted(cleaning.clean_listings(noisy, 2026).collect())
    monkeypatch.setattr(ordered, "PARTS", 8)
    monkeypatch.setattr(ordered, "CELL_ROWS", 20)
    assert small == sorted(cleaning.clean_listings(noisy.repartition(7), 2026).collect())


def test_typed_table_rejects_nulls(spark, sf, tmp_path):
    df = listings(spark, sf).select(*RAW_COLUMNS)
    assert tables.load_typed_table(df, str(tmp_path / "t")).count() == df.count()
    broken = df.withColumn("status", F.when(F.col("id") != 5, F.col("status")))
    with pytest.raises(Exception, match="null in listing"):
        tables.load_typed_table(broken, str(tmp_path / "t2"))


def test_layout_prunes(spark, sf, tmp_path):
    out = tables.layout_listings(listings(spark, sf).select(*RAW_COLUMNS), str(tmp_path / "l"))
    plan = out.filter("ano_mes = '1997-03' and status = 'Vendido'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ano_mes" in plan
    assert "EqualTo(status,Vendido)" in plan


def test_csv_has_mark_and_round_trips(spark, sf, tmp_path):
    path = tmp_path / "csv"
    tables.write_clean_csv(listings(spark, sf).select(*RAW_COLUMNS), str(path))
    parts = [p for p in path.iterdir() if p.name.startswith("part-")]
    assert parts and all(p.read_bytes().startswith(b"\xef\xbb\xbfmarca_modelo,") for p in parts)
