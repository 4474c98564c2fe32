"""Writing and reading listings: typed table, query layout, text exports, dashboard bundle."""

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patio.columns import (BRAND, DATE, ENTITY, FUEL, ID, LISTINGS_SCHEMA, PRICE, RAW_COLUMNS,
                           STATUS, YEAR)
from patio.functions.dates import format_date_br, format_date_iso, year_month
from patio.functions.money import format_brl
from patio.operators.dashboard import filter_domains, rfm_cards

BOM = "﻿"


def load_typed_table(clean: DataFrame, path: str) -> DataFrame:
    """Replace the typed table at ``path``; a null in any column fails the write."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in RAW_COLUMNS])
    message = F.concat(F.lit("null in listing "), F.coalesce(F.col(ID).cast("string"), F.lit("?")))
    audited = clean.select(
        F.when(missing, F.raise_error(message)).otherwise(F.col(ID)).cast("long").alias(ID),
        *[F.col(f.name).cast(f.dataType) for f in LISTINGS_SCHEMA.fields if f.name != ID])
    audited.write.mode("overwrite").parquet(path)
    return read_listings(clean.sparkSession, path)


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LISTINGS_SCHEMA).parquet(path)


def layout_listings(df: DataFrame, path: str) -> DataFrame:
    """Table partitioned by month, rows ordered so that row-group statistics skip by status, fuel
    and year. Range partitioning over the whole sort key keeps a very large month in many tasks."""
    keys = ["ano_mes", STATUS, FUEL, YEAR, ID]
    (
        df.withColumn("ano_mes", year_month(F.col(DATE)))
        .repartitionByRange(*keys).sortWithinPartitions(*keys)
        .write.mode("overwrite").partitionBy("ano_mes").parquet(path)
    )
    return df.sparkSession.read.parquet(path)


def _write_csv(df: DataFrame, path: str, bom: bool) -> None:
    first = df.columns[0]
    out = df.withColumnRenamed(first, BOM + first) if bom else df
    out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def clean_text_form(clean: DataFrame) -> DataFrame:
    """Presentation form: day-first dates and formatted prices."""
    return clean.select(
        ENTITY, YEAR, format_brl(F.col(PRICE)).alias(PRICE), format_date_br(F.col(DATE)).alias(DATE),
        FUEL, STATUS)


def write_clean_csv(clean: DataFrame, path: str) -> None:
    """Text-form export as UTF-8 with a byte order mark (it leads the header of every part)."""
    _write_csv(clean_text_form(clean), path, bom=True)


def write_rfm_csv(segmented: DataFrame, path: str) -> None:
    _write_csv(segmented, path, bom=False)


def dashboard_bundle(df: DataFrame, segmented: DataFrame) -> dict[str, DataFrame]:
    """Filter domains, listing rows and segment cards, each as one JSON document per line."""
    domains = filter_domains(df)
    rows = df.select(
        ENTITY, BRAND, YEAR, PRICE, format_date_iso(F.col(DATE)).alias(DATE),
        year_month(F.col(DATE)).alias("ano_mes"), FUEL, STATUS)
    parts = {"filters": domains, "raw": rows, "rfm_seg": rfm_cards(segmented)}
    return {
        name: part.select(F.to_json(F.struct(*part.columns)).alias("value"))
        for name, part in parts.items()}


def write_dashboard_bundle(df: DataFrame, segmented: DataFrame, path: str) -> list[str]:
    """Writes each part as text under ``path``; returns the parts' names."""
    parts = dashboard_bundle(df, segmented)
    for name, lines in parts.items():
        lines.write.mode("overwrite").text(os.path.join(path, name))
    return list(parts)
