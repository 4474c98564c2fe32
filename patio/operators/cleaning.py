"""Cleaning pipeline: raw text listings to the typed table.

Order matters: every imputation uses statistics taken after the filters before it.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patio.columns import (DATE, ENTITY, FUEL, FUEL_SYNONYMS, ID, PRICE, STATUS, STATUS_SYNONYMS,
                           UNKNOWN_FUEL, UNKNOWN_STATUS, YEAR)
from patio.functions.dates import parse_date_multi
from patio.functions.money import coerce_number, parse_price
from patio.functions.text import normalize_text, unify_synonyms
from patio.operators.quantiles import quantile_scalars
from patio.session import durable

MIN_YEAR = 1980


def profile_nulls(df: DataFrame) -> DataFrame:
    """Per column: null count, row count and number of repeated rows (copies after the first)."""
    columns = df.columns
    distinct_rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    wide = distinct_rows.agg(
        F.sum("_copies").alias("linhas"),
        F.sum(F.col("_copies") - 1).alias("duplicatas"),
        *[F.sum(F.when(F.col(c).isNull(), F.col("_copies")).otherwise(0)).alias(f"_n_{c}")
          for c in columns])
    per_column = F.array(*[
        F.struct(F.lit(c).alias("coluna"), F.col(f"_n_{c}").alias("nulos")) for c in columns])
    return wide.select("linhas", "duplicatas", F.inline(per_column)).select(
        "coluna", "nulos", "linhas", "duplicatas")


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def median_of(df: DataFrame, column: str) -> Column:
    return quantile_scalars(df, column, [0.5])[0]


def mode_of(df: DataFrame, column: str) -> Column:
    """Most frequent value; the smallest one when several tie."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("_c"))
    best = counts.agg(F.max("_c").alias("_m")).scalar()
    return counts.filter(F.col("_c") == best).agg(F.min(column).alias("moda")).scalar()


def impute_median_int(df: DataFrame, column: str = YEAR) -> DataFrame:
    """Fill nulls with the median, truncated to int."""
    return df.withColumn(
        column, F.coalesce(F.col(column), median_of(df, column)).cast("int"))


def filter_year_range(df: DataFrame, max_year: int, min_year: int = MIN_YEAR,
                      column: str = YEAR) -> DataFrame:
    return df.filter(F.col(column).between(min_year, max_year))


def filter_positive_or_null(df: DataFrame, column: str = PRICE) -> DataFrame:
    return df.filter(F.col(column).isNull() | (F.col(column) > 0))


def impute_median_price(df: DataFrame, column: str = PRICE, digits: int = 2) -> DataFrame:
    """Fill nulls with the median, then round half to even."""
    return df.withColumn(
        column, F.bround(F.coalesce(F.col(column), median_of(df, column)), digits))


def impute_mode_date(df: DataFrame, column: str = DATE) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), mode_of(df, column)))


def parse_listings(raw: DataFrame) -> DataFrame:
    """Row-level part of the pipeline: typed, normalised, gaps still null."""
    return dedup_rows(raw).select(
        F.col(ID).try_cast("long").alias(ID),
        normalize_text(F.col(ENTITY), UNKNOWN_STATUS).alias(ENTITY),
        coerce_number(F.col(YEAR)).alias(YEAR),
        parse_price(F.col(PRICE)).alias(PRICE),
        parse_date_multi(F.col(DATE)).alias(DATE),
        unify_synonyms(normalize_text(F.col(FUEL), UNKNOWN_FUEL), FUEL_SYNONYMS).alias(FUEL),
        unify_synonyms(normalize_text(F.col(STATUS), UNKNOWN_STATUS), STATUS_SYNONYMS)
        .alias(STATUS),
    )


def clean_listings(raw: DataFrame, max_year: int) -> DataFrame:
    """Whole pipeline. The parsed rows are written once to the checkpoint folder, because three
    statistics and the result each read them and the deduplicating shuffle must not run again."""
    parsed = durable(parse_listings(raw))
    in_range = filter_year_range(impute_median_int(parsed), max_year)
    priced = impute_median_price(filter_positive_or_null(in_range))
    return impute_mode_date(priced)


def replace_values(df: DataFrame, pairs: dict[str, str], columns: Sequence[str]) -> DataFrame:
    return df.replace(pairs, subset=list(columns))
