"""Dirty a clean listings table at fixed rates, driven by id arithmetic."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patio.columns import DATE, ENTITY, FUEL, ID, PRICE, RAW_COLUMNS, STATUS, YEAR
from patio.functions.money import format_brl


def _class(modulus: int) -> Column:
    return F.col(ID) % modulus


def _noisy_price() -> Column:
    k = _class(100)
    text = F.col(PRICE).cast("decimal(18,2)").cast("string")
    return (
        F.when(k < 4, F.lit(None).cast("string"))
        .when(k < 6, F.concat(F.lit("-"), text))
        .when(k < 8, format_brl(F.col(PRICE)))
        .when(k < 10, F.concat(F.lit("$"), text))
        .otherwise(text)
    )


def _noisy_date() -> Column:
    k = _class(101)
    out = F.when(k < 4, F.lit(None).cast("string"))
    for bound, pattern in ((7, "dd/MM/yyyy"), (10, "yyyy/MM/dd"), (12, "MM-dd-yyyy")):
        out = out.when(k < bound, F.date_format(DATE, pattern))
    return out.otherwise(F.date_format(DATE, "yyyy-MM-dd"))


def _noisy_fuel() -> Column:
    k = _class(7)
    x = F.col(FUEL)
    return (
        F.when(k == 0, F.lit(None).cast("string")).when(k == 1, F.lower(x)).when(k == 2, F.upper(x))
        .when(k == 3, F.replace(x, F.lit("Elétrico"), F.lit("Eletrico")))
        .when(k == 4, F.concat(F.lit("  "), x, F.lit(" ")))
        .otherwise(x)
    )


def _noisy_status() -> Column:
    k = _class(11)
    x = F.col(STATUS)
    return (
        F.when(k == 0, F.lit(None).cast("string")).when(k == 1, F.lower(x)).when(k == 2, F.upper(x))
        .when(k == 3, F.replace(x, F.lit("Disponível"), F.lit("disponivel")))
        .otherwise(x)
    )


def append_sample(df: DataFrame, modulus: int = 97, keep: int = 3) -> DataFrame:
    """The table with an id-determined slice of itself once more, in one pass."""
    copies = F.when(F.col(ID) % modulus < keep, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.select("*", F.explode(copies).alias("_copy")).drop("_copy")


def inject_noise(clean: DataFrame) -> DataFrame:
    noisy = clean.select(
        F.col(ID).cast("string").alias("_id"),
        F.col(ID),
        F.col(ENTITY),
        F.when(_class(103) >= 3, F.col(YEAR).cast("string")).alias(YEAR),
        _noisy_price().alias(PRICE),
        _noisy_date().alias(DATE),
        _noisy_fuel().alias(FUEL),
        _noisy_status().alias(STATUS),
    )
    return append_sample(noisy).drop(ID).withColumnRenamed("_id", ID).select(*RAW_COLUMNS)
