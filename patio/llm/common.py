"""Names and small helpers shared by the text operators."""

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The bytes that separate words, the word pattern, and its SQL form.
WHITE = "\t\n\x0b\x0c\r "
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spaced(text: Column) -> Column:
    """The text with every white-space character as a space; null as empty."""
    out = F.coalesce(text, F.lit(""))
    for c in WHITE[:-1]:  # a replacement that finds nothing costs one search
        out = F.replace(out, F.lit(c), F.lit(" "))
    return out


def words_of(text: Column) -> Column:
    """Words of a text as an array; null text has none."""
    return F.array_remove(F.split(spaced(text), " "), "")


def lines_with_words(text: Column) -> Column:
    """The \\n-split lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"),
                    lambda line: F.btrim(line, F.lit(WHITE)) != "")


def chars_in(text: Column, characters: str) -> Column:
    """How many of the text's characters are in the set of ASCII characters."""
    rest = text
    for c in characters:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return F.octet_length(text) - F.octet_length(rest)


def private(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
