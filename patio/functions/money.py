"""Price parsing and presentation."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text shapes recognised when reading prices.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
DOT_THOUSANDS = r"\d{1,3}(\.\d{3})+,\d{2}"
COMMA_THOUSANDS = r"\d{1,3}(,\d{3})+\.\d{2}"
CURRENCY_CHARS = r"(?U)[R$\s]"


def coerce_number(x: Column) -> Column:
    """Text to double, null where it is not a plain decimal number."""
    # an empty extract (no match) casts to null
    return F.regexp_extract(F.trim(x.cast("string")), NUMBER, 0).try_cast("double")


def parse_price(x: Column) -> Column:
    """Price text in Brazilian, US or plain notation to double; null when unreadable."""
    s = F.regexp_replace(x.cast("string"), CURRENCY_CHARS, "")
    plain = (
        F.when(s.rlike(DOT_THOUSANDS), F.translate(s, ",.", "."))
        .when(s.rlike(COMMA_THOUSANDS), F.translate(s, ",", ""))
        .otherwise(F.translate(s, ",", "."))
    )
    return coerce_number(plain)


def format_brl(x: Column) -> Column:
    """1234567.891 -> 'R$ 1.234.567,89'."""
    return F.concat(F.lit("R$ "), F.translate(F.format_number(x, 2), ",.", ".,"))


def format_brl_short(x: Column) -> Column:
    """Compact amount: millions with one decimal, thousands and units without."""
    return (
        F.when(x >= 1e6, F.format_string("R$ %.1fM", x / 1e6))
        .when(x >= 1e3, F.format_string("R$ %.0fk", x / 1e3))
        .otherwise(F.format_string("R$ %.0f", x))
    )
