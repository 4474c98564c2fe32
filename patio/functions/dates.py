"""Date parsing, presentation and calendar parts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date shapes, tried in this order.
DATE_FORMATS = [
    ("[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}", "y-M-d"),
    ("[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}", "d/M/y"),
    ("[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}", "y/M/d"),
    ("[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}", "M-d-y"),
]


def parse_date_multi(x: Column) -> Column:
    """First format whose shape matches (surrounding whitespace allowed) and names a real day."""
    return F.coalesce(*[
        F.try_to_date(F.regexp_extract(x, rf"(?U)^\s*({shape})\s*$", 1), pattern)
        for shape, pattern in DATE_FORMATS])


def format_date_br(d: Column) -> Column:
    return F.date_format(d, "dd/MM/yyyy")


def format_date_iso(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def calendar_parts(d: Column) -> dict[str, Column]:
    return {
        "ano": F.date_format(d, "yyyy"),
        "mes": F.date_format(d, "MM"),
        "ano_mes": year_month(d),
        "trimestre": F.quarter(d),
    }


def vehicle_age(d: Column, year: Column) -> Column:
    return F.year(d) - year


def cyclic_month(d: Column) -> tuple[Column, Column]:
    angle = F.lit(2.0) * F.pi() * F.month(d) / F.lit(12.0)
    return F.sin(angle), F.cos(angle)
