"""Dropping boilerplate lines by their frequency relative to the site.

Per host, a line's frequency is the number of the host's pages that hold it, divided by the host's
pages. Lines above ``ratio`` that ``min_pages`` of the host's pages hold go, wherever they stand.
A page counts a line once, however often it repeats it.

Rows are stored once, numbered. Counting combines on the map side by 128-bit hashes of (host, line),
so neither a host with a third of the pages nor a line on all of them meets in one task. The lines to
drop are a table of (host, line) rows that each line of a page looks up by a join, broadcast only when
small; a page gets back the sorted places of its own lines that go, so nothing grows with the number
of a host's boilerplate lines.

Results for odd rows: a null text stays null; a null host is a host of its own; lines without a word
are kept and never counted; a page all of whose lines go keeps an empty text; repeated rows count as
pages of their own; an empty table stays empty.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patio.llm.common import WHITE, private
from patio.session import durable

RATIO = 0.01
MIN_PAGES = 3


def _body(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE))


def _key(body: Column) -> Column:
    """128 bits of a line without white space at its ends."""
    return F.struct(F.xxhash64(body).alias("a"), F.xxhash64(body, F.lit(1)).alias("b"))


def _keys(text: Column) -> Column:
    bodies = F.filter(F.transform(F.split(text, "\n"), _body), lambda x: x != "")
    return F.transform(F.array_distinct(bodies), _key)


def boilerplate(docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per boilerplate line of a host: ``host``, ``key``, ``holding``, ``pages``."""
    pages = docs.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("pages"))
    held = docs.select(F.col(host).alias("host"), F.explode(_keys(F.col(text))).alias("key"))
    counted = held.groupBy("host", "key").agg(F.count(F.lit(1)).alias("holding")).filter(
        F.col("holding") >= min_pages)
    sized = counted.alias("c").join(pages.alias("p"), F.col("c.host").eqNullSafe(F.col("p.host")))
    return sized.filter(F.col("holding") > ratio * F.col("pages")).select("c.host", "key", "holding", "pages")


def drop_boilerplate(docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, dropped: str | None = None,
                     length: str | None = None) -> DataFrame:
    """The table with the boilerplate lines taken out of ``text``. ``dropped`` names an added column
    with the number of lines that went, ``length`` a column that holds the number of characters."""
    row, of, places, lines = (private(docs, n) for n in ("_row", "_of", "_places", "_lines"))
    stored = durable(docs.withColumn(row, F.monotonically_increasing_id()))
    found = durable(boilerplate(stored, text, host, ratio, min_pages)).select(
        F.col("host").alias("site"), F.col("key.a").alias("a"), F.col("key.b").alias("b"))
    body = _body(F.col("line"))
    held = stored.select(
        F.col(host).alias("host"), F.col(row).alias(of),
        F.posexplode(F.split(F.col(text), "\n")).alias("place", "line")).filter(body != "").select(
        "host", of, "place", _key(body).alias("key"))
    gone = (
        held.join(found, F.col("host").eqNullSafe(F.col("site")) & (F.col("key.a") == F.col("a"))
                  & (F.col("key.b") == F.col("b")))
        .groupBy(of).agg(F.array_sort(F.collect_list("place")).alias(places)))
    joined = stored.join(gone, F.col(row) == F.col(of), "left").withColumn(lines, F.split(F.col(text), "\n"))
    # the lines between each place and the one before it; the last run ends with the text
    n_gone = F.coalesce(F.size(places), F.lit(0))

    def run(i: Column) -> Column:
        before = F.coalesce(F.get(places, i - 1), F.lit(-1))
        after = F.coalesce(F.get(places, i), F.size(lines))
        return F.slice(lines, before + 2, after - before - 1)

    kept = F.flatten(F.transform(F.sequence(F.lit(0), n_gone), run))
    out = joined.withColumn(text, F.when(n_gone > 0, F.array_join(kept, "\n")).otherwise(F.col(text)))
    if dropped is not None:
        out = out.withColumn(dropped, n_gone.cast("long"))
    if length is not None:
        out = out.withColumn(length, F.length(text).cast(docs.schema[length].dataType))
    return out.select(*docs.columns, *([dropped] if dropped else []))
