"""Ranks, moving windows and running totals."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patio.columns import BRAND, DATE, FUEL, ID, PRICE
from patio.functions.labels import quartile_label
from patio.functions.numeric import pct_change, round_stable
from patio.operators.ordered import (ntile_of, number_rows, percent_rank_of, with_neighbours)
from patio.session import durable


def _tops(df: DataFrame, group: str, value: str, k: int) -> tuple[DataFrame, DataFrame]:
    """The stored rows with RANK <= k per group by value descending (nulls last), and per (group, value)
    among them RANK and DENSE_RANK.

    ROW_NUMBER limits each group to k rows before its shuffle and so gives the k-th largest value,
    ties or not; a value has RANK <= k exactly when it is not below that one. A group with fewer
    values keeps all rows. Null groups and values are compared like any other.
    """
    by_value = Window.partitionBy(group).orderBy(F.desc_nulls_last(value))
    kth = (
        df.select(group, value).withColumn("_r", F.row_number().over(by_value))
        .filter(F.col("_r") <= k).groupBy(F.col(group).alias("_g"))
        .agg(F.max_by(F.struct(value), "_r")[value].alias("_least"))
    )
    kept = durable(
        df.join(kth, F.col(group).eqNullSafe(F.col("_g")))
        .filter(F.col("_least").isNull() | (F.col(value) >= F.col("_least"))).select(*df.columns))
    counts = kept.groupBy(F.col(group).alias("_g"), F.col(value).alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"))
    # at most k values and null per group
    w = Window.partitionBy("_g").orderBy(F.desc_nulls_last("_v"))
    above = F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1))
    ranks = counts.select(
        "_g", "_v", (F.coalesce(above, F.lit(0)) + 1).alias("rank_preco"),
        F.row_number().over(w).cast("long").alias("dense_rank_preco")).filter(F.col("rank_preco") <= k)
    return kept, ranks


def _with_ranks(df: DataFrame, group: str, value: str, k: int) -> DataFrame:
    kept, ranks = _tops(df, group, value, k)
    same = F.col(group).eqNullSafe(F.col("_g")) & F.col(value).eqNullSafe(F.col("_v"))
    return kept.join(ranks, same).select(*df.columns, "rank_preco", "dense_rank_preco")


def rank_triplet(df: DataFrame, group: str = BRAND, value: str = PRICE, tie: str = ID,
                 k: int = 3) -> DataFrame:
    """RANK, DENSE_RANK and ROW_NUMBER by value descending, rows with RANK <= k (ties kept)."""
    kept = _with_ranks(df, group, value, k)
    numbered = number_rows(kept, tie, tie, within=[group, value])
    return numbered.select(*kept.columns, (F.col("rank_preco") + F.col("_pos") - 1)
                           .alias("row_num"))


def top_by_rank(df: DataFrame, group: str = BRAND, value: str = PRICE, k: int = 3) -> DataFrame:
    """Rows with RANK <= k by value descending; ties kept, so a group may give more than k."""
    return _with_ranks(df, group, value, k).drop("dense_rank_preco")


def top_by_row(df: DataFrame, group: str = FUEL, value: str = PRICE, tie: str = ID,
               k: int = 5) -> DataFrame:
    """First k rows per group by value descending, then tie."""
    w = Window.partitionBy(group).orderBy(F.desc_nulls_last(value), tie)
    return df.withColumn("posicao", F.row_number().over(w).cast("long")).filter(
        F.col("posicao") <= k)


def moving_average(df: DataFrame, sizes: Sequence[int] = (7, 30), value: str = PRICE,
                   by: str = DATE, tie: str = ID) -> DataFrame:
    """Trailing means over the last rows by (by, tie); shorter frames at the start."""
    def means(w):
        return [round_stable(F.avg(value).over(w.rowsBetween(1 - s, 0))).alias(f"media_movel_{s}")
                for s in sizes]
    return with_neighbours(df, by, tie, max(sizes) - 1, 0, means)


def price_neighbors(df: DataFrame, value: str = PRICE, by: str = DATE, tie: str = ID) -> DataFrame:
    """Previous and next value by (by, tie), difference and percent change."""
    def around(w):
        x, prev, nxt = F.col(value), F.lag(value).over(w), F.lead(value).over(w)
        return [
            F.round(prev, 2).alias("preco_anterior"), F.round(nxt, 2).alias("preco_proximo"),
            round_stable(x - prev).alias("delta_anterior"),
            round_stable(pct_change(x, prev)).alias("variacao_pct")]
    return with_neighbours(df, by, tie, 1, 1, around)


def running_totals(df: DataFrame, value: str = PRICE, by: str = DATE, tie: str = ID) -> DataFrame:
    """Cumulative sum and count by (by, tie)."""
    numbered = number_rows(df, by, tie, sums=[value])
    return numbered.select(
        *df.columns, round_stable(F.col(f"_sum_{value}")).alias("receita_acumulada"),
        F.col("_pos").alias("anuncios_acumulados"))


def percentile_buckets(df: DataFrame, value: str = PRICE, tie: str = ID) -> DataFrame:
    """PERCENT_RANK, quartile, decile and quartile label by value."""
    numbered = number_rows(df, value, tie)
    n, pos = F.col("_n"), F.col("_pos")
    quartile = ntile_of(pos, n, 4)
    return numbered.select(
        *df.columns, F.round(percent_rank_of(F.col("_rank"), n), 4).alias("percent_rank"),
        quartile.alias("quartil"), ntile_of(pos, n, 10).alias("decil"),
        quartile_label(quartile).alias("quartil_label"))


def first_rows(df: DataFrame, n: int, by: str = DATE, tie: str = ID) -> DataFrame:
    """Leading rows of a report. Trailing windows and running totals of the first n rows depend on
    those rows only, so a report may take them before the window."""
    return df.orderBy(by, tie).limit(n)
