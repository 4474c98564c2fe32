"""Exact linear-interpolated quantiles of one or many columns, globally or per group, in one form for
every size.

All columns and probabilities of a call share one chain of jobs. Without groups a mergeable sketch
brackets every wanted rank; brackets that may hold too many rows are narrowed with exact counts, and only
values inside brackets are shuffled, as (column, value, count). Per group, ranks are located in cells of
the columns' values, counted over (column, group, cell) with a map-side combine. Cells that hold a wanted
rank and too many rows of different values are cut again; only the rows of the cells that are left are
shuffled, as (value, count).
"""

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from patio.operators import ordered
from patio.session import durable, scalar_struct

#: A sketch's rank error is rows / ACCURACY at most; ranks are looked for within three times of it.
ACCURACY = 10_000
REACH = 3 / ACCURACY


class _Bracket:
    """Values ``lo`` to ``hi`` between which the ranks around a probability lie, and how many rows at most
    lie strictly between them."""

    def __init__(self, n: int, p: float, low: float, high: float, least: float, most: float):
        self.ranks = [math.floor((n - 1) * p), math.ceil((n - 1) * p)]
        self.part = (n - 1) * p - self.ranks[0]
        exact = n < ACCURACY  # few rows: all of them
        self.lo, self.hi = (least, most) if exact else (low, high)
        self.inside = n if exact else math.ceil(n * (2 * REACH + 2 / ACCURACY))
        if self.lo == self.hi:
            self.inside = 0

    def counts(self, x: Column, grid: Sequence[float]) -> Column:
        between = (x > self.lo) & (x < self.hi)
        return F.struct(
            F.count_if(x < self.lo).alias("below"), F.count_if(x == self.lo).alias("first"),
            F.count_if(between).alias("n"),
            F.percentile_approx(F.when(between, x), list(grid), ACCURACY).alias("grid"))

    def narrow(self, counts, grid: Sequence[float]) -> None:
        """Moves the ends to the neighbours of the ranks among the counted values."""
        values = [self.lo, *(counts.grid or []), self.hi]
        ends = []
        for rank in self.ranks:
            place = rank - counts.below - counts.first
            if place < 0 or place >= counts.n:
                ends += [self.lo] * 2 if place < 0 else [self.hi] * 2
                continue
            reach = REACH + 2 / counts.n
            at = (place + 1) / counts.n
            ends.append(max([v for q, v in zip([0, *grid], values) if q < at - reach], default=self.lo))
            ends.append(min([v for q, v in zip([*grid, 1], values[1:]) if q > at + reach], default=self.hi))
        lo, hi = min(ends), max(ends)
        inside = math.ceil(counts.n * (2 / len(grid) + 3 * REACH)) + 4
        # no progress means that the values between the ends are few
        self.inside = inside if lo < hi and (lo, hi) != (self.lo, self.hi) and inside < counts.n else 0
        self.lo, self.hi = lo, hi


def _narrowed(df: DataFrame, columns: Sequence[str], brackets: Sequence[Sequence[_Bracket]]) -> None:
    grid = [i / (4 * ordered.PARTS) for i in range(1, 4 * ordered.PARTS)]
    while True:
        wide = [(c, b) for c, row in zip(columns, brackets) for b in row if b.inside > ordered.CELL_ROWS]
        if not wide:
            return
        counts = df.agg(*[b.counts(F.col(c).cast("double"), grid).alias(f"_b{i}")
                          for i, (c, b) in enumerate(wide)]).first()
        for (_, b), found in zip(wide, counts):
            b.narrow(found, grid)


def quantile_row(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                 aggs: Sequence[Column] = ()) -> DataFrame:
    """One row: ``aggs``, then ``<column>_q<i>`` for every column and probability; null for a column
    without values."""
    columns = list(columns)
    ends = [max(p - REACH, 0.0) for p in probs] + [min(p + REACH, 1.0) for p in probs]
    doubles = [F.col(c).cast("double") for c in columns]
    first = df.agg(*aggs, *[
        F.struct(F.count(x).alias("n"), F.percentile_approx(x, ends, ACCURACY).alias("ends"),
                 F.min(x).alias("least"), F.max(x).alias("most")).alias(f"_s{i}")
        for i, x in enumerate(doubles)])
    row = first.first()
    sketches = row[len(aggs):]
    k = len(probs)
    brackets = [[_Bracket(s.n, p, s.ends[j], s.ends[k + j], s.least, s.most) for j, p in enumerate(probs)]
                if s.n else [] for s in sketches]
    _narrowed(df, columns, brackets)

    # a value's cell: odd for an end of a bracket, even for the gaps; only gaps inside brackets keep values
    parts = []
    for i, (x, own) in enumerate(zip(doubles, brackets)):
        points = sorted({e for b in own for e in (b.lo, b.hi)})
        inner = {2 * j for b in own for j in range(points.index(b.lo) + 1, points.index(b.hi) + 1)}
        cell = F.lit(0)
        for e in points:
            cell = cell + (x >= e).cast("int") + (x > e).cast("int")
        keep = (F.col("_cell") % 2 != 0) | F.col("_cell").isin(*inner) if inner else F.col("_cell") % 2 != 0
        parts.append((F.struct(F.lit(i).alias("_v"), cell.alias("_cell"), x.alias("_x")), keep))
    long = df.select(F.explode(F.array(*[p for p, _ in parts])).alias("_e")).select("_e.*").filter("_x IS NOT NULL")
    kept = F.lit(False)
    for i, (_, keep) in enumerate(parts):
        kept = kept | ((F.col("_v") == i) & keep)
    counted = long.groupBy("_v", "_cell", F.when(kept, F.col("_x")).alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
    order = Window.partitionBy("_v").orderBy("_cell", "_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = counted.withColumn("_end", F.sum("_c").over(order))

    def at(i: int, rank: int) -> Column:
        here = (F.col("_v") == i) & (F.col("_end") > rank) & (F.col("_end") - F.col("_c") <= rank)
        return F.coalesce(F.max(F.when(here, F.col("_x"))), F.raise_error(F.lit("rank outside its bracket")).cast("double"))

    quantile_columns = []
    for i, c in enumerate(columns):
        for j in range(k):
            value = F.lit(None).cast("double")
            if brackets[i]:
                b = brackets[i][j]
                low, high = (at(i, r) for r in b.ranks)
                value = low + (high - low) * F.lit(b.part)
            quantile_columns.append(value.alias(f"{c}_q{j}"))
    plain = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, first.schema.fields[:len(aggs)])]
    return spans.agg(*quantile_columns).select(*plain, "*")


def quantile_table(df: DataFrame, keys: Sequence[str], names: Mapping[str, Sequence[str]],
                   probs: Sequence[float], aggs: Sequence[Column] = ()) -> DataFrame:
    """One row per key group: keys, ``aggs``, then for each column of ``names`` one column per probability
    (null for a group whose values are all null)."""
    keys = list(keys)
    located = _located(df, keys, names, probs)
    plain = df.groupBy(*keys).agg(*(aggs or [F.count(F.lit(1)).alias("_rows")]))
    made = [n for own in names.values() for n in own]
    right = located.select(*[F.col(k).alias(f"_q{i}") for i, k in enumerate(keys)], *made)
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_q{i}"))
    return plain.join(right, match, "left").drop("_rows", *[f"_q{i}" for i in range(len(keys))])


def _located(df: DataFrame, keys: list[str], names: Mapping[str, Sequence[str]], probs: Sequence[float]) -> DataFrame:
    """One row per group with a value: keys, and each column's quantiles under its names."""
    groups, x = [f"_k{i}" for i in range(len(keys))], F.col("_x")
    ks = [*groups, "_v"]
    named = df.select(*[F.col(k).alias(g) for k, g in zip(keys, groups)],
                      *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(names)])
    celled = ordered.stacked_cut(named, [f"_x{i}" for i in range(len(names))])
    order = Window.partitionBy(*ks).orderBy("_cell")
    ranks = [(F.col("_n") - 1) * F.lit(float(p)) for p in probs]
    wanted = F.lit(False)
    for h in ranks:
        for r in (F.floor(h), F.ceil(h)):
            wanted = wanted | ((r >= F.col("_off")) & (r < F.col("_off") + F.col("_c")))
    while True:
        cells = celled.groupBy(*ks, "_cell").agg(
            F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        found = cells.select(
            *ks, "_cell", "_c", "_lo", "_hi",
            F.coalesce(F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, -1)),
                       F.lit(0)).alias("_off"),
            F.sum("_c").over(Window.partitionBy(*ks)).alias("_n")).filter(wanted)
        large = (F.col("_c") > ordered.CELL_ROWS) & (F.col("_lo") < F.col("_hi"))
        seen = Observation()
        targets = durable(found.observe(seen, F.count_if(large).alias("large")))
        if not seen.get["large"]:
            break
        celled = ordered.recut(celled, targets.filter(large).select("_cell").distinct(), "_x")

    side = targets.select(*[F.col(k).alias(f"t{k}") for k in ks], F.col("_cell").alias("t_cell"), "_off", "_n")
    match = F.col("_cell") == F.col("t_cell")
    for k in ks:
        match = match & F.col(k).eqNullSafe(F.col(f"t{k}"))
    counted = celled.join(side, match).groupBy(*ks, "_cell", "_off", "_n", "_x").agg(
        F.count(F.lit(1)).alias("_c"))
    inside = Window.partitionBy(*ks, "_cell", "_off", "_n").orderBy("_x")
    spans = counted.withColumn("_end", F.col("_off") + F.sum("_c").over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    def at(i: int, r: Column) -> Column:
        here = (F.col("_v") == i) & (r < F.col("_end")) & (r >= F.col("_end") - F.col("_c"))
        return F.max(F.when(here, x))

    picked = spans.groupBy(*groups).agg(*[e for i in range(len(names)) for e in (
        F.max(F.when(F.col("_v") == i, F.col("_n"))).alias(f"_n{i}"),
        *[at(i, F.floor(h)).alias(f"_lo{i}_{j}") for j, h in enumerate(ranks)],
        *[at(i, F.ceil(h)).alias(f"_hi{i}_{j}") for j, h in enumerate(ranks)])])
    out = []
    for i, own in enumerate(names.values()):
        for j, (p, name) in enumerate(zip(probs, own)):
            h = (F.col(f"_n{i}") - 1) * F.lit(float(p))
            low, high = F.col(f"_lo{i}_{j}"), F.col(f"_hi{i}_{j}")
            out.append((low + (high - low) * (h - F.floor(h))).alias(name))
    return picked.select(*[F.col(g).alias(k) for g, k in zip(groups, keys)], *out)


def quantiles_by(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                 names: Sequence[str], aggs: Sequence[Column] = ()) -> DataFrame:
    """One row per key group: keys, ``aggs``, then one column per probability of one value."""
    return quantile_table(df, keys, {value: names}, probs, aggs)


def quantile_scalars(df: DataFrame, value: str, probs: Sequence[float]) -> list[Column]:
    """Global quantiles as scalar columns usable in any plan."""
    q = scalar_struct(quantile_row(df, [value], probs))
    return [q[f"{value}_q{i}"] for i in range(len(probs))]


def quantiles(df: DataFrame, value: str, probs: Sequence[float]) -> DataFrame:
    """One row per probability."""
    pairs = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.col(f"{value}_q{i}").alias("valor"))
                      for i, p in enumerate(probs)])
    return quantile_row(df, [value], probs).select(F.inline(pairs))
