"""Whole-table orderings without a single-task sort.

A window with no partition key (or with one hot key) puts all its rows in one task. Here the ordering
is always cut into cells that follow from the values alone:

* quantile split points of the sort column come from a mergeable sketch,
* a split value gets a cell of its own, and the gaps between split values are the other cells,
* a split value's cell is cut again by quantile splits of the unique tie-break column,
* cells that still hold more than ``CELL_ROWS`` rows are cut again with their own split points, until
  none does. A cell's size therefore does not grow with the table, whatever the distribution.

Cells are functions of the row, so a lost and recomputed task lands its rows in the same cells.
Per-cell totals give offsets, and a window inside each cell gives the rest. There is one form for every
size of table.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patio.session import durable

PARTS = 64
CELL_ROWS = 1 << 17
BLOCK_ROWS = 1 << 14


def bucket_of(x: Column, points: Column) -> Column:
    """0-based cell number of x: even for gaps between split values, odd for a split value, -1 for
    null. ``points`` is a sorted array of fewer than 2 * PARTS split values."""
    steps, size = [], PARTS
    while size:
        steps.append(F.lit(size))
        size //= 2

    # binary search: how many split values are <= x
    upto = F.aggregate(
        F.array(*steps), F.lit(0),
        lambda pos, step: F.when(F.get(points, pos + step - 1) <= x, pos + step).otherwise(pos),
    )
    # one-element transform: the search result is used three times but computed once
    cell = F.transform(F.array(upto), lambda u: F.when(
        F.get(points, u - 1) == x, u * 2 - 1).otherwise(u * 2))
    return F.when(x.isNull(), F.lit(-1)).otherwise(F.get(cell, 0))


def _bucket_of_known(x: Column, points: Sequence) -> Column:
    """``bucket_of`` for split values known to the driver, as a tree of comparisons."""
    def below(lo: int, hi: int) -> Column:  # lo to hi split values are <= x
        if lo == hi:
            return F.when(x == points[lo - 1], 2 * lo - 1).otherwise(2 * lo) if lo else F.lit(0)
        mid = (lo + hi) // 2
        return F.when(x < points[mid], below(lo, mid)).otherwise(below(mid + 1, hi))

    return F.when(x.isNull(), F.lit(-1)).otherwise(below(0, len(points)))


def _quantiles(column: str) -> Column:
    """Distinct approximate quantile values, sorted."""
    probs = [i / PARTS for i in range(1, PARTS)]
    found = F.percentile_approx(column, probs, PARTS * 20)
    return F.array_sort(F.array_distinct(F.coalesce(found, F.array())))


def _place(by: str, tie: str | None, by_points, tie_points, descending: bool, bucket=bucket_of) -> list[Column]:
    cell = bucket(F.col(by), by_points)
    inner = F.lit(0) if tie is None else F.when(
        cell % 2 != 0, bucket(F.col(tie), tie_points)).otherwise(F.lit(0))
    return [-cell if descending else cell, inner]


def first_cut(df: DataFrame, by: str, tie: str | None = None, descending: bool = False) -> DataFrame:
    """Adds ``_cell``, an array of ints whose order is the order of the rows (nulls first ascending,
    last descending)."""
    columns = [by] if tie is None else [by, tie]
    row = df.agg(*[_quantiles(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    points = [[F.lit(p).cast(df.schema[c].dataType) for p in row[f"s{i}"]] for i, c in enumerate(columns)]
    return df.withColumn("_cell", F.array(*_place(by, tie, points[0], points[-1], descending, _bucket_of_known)))


def stacked_cut(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of many columns in long form: ``_v`` (the column's number), ``_x`` (its value, nulls left
    out) and ``_cell``, cut by each column's own split points; other columns are carried."""
    row = df.agg(*[_quantiles(c).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    stacked = F.array(*[
        F.struct(F.lit(i).alias("_v"), F.col(c).alias("_x"),
                 F.array(_bucket_of_known(F.col(c), row[i]), F.lit(0)).alias("_cell"))
        for i, c in enumerate(columns)])
    others = [c for c in df.columns if c not in columns]
    return df.select(*others, F.explode(stacked).alias("_e")).select(*others, "_e.*").filter("_x IS NOT NULL")


def recut(celled: DataFrame, large: DataFrame, by: str, tie: str | None = None,
          descending: bool = False) -> DataFrame:
    """Cuts the cells in ``large`` again, each by its own quantiles."""
    named = large.select(F.col("_cell").alias("_large"))
    splits = durable(
        celled.join(named, F.col("_cell") == F.col("_large")).groupBy("_large").agg(
            _quantiles(by).alias("_bs"), _quantiles(tie or by).alias("_ts")))
    deeper = F.array(*_place(by, tie, F.col("_bs"), F.col("_ts"), descending))
    return (
        celled.join(splits, F.col("_cell") == F.col("_large"), "left")
        .withColumn("_cell", F.when(F.col("_bs").isNull(), F.col("_cell")).otherwise(
            F.concat("_cell", deeper)))
        .drop("_large", "_bs", "_ts"))


def cut(df: DataFrame, by: str, tie: str, within: Sequence[str] = (), descending: bool = False,
        aggs: Sequence[Column] = ()) -> tuple[DataFrame, DataFrame, int]:
    """The rows with ``_cell``, the stored totals of every (within, cell): ``_c`` rows, ``_lo`` and
    ``_hi`` of ``by``, and ``aggs``, and the number of cuts, two numbers of ``_cell`` each. No cell holds
    more than ``CELL_ROWS`` rows, unless they are equal in both columns."""
    celled, before, cuts = first_cut(df, by, tie, descending), None, 1
    while True:
        totals = durable(celled.groupBy(*within, "_cell").agg(
            F.count(F.lit(1)).alias("_c"), F.min(by).alias("_lo"), F.max(by).alias("_hi"), *aggs))
        large = totals.groupBy("_cell").agg(F.sum("_c").alias("_c")).filter(F.col("_c") > CELL_ROWS)
        worst = large.agg(F.count(F.lit(1)), F.max("_c")).first()
        if not worst[0] or worst == before:
            return celled, totals, cuts
        before, cuts = worst, cuts + 1
        celled = recut(celled, large, by, tie, descending)


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Null-safe equality of columns by pairs."""
    match = F.lit(True)
    for a, b in zip(left, right):
        match = match & F.col(a).eqNullSafe(F.col(b))
    return match


def _before(totals: DataFrame, within: list[str], cuts: int, sums: dict[str, str]) -> DataFrame:
    """Adds, under the new names of ``sums``, what lies before each cell.

    Cells are the leaves of a tree, one level per cut. On every level the nodes of one parent are summed
    up in order, and a cell adds what lies before its nodes from the top down. A window holds the nodes
    of one parent, whose number doesn't grow with the table.
    """
    out = totals
    for level in range(1, cuts + 1):
        nodes = totals.groupBy(*within, F.slice("_cell", 1, 2 * level).alias("_node")).agg(
            *[F.sum(c).alias(c) for c in sums])
        siblings = Window.partitionBy(*within, F.slice("_node", 1, 2 * level - 2)).orderBy("_node").rowsBetween(
            Window.unboundedPreceding, -1)
        prior = nodes.select(*[F.col(k).alias(f"_w{i}") for i, k in enumerate(within)], "_node",
                             *[F.sum(c).over(siblings).alias(f"_l{level}{name}") for c, name in sums.items()])
        match = F.slice("_cell", 1, 2 * level) == F.col("_node")
        out = out.join(prior, match & _same(within, [f"_w{i}" for i in range(len(within))])).drop(
            "_node", *[f"_w{i}" for i in range(len(within))])
    names = list(sums.values())
    levels = {n: [F.col(f"_l{level}{n}") for level in range(1, cuts + 1)] for n in names}
    return out.select(*totals.columns, *[
        F.when(F.coalesce(*own).isNotNull(), sum((F.coalesce(c, F.lit(0)) for c in own[1:]), F.coalesce(own[0], F.lit(0))))
        .alias(n) for n, own in levels.items()])


def number_rows(df: DataFrame, by: str, tie: str, within: Sequence[str] = (),
                descending: bool = False, sums: Sequence[str] = ()) -> DataFrame:
    """Add exact 1-based ``_pos`` (by, then unique tie), ``_rank`` and ``_ties`` of ``by``, the
    group size ``_n``, and ``_sum_<c>`` running sums, per ``within`` group.

    Nulls of ``by`` come first ascending and last descending. A running sum is null until the first
    value that isn't.
    """
    within = list(within)
    added = ["_pos", "_rank", "_ties", "_n"] + [f"_sum_{c}" for c in sums]
    value_order = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_first()
    celled, totals, cuts = cut(df, by, tie, within, descending,
                               [F.sum(c).alias(f"_t_{c}") for c in sums])
    cell = within + ["_cell"]

    placed = _before(totals, within, cuts, {"_c": "_off"} | {f"_t_{c}": f"_off_{c}" for c in sums}).withColumn(
        "_off", F.coalesce("_off", F.lit(0))).withColumn("_single", F.col("_lo").eqNullSafe(F.col("_hi")))
    # a value's rows lie in one cell, or in several that hold nothing else
    group = [f"_g{i}" for i in range(len(within))]
    keyed = [F.col(k).alias(g) for k, g in zip(within, group)]
    spread = placed.filter("_single").groupBy(*keyed, F.col("_lo").alias("_value")).agg(
        F.min("_off").alias("_first"), F.sum("_c").alias("_all"), F.count(F.lit(1)).alias("_cells")).filter("_cells > 1")
    offsets = placed.join(spread, F.col("_single") & _same([*within, "_lo"], [*group, "_value"]), "left").select(
        *cell, "_off", "_single", *[f"_off_{c}" for c in sums],
        F.coalesce("_first", "_off").alias("_boff"), F.coalesce("_all", "_c").alias("_bn"))
    if within:
        sizes = totals.groupBy(*keyed).agg(F.sum("_c").alias("_n"))
        offsets = offsets.join(sizes, _same(within, group)).drop(*group)
    else:
        offsets = offsets.withColumn("_n", totals.agg(F.sum("_c")).scalar())

    right = offsets.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(cell)],
                           *[c for c in offsets.columns if c not in cell])
    match = (F.col("_cell") == F.col(f"_k{len(within)}")) & _same(within, [f"_k{i}" for i in range(len(within))])
    joined = celled.join(right, match)

    # a cell is known by its offset, which sorts faster than the array
    w = Window.partitionBy(*within, "_off").orderBy(value_order, tie)
    peers = Window.partitionBy(*within, "_off").orderBy(value_order)
    out = joined.withColumn("_pos", F.col("_off") + F.row_number().over(w))
    for c in sums:
        here = F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        before = F.col(f"_off_{c}")
        out = out.withColumn(f"_sum_{c}", F.when(before.isNull(), here).otherwise(
            before + F.when(here.isNull(), F.lit(0)).otherwise(here)))
    out = out.withColumn(
        "_rank", F.when(F.col("_single"), F.col("_boff") + 1).otherwise(
            F.col("_off") + F.rank().over(peers))
    ).withColumn(
        "_ties", F.when(F.col("_single"), F.col("_bn")).otherwise(F.count(F.lit(1)).over(
            peers.rangeBetween(Window.currentRow, Window.currentRow))))
    return out.select(*df.columns, *added)


def ntile_of(pos: Column, n: Column, k: int) -> Column:
    """NTILE(k) from a 1-based position: the first n mod k tiles get one row more."""
    q, r = F.floor(n / k), n % k
    long_part = r * (q + 1)
    return F.when(pos <= long_part, F.ceil(pos / (q + 1))).otherwise(
        r + F.ceil((pos - long_part) / q)).cast("long")


def percent_rank_of(rank: Column, n: Column) -> Column:
    return F.when(n > 1, (rank - 1) / (n - 1)).otherwise(F.lit(0.0))


def with_neighbours(df: DataFrame, by: str, tie: str, before: int, after: int,
                    expressions) -> DataFrame:
    """Evaluate row-frame windows over the whole (by, tie) order.

    ``expressions(window)`` returns a list of aliased columns using frames that reach at most
    ``before`` rows back and ``after`` rows ahead. The order is cut into blocks of consecutive
    positions; rows near a block edge are copied into the neighbouring block, so every frame is
    complete inside one block.
    """
    size = max(BLOCK_ROWS, before, after, 1)
    pos = F.col("_pos") - 1
    home = F.floor(pos / size)
    offset = pos % size
    copies = F.filter(F.array(
        home,
        F.when(offset >= size - before, home + 1),
        F.when(offset < after, home - 1),
    ), lambda b: b.isNotNull())
    placed = (
        number_rows(df, by, tie)
        .select(*df.columns, "_pos", home.alias("_home"), F.explode(copies).alias("_block"))
    )
    w = Window.partitionBy("_block").orderBy("_pos")
    return (
        placed.select(*df.columns, "_home", "_block", *expressions(w))
        .filter(F.col("_home") == F.col("_block")).drop("_home", "_block")
    )
