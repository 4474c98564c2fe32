"""Descriptive statistics, tests, correlation and the data behind statistical charts."""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patio.columns import PRICE, YEAR
from patio.functions.labels import corr_strength, shape_label
from patio.functions.numeric import round_stable
from patio.functions.special import f_sf, normal_ppf, t_two_sided
from patio.operators.ordered import number_rows
from patio.operators.quantiles import quantile_row, quantile_scalars, quantiles_by
from patio.session import durable, scalar_struct

KERNEL_REACH = 39.0  # exp(-39**2 / 2) is zero in double precision


def describe_numeric(df: DataFrame, columns: Sequence[str] = (PRICE, YEAR)) -> DataFrame:
    """Mean, median, sample standard deviation, minimum and maximum, one row per column."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}_m"), F.stddev_samp(x).alias(f"{c}_s"),
                 F.min(x).alias(f"{c}_lo"), F.max(x).alias(f"{c}_hi")]
    wide = quantile_row(df, columns, [0.5], aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("variavel"), round_stable(F.col(f"{c}_m"), 4).alias("media"),
            round_stable(F.col(f"{c}_q0"), 4).alias("mediana"),
            round_stable(F.col(f"{c}_s"), 4).alias("desvio_padrao"),
            F.col(f"{c}_lo").alias("minimo"), F.col(f"{c}_hi").alias("maximo"))
        for c in columns])))


def describe_full(df: DataFrame, column: str, digits: int = 3) -> DataFrame:
    """Count, mean, sample std, minimum, quartiles and maximum as (estatistica, valor) rows."""
    x = F.col(column).cast("double")
    wide = quantile_row(df, [column], [0.25, 0.5, 0.75], [
        F.count(x).cast("double").alias("count"), F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")])
    names = {"count": "count", "mean": "mean", "std": "std", "min": "min",
             "25%": f"{column}_q0", "50%": f"{column}_q1", "75%": f"{column}_q2", "max": "max"}
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("estatistica"), round_stable(F.col(v), digits).alias("valor"))
        for k, v in names.items()])))


def _moments(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.count(value).cast("double").alias("n"), F.skewness(value).alias("g1"),
                  F.kurtosis(value).alias("g2"))


def shape_stats(df: DataFrame, value: str = PRICE) -> DataFrame:
    """Bias-corrected skewness and excess kurtosis with their labels."""
    n, g1, g2 = F.col("n"), F.col("g1"), F.col("g2")
    skew = g1 * F.sqrt(n * (n - 1)) / (n - 2)
    kurt = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)
    both = _moments(df, value).select(skew.alias("s"), kurt.alias("k"))
    skew_text, kurt_text = shape_label(F.col("s"), F.col("k"))
    return both.select(
        round_stable(F.col("s"), 6).alias("assimetria"), round_stable(F.col("k"), 6).alias("curtose"),
        skew_text.alias("forma_assimetria"), kurt_text.alias("forma_curtose"))


def normality_test(df: DataFrame, value: str = PRICE, alpha: float = 0.05) -> DataFrame:
    """D'Agostino-Pearson omnibus test from the sample moments (n >= 8)."""
    n, g1, g2 = F.col("n"), F.col("g1"), F.col("g2")
    m = _moments(df, value)

    y = g1 * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / (
        (n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + F.sqrt(2 * (beta2 - 1))
    delta = 1 / F.sqrt(0.5 * F.log(w2))
    root = F.sqrt(2 / (w2 - 1))
    z_skew = delta * F.asinh(y / root)

    expected = 3 * (n - 1) / (n + 1)
    variance = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (g2 + 3 - expected) / F.sqrt(variance)
    third = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(
        6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / third * (2 / third + F.sqrt(1 + 4 / (third * third)))
    denom = 1 + x * F.sqrt(2 / (a - 4))
    cube = F.signum(denom) * F.pow((1 - 2 / a) / F.abs(denom), F.lit(1 / 3))
    z_kurt = (1 - 2 / (9 * a) - cube) / F.sqrt(2 / (9 * a))

    out = m.select((z_skew * z_skew + z_kurt * z_kurt).alias("k2"))
    p = F.exp(-F.col("k2") / 2)
    return out.select(round_stable(F.col("k2"), 4).alias("k2"), round_stable(p, 8).alias("p"),
                      (p >= alpha).alias("normal"))


def _fence_columns(df: DataFrame, value: str) -> tuple[Column, Column, Column, Column]:
    q1, q3 = quantile_scalars(df, value, [0.25, 0.75])
    reach = (q3 - q1) * 1.5
    return q1, q3, q1 - reach, q3 + reach


def iqr_fences(df: DataFrame, value: str = PRICE) -> DataFrame:
    q1, q3, low, high = _fence_columns(df, value)
    x = F.col(value)
    outside = F.sum(F.when((x < low) | (x > high), 1).otherwise(0))
    counts = df.agg(F.count(F.lit(1)).alias("n"), outside.alias("outliers"))
    return counts.select(
        round_stable(q1, 4).alias("q1"), round_stable(q3, 4).alias("q3"),
        round_stable(q3 - q1, 4).alias("iqr"), round_stable(low, 4).alias("limite_inferior"),
        round_stable(high, 4).alias("limite_superior"), "outliers",
        round_stable(F.col("outliers") * F.lit(100.0) / F.col("n"), 2).alias("pct"),
        (F.col("n") - F.col("outliers")).alias("normais"))


def iqr_split(df: DataFrame, value: str = PRICE) -> DataFrame:
    """Every row with a flag: strictly outside the 1.5 IQR fences or not."""
    _, _, low, high = _fence_columns(df, value)
    x = F.col(value)
    return df.withColumn("outlier_iqr", F.coalesce((x < low) | (x > high), F.lit(False)))


def iqr_outliers(df: DataFrame, value: str = PRICE) -> DataFrame:
    _, _, low, high = _fence_columns(df, value)
    return df.filter((F.col(value) < low) | (F.col(value) > high))


def with_zscore(df: DataFrame, value: str = PRICE) -> DataFrame:
    """Absolute z-score with the population standard deviation; null stays null."""
    s = scalar_struct(df.agg(F.avg(value).alias("m"), F.stddev_pop(value).alias("d")))
    return df.withColumn("z", F.try_divide(F.abs(F.col(value) - s["m"]), s["d"]))


def zscore_outliers(df: DataFrame, value: str = PRICE, threshold: float = 3.0) -> DataFrame:
    return with_zscore(df, value).filter(F.col("z") > threshold).withColumn(
        "z_score", round_stable(F.col("z"), 4)).drop("z")


def nlargest_outliers(df: DataFrame, value: str, tie: str, n: int = 10,
                      method: str = "iqr") -> DataFrame:
    if method == "iqr":
        return iqr_outliers(df, value).orderBy(F.desc(value), tie).limit(n)
    return zscore_outliers(df, value).orderBy(F.desc("z_score"), tie).limit(n)


def outlier_agreement(df: DataFrame, value: str = PRICE, threshold: float = 3.0) -> DataFrame:
    """How often the IQR rule and the z rule name the same rows."""
    _, _, low, high = _fence_columns(df, value)
    x = F.col(value)
    flagged = with_zscore(df, value).filter(x.isNotNull()).select(
        ((x < low) | (x > high)).alias("i"), F.coalesce(F.col("z") > threshold, F.lit(False))
        .alias("z"))
    i, z = F.col("i"), F.col("z")

    def n(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    counts = flagged.agg(n(i & ~z).alias("so_iqr"), n(~i & z).alias("so_z"), n(i & z).alias("ambos"),
                         n(~i & ~z).alias("normais"))
    union = F.col("so_iqr") + F.col("so_z") + F.col("ambos")
    return counts.select("*", round_stable(
        F.col("ambos") * F.lit(100.0) / F.nullif(union, F.lit(0)), 1).alias("concordancia_pct"))


def sigma_limits(df: DataFrame, value: str = PRICE, k: float = 3.0) -> DataFrame:
    """Mean -/+ k sample standard deviations."""
    m, s = F.avg(value), F.stddev_samp(value)
    return df.agg(round_stable(m - k * s, 4).alias("limite_inferior"),
                  round_stable(m + k * s, 4).alias("limite_superior"))


def _matrix(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            r = F.lit(1.0) if i == j else F.col(f"r{min(i, j)}_{max(i, j)}")
            cells.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"),
                                  round_stable(r, 6).alias("r")))
    return wide.select(F.inline(F.array(*cells))).withColumn("forca", corr_strength(F.col("r")))


def _pair_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[
        F.corr(columns[i], columns[j]).alias(f"r{i}_{j}")
        for i in range(len(columns)) for j in range(i + 1, len(columns))])


def pearson_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations, all pairs in one aggregate."""
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return _matrix(_pair_correlations(doubles, columns), columns)


def average_ranks(df: DataFrame, columns: Sequence[str], tie: str) -> DataFrame:
    """``tie``, the columns as doubles and ``<column>_rank``: 1-based ranks, ties averaged, over rows
    complete in all columns.

    A rank follows from the value alone, so the distinct values of all columns, with their numbers of rows, are
    ordered in one pass in long form, each column by itself. Every row (one per ``tie``) then looks its ranks up
    in the stored tables of (value, rank).
    """
    columns = list(columns)
    doubles = df.dropna(subset=columns).select(tie, *[F.col(c).cast("double").alias(c) for c in columns])
    counted = durable(doubles.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("_v"), F.col(c).alias("_x")) for i, c in enumerate(columns)]))).groupBy("_v", "_x").agg(
        F.count(F.lit(1)).alias("_c")))
    ranks = durable(number_rows(counted, "_x", "_v", within=["_v"], sums=["_c"]).select(
        "_v", "_x", (F.col("_sum__c") - (F.col("_c") - 1) / 2.0).alias("_r")))
    ranked = doubles.groupBy(tie).agg(*[F.max(c).alias(c) for c in columns])
    for i, c in enumerate(columns):
        own = durable(ranks.filter(F.col("_v") == i).select("_x", F.col("_r").alias(f"{c}_rank")))
        ranked = ranked.join(own, F.col(c) == F.col("_x")).drop("_x")
    return ranked


def spearman_matrix(df: DataFrame, columns: Sequence[str], tie: str) -> DataFrame:
    """Spearman correlations on rows complete in all columns."""
    ranked = average_ranks(df, columns, tie)
    plain = ranked.select(*[F.col(f"{c}_rank").alias(c) for c in columns])
    return _matrix(_pair_correlations(plain, columns), columns)


def corr_significance(df: DataFrame, x: str, y: str, tie: str) -> DataFrame:
    """Pearson and Spearman r of two columns with two-sided p-values."""
    ranked = average_ranks(df.select(tie, x, y), [x, y], tie)
    wide = ranked.agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.corr(x, y).alias("pearson"),
        F.corr(f"{x}_rank", f"{y}_rank").alias("spearman"))
    rows = wide.select("n", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metodo"), F.col(m).alias("r0")) for m in ("pearson", "spearman")])))
    r, free = F.col("r0"), F.col("n") - 2
    tested = rows.select("metodo", "r0", free.alias("gl"), (r * F.sqrt(free / (1 - r * r))).alias("t"))
    return tested.select("metodo", round_stable(r, 6).alias("r"),
                       round_stable(t_two_sided("t", "gl"), 6).alias("p"),
                       corr_strength(r).alias("forca"))


def anova_oneway(df: DataFrame, group: str, value: str = PRICE,
                 exclude: Sequence[str] = ()) -> DataFrame:
    """F statistic and p-value from per-group count, mean and variance."""
    kept = df.filter(~F.col(group).isin(list(exclude))) if exclude else df
    groups = kept.filter(F.col(value).isNotNull()).groupBy(group).agg(
        F.count(value).cast("double").alias("n"), F.avg(value).alias("m"),
        F.var_pop(value).alias("v"))
    total = groups.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).cast("double").alias("k"),
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"))
    s = scalar_struct(total)
    sums = groups.agg(
        F.sum(F.col("n") * F.pow(F.col("m") - s["mean"], 2)).alias("ssb"),
        F.sum(F.col("n") * F.col("v")).alias("ssw"),
        F.max(s["k"] - 1).alias("d1"), F.max(s["n"] - s["k"]).alias("d2"))
    f = (F.col("ssb") / F.col("d1")) / (F.col("ssw") / F.col("d2"))
    tested = sums.select(f.alias("f0"), "d1", "d2")
    return tested.select(
        round_stable(F.col("f0"), 6).alias("f"),
        round_stable(f_sf("f0", "d1", "d2"), 6).alias("p"),
        F.col("d1").cast("long").alias("gl_entre"), F.col("d2").cast("long").alias("gl_dentro"))


def ols_trend(df: DataFrame, x: str = YEAR, y: str = PRICE, scale: float = 1000.0) -> DataFrame:
    """Least-squares slope and intercept of y / scale on x, and the range of x."""
    target = F.col(y) / scale
    return df.agg(
        F.regr_slope(target, F.col(x).cast("double")).alias("inclinacao"),
        F.regr_intercept(target, F.col(x).cast("double")).alias("intercepto"),
        F.min(x).cast("double").alias("x_min"), F.max(x).cast("double").alias("x_max"))


def ols_line(trend: DataFrame, points: int = 100) -> DataFrame:
    """Evenly spaced points of the fitted line over the range of x."""
    i = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("ponto")
    spread = trend.select("*", i)
    x = F.col("x_min") + (F.col("x_max") - F.col("x_min")) * F.col("ponto") / (points - 1)
    return spread.select("ponto", x.alias("x"),
                         (F.col("inclinacao") * x + F.col("intercepto")).alias("y"))


def histogram(df: DataFrame, value: str = PRICE, bins: int = 50, scale: float = 1.0) -> DataFrame:
    """Equal-width bins between minimum and maximum, last bin closed, empty bins kept."""
    data = df.select((F.col(value) / scale).alias("x")).filter(F.col("x").isNotNull())
    ends = data.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    s = scalar_struct(ends.select(
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi")))
    slot = F.least(F.floor((F.col("x") - s["lo"]) * bins / (s["hi"] - s["lo"])), F.lit(bins - 1))
    counts = data.groupBy(slot.cast("long").alias("faixa")).agg(F.count(F.lit(1)).alias("c"))
    width = (s["hi"] - s["lo"]) / bins
    return (
        df.sparkSession.range(bins).withColumnRenamed("id", "faixa").join(counts, "faixa", "left")
        .select("faixa", round_stable(s["lo"] + width * F.col("faixa"), 6).alias("inicio"),
                round_stable(s["lo"] + width * (F.col("faixa") + 1), 6).alias("fim"),
                F.coalesce("c", F.lit(0)).alias("n"))
    )


def kde_curve(df: DataFrame, value: str = PRICE, points: int = 300, scale: float = 1.0
              ) -> DataFrame:
    """Gaussian kernel density (Scott bandwidth) on an even grid from minimum to maximum.

    A value only meets the grid points its kernel reaches; the rest would add exactly zero. Sums of the
    grid points combine on the map side, so no row is shuffled. Equal values have no density: the curve
    is null then.
    """
    data = df.select((F.col(value) / scale).alias("x")).filter(F.col("x").isNotNull())
    s = scalar_struct(data.agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").cast("double").alias("n"),
        F.stddev_samp("x").alias("sd")))
    h = s["sd"] * F.pow(s["n"], F.lit(-0.2))
    step = (s["hi"] - s["lo"]) / (points - 1)
    reach = h * KERNEL_REACH
    first = F.greatest(F.floor(F.try_divide(F.col("x") - reach - s["lo"], step)), F.lit(0))
    last = F.least(F.ceil(F.try_divide(F.col("x") + reach - s["lo"], step)), F.lit(points - 1))
    near = data.filter(step > 0).select("x", F.explode(F.sequence(first, last)).alias("ponto"))
    u = F.try_divide(s["lo"] + step * F.col("ponto") - F.col("x"), h)
    sums = near.groupBy("ponto").agg(F.sum(F.exp(u * u * -0.5)).alias("k"))
    density = F.try_divide(F.coalesce("k", F.lit(0.0)), s["n"] * h * math.sqrt(2 * math.pi))
    return (
        df.sparkSession.range(points).withColumnRenamed("id", "ponto").join(sums, "ponto", "left")
        .select("ponto", round_stable(s["lo"] + step * F.col("ponto"), 6).alias("x"),
                round_stable(density, 9).alias("densidade"))
    )


def boxplot_fliers(df: DataFrame, group: str, value: str, keep: Sequence[str]) -> DataFrame:
    """The rows beyond the whiskers of their group's box."""
    boxes = quantiles_by(df, [group], value, [0.25, 0.75], ["q1", "q3"]).select(
        F.col(group).alias("_g"), "q1", "q3")
    x, reach = F.col(value), (F.col("q3") - F.col("q1")) * 1.5
    joined = df.join(boxes, F.col(group).eqNullSafe(F.col("_g")))
    return joined.filter((x < F.col("q1") - reach) | (x > F.col("q3") + reach)).select(*keep)


def boxplot_stats(df: DataFrame, group: str, value: str = PRICE) -> DataFrame:
    """Quartiles, whisker ends (furthest data within 1.5 IQR) and outside counts per group."""
    boxes = quantiles_by(df, [group], value, [0.25, 0.5, 0.75], ["q1", "mediana", "q3"]).select(
        F.col(group).alias("_g"), "q1", "mediana", "q3")
    x = F.col(value)
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = (x >= F.col("q1") - reach) & (x <= F.col("q3") + reach)
    joined = df.select(group, value).join(boxes, F.col(group).eqNullSafe(F.col("_g")))
    return joined.groupBy(group).agg(
        round_stable(F.max("q1"), 4).alias("q1"), round_stable(F.max("mediana"), 4).alias("mediana"),
        round_stable(F.max("q3"), 4).alias("q3"),
        F.min(F.when(inside, x)).alias("bigode_inferior"),
        F.max(F.when(inside, x)).alias("bigode_superior"),
        F.sum(F.when(~inside, 1).otherwise(0)).alias("fora"), F.avg(value).alias("_m"),
    ).orderBy(F.desc("mediana"), group).drop("_m")


def qq_points(df: DataFrame, value: str, tie: str) -> DataFrame:
    """Normal probability plot: theoretical quantile (Filliben medians) and ordered value."""
    numbered = number_rows(df.select(tie, value).filter(F.col(value).isNotNull()), value, tie)
    n, i = F.col("_n").cast("double"), F.col("_pos").cast("double")
    top = F.pow(F.lit(0.5), F.lit(1.0) / n)
    p = F.when(F.col("_pos") == F.col("_n"), top).when(F.col("_pos") == 1, F.lit(1.0) - top).otherwise(
        (i - 0.3175) / (n + 0.365))
    return numbered.select("_pos", p.alias("p"), value).select(
        F.col("_pos").alias("ordem"), normal_ppf(F.col("p")).alias("teorico"),
        F.col(value).alias("observado"))


def qq_fit(points: DataFrame) -> DataFrame:
    return points.agg(
        F.regr_slope("observado", "teorico").alias("inclinacao"),
        F.regr_intercept("observado", "teorico").alias("intercepto"),
        F.corr("observado", "teorico").alias("r"))
