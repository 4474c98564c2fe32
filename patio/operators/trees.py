"""A regression tree grown level by level from count tables and kept as a table of nodes.

Every level is one pass: rows find their node by the splits so far, and one aggregate with map-side combine
counts them by (node, feature, interval between candidate thresholds). The driver sees those counts only,
at most 2^depth x features x bins rows, whatever the number of table rows.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patio.operators.quantiles import quantiles_by
from patio.operators.summaries import rows

BINS = 32
NODES = ("no int, profundidade int, variavel string, limiar double, linhas long, media double, "
         "desvio double, ganho double")


@dataclass(frozen=True)
class Part:
    """Row count, mean and squared deviations of a set of rows."""

    n: int = 0
    mean: float = 0.0
    squares: float = 0.0

    def __add__(self, other: "Part") -> "Part":
        n = self.n + other.n
        if not n:
            return self
        gap = other.mean - self.mean
        return Part(n, self.mean + gap * other.n / n, self.squares + other.squares + gap * gap * self.n * other.n / n)


def split_points(df: DataFrame, features: Sequence[str], bins: int = BINS, digits: int = 6) -> dict[str, list[float]]:
    """Candidate thresholds per feature: its exact quantiles at 1/bins, 2/bins and so on, rounded, without
    repeats. A feature without values has none."""
    names = [f"q{i}" for i in range(1, bins)]
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("f"), F.col(c).cast("double").alias("v")) for c in features])))
    found = quantiles_by(long, ["f"], "v", [i / bins for i in range(1, bins)], names).collect()
    points = {r.f: sorted({round(r[q], digits) for q in names if r[q] is not None}) for r in found}
    return {c: points.get(c, []) for c in features}


def _walk(splits: Mapping[int, tuple[str, float]], node: int, leaf) -> Column:
    if node not in splits:
        return leaf(node)
    feature, point = splits[node]
    return F.when(F.col(feature) <= point, _walk(splits, 2 * node, leaf)).otherwise(_walk(splits, 2 * node + 1, leaf))


def _counts(df: DataFrame, label: str, points: Mapping[str, Sequence[float]], splits: Mapping[int, tuple[str, float]]
            ) -> dict[tuple[int, str], dict[int, Part]]:
    """Parts by node, feature and the number of the feature's thresholds below the value; null counts as
    the largest value."""
    cells = []
    for c, ts in points.items():
        below = sum(((F.col(c) > t).cast("int") for t in ts), F.lit(0))
        cells.append(F.struct(F.lit(c).alias("f"), F.coalesce(below, F.lit(len(ts))).alias("b")))
    node = _walk(splits, 1, lambda i: F.lit(i))
    y = F.col("y")
    counted = (
        df.select(node.alias("node"), F.col(label).cast("double").alias("y"), F.inline(F.array(*cells)))
        .groupBy("node", "f", "b").agg(rows().alias("n"), F.avg(y).alias("mean"), F.var_pop(y).alias("var")))
    out: dict[tuple[int, str], dict[int, Part]] = {}
    for r in counted.collect():
        out.setdefault((r.node, r.f), {})[r.b] = Part(r.n, r.mean, r["var"] * r.n)
    return out


def grow_tree(df: DataFrame, features: Sequence[str], label: str, depth: int = 3, least: int = 20,
              points: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """The tree as rows (``no``, ``profundidade``, ``variavel``, ``limiar``, ``linhas``, ``media``, ``desvio``,
    ``ganho``). Node n has the children 2n (value <= threshold) and 2n + 1 (above it, or null).

    A node takes the split with the largest fall of squared deviations, as a share of those of all rows
    rounded to nine digits; ties go to the first feature, then to the smallest threshold. Both sides need
    ``least`` rows. ``ganho`` is that share, null at a leaf, as are variable and threshold. Rows without a
    label don't count; without any row there is no node.
    """
    features = list(features)
    labelled = df.filter(F.col(label).isNotNull())
    points = points if points is not None else split_points(labelled, features)
    points = {c: sorted(points[c]) for c in features}
    splits: dict[int, tuple[str, float]] = {}
    gains: dict[int, float] = {}
    parts: dict[int, Part] = {}
    fresh = {1}
    for level in range(max(depth, 1)):
        counts = _counts(labelled, label, points, splits)
        if level == 0 and counts:
            parts[1] = sum(counts[1, features[0]].values(), Part())
        grown = set()
        for node in sorted(fresh & set(parts)):
            best = None
            for at, c in enumerate(features):
                cells = counts[node, c]
                low = Part()
                for b, t in enumerate(points[c]):
                    low = low + cells.get(b, Part())
                    high = sum((p for i, p in cells.items() if i > b), Part())
                    if min(low.n, high.n) < least or not parts[1].squares or depth < 1:
                        continue
                    gain = round(low.n * high.n / (low.n + high.n) * (low.mean - high.mean) ** 2 / parts[1].squares, 9)
                    if gain > 0 and (best is None or (-gain, at, t) < best[0]):
                        best = ((-gain, at, t), low, high)
            if best:
                (gain, at, t), low, high = best
                splits[node], gains[node] = (features[at], t), -gain
                parts[2 * node], parts[2 * node + 1] = low, high
                grown |= {2 * node, 2 * node + 1}
        fresh = grown
        if not fresh:
            break
    table = [(n, n.bit_length() - 1, *splits.get(n, (None, None)), p.n, p.mean, (max(p.squares, 0.0) / p.n) ** 0.5,
              gains.get(n)) for n, p in sorted(parts.items())]
    return df.sparkSession.createDataFrame(table, NODES)


def predict_tree(df: DataFrame, tree: DataFrame, keep: Sequence[str], model: str = "arvore") -> DataFrame:
    """(modelo, kept columns, prediction, no): each row's leaf and its mean. A tree without nodes predicts null."""
    nodes = {r.no: r for r in tree.collect()}
    splits = {n: (r.variavel, r.limiar) for n, r in nodes.items() if r.variavel is not None}
    mean = _walk(splits, 1, lambda i: F.lit(nodes[i].media if i in nodes else None).cast("double"))
    return df.select(F.lit(model).alias("modelo"), *keep, mean.alias("prediction"),
                     _walk(splits, 1, lambda i: F.lit(i)).alias("no"))


def tree_importance(tree: DataFrame) -> DataFrame:
    """(feature, importancia): each feature's share of the gains of all splits."""
    split = tree.filter("variavel IS NOT NULL")
    total = split.select(F.sum("ganho")).scalar()
    return split.groupBy(F.col("variavel").alias("feature")).agg((F.sum("ganho") / total).alias("importancia"))
