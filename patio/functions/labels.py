"""Label expressions: ordered when-chains and code lookups."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from patio.columns import BAND_CUTS, BAND_LABELS

# Label texts.
QUARTILE_LABELS = [
    "Q1 — Mais baratos", "Q2 — Abaixo da mediana", "Q3 — Acima da mediana", "Q4 — Mais caros",
]
ABOVE_MEAN, BELOW_MEAN = "Acima da média", "Abaixo da média"
HIGH_OUTLIER, LOW_OUTLIER = "Outlier alto", "Outlier baixo"
STRENGTH = [(0.7, "FORTE"), (0.4, "MODERADA"), (0.2, "FRACA")]
NO_STRENGTH = "DESPREZÍVEL"
SKEW_LABELS = ("assimetria positiva", "assimetria negativa", "simétrica")
KURTOSIS_LABELS = ("leptocúrtica", "platicúrtica", "mesocúrtica")


def price_band(price: Column, cuts: Sequence[float] = BAND_CUTS,
               labels: Sequence[str] = BAND_LABELS) -> Column:
    """Half-open bands in ascending order; null falls in the last one."""
    out = F.when(price < cuts[0], F.lit(labels[0]))
    for cut, label in zip(cuts[1:], labels[1:]):
        out = out.when(price < cut, F.lit(label))
    return out.otherwise(F.lit(labels[len(cuts)]))


def relative_label(x: Column, mean: Column) -> Column:
    return F.when(x > mean, F.lit(ABOVE_MEAN)).otherwise(F.lit(BELOW_MEAN))


def quartile_label(quartile: Column) -> Column:
    return F.get(F.array(*map(F.lit, QUARTILE_LABELS)), quartile.cast("int") - 1)


def outlier_label(x: Column, mean: Column, std: Column, k: float = 2.0) -> Column:
    return (
        F.when(x > mean + F.lit(k) * std, F.lit(HIGH_OUTLIER))
        .when(x < mean - F.lit(k) * std, F.lit(LOW_OUTLIER))
    )


def corr_strength(r: Column) -> Column:
    out = F.when(r.isNull(), F.lit(None).cast("string"))
    for bound, label in STRENGTH:
        out = out.when(F.abs(r) >= bound, F.lit(label))
    return out.otherwise(F.lit(NO_STRENGTH))


def _three_way(x: Column, bound: float, labels: tuple[str, str, str]) -> Column:
    high, low, mid = labels
    return F.when(x > bound, F.lit(high)).when(x < -bound, F.lit(low)).otherwise(F.lit(mid))


def shape_label(skew: Column, kurt: Column) -> tuple[Column, Column]:
    return _three_way(skew, 0.5, SKEW_LABELS), _three_way(kurt, 1.0, KURTOSIS_LABELS)


def ordinal_encode(x: Column, codes: Mapping[str, int]) -> Column:
    """Value to code through a literal map; unmapped values give null."""
    table = F.create_map(*[F.lit(v) for pair in codes.items() for v in pair])
    return F.try_element_at(table, x)
