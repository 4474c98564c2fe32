import datetime as dt
import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from patio.functions import dates, labels, money, numeric, special, text


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"x {kind}").select(
        expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw, want", [
    ("R$ 1.234,56", 1234.56), ("1,234.56", 1234.56), ("R$ 950,00", 950.0), ("$85000.12", 85000.12),
    ("1.234.567", None), ("$1,234", 1.234), ("-5.5", -5.5), ("R$ 1.234,56", 1234.56),
    ("abc", None), ("", None), (None, None), ("1.0d", None), ("nan", None), ("inf", None),
    ("1_000", None), ("1e3", 1000.0), ("R$ 12.345.678,90", 12345678.90),
])
def test_parse_price(spark, raw, want):
    assert one(spark, raw, "string", money.parse_price) == want


@pytest.mark.parametrize("raw, want", [
    ("2022-03-04", dt.date(2022, 3, 4)), ("04/03/2022", dt.date(2022, 3, 4)),
    ("2022/03/04", dt.date(2022, 3, 4)), ("03-04-2022", dt.date(2022, 3, 4)),
    ("2022-3-4", dt.date(2022, 3, 4)), ("22-03-04", None), ("31-02-2022", None),
    ("30/02/2022", None), ("bad", None), (None, None), ("  2022-03-04 ", dt.date(2022, 3, 4)),
])
def test_parse_date(spark, raw, want):
    assert one(spark, raw, "string", dates.parse_date_multi) == want


@pytest.mark.parametrize("raw, want", [
    ("honda HR-V", "Honda Hr-V"), ("hyundai i30", "Hyundai I30"), ("ford EcoSport", "Ford Ecosport"),
    ("4x4 t-cross", "4X4 T-Cross"), ("ELÉTRICO", "Elétrico"), (None, "Padrão"),
    ("  gol\t", "Gol"), ("straße o'neil", "Straße O'Neil"),
])
def test_normalize_text(spark, raw, want):
    assert one(spark, raw, "string", lambda x: text.normalize_text(x, "Padrão")) == want
    if raw is not None:
        assert raw.strip().title() == want


def test_text_repair_and_synonyms(spark):
    assert one(spark, "Carro Disponvel, No Informado�", "string",
               text.repair_text) == "Carro Disponível, Não Informado"
    assert one(spark, "Eletrico", "string",
               lambda x: text.unify_synonyms(x, {"Eletrico": "Elétrico"})) == "Elétrico"
    assert one(spark, "  Honda  Civic", "string", text.brand_of) == "Honda"


@pytest.mark.parametrize("raw, want", [
    ("é “ok”".encode(), "é “ok”"), ("é “ok” €".encode("cp1252"), "é “ok” €"),
    (b"plain", "plain"), (b"\xff\xfe", "ÿþ"),
])
def test_decode(spark, raw, want):
    assert one(spark, bytearray(raw), "binary", text.decode_text) == want


def test_money_formats(spark):
    assert one(spark, 1234567.891, "double", money.format_brl) == "R$ 1.234.567,89"
    assert one(spark, -5.0, "double", money.format_brl) == "R$ -5,00"
    assert [one(spark, v, "double", money.format_brl_short) for v in (1.25e6, 80837.0, 12.0)] == [
        "R$ 1.3M", "R$ 81k", "R$ 12"]


def test_rounding(spark):
    assert one(spark, 2.675, "double", numeric.round_stable) == 2.68
    assert one(spark, 0.1 + 0.2 + 2.375, "double", numeric.round_stable) == 2.68
    assert one(spark, -2.5, "double", numeric.round_half_up) == -2.0
    assert one(spark, 2.5, "double", numeric.round_half_up) == 3.0
    assert one(spark, 5.0, "double", lambda x: numeric.pct_change(x, F.lit(0.0))) is None


def test_labels(spark):
    band = [one(spark, v, "double", labels.price_band) for v in (49999.99, 50000.0, 90000.0, 130000.0)]
    assert band == labels.BAND_LABELS
    assert one(spark, None, "double", labels.price_band) == "4_Luxo"
    assert [one(spark, v, "double", labels.corr_strength) for v in (-0.7, 0.5, 0.2, 0.1)] == [
        "FORTE", "MODERADA", "FRACA", "DESPREZÍVEL"]
    assert one(spark, "Flex", "string", lambda x: labels.ordinal_encode(x, {"Flex": 2})) == 2
    assert one(spark, "Outro", "string", lambda x: labels.ordinal_encode(x, {"Flex": 2})) is None


def test_normal_quantile(spark):
    for p in (1e-12, 1e-4, 0.02, 0.3, 0.5, 0.7, 0.975, 1 - 1e-9):
        got = one(spark, p, "double", special.normal_ppf)
        assert math.isclose(got, NormalDist().inv_cdf(p), rel_tol=1e-9, abs_tol=1e-12)


def test_tail_probabilities(spark):
    def tail(f, d1, d2):
        return one(spark, f, "double", lambda x: special.f_sf("x", str(d1), str(d2)))

    for f, d2 in ((0.01, 10), (1.08, 4886), (3.0, 12), (50.0, 100), (1.2, 10**9)):
        # closed forms for two and four numerator degrees of freedom
        y = -d2 / 2 * math.log1p(2 * f / d2)
        assert math.isclose(tail(f, 2, d2), math.exp(y), rel_tol=1e-7)
        odds = 4 * f / d2
        want = math.exp(-d2 / 2 * math.log1p(odds)) * (1 + d2 / 2 * odds / (1 + odds))
        assert math.isclose(tail(f, 4, d2), want, rel_tol=1e-7)
    t = one(spark, 1.1, "double", lambda x: special.t_two_sided("x", "1e11D"))
    assert math.isclose(t, 2 * (1 - NormalDist().cdf(1.1)), rel_tol=1e-6)
    cauchy = one(spark, 2.0, "double", lambda x: special.t_two_sided("x", "1D"))
    assert math.isclose(cauchy, 1 - 2 / math.pi * math.atan(2.0), rel_tol=1e-9)


def test_brand_is_split_at_any_white_space(spark):
    from patio.functions.text import brand_of
    df = spark.createDataFrame([("Honda\tCivic",), ("Honda\u00a0Fit",), ("  Honda City",), ("Honda",)], "x string")
    assert {r[0] for r in df.select(brand_of(F.col("x"))).collect()} == {"Honda"}


def test_default_repairs(spark):
    from patio.functions.text import repair_text
    df = spark.createDataFrame([("El\ufffdtrico",), ("El\xef\xbf\xbd\xef\xbf\xbd\xef\xbf\xbdtrico",), ("Eltrico",)], "x string")
    assert {r[0] for r in df.select(repair_text(F.col("x"))).collect()} == {"Elétrico"}
