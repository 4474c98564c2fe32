import pytest
from pyspark.sql import functions as F

from patio.operators import dashboard, ordered, rfm

# Published result for 32 models
# (model, recency, frequency, monetary, composite score, segment).
GOLDEN = [
    ("Chevrolet Cruze", 3, 150, 84792.2204, 4.15, "Premium"),
    ("Chevrolet Onix", 1, 138, 83150.0438, 3.8, "Premium"),
    ("Chevrolet S10", 1, 159, 82990.6957, 4.7, "Premium"),
    ("Chevrolet Tracker", 7, 156, 78839.9497, 2.3, "Econômico"),
    ("Fiat Argo", 2, 171, 80124.3099, 4.1, "Alto Volume"),
    ("Fiat Pulse", 2, 175, 80655.3827, 4.55, "Premium"),
    ("Fiat Toro", 18, 130, 83378.1622, 2.8, "Baixa Relevância"),
    ("Fiat Uno", 4, 157, 79223.4048, 2.85, "Alto Volume"),
    ("Ford Ecosport", 16, 156, 81113.2878, 2.95, "Baixa Relevância"),
    ("Ford Ka", 17, 173, 80459.3342, 3.1, "Alto Volume"),
    ("Ford Ranger", 4, 155, 78403.0510, 2.1, "Econômico"),
    ("Ford Territory", 3, 156, 76250.8629, 2.35, "Econômico"),
    ("Honda Civic", 7, 130, 79827.9146, 2.15, "Baixa Relevância"),
    ("Honda Cr-V", 4, 160, 83185.2972, 4.2, "Premium"),
    ("Honda Fit", 1, 146, 83184.4888, 4.1, "Premium"),
    ("Honda Hr-V", 15, 152, 79586.3309, 2.5, "Baixa Relevância"),
    ("Hyundai Creta", 10, 146, 79692.0751, 2.45, "Baixa Relevância"),
    ("Hyundai Hb20", 4, 158, 81958.0779, 3.75, "Premium"),
    ("Hyundai I30", 18, 157, 78338.3999, 1.9, "Alto Volume"),
    ("Hyundai Tucson", 1, 164, 80628.7076, 4.1, "Alto Volume"),
    ("Renault Duster", 3, 140, 78904.2147, 2.2, "Econômico"),
    ("Renault Kwid", 17, 186, 80773.6808, 3.55, "Premium"),
    ("Renault Logan", 3, 164, 77516.0889, 2.95, "Alto Volume"),
    ("Renault Sandero", 14, 149, 80634.1073, 2.9, "Baixa Relevância"),
    ("Toyota Corolla", 1, 136, 78043.6536, 2.0, "Econômico"),
    ("Toyota Hilux", 11, 132, 84056.2505, 3.05, "Baixa Relevância"),
    ("Toyota Sw4", 9, 146, 82253.8146, 2.9, "Baixa Relevância"),
    ("Toyota Yaris", 21, 152, 77474.8920, 1.6, "Econômico"),
    ("Volkswagen Gol", 4, 142, 78705.2795, 1.95, "Econômico"),
    ("Volkswagen Polo", 1, 148, 79581.2551, 2.75, "Baixa Relevância"),
    ("Volkswagen T-Cross", 3, 142, 75902.8176, 1.75, "Econômico"),
    ("Volkswagen Virtus", 5, 166, 78460.6304, 3.15, "Alto Volume"),
]
# Published standardised columns of three of them.
NORMS = {
    "Chevrolet Cruze": (0.668697, -0.219227, 2.027957),
    "Renault Kwid": (-1.566947, 2.525872, 0.232711),
    "Toyota Yaris": (-2.205703, -0.066721, -1.240992),
}


def golden(spark):
    return spark.createDataFrame(
        [g[:4] for g in GOLDEN], "marca_modelo string, recency long, frequency long, monetary double")


def segmented(spark):
    scored = rfm.rfm_composite(rfm.rfm_scores(golden(spark)))
    return rfm.rfm_standardize(rfm.rfm_segment(scored))


@pytest.mark.parametrize("rows", [1 << 17, 5])
def test_golden(spark, rows, monkeypatch):
    monkeypatch.setattr(ordered, "CELL_ROWS", rows)
    out = {r.marca_modelo: r for r in segmented(spark).collect()}
    for name, _, _, _, score, segment in GOLDEN:
        assert (out[name].RFM_score, out[name].segmento_rfm) == (score, segment), name
    for name, norms in NORMS.items():
        assert (out[name].R_norm, out[name].F_norm, out[name].M_norm) == pytest.approx(norms, abs=2e-5)


def test_golden_reports(spark):
    df = segmented(spark)
    share = {r.segmento_rfm: r.n for r in rfm.rfm_segment_share(df).collect()}
    assert share == {"Premium": 8, "Econômico": 8, "Baixa Relevância": 9, "Alto Volume": 7}
    medians = {r.segmento_rfm: round(r.preco_med) for r in rfm.segment_stats(df).collect()}
    assert medians == {"Premium": 83070, "Alto Volume": 79223, "Econômico": 78223,
                       "Baixa Relevância": 80634}
    assert rfm.rfm_score_table(df, "marca_modelo").first().Modelo == "Chevrolet S10"
    top = [r.marca_modelo for r in rfm.rfm_top_per_segment(df, "marca_modelo").collect()
           if r.segmento_rfm == "Econômico"]
    assert top[0] == "Volkswagen T-Cross"
    assert sum(r.n for r in dashboard.rfm_cards(df).collect()) == 32


def test_repeated_edges(spark):
    same = spark.createDataFrame([(f"e{i}", 1, i, float(i)) for i in range(10)],
                                 "marca_modelo string, recency long, frequency long, monetary double")
    with pytest.raises(ValueError, match="recency"):
        rfm.rfm_scores(same)
    out = rfm.rfm_scores(same, on_ties="collapse").collect()
    assert {r.R_score for r in out} == {5} and {r.F_score for r in out} == {1, 2, 3, 4, 5}


def test_segment_rules_first_match(spark):
    df = spark.createDataFrame([
        (5, 5, 4, 4.55), (1, 5, 3, 3.1), (1, 4, 1, 1.9), (1, 1, 2, 1.45), (4, 2, 3, 2.95),
        (1, 3, 4, 2.95), (1, 1, 4, 2.35)],
        "R_score int, F_score int, M_score int, RFM_score double")
    assert [r.segmento_rfm for r in rfm.rfm_segment(df).collect()] == [
        "Premium", "Alto Volume", "Alto Volume", "Econômico", "Emergente", "Baixa Relevância",
        "Baixa Relevância"]


def test_recency_starts_at_one(spark, sf):
    from patio.sources.views import listings
    out = rfm.rfm_metrics(listings(spark, sf), "marca_modelo")
    row = out.agg(F.min("recency").alias("r"), F.sum("frequency").alias("f")).first()
    assert (row.r, row.f) == (1, 1500)
