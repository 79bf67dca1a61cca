import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.columns import METRICS
from stayline.operators import business, evaluate, risk
from stayline.operators.explain import cum_importance, features_to_reach

# Fixed published results of the four models on 1,409 test rows: counts, then rounded metrics.
PUBLISHED = {
    "lr": ((846, 189, 129, 245), (0.7743, 0.5645, 0.6551, 0.6064)),
    "rf": ((795, 240, 101, 273), (0.7580, 0.5322, 0.7299, 0.6156)),
    "xgb": ((829, 206, 127, 247), (0.7637, 0.5453, 0.6604, 0.5973)),
    "lgbm": ((829, 206, 132, 242), (0.7601, 0.5402, 0.6471, 0.5888)),
}
PUBLISHED_AUC = {"lr": 0.8386, "rf": 0.8407, "xgb": 0.8328, "lgbm": 0.8332}
# Fixed published mean attributions of the 20 strongest features.
PUBLISHED_IMPORTANCE = [
    0.09004407412186005, 0.05253414205560711, 0.045087989745372405, 0.03886105999186387, 0.03349065142979131,
    0.03236476067645647, 0.02654390605842546, 0.0186963368709296, 0.01857923108811086, 0.017686279846865494,
    0.01588982275068381, 0.015839584936714276, 0.015660078365499645, 0.013670914777114107, 0.010385646985759228,
    0.010206787561449689, 0.009427038933884342, 0.009130006729823007, 0.0088972913917591, 0.007261104528141582,
]


def test_published_metrics_follow_from_the_counts(spark):
    counts = spark.createDataFrame([(m, *c) for m, (c, _) in PUBLISHED.items()], "model string, tn int, fp int, fn int, tp int")
    rows = evaluate.rounded(evaluate.metrics_from_counts(counts, ["model"]), METRICS[:4]).collect()
    for r in rows:
        assert (r.accuracy, r.precision, r.recall, r.f1) == PUBLISHED[r.model][1]


def test_published_choice(spark):
    rows = [(m, *v[1], PUBLISHED_AUC[m]) for m, v in PUBLISHED.items()]
    table = spark.createDataFrame(rows, ["model", *METRICS])
    best = evaluate.select_best(table, list(PUBLISHED)).where("is_best = 1").first()
    assert best.model == "rf" and round(best.composite, 4) == 0.7285


def test_first_model_wins_a_tie(spark):
    table = spark.createDataFrame([("b", .5, .5, .5, .5, .5), ("a", .5, .5, .5, .5, .5)], ["model", *METRICS])
    assert evaluate.select_best(table, ["b", "a"]).where("is_best = 1").first().model == "b"


def test_published_cumulative_importance(spark):
    ranked = spark.createDataFrame([(f"f{i:02d}", v) for i, v in enumerate(PUBLISHED_IMPORTANCE)], "feature string, mean_abs_shap double")
    cum = cum_importance(ranked)
    got = {r["rank"]: r.cum_pct for r in cum.collect()}
    assert round(got[11], 2) == 79.50 and round(got[12], 2) == 82.74 and got[20] == pytest.approx(100)
    assert features_to_reach(cum).first()[0] == 12
    assert cum.agg(F.max("relative")).first()[0] == 1.0


def test_zero_denominators(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "label int, pred int, score double")
    row = evaluate.class_metrics(df).first()
    assert tuple(row) == (1.0, 0.0, 0.0, 0.0)
    assert evaluate.roc_auc(df).first()[0] is None
    assert evaluate.confusion(df).first().tp_share is None


def auc_by_pairs(labels, scores):
    pos, neg = scores[labels == 1], scores[labels == 0]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


@pytest.mark.parametrize("limit", [0, 10**6])
def test_auc_counts_ties_half(spark, limit):
    rng = np.random.default_rng(11)
    labels, scores = rng.integers(0, 2, 400), np.round(rng.random(400), 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(labels, scores)], "label int, score double")
    assert evaluate.roc_auc(df).first()[0] == pytest.approx(auc_by_pairs(labels, scores), abs=1e-12)
    curve = evaluate.roc_curve(df).orderBy(F.desc("threshold")).toPandas()
    assert math.isinf(curve["threshold"][0]) and (curve["fpr"][0], curve["tpr"][0]) == (0, 0)
    assert (curve["fpr"].iloc[-1], curve["tpr"].iloc[-1]) == (1, 1)
    assert np.trapezoid(curve["tpr"], curve["fpr"]) == pytest.approx(auc_by_pairs(labels, scores), abs=1e-12)


EDGES = [0.0, 0.3, 0.30001, 0.4, 0.5, 0.69, 0.7, 1.0]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(f"c{i}", v, int(v > 0.5)) for i, v in enumerate(EDGES)], "customer_id string, score double, label int")


def test_both_kinds_of_tier_at_their_edges(edges):
    assert {r.tier: r.n for r in risk.risk_tiers(edges).collect()} == {"high": 2, "medium": 3, "low": 3}
    # Right-closed: 0.7 is Medium, and exactly 0 is in no band.
    assert [r.n for r in risk.risk_bands(edges).orderBy("band_ord").collect()] == [1, 3, 2, 1]


def test_empty_tiers_stay(edges):
    rows = risk.risk_bands(edges.where("score = 1")).orderBy("band_ord").collect()
    assert [r.n for r in rows] == [0, 0, 0, 1]
    assert {r.tier: r.n for r in risk.risk_tiers(edges.limit(0)).collect()} == {"high": 0, "medium": 0, "low": 0}


def test_priority_labels(edges):
    got = {r.score: r.priority for r in risk.priority_tiers(edges).collect()}
    assert got[0.0] is None and got[0.7] == "At-Risk" and got[1.0] == "Critical" and got[0.3] == "Low Risk"


def test_probability_histogram_closes_at_one(edges):
    rows = {(r.label, r.bin): r.n for r in risk.proba_hist(edges).collect()}
    want0 = np.histogram([v for v in EDGES if v <= 0.5], bins=np.linspace(0, 1, 41))[0]
    assert rows[1, 40] == 1 and sum(rows.values()) == len(EDGES)
    assert sum(n for (label, _), n in rows.items() if label == 0) == want0.sum()


def test_tenure_bins_match_pandas_edges(spark):
    df = spark.createDataFrame([(t, t / 10) for t in range(11)], "tenure int, score double")
    rows = risk.tenure_score_bins(df).orderBy("bin").collect()
    assert [r.n for r in rows] == [2] + [1] * 9
    assert rows[0].mid == pytest.approx((-0.01 + 1) / 2) and rows[1].mid == pytest.approx(1.5)
    flat = spark.createDataFrame([(5, 0.5), (5, 0.7)], "tenure int, score double")
    assert [(r.bin, r.n) for r in risk.tenure_score_bins(flat).collect()] == [(1, 2)]


def test_trend_equals_polyfit(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 73, 500)
    y = 0.9 - 0.01 * x + 1e-6 * x**3 + rng.normal(0, .05, 500)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(x, y)], "tenure int, score double")
    got = risk.tenure_trend(df).orderBy("point").toPandas()
    grid = np.linspace(x.min(), x.max(), 100)
    assert np.allclose(got["x"], grid) and np.allclose(got["trend"], np.polyval(np.polyfit(x, y, 3), grid), atol=1e-9)
    with pytest.raises(ValueError):
        risk.tenure_trend(df.where("tenure = 5"))


@pytest.fixture(scope="module")
def customers(spark):
    rows = [("a", 50.0, 1), ("b", 70.0, 0), ("c", 90.0, 0), ("d", 70.0, 1)]
    return spark.createDataFrame(rows, "customer_id string, monthly_charges double, label int")


def test_campaign_arithmetic(customers, edges):
    k = business.kpis(customers).first()
    assert (k.churn_rate, k.n_customers, k.n_churned, k.mean_charge, k.revenue_at_risk) == (50.0, 4, 2, 70.0, 1680.0)
    r = business.campaign_roi(customers, edges).first()
    high, medium, cost = 2 * .35 * 70 * 12, 3 * .35 * .2 * 70 * 12, 5 * 70 * .15
    assert r.high_saved == pytest.approx(high) and r.medium_saved == pytest.approx(medium)
    assert r.total_cost == pytest.approx(cost) and r.roi_pct == pytest.approx((high + medium - cost) / cost * 100)
    steps = {s.item: s.value_k for s in business.roi_waterfall(business.campaign_roi(customers, edges)).collect()}
    assert steps["Net Benefit"] == pytest.approx((high + medium - cost) / 1000) and steps["Campaign Cost"] < 0
    proj = business.savings_projection(business.campaign_roi(customers, edges)).orderBy("month").collect()
    net = np.cumsum([p.savings - p.cost for p in proj])
    assert len(proj) == 12 and np.allclose([p.cumulative_net for p in proj], net)


def test_campaign_without_targets_has_no_roi(customers, edges):
    r = business.campaign_roi(customers, edges.where("score < 0.4")).first()
    assert r.total_cost == 0 and r.roi_pct is None


def test_published_revenue_at_risk(spark):
    """The formula on the published totals gives about 1.45 million."""
    df = spark.range(7043).selectExpr("int(id < 1869) as label", "64.76D as monthly_charges")
    assert business.kpis(df).first().revenue_at_risk == pytest.approx(1.4524e6, rel=1e-3)
