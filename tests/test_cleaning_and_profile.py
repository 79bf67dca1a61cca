import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stayline.columns import TENURE_EDGES, TENURE_LABELS
from stayline.functions.exprs import clean_label, half_even, slug, to_number
from stayline.operators import cleaning, features, profile
from stayline.session import new_path
from stayline.sources import customers


def test_lenient_cast(spark):
    df = spark.createDataFrame([(" ",), ("",), ("12.5",), (" 7 ",), ("x1",), (None,)], "t string")
    assert [r[0] for r in df.select(to_number(F.col("t"))).collect()] == [None, None, 12.5, 7.0, None, None]


def test_median_fill_interpolates_and_can_fit_on_train(spark):
    df = spark.createDataFrame(
        [(1.0, False), (2.0, False), (10.0, True), (20.0, True), (None, False)], "v double, is_test boolean"
    )
    both = cleaning.fill_median(df, "v").where("v not in (1, 2, 10, 20)").collect()
    train = cleaning.fill_median(df, "v", fit_on="train").where("v not in (1, 2, 10, 20)").collect()
    assert both[0].v == 6.0 and train[0].v == 1.5
    assert cleaning.missing_count(df, "v").first()[0] == 1
    with pytest.raises(ValueError):
        cleaning.fill_median(df, "v", fit_on="test")


def test_tenure_bands_are_right_closed_and_drop_zero(spark):
    df = spark.createDataFrame([(t, 1) for t in (0, 1, 12, 13, 24, 48, 49, 72)], "tenure int, label int")
    got = {r.band: r.n for r in profile.tenure_bands(df, TENURE_EDGES, TENURE_LABELS).collect()}
    assert got == {"0-12m": 2, "13-24m": 2, "25-48m": 1, "49-72m": 2}


def test_duplicates_count_occurrences_after_the_first(spark):
    df = spark.createDataFrame([("a", 1)] * 3 + [("b", None)] * 2 + [("c", 1)], "k string, v int")
    assert profile.duplicate_rows(df).first()[0] == 3
    assert profile.duplicate_rows(df.limit(0)).first()[0] == 0


def test_missing_values_lists_only_columns_with_nulls(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("c", 1)], "k string, v int")
    assert {r.column_name: r.n_missing for r in profile.missing_values(df).collect()} == {"k": 1, "v": 2}


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,)], "v double")
    assert [r[0] for r in df.select(half_even(F.col("v"), 2)).collect()] == [0.12, 0.38, 2.5]


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.normal(50, 9, 301), "b": rng.integers(0, 72, 301)})
    got = profile.describe(spark.createDataFrame(pdf), ["a", "b"]).toPandas().set_index("feature")
    want = pdf.describe().round(2)
    for c in pdf:
        names = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
        assert np.allclose(got.loc[c].to_numpy(float), want.loc[names, c].to_numpy(float))


def test_correlation_is_pairwise_complete_and_null_for_constants(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, np.nan, 5], "b": [2.0, 1, 4, 9, np.nan], "k": [7.0] * 5})
    df = spark.createDataFrame(pdf).select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in pdf])
    got = {(r.x, r["y"]): r["corr"] for r in profile.corr_matrix(df, ["a", "b", "k"], None).collect()}
    assert got["a", "b"] == pytest.approx(pdf["a"].corr(pdf["b"])) and got["a", "a"] == 1.0
    assert got["k", "k"] is None and got["a", "k"] is None


def test_histogram_closes_the_last_bin_and_keeps_empty_ones(spark):
    df = spark.createDataFrame([("No", float(v)) for v in (0, 1, 2, 10)] + [("Yes", 3.0)], "churn string, v double")
    rows = profile.histogram(df, "v", bins=5, density=False).where("churn = 'No'").orderBy("bin").collect()
    assert [r.n for r in rows] == np.histogram([0, 1, 2, 10], bins=5)[0].tolist()


def test_box_whiskers_stop_at_the_furthest_inside_value(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 100.0]
    df = spark.createDataFrame([("No", v) for v in values], "churn string, v double")
    row = profile.box_stats(df, "v").first()
    assert (row.q25, row.q50, row.q75) == tuple(np.percentile(values, [25, 50, 75]))
    assert (row.whisker_low, row.whisker_high, row.n_outliers) == (1.0, 7.0, 1)


def test_kde_matches_the_formula(spark):
    values = np.array([1.0, 2, 2, 5, 9, 9, 9])
    df = spark.createDataFrame([("No", float(v)) for v in values], "churn string, v double")
    got = profile.kde(df, "v", points=11).orderBy("point").toPandas()
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(1 - 4, 9 + 4, 11)
    want = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi))
    assert np.allclose(got["grid_x"], grid) and np.allclose(got["density"], want)


def test_scatter_sample_is_a_seeded_share(spark):
    df = spark.range(4000).selectExpr("string(id) as customer_id", "id as x", "id as y", "'No' as churn")
    share = profile.scatter(df, "x", "y", sample=0.25)
    assert 850 < share.count() < 1150
    assert share.exceptAll(profile.scatter(df, "x", "y", sample=0.25)).count() == 0
    assert profile.scatter(df, "x", "y", sample=1).count() == 4000


def test_labels(spark):
    names = ["Contract_Month-to-month", "PaymentMethod_Electronic check", "InternetService_Fiber optic",
             "OnlineSecurity_No", "OnlineSecurity_Yes", "tenure", "MultipleLines_No phone service"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(clean_label(F.col("n"))).collect()]
    assert got == ["Contract: Month-To-Month", "Payment: Electronic Check", "Internet: Fiber Optic",
                   "Onlinesecurity", "Onlinesecurity", "Tenure", "Multiplelines Phone Service"]
    assert spark.range(1).select(slug(F.lit("Random Forest"), "_best_model")).first()[0] == "random_forest_best_model"


def test_csv_keeps_blanks_and_types(spark, sf):
    from stayline.sources.snapshot import snapshot

    table = snapshot(spark, sf)
    path = new_path(spark, "csv")
    customers.write_customers_csv(table, path)
    back = customers.read_customers(spark, path)
    assert back.dtypes == table.dtypes
    assert back.exceptAll(table).count() == 0 and back.count() == table.count()
    assert back.where("total_charges_raw = ' '").count() == 3


def test_unknown_levels_and_codes(spark):
    df = spark.createDataFrame([("Yes", "DSL"), ("maybe", None)], "partner string, internet_service string")
    assert [r.partner for r in features.encode_binary(df, ["partner"]).collect()] == [1, None]
    hot = features.one_hot(df, {"internet_service": ["DSL", "No"]}).collect()
    assert [tuple(r) for r in hot] == [(1, 0), (0, 0)]


def test_engineered_count_and_flag(spark):
    row = dict.fromkeys(["online_security", "online_backup", "device_protection", "tech_support", "streaming_tv",
                         "streaming_movies"], "No")
    row |= {"online_backup": "Yes", "streaming_tv": "Yes", "tenure": 3, "monthly_charges": 20.0, "total_charges": 80.0}
    got = features.engineer(spark.createDataFrame([row])).first()
    assert (got.num_addon_services, got.has_any_addon, got.has_streaming, got.has_security) == (2, 1, 1, 0)
    assert (got.avg_monthly_charges, got.charge_per_tenure) == (20.0, 5.0)


def test_scaler_uses_population_deviation_and_leaves_constants(spark):
    df = spark.createDataFrame([(0.0, 5.0), (12.0, 5.0), (12.5, 5.0), (72.0, 5.0)], "a double, b double")
    got = features.scale(df, features.fit_scaler(df, ["a", "b"]), ["a", "b"], suffix="_z").toPandas()
    a = np.array([0, 12, 12.5, 72])
    assert np.allclose(got["a_z"], (a - a.mean()) / a.std()) and (got["b_z"] == 0).all() and (got["a"] == a).all()


def test_align_adds_zeros_drops_extras_and_reorders(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, extra int")
    got = features.align(df, ["b", "new one", "a"])
    assert got.columns == ["b", "new one", "a"] and tuple(got.first()) == (2, 0, 1)
