"""The distributed paths agree with plain windows and numpy, also with a third of the rows on one value."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stayline.operators import ordered, split


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.lognormal(3, 1, 4000), np.full(2000, 17.0)])
    pdf = pd.DataFrame({"g": np.where(np.arange(6000) % 3 == 0, "a", "b"), "v": v, "w": rng.integers(0, 5, 6000)})
    return pdf, spark.createDataFrame(pdf).repartition(6)


def test_quantiles(skewed):
    pdf, df = skewed
    probs = [0.0, 0.25, 0.5, 0.73, 1.0]
    got = ordered.exact_quantiles(df, ["v", "w"], probs, ["g"]).toPandas()
    assert len(got) == 2 * 2 * len(probs)
    for (g, c), rows in got.groupby(["g", "feature"]):
        want = np.quantile(pdf.loc[pdf.g == g, c], rows["prob"])
        assert np.allclose(rows["value"], want, rtol=1e-12)


@pytest.mark.parametrize("n", [1, 2, 7, 40, 700, 13_000])
def test_quantiles_of_any_size(spark, n):
    values = np.random.default_rng(n).normal(size=n)
    got = ordered.exact_quantiles(spark.createDataFrame(pd.DataFrame({"v": values})), ["v"], [0.0, 0.25, 0.5, 0.99])
    for row in got.collect():
        assert row["value"] == pytest.approx(np.quantile(values, row["prob"]), rel=1e-12)


def test_quantiles_skip_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,)], "v double")
    assert ordered.exact_quantiles(df, ["v"], [0.5]).first()["value"] == 2.5


@pytest.mark.parametrize("descending", [False, True])
def test_running_sum_in_pieces(spark, skewed, descending):
    _, df = skewed
    rows = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    order = F.col("v").desc() if descending else F.col("v")
    window = Window.partitionBy("g").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    whole = rows.select("*", F.sum("n").over(window).alias("cum_n"))
    pieces = ordered.running_sum(rows, "v", ["n"], ["g"], descending, pieces=20)
    assert whole.exceptAll(pieces).count() == 0 and whole.count() == pieces.count()


def test_split_and_folds_match_ranks(spark):
    rows = [(f"c{i:04d}", int(i % 7 == 0)) for i in range(997)]
    df = spark.createDataFrame(rows, "customer_id string, label int")
    flagged = split.stratified_folds(split.stratified_split(df)).toPandas()
    import hashlib

    flagged["h"] = [hashlib.md5(f"{c}|42".encode()).hexdigest() for c in flagged.customer_id]
    for _, part in flagged.groupby("label"):
        part = part.sort_values(["h", "customer_id"]).reset_index(drop=True)
        n = len(part)
        assert part["is_test"].sum() == round(0.2 * n)
        assert part["is_test"].tolist() == [i < round(0.2 * n) for i in range(n)]
        assert part["fold"].tolist() == [i * 5 // n for i in range(n)]


def test_repeated_keys_stay_together(spark):
    df = spark.range(900).selectExpr("if(id < 300, 'same', string(id)) as customer_id", "0 as label")
    got = split.stratified_split(df).groupBy("is_test").count().collect()
    n = {r.is_test: r["count"] for r in got}
    assert n.get(True, 0) + n[False] == 900 and n.get(True, 0) >= 180


def test_fewer_rows_than_folds(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "customer_id string, label int")
    got = split.stratified_folds(df).toPandas()
    assert len(got) == 3 and got["fold"].between(0, 4).all()
    assert not split.stratified_split(df, share=0.0).where("is_test").count()


def test_sample_is_repeatable_whatever_the_partitioning(spark):
    df = spark.range(500).selectExpr("string(id) as customer_id")
    a, b = split.sample_n(df.repartition(7), 40), split.sample_n(df.coalesce(1), 40)
    assert a.count() == 40 and a.exceptAll(b).count() == 0
