import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stayline.operators import neighbours
from stayline.operators.balance import balance_report, smote
from stayline.operators.neighbours import nearest


def brute(x, k):
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(d2, np.inf)
    return np.sort(d2, axis=1)[:, :k]


@pytest.mark.parametrize("block_rows", [25, 100, 10**6])
def test_nearest_equals_brute_force(spark, block_rows):
    rng = np.random.default_rng(5)
    near_copies = np.round(rng.normal(0, 1e-3, (150, 4)), 9)  # a third of the points crowd one spot
    x = np.concatenate([rng.normal(0, 1, (200, 4)), near_copies, rng.integers(0, 2, (50, 4)) + rng.normal(0, .1, (50, 4))])
    pdf = pd.DataFrame(x, columns=list("abcd"))
    pdf["pid"] = [f"p{i:04d}" for i in np.random.default_rng(6).permutation(len(x))]
    got = nearest(spark.createDataFrame(pdf), list("abcd"), 5, block_rows).toPandas()
    assert len(got) == 5 * len(x)
    table = got.sort_values(["pid", "rank"]).groupby("pid")["d2"].apply(list)
    want = brute(x, 5)
    for i, pid in enumerate(pdf["pid"]):
        assert np.allclose(table[pid], want[i], rtol=1e-9, atol=1e-18)


def test_points_that_all_differ_visit_few_blocks(spark, monkeypatch):
    """Limits from the nearest blocks spare a point most of the others; the neighbours are those of brute force."""
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.integers(0, 2, (1500, 10)), rng.normal(0, 0.3, (1500, 2))], axis=1).astype(float)
    pdf = pd.DataFrame(x, columns=[f"f{i}" for i in range(12)])
    pdf["pid"] = [f"p{i:04d}" for i in range(len(x))]
    visits, write = [], neighbours.materialise

    def counted(df, name):
        out = write(df, name)
        if name == "visits":
            visits.append(out.count())
        return out

    monkeypatch.setattr(neighbours, "materialise", counted)
    got = nearest(spark.createDataFrame(pdf), list(pdf.columns[:12]), 5, 25).toPandas()
    table = got.sort_values(["pid", "rank"]).groupby("pid")["d2"].apply(list)
    for pid, want in zip(pdf["pid"], brute(x, 5)):
        assert np.allclose(table[pid], want, rtol=1e-9)
    limit = brute(x, 5)[:, 4]
    blocks = 64  # halvings give a power of two
    assert len(visits) == 2 and sum(visits) < 0.6 * blocks * len(x), (visits, limit.mean())


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(7)
    n = 300
    pdf = pd.DataFrame({"f one": rng.normal(size=n), "f two": rng.integers(0, 2, n), "f3": rng.normal(size=n)})
    pdf["customer_id"] = [f"c{i:04d}" for i in range(n)]
    pdf["label"] = (np.arange(n) % 4 == 0).astype(int)
    hot = (pdf["label"] == 1) & (np.arange(n) % 12 == 0)  # a third of the minority are copies
    pdf.loc[hot, ["f one", "f two", "f3"]] = [0.5, 1, -0.5]
    return pdf, spark.createDataFrame(pdf)


NAMES = ["f one", "f two", "f3"]


@pytest.mark.parametrize("block_rows", [20, 4096])
def test_synthetic_rows_lie_between_a_base_and_one_of_its_neighbours(train, block_rows):
    pdf, df = train
    out = smote(df, NAMES, block_rows=block_rows).toPandas()
    assert (out["label"].value_counts() == 225).all()
    assert out["customer_id"].is_unique
    new = out[out["base_key"].notna()]
    uses = new["base_key"].value_counts()
    assert uses.max() - uses.min() <= 1 and len(uses) == 75
    minority = pdf[pdf["label"] == 1].set_index("customer_id")[NAMES].astype(float)
    x = minority.to_numpy()
    d2 = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    np.fill_diagonal(d2, np.inf)
    reach = np.sort(d2, axis=1)[:, 4]
    for _, row in new.iterrows():
        i = minority.index.get_loc(row["base_key"])
        step = row[NAMES].to_numpy(float) - x[i]
        found = False
        for j in np.nonzero(d2[i] <= reach[i] + 1e-12)[0]:
            way = x[j] - x[i]
            length = way @ way
            u = 0.0 if length == 0 else step @ way / length
            found |= bool(np.allclose(step, u * way, atol=1e-9) and -1e-9 <= u < 1)
        assert found


def test_originals_are_kept_and_result_is_repeatable(train):
    pdf, df = train
    out = smote(df, NAMES)
    again = smote(df.repartition(5), NAMES, block_rows=20)
    assert out.exceptAll(again).count() == 0 and again.count() == 450
    assert out.where("base_key is null").count() == len(pdf)
    report = {(r.stage, r.label): r.n for r in balance_report(df, out).collect()}
    assert report == {("before", 0): 225, ("before", 1): 75, ("after", 0): 225, ("after", 1): 225}


def test_balanced_and_too_small_inputs(spark):
    even = spark.createDataFrame([(f"c{i}", i % 2, float(i)) for i in range(8)], "customer_id string, label int, f double")
    assert smote(even, ["f"]).count() == 8
    few = spark.createDataFrame([(f"c{i}", int(i < 3), float(i)) for i in range(20)], "customer_id string, label int, f double")
    with pytest.raises(ValueError, match="too few"):
        smote(few, ["f"])
    with pytest.raises(ValueError, match="two classes"):
        smote(even.withColumn("label", F.lit(1)), ["f"])
