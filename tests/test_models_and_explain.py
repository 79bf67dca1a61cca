import itertools
import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from stayline.columns import KEY
from stayline.operators import evaluate, explain, features, models
from stayline.session import new_path
from stayline.sources import artifacts


def test_forty_five_features_in_stored_order(pipe):
    names = pipe.spec.names
    assert len(names) == 45 and names[0] == "gender" and names[-1] == "NumAddonServices"
    assert "Contract_Month-to-month" in names and "PaymentMethod_Bank transfer (automatic)" in names


def test_split_is_disjoint_and_keeps_the_class_share(pipe):
    n = {(r.label, r.is_test): r["count"] for r in pipe.prepared.groupBy("label", "is_test").count().collect()}
    for label in (0, 1):
        assert n[label, True] == round(0.2 * (n[label, True] + n[label, False]))
    assert pipe.train.join(pipe.test, KEY, "left_semi").count() == 0


def test_scaling_is_fitted_on_train(pipe):
    row = pipe.train.agg(F.avg("tenure").alias("m"), F.stddev_pop("tenure").alias("s")).first()
    assert row.m == pytest.approx(0, abs=1e-9) and row.s == pytest.approx(1)


def test_scores_are_beside_key_and_label(pipe):
    per_model = pipe.scored.groupBy("model").agg(F.countDistinct(KEY).alias("n"), F.min("score"), F.max("score"))
    n = pipe.test.count()
    rows = per_model.collect()
    assert len(rows) == 4
    assert all(r.n == n and 0 <= r["min(score)"] <= r["max(score)"] <= 1 for r in rows)


def test_auc_equals_the_evaluator(pipe):
    ours = {r["model"]: r.roc_auc for r in evaluate.roc_auc(pipe.scored, ["model"]).collect()}
    for name, auc in ours.items():
        raw = pipe.scored.where(F.col("model") == name).withColumn("label", F.col("label").cast("double"))
        want = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(raw)
        assert auc == pytest.approx(want, abs=1e-12) and auc > 0.6


def test_logistic_penalty_matches_the_inverse_penalty_form(spark):
    """At the optimum, w equals C times the summed residual gradient."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 2))
    y = (x[:, 0] - x[:, 1] + rng.normal(size=300) > 0).astype(int)
    df = spark.createDataFrame([(int(c), float(a), float(b)) for (a, b), c in zip(x, y)], "label int, a double, b double")
    model = models.estimators(300)[models.LOGISTIC].fit(features.assemble(df, ["a", "b"]))
    w, b = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.allclose(w, x.T @ (y - p), atol=1e-3) and abs((y - p).sum()) < 1e-3


def shapley_by_definition(tree, x, m):
    """Path-dependent Shapley values of one tree by enumerating coalitions."""

    def value(node, known):
        n = tree[node]
        if n.left < 0:
            return n.positive / n.cover
        if n.feature in known:
            return value(n.left if x[n.feature] <= n.threshold else n.right, known)
        return sum(tree[c].cover / n.cover * value(c, known) for c in (n.left, n.right))

    phi = np.zeros(m)
    used = sorted({n.feature for n in tree.values() if n.left >= 0})
    for j in used:
        rest = [f for f in used if f != j]
        for size in range(len(rest) + 1):
            weight = math.factorial(size) * math.factorial(len(used) - size - 1) / math.factorial(len(used))
            for known in itertools.combinations(rest, size):
                phi[j] += weight * (value(0, {*known, j}) - value(0, set(known)))
    return phi


def test_forest_attribution_equals_the_definition(spark):
    rng = np.random.default_rng(8)
    x = rng.integers(0, 4, size=(250, 5)).astype(float)
    y = ((x[:, 0] > 1) ^ (x[:, 1] + x[:, 2] > 4)).astype(int)
    names = list("abcde")
    df = spark.createDataFrame([(f"k{i}", int(c), *map(float, r)) for i, (r, c) in enumerate(zip(x, y))], [KEY, "label", *names])
    rows = features.assemble(df, names)
    model = models.estimators(250, trees=3, depth=4)[models.FOREST].fit(rows)
    path = new_path(spark, "forest")
    model.write().save(path)
    nodes = explain.forest_nodes(spark, path)
    leaves = explain.tree_leaves(nodes)
    got = explain.long_form(explain.shap_tree(rows, leaves), names).toPandas().pivot(index=KEY, columns="feature", values="shap")
    trees = {}
    for n in nodes.collect():
        trees.setdefault(n.tree, {})[n.id] = n
    for i in range(0, 250, 25):
        want = np.mean([shapley_by_definition(t, x[i], 5) for t in trees.values()], axis=0)
        assert np.allclose(got.loc[f"k{i}", names], want, atol=1e-12)


@pytest.mark.parametrize("name", models.MODEL_ORDER)
def test_attributions_of_every_model_add_up(pipe, name):
    rows, base = pipe.explained(name)
    total = explain.long_form(rows, pipe.spec.names).groupBy(KEY).agg(F.sum("shap").alias("t"))
    scored = pipe.scored.where(F.col("model") == name)
    whole = F.col("t") + base
    score = whole if name == models.FOREST else 1 / (1 + F.exp(-whole))
    found = total.join(scored, KEY).agg(F.max(F.abs(score - F.col("score"))), F.count(F.lit(1))).first()
    assert found[0] < 1e-9 and found[1] == pipe.test.count()


def test_the_selected_model_is_explained(pipe):
    rows, base = pipe.explanation
    again, other = pipe.explained(pipe.best_name)
    assert base == pytest.approx(other)
    assert rows.join(again.withColumnRenamed("phi", "phi2"), KEY).where("phi != phi2").count() == 0


def test_the_fit_is_bounded_by_a_parameter(pipe):
    from stayline.plans.training import Pipeline

    small = Pipeline(pipe.customers, pipe.settings, fit_rows=400)
    assert small.fit_source.count() == pytest.approx(400, abs=1)
    assert small.fit_source.join(pipe.train, KEY, "left_anti").count() == 0


def test_importance_views(pipe):
    ranked = pipe.importance.collect()
    assert len(ranked) == 45
    assert [r.mean_abs_shap for r in ranked] == sorted((r.mean_abs_shap for r in ranked), reverse=True)
    n = pipe.test.count()
    assert explain.of_top_features(pipe.shap, pipe.importance, 3).count() == 3 * n
    who = pipe.test.where("label = 1").agg(F.min(KEY)).first()[0]
    rows = explain.waterfall(pipe.shap, who, 0.3).collect()
    sizes = [abs(r.shap) for r in rows]
    assert len(rows) == 15 and {r[KEY] for r in rows} == {who} and sizes == sorted(sizes, reverse=True)


def test_saved_model_scores_the_same(spark, pipe):
    path = new_path(spark, "model")
    artifacts.save_model(pipe.models[models.FOREST], pipe.spec, pipe.scaler, path)
    model, spec, scaler = artifacts.load_model(spark, path)
    assert spec.names == pipe.spec.names
    raw = features.align(pipe.prepared.where("is_test"), spec.names, keep=[KEY, "label"])
    back = models.score(model, features.scale(raw, scaler)).withColumnRenamed("score", "again")
    first = pipe.scored.where(F.col("model") == models.FOREST)
    joined = back.select(KEY, "again").join(first, KEY)
    assert joined.count() == pipe.test.count()
    assert joined.agg(F.max(F.abs(F.col("again") - F.col("score")))).first()[0] < 1e-12


def test_metadata_round_trip(spark, pipe):
    cv = spark.createDataFrame([(m, 0.87654, 0.01234) for m in models.MODEL_ORDER], "model string, cv_mean double, cv_std double")
    made = artifacts.metadata(pipe.metrics, pipe.ranking, 45, pipe.test, "2026-03-15", cv)
    path = new_path(spark, "meta")
    artifacts.write_metadata(made, path)
    row = artifacts.read_metadata(spark, path).first()
    assert row == made.first()
    assert row.best_model == pipe.best_name and row.test_set_size == pipe.test.count()
    assert set(row.all_models) == set(models.MODEL_ORDER)
    assert row.model_file == pipe.best_name.lower().replace(" ", "_") + "_best_model"
    assert (row.metrics.cv_auc_mean, row.metrics.cv_auc_std) == (0.8765, 0.0123)


def test_metadata_from_a_pretty_printed_document(spark, tmp_path):
    five = {"accuracy": 0.7, "precision": 0.5, "recall": 0.6, "f1": 0.55, "roc_auc": 0.8}
    doc = {"best_model": "Random Forest", "metrics": five, "all_models": {"Random Forest": five}, "n_features": 45}
    (tmp_path / "metadata.json").write_text(json.dumps(doc, indent=2))
    row = artifacts.read_metadata(spark, str(tmp_path / "metadata.json")).first()
    assert row.all_models["Random Forest"].roc_auc == 0.8 and row.metrics.f1 == 0.55 and row.metrics.cv_auc_std is None


@pytest.mark.parametrize("leaky", [False, True])
def test_cross_validation(pipe, leaky):
    learner = {models.FOREST: models.estimators(1000, trees=5, depth=4)[models.FOREST]}
    scores = models.cross_validate(pipe.train, pipe.spec.names, learner, folds=3, leaky=leaky)
    rows = scores.collect()
    assert sorted(r[1] for r in rows) == [0, 1, 2]
    assert all(0.5 < r[2] <= 1 for r in rows)
    summary = models.cv_summary(scores).first()
    assert summary.cv_mean == pytest.approx(np.mean([r[2] for r in rows]))
    assert summary.cv_std == pytest.approx(np.std([r[2] for r in rows]))
    assert models.cv_overall(scores).first()[0] == pytest.approx(summary.cv_mean)


def test_batches_are_explained_together_to_the_same_attributions(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.random((500, 20)).round(1)
    leaves = []
    for m in (1, 4, 9, 14):
        low = np.where(rng.random(m) < 0.5, -np.inf, 0.3)
        leaves.append((np.sort(rng.choice(20, m, replace=False)), low, np.where(low > 0, np.inf, 0.7),
                       rng.uniform(0.1, 0.9, m), float(m)))
    plain = np.zeros(x.shape)
    for feats, low, high, z, value in leaves:
        for row in range(len(x)):
            follows = ((x[row, feats] > low) & (x[row, feats] <= high)).astype(float)
            plain[row, feats] += value * explain._leaf_shares(follows[None, :], z)[0]
    frames = [pd.DataFrame({"row": range(i, i + 100)}) for i in range(0, 500, 100)]
    joined = [pdf["row"].tolist() for pdf in explain._joined(iter(frames), 250)]
    assert joined == [list(range(300)), list(range(300, 500))]
    for conditions in (explain.HELD_CONDITIONS, 2):
        monkeypatch.setattr(explain, "HELD_CONDITIONS", conditions)
        assert np.array_equal(explain._tree_attribution(x, leaves), plain)


@pytest.mark.parametrize("name", ["final_report", "model_invariants", "metadata_rows"])
def test_folds_and_all_rows_are_fitted_in_one_series(name, spark, sf, pipe, monkeypatch):
    import __spark_entry__ as entry
    from stayline.plans.training import Pipeline

    class Fitting(Exception):
        pass

    def begun(sets, *more):
        raise Fitting(*sorted(sets))

    own = Pipeline(pipe.customers, {**pipe.settings, "trees": 3})  # nothing of it is stored yet
    monkeypatch.setattr(entry, "_pipe", lambda s, d: own)
    monkeypatch.setattr(models, "fit_sets", begun)
    with pytest.raises(Fitting) as found:
        entry._own_queries()[name](spark, sf)
    assert found.value.args == ("0", "1", "2", "3", "4", "all")
