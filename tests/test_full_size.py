"""The registered sizes once: 200 trees and rounds, four learners, five folds and all rows."""

from pyspark.sql import functions as F

from stayline.operators import models
from stayline.plans.training import Pipeline


def test_cross_validation_at_full_size(pipe):
    whole = Pipeline(pipe.customers, {})
    scores = {(r["model"], r["fold"]): r["auc"] for r in whole.cv_scores.collect()}
    assert set(scores) == {(m, f) for m in models.MODEL_ORDER for f in range(5)}
    assert all(0.7 < auc < 1 for auc in scores.values())
    fitted = whole.models
    for name in (models.BOOSTED, models.BOOSTED_NARROW):
        nodes = fitted[name].nodes
        assert len({n["tree"] for n in nodes}) == 200
    leaves = {}
    for n in fitted[models.BOOSTED_NARROW].nodes:
        leaves[n["tree"]] = leaves.get(n["tree"], 0) + (n["left"] < 0)
    assert max(leaves.values()) <= 31
    assert fitted[models.FOREST].getNumTrees == 200
    best = whole.scored.groupBy("model").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r["n"] for r in best} == {whole.test.count()}
