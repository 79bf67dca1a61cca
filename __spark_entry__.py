
from __future__ import annotations

import importlib
import sys
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_queries
from stayline.columns import BINARY, CATEGORICAL, KEY, NUMERIC, public
from stayline.functions.exprs import clean_label, half_even, one_row, recode, slug
from stayline.operators import (
    balance, business, cleaning, evaluate, explain, features, models, profile, risk, split,
)
from stayline.plans.stand_in import STAND_INS, all_stand_ins, stand_in_scores
from stayline.plans.training import Pipeline, pipeline
from stayline.session import new_path
from stayline.sources import artifacts, customers
from stayline.sources.snapshot import snapshot

SF_SMOKE = "/root/testdata/sf0.001"


def _llm() -> list:
    """The query modules of the training-data subpackage, if it is there."""
    modules = []
    for name in ("stayline.llm.queries", "corpus_pipeline"):
        try:
            modules.append(importlib.import_module(name))
        except ImportError:  # the subpackage, the pipeline or a library they need is not there
            continue
    return modules


# Arguments of the learners in the registered queries: none, so the library's sizes (200 trees and rounds).
MODEL_SETTINGS: dict = {}


def fixed(df: DataFrame, digits: int = 6, **other: int) -> DataFrame:
    """Round doubles so that the order of summation does not show; no negative zero."""
    cols = {c: half_even(F.col(f"`{c}`"), other.get(c, digits)) + F.lit(0.0) for c, t in df.dtypes if t == "double"}
    return df.withColumns(cols) if cols else df


def _pipe(spark: SparkSession, sf: str) -> Pipeline:
    return pipeline(spark, sf, **MODEL_SETTINGS)


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean(snapshot(spark, sf))


def _numeric(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.with_total_charges(snapshot(spark, sf))


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Label without the median: for queries that do not touch total charges."""
    return cleaning.with_label(snapshot(spark, sf))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return stand_in_scores(_labelled(spark, sf))


def entry(spark: SparkSession) -> DataFrame:
    """Attrition rate per contract type."""
    return profile.churn_rate_by(_labelled(spark, SF_SMOKE), "contract")


# --- sources and cleaning ----------------------------------------------------------------------

def scan_snapshot(spark, sf):
    return fixed(snapshot(spark, sf))


def csv_roundtrip(spark, sf):
    """The snapshot written and read as CSV with public header names."""
    path = new_path(spark, "customers-csv")
    customers.write_customers_csv(snapshot(spark, sf), path)
    return fixed(customers.read_customers(spark, path))


def fill_median_train(spark, sf):
    flags = _pipe(spark, sf).prepared.select(KEY, "is_test")
    df = _numeric(spark, sf).join(flags, KEY)
    return fixed(cleaning.fill_median(df, "total_charges", fit_on="train").select(KEY, "total_charges"))


# --- features ----------------------------------------------------------------------------------

def one_hot(spark, sf):
    df = snapshot(spark, sf)
    return features.one_hot(df, features.fit_levels(df), keep=[KEY])


def engineered(spark, sf):
    names = ["avg_monthly_charges", "charge_per_tenure", "has_streaming", "has_security", "num_addon_services",
             "has_any_addon"]
    return fixed(features.engineer(_clean(spark, sf)).select(KEY, *names))


def align_features(spark, sf):
    """A frame that lacks one feature, brought to a stored order."""
    pipe = _pipe(spark, sf)
    lacking = pipe.prepared.drop("gender")
    return fixed(features.align(lacking, pipe.spec.names[::-1], keep=[KEY]))


def split_members(spark, sf):
    return _pipe(spark, sf).prepared.select(KEY, "label", F.col("is_test").cast("int").alias("is_test"))


def scaled_train(spark, sf):
    df = _pipe(spark, sf).scaled
    return fixed(df.select(KEY, F.col("is_test").cast("int").alias("is_test"), *features.SCALED))


def cv_folds(spark, sf):
    train = _pipe(spark, sf).prepared.where("not is_test").select(KEY, "label")
    return split.stratified_folds(train).groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n_rows"))


def sample_n(spark, sf):
    return split.sample_n(snapshot(spark, sf).select(KEY, "tenure"), 200)


# --- models ------------------------------------------------------------------------------------

def training_times(spark, sf):
    fitted = _pipe(spark, sf).fitted
    return spark.createDataFrame([(n, float(f.seconds)) for n, f in fitted.items()], "model string, seconds double")


def cv_scores(spark, sf):
    scores = _pipe(spark, sf).cv_scores
    overall = models.cv_overall(scores).scalar()
    return models.cv_summary(scores).withColumn("overall_mean", overall)


def cv_box(spark, sf):
    return profile.box_stats(_pipe(spark, sf).cv_scores, "auc", "model")


def model_scores(spark, sf):
    return _pipe(spark, sf).scored


def model_metrics(spark, sf):
    return evaluate.rounded(_pipe(spark, sf).metrics, evaluate.METRICS)


def model_roundtrip(spark, sf):
    """New customers scored by a saved and reloaded model with its own levels and scaler."""
    pipe = _pipe(spark, sf)
    path = new_path(spark, "model")
    artifacts.save_model(pipe.models[models.FOREST], pipe.spec, pipe.scaler, path)
    model, spec, scaler = artifacts.load_model(spark, path)
    frame = features.feature_frame(_clean(spark, sf), spec)
    aligned = features.align(frame, spec.names, keep=[KEY, "label"])
    return models.score(model, features.scale(aligned, scaler))


def splits_roundtrip(spark, sf):
    pipe = _pipe(spark, sf)
    path = new_path(spark, "splits")
    artifacts.write_splits(pipe.train, pipe.test, path)
    parts = [spark.read.parquet(f"{path}/{p}").withColumn("is_test", F.lit(int(p == "test"))) for p in ("train", "test")]
    return fixed(parts[0].unionByName(parts[1]).select(KEY, "label", "is_test", *features.SCALED))


def metadata_rows(spark, sf):
    pipe = _pipe(spark, sf)
    path = new_path(spark, "metadata")
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    trained_on = str(orders.agg(F.to_date(F.max("o_orderdate"))).first()[0])
    cv = models.cv_summary(pipe.cv_scores)
    made = artifacts.metadata(pipe.metrics, pipe.ranking, len(pipe.spec.names), pipe.test, trained_on, cv)
    artifacts.write_metadata(made, path)
    back = artifacts.read_metadata(spark, path)
    return back.select("best_model", "model_file", "metrics.*", "n_features", "test_set_size", "training_date")


def model_roc_curve(spark, sf):
    return evaluate.roc_curve(_pipe(spark, sf).scored, ["model"])


# --- explanations ------------------------------------------------------------------------------

def _shap_of(spark, sf, name):
    pipe = _pipe(spark, sf)
    return explain.long_form(pipe.explained(name)[0], pipe.spec.names)


def shap_additivity(spark, sf):
    """Base value plus attributions against the selected model's score, per customer."""
    pipe = _pipe(spark, sf)
    rows, base = pipe.explanation
    total = F.expr("aggregate(phi, 0D, (a, x) -> a + x)") + F.lit(base)
    score = total if pipe.best_name == models.FOREST else 1 / (1 + F.exp(-total))
    return pipe.best_scored.select("model", KEY, "score").join(rows.select(KEY, score.alias("explained")), KEY)


def model_invariants(spark, sf):
    """What must hold of the models, their choice and the explanation, whatever they learned."""
    pipe = _pipe(spark, sf)
    cv_scores = pipe.cv_scores  # first, so that folds and all rows are fitted in one series of passes
    per_model = pipe.scored.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("p"),
        F.count_if(~F.col("score").between(0, 1) | ((F.col("score") > 0.5).cast("int") != F.col("pred"))).alias("odd"),
        F.count_distinct(KEY).alias("keys"))
    sums = per_model.agg(
        F.count(F.lit(1)).alias("n_models"), F.min("n").alias("least_rows"), F.max("n").alias("most_rows"),
        F.min("keys").alias("least_keys"), F.min("p").alias("least_churners"), F.max("p").alias("most_churners"),
        F.sum("odd").alias("odd_scores"))
    counts = evaluate.confusion(pipe.scored, ["model"]).agg(
        F.min(F.col("tp") + F.col("fn")).alias("least_actual"), F.max(F.col("tp") + F.col("fn")).alias("most_actual"))
    best = pipe.ranking.agg(F.sum("is_best").alias("n_best"))
    off = shap_additivity(spark, sf).agg(
        F.count(F.lit(1)).alias("explained_rows"),
        F.count_if(F.abs(F.col("explained") - F.col("score")) > 1e-9).alias("unexplained"))
    ranked = pipe.importance.agg(F.count(F.lit(1)).alias("n_features"))
    share = explain.cum_importance(pipe.importance, len(pipe.spec.names)).agg(F.max("cum_pct").alias("whole_share"))
    cv = models.cv_summary(cv_scores).agg(
        F.count("cv_mean").alias("cv_models"), F.count_if(~F.col("cv_mean").between(0, 1)).alias("odd_cv"))
    meta = metadata_rows(spark, sf).select("test_set_size", F.col("n_features").alias("meta_features"),
                                           F.col("cv_auc_mean").isNotNull().cast("int").alias("meta_cv"))
    folds = cv_scores.agg(F.count_distinct("model", "fold").alias("fold_scores"))
    tiers = risk.risk_tiers(pipe.best_scored).agg(F.sum("n").alias("tier_rows"))
    # The importance of a feature is the mean of its absolute attributions; the strongest twenty have one for each row.
    phi = pipe.explanation[0].select(F.posexplode("phi").alias("i", "phi")).groupBy("i").agg(F.avg(F.abs("phi")).alias("mean"))
    listed = F.array(*[F.lit(n) for n in pipe.spec.names])
    unlike = phi.select(F.get(listed, F.col("i")).alias("feature"), "mean").join(pipe.importance, "feature").agg(
        F.count_if(F.abs(F.col("mean") - F.col("mean_abs_shap")) < 1e-12).alias("equal_importances"))
    cloud = shap_beeswarm(spark, sf).agg(F.count(F.lit(1)).alias("cloud_points"))
    row = sums
    for name, part in zip("abcdefghijk", (counts, best, off, ranked, share, cv, meta, folds, tiers, unlike, cloud)):
        row = row.withColumn(name, one_row(part)).select("*", f"{name}.*").drop(name)
    return fixed(row)


def model_tenure_points(spark, sf):
    """Tenure and the selected model's score, per customer."""
    return _pipe(spark, sf).best_scored.join(snapshot(spark, sf).select(KEY, "tenure"), KEY).select(KEY, "tenure", "score")


def model_action_list(spark, sf):
    best = _pipe(spark, sf).best_scored.select(KEY, "score")
    wanted = (KEY, "contract", "payment_method", "internet_service", "online_security", "tech_support", "tenure")
    return business.action_list(best.join(snapshot(spark, sf).select(*wanted), KEY))


def shap_waterfall(spark, sf):
    """One churner, chosen by key."""
    pipe = _pipe(spark, sf)
    who = pipe.test.where("label = 1").agg(F.min(KEY)).first()[0]
    return explain.waterfall(pipe.shap, who, pipe.explanation[1])


def shap_beeswarm(spark, sf):
    pipe = _pipe(spark, sf)
    return explain.of_top_features(pipe.shap, pipe.importance, 20)


def importance_roundtrip(spark, sf):
    path = new_path(spark, "importance")
    artifacts.write_importance(_pipe(spark, sf).importance, path)
    return spark.read.schema("feature string, mean_abs_shap double").option("header", True).csv(path)


def clean_labels(spark, sf):
    wide = snapshot(spark, sf).selectExpr(*[f"string({c}) as {c}" for c in CATEGORICAL])
    levels = wide.unpivot([], CATEGORICAL, "feature", "level").distinct()
    named = F.concat_ws("_", recode(F.col("feature"), {c: public(c) for c in CATEGORICAL}), "level")
    return levels.select(named.alias("feature")).select(
        "feature", clean_label(F.col("feature")).alias("display"), slug(F.col("feature")).alias("slug")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = _own_queries()
    for module in _llm():
        found |= module.queries()
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle_queries.oracle_sql()
    for module in _llm():
        found |= module.oracle_sql()
    return found


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    roi = lambda s, d: business.campaign_roi(_labelled(s, d), _scored(s, d))
    return {
        # A sources, sinks, cleaning
        "scan_snapshot": scan_snapshot,
        "csv_roundtrip": csv_roundtrip,
        "clean_numeric": lambda s, d: _numeric(s, d).select(KEY, "total_charges"),
        "missing_total_charges": lambda s, d: cleaning.missing_count(_numeric(s, d), "total_charges"),
        "fill_median": lambda s, d: fixed(_clean(s, d).select(KEY, "total_charges")),
        "fill_median_train": fill_median_train,
        "label": lambda s, d: _labelled(s, d).select(KEY, "label"),
        "splits_roundtrip": splits_roundtrip,
        "importance_roundtrip": importance_roundtrip,
        "model_roundtrip": model_roundtrip,
        "metadata_rows": metadata_rows,
        "report_rows": lambda s, d: fixed(profile.report(_clean(s, d), _numeric(s, d))),
        "final_report": lambda s, d: _pipe(s, d).report(),
        # B profiling
        "profile_shape": lambda s, d: profile.shape(snapshot(s, d)),
        "duplicate_rows": lambda s, d: profile.duplicate_rows(snapshot(s, d)),
        "missing_values": lambda s, d: profile.missing_values(_numeric(s, d)),
        "column_types": lambda s, d: profile.column_types(snapshot(s, d)),
        "class_balance": lambda s, d: fixed(profile.class_balance(snapshot(s, d))),
        "describe_numeric": lambda s, d: fixed(profile.describe(_numeric(s, d), digits=None)),
        "mean_by_class": lambda s, d: fixed(profile.mean_by(_numeric(s, d), "churn", NUMERIC)),
        "churn_rates_all": lambda s, d: fixed(profile.churn_rates(_labelled(s, d), digits=None)),
        "rate_contract": lambda s, d: fixed(profile.churn_rate_by(_labelled(s, d), "contract")),
        "rate_internet": lambda s, d: fixed(profile.churn_rate_by(_labelled(s, d), "internet_service")),
        "rate_payment": lambda s, d: fixed(profile.churn_rate_by(_labelled(s, d), "payment_method", sort=True)),
        "crosstab_contract": lambda s, d: profile.crosstab(snapshot(s, d), "contract"),
        "crosstab_internet": lambda s, d: profile.crosstab(snapshot(s, d), "internet_service"),
        "crosstab_contract_pct": lambda s, d: fixed(profile.crosstab_pct(snapshot(s, d), "contract")),
        "corr_matrix": lambda s, d: fixed(profile.corr_matrix(profile.numeric_frame(_clean(s, d)), digits=None)),
        "corr_target": lambda s, d: fixed(profile.corr_with_target(profile.numeric_frame(_clean(s, d)), digits=None)),
        "tenure_bands": lambda s, d: fixed(profile.tenure_bands(_labelled(s, d))),
        "association_rank": lambda s, d: fixed(profile.association_rank(_clean(s, d))),
        "hist_density": lambda s, d: fixed(profile.histogram(_clean(s, d), NUMERIC), height=12),
        "box_stats": lambda s, d: fixed(profile.box_stats(_clean(s, d), NUMERIC)),
        "kde_tenure": lambda s, d: fixed(profile.kde(snapshot(s, d), "tenure"), density=9),
        "scatter_tenure_charges": lambda s, d: fixed(profile.scatter(snapshot(s, d), "tenure", "monthly_charges")),
        "contract_profile": lambda s, d: fixed(profile.contract_profile(_labelled(s, d))),
        "key_insights": lambda s, d: fixed(profile.insights(_labelled(s, d))),
        # C features
        "encode_binary": lambda s, d: features.encode_binary(snapshot(s, d)).select(KEY, *BINARY),
        "one_hot": one_hot,
        "engineered": engineered,
        "split_counts": lambda s, d: split_members(s, d).groupBy("label", "is_test").agg(F.count(F.lit(1)).alias("n")),
        "split_members": split_members,
        "scaled_train": scaled_train,
        "smote_balance": lambda s, d: balance.balance_report(_pipe(s, d).train, _pipe(s, d).oversampled),
        "smote_rows": lambda s, d: fixed(_pipe(s, d).oversampled),
        "align_features": align_features,
        "sample_n": sample_n,
        # D models
        "training_times": training_times,
        "cv_folds": cv_folds,
        "cv_scores": cv_scores,
        "cv_box": cv_box,
        "model_scores": model_scores,
        # E evaluation
        "confusion": lambda s, d: fixed(evaluate.confusion(_scored(s, d))),
        "class_metrics": lambda s, d: fixed(evaluate.class_metrics(_scored(s, d))),
        "roc_auc": lambda s, d: fixed(evaluate.roc_auc(_scored(s, d)), 9),
        "roc_curve": lambda s, d: fixed(evaluate.roc_curve(all_stand_ins(_labelled(s, d)), ["model"]), 9),
        "metric_table": lambda s, d: fixed(evaluate.metric_table(all_stand_ins(_labelled(s, d))), 9),
        "select_best": lambda s, d: fixed(evaluate.select_best(
            evaluate.model_metrics(all_stand_ins(_labelled(s, d))), list(STAND_INS)), 9),
        "model_confusion": lambda s, d: evaluate.confusion(_pipe(s, d).scored, ["model"]),
        "model_metrics": model_metrics,
        "model_roc_curve": model_roc_curve,
        "model_ranking": lambda s, d: _pipe(s, d).ranking,
        # F risk
        "risk_tiers": lambda s, d: risk.risk_tiers(_scored(s, d)),
        "risk_bands": lambda s, d: risk.risk_bands(_scored(s, d)),
        "priority_tiers": lambda s, d: risk.priority_tiers(_scored(s, d)),
        "proba_hist": lambda s, d: fixed(risk.proba_hist(_scored(s, d))),
        "tenure_score_bins": lambda s, d: fixed(risk.tenure_score_bins(
            stand_in_scores(_labelled(s, d), keep=("tenure",)))),
        "tenure_trend": lambda s, d: fixed(risk.tenure_trend(stand_in_scores(_labelled(s, d), keep=("tenure",)))),
        "value_vs_score": lambda s, d: fixed(risk.value_vs_score(
            stand_in_scores(_clean(s, d), keep=(KEY, "total_charges")))),
        # F, G on the selected model
        "model_invariants": model_invariants,
        "model_risk_tiers": lambda s, d: risk.risk_tiers(_pipe(s, d).best_scored),
        "model_risk_bands": lambda s, d: risk.risk_bands(_pipe(s, d).best_scored),
        "model_proba_hist": lambda s, d: risk.proba_hist(_pipe(s, d).best_scored),
        "model_priority_tiers": lambda s, d: risk.priority_tiers(_pipe(s, d).best_scored),
        "model_tenure_points": model_tenure_points,
        "model_kpis": lambda s, d: business.scored_kpis(_labelled(s, d), _pipe(s, d).best_scored),
        "model_campaign_roi": lambda s, d: business.campaign_roi(_labelled(s, d), _pipe(s, d).best_scored),
        "model_action_list": model_action_list,
        # G business
        "kpis": lambda s, d: fixed(business.scored_kpis(_labelled(s, d), _scored(s, d)), revenue_at_risk=3),
        "monthly_risk": lambda s, d: fixed(business.monthly_risk(_labelled(s, d)), 3),
        "campaign_roi": lambda s, d: fixed(roi(s, d), 3),
        "roi_waterfall": lambda s, d: fixed(business.roi_waterfall(roi(s, d))),
        "segment_savings": lambda s, d: fixed(business.segment_savings(roi(s, d))),
        "savings_projection": lambda s, d: fixed(business.savings_projection(roi(s, d)), 3),
        "action_list": lambda s, d: business.action_list(stand_in_scores(
            _labelled(s, d),
            keep=(KEY, "contract", "payment_method", "internet_service", "online_security", "tech_support", "tenure"))),
        # H explanations
        "shap_best": lambda s, d: _pipe(s, d).shap.withColumn("model", F.lit(_pipe(s, d).best_name)),
        "shap_forest": lambda s, d: _shap_of(s, d, models.FOREST),
        "shap_boosted": lambda s, d: _shap_of(s, d, models.BOOSTED),
        "shap_linear": lambda s, d: _shap_of(s, d, models.LOGISTIC),
        "shap_additivity": shap_additivity,
        "shap_importance": lambda s, d: _pipe(s, d).importance,
        "shap_beeswarm": shap_beeswarm,
        "shap_dependence": lambda s, d: explain.of_top_features(_pipe(s, d).shap, _pipe(s, d).importance, 3),
        "shap_waterfall": shap_waterfall,
        "cum_importance": lambda s, d: explain.cum_importance(_pipe(s, d).importance),
        "features_to_reach": lambda s, d: explain.features_to_reach(
            explain.cum_importance(_pipe(s, d).importance, len(_pipe(s, d).spec.names))),
        # I labels
        "clean_label": clean_labels,
    }
