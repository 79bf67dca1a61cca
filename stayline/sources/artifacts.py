"""Sinks and sources of the pipeline: splits, importance, models, metadata, reports."""

from __future__ import annotations

from pyspark.ml import Model, PipelineModel, classification
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.columns import METRICS
from stayline.functions.exprs import slug
from stayline.operators.boosting import BoostedTrees
from stayline.operators.features import FeatureSpec
from stayline.operators.models import Fitted


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def write_splits(train: DataFrame, test: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Processed training and test rows."""
    write_table(train, f"{path}/train", fmt)
    write_table(test, f"{path}/test", fmt)


def write_importance(ranked: DataFrame, path: str, fmt: str = "csv") -> None:
    write_table(ranked, path, fmt)


def save_model(model: Model, spec: FeatureSpec, scaler: DataFrame, path: str) -> None:
    """Model with its vector assembly, fitted levels and scaler: all that scoring new rows needs."""
    spark = scaler.sparkSession
    assembler = VectorAssembler(inputCols=spec.names, outputCol="features")
    boosted = isinstance(model, BoostedTrees)
    PipelineModel([assembler] if boosted else [assembler, model]).write().save(f"{path}/model")
    if boosted:
        model.save(f"{path}/trees")
    scaler.write.parquet(f"{path}/scaler")
    rows = [(c, i, level) for c, levels in spec.levels.items() for i, level in enumerate(levels)]
    order = {c: p for p, c in enumerate(spec.levels)}
    spark.createDataFrame(
        [(order[c], c, i, level) for c, i, level in rows], "position int, column_name string, ord int, level string"
    ).write.parquet(f"{path}/levels")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, FeatureSpec, DataFrame]:
    levels: dict[str, list[str]] = {}
    for r in spark.read.parquet(f"{path}/levels").orderBy("position", "ord").collect():  # fitted levels only
        levels.setdefault(r.column_name, []).append(r.level)
    model = PipelineModel.load(f"{path}/model")
    if len(model.stages) == 1:  # the assembler alone: the trees lie beside it
        model = PipelineModel([*model.stages, BoostedTrees.load(spark, f"{path}/trees")])
    return model, FeatureSpec(levels), spark.read.parquet(f"{path}/scaler")


def save_fitted(spark: SparkSession, fitted: dict[str, Fitted], path: str) -> None:
    """Models by name, in the order given, with what their fits cost."""
    for i, f in enumerate(fitted.values()):
        if isinstance(f.model, BoostedTrees):
            f.model.save(f"{path}/{i}")
        else:
            f.model.write().save(f"{path}/{i}")
    rows = [(i, n, type(f.model).__name__, float(f.seconds)) for i, (n, f) in enumerate(fitted.items())]
    spark.createDataFrame(rows, "place int, name string, kind string, seconds double").coalesce(1).write.parquet(f"{path}/list")


def load_fitted(spark: SparkSession, path: str) -> dict[str, Fitted]:
    """Models saved by ``save_fitted``."""
    found = {}
    for r in spark.read.parquet(f"{path}/list").orderBy("place").collect():  # a few models
        own = f"{path}/{r['place']}"
        model = BoostedTrees.load(spark, own) if r["kind"] == "BoostedTrees" else getattr(classification, r["kind"]).load(own)
        found[r["name"]] = Fitted(model, r["seconds"])
    return found


_FIVE = ", ".join(f"{m}: double" for m in METRICS)
METADATA_SCHEMA = (
    f"best_model string, model_file string, metrics struct<{_FIVE}, cv_auc_mean: double, cv_auc_std: double>, "
    f"all_models map<string, struct<{_FIVE}>>, n_features int, test_set_size bigint, training_date string"
)


def metadata(metrics: DataFrame, best: DataFrame, n_features: int, test_rows: DataFrame, trained_on: str,
             cv: DataFrame | None = None) -> DataFrame:
    """One nested row: winner, its file name, metrics of all models at 4 decimals, sizes, date.

    ``cv`` holds ``model, cv_mean, cv_std``; without it the winner's fold scores are null.
    """
    winner = best.where("is_best = 1").select("model").scalar()
    values = ", ".join(f"'{m}', rint({m} * 1e4D) / 1e4D" for m in METRICS)
    listed = metrics.agg(F.expr(f"map_from_entries(collect_list((model, named_struct({values})))) as all_models"))
    listed = listed.withColumn("best_model", winner)
    if cv is None:
        folds = F.expr("named_struct('cv_mean', cast(null as double), 'cv_std', cast(null as double))")
    else:
        own_folds = cv.groupBy().agg(
            F.map_from_entries(F.collect_list(F.struct("model", F.struct("cv_mean", "cv_std")))).alias("m"))  # few models
        folds = own_folds.scalar()[F.col("best_model")]
    own = ", ".join(f"'{m}', all_models[best_model].{m}" for m in METRICS)
    return listed.withColumn("cv", folds).select(
        "best_model", slug(F.col("best_model"), "_best_model").alias("model_file"),
        F.expr(f"named_struct({own}, 'cv_auc_mean', rint(cv.cv_mean * 1e4D) / 1e4D, "
               "'cv_auc_std', rint(cv.cv_std * 1e4D) / 1e4D) as metrics"),
        "all_models", F.lit(n_features).alias("n_features"),
        test_rows.agg(F.count(F.lit(1))).scalar().alias("test_set_size"), F.lit(trained_on).alias("training_date"),
    )


def write_metadata(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.json(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata written by ``write_metadata``, or a pretty-printed JSON document."""
    return spark.read.schema(METADATA_SCHEMA).option("multiLine", True).json(path)
