"""Distributed training, scoring and cross validation of the four classifiers."""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.columns import KEY, SEED
from stayline.operators import boosting
from stayline.operators.balance import smote
from stayline.operators.boosting import Boosting
from stayline.operators.evaluate import roc_auc
from stayline.operators.features import assemble
from stayline.operators.split import stratified_folds
from stayline.session import materialise

LOGISTIC, FOREST, BOOSTED, BOOSTED_NARROW = (
    "Logistic Regression", "Random Forest", "Gradient Boosting", "Leaf-wise Gradient Boosting",
)
ROWS_PER_TASK = 20_000
MODEL_ORDER = [LOGISTIC, FOREST, BOOSTED, BOOSTED_NARROW]


def estimators(
    n_train: int, trees: int = 200, depth: int = 10, rounds: int = 200, boost_depth: int = 6, leaves: int = 31,
    seed: int = SEED,
) -> dict[str, Estimator | Boosting]:
    """The four learners in comparison order.

    Logistic regression: an inverse penalty C = 1 on the summed loss equals a penalty of 1/n on the mean loss. Both
    boosted learners draw 0.8 of the rows and of the columns per tree. One splits whole levels; the leaf-wise one grows
    best-first to ``leaves`` leaves, at the usual settings of that kind: no penalty, at least 20 rows in a leaf.
    """
    return {
        LOGISTIC: LogisticRegression(
            regParam=1.0 / n_train, elasticNetParam=0.0, standardization=False, maxIter=1000
        ),
        FOREST: RandomForestClassifier(
            numTrees=trees, maxDepth=depth, minInstancesPerNode=5, featureSubsetStrategy="sqrt", seed=seed,
            cacheNodeIds=True, checkpointInterval=10,
        ),
        BOOSTED: Boosting(rounds, boost_depth, seed=seed),
        BOOSTED_NARROW: Boosting(rounds, boost_depth, leaves, l2=0.0, min_hessian=1e-3, min_rows=20, seed=seed + 1),
    }


def fit_table(df: DataFrame, names: Sequence[str], name: str = "fit-rows") -> tuple[DataFrame, int]:
    """Label and feature vector as a table cut for training, and its row count.

    Learners pass over it many times, so tasks too small to be worth starting are merged; large
    tables keep the partitions they have.
    """
    n = df.count()
    rows = assemble(df, names).select("label", "features").coalesce(max(1, math.ceil(n / ROWS_PER_TASK)))
    return materialise(rows, name), n


@dataclass
class Fitted:
    """A model and what its fit cost: wall time of a learner of its own, CPU time of the tasks of a shared one."""

    model: Model
    seconds: float


def _members(sets: dict[str, DataFrame], key: str) -> DataFrame:
    """The rows of all sets, each with a bit per set that holds it. Rows met in several sets appear once."""
    marked = [df.withColumn("member", F.lit(1 << i).cast("bigint")) for i, df in enumerate(sets.values())]
    whole = reduce(DataFrame.unionByName, marked)
    others = [c for c in whole.columns if c != "member"]
    return whole.groupBy(*others).agg(F.bit_or("member").alias("member"))


def fit_sets(
    sets: dict[str, DataFrame], names: Sequence[str], learners: dict[str, Estimator | Boosting], key: str = KEY,
    parallelism: int = 4,
) -> dict[str, dict[str, Fitted]]:
    """Every learner on every set of rows (key, label, features by name).

    The boosted ones grow side by side on one table of all sets' rows, in one series of passes. The others are
    independent jobs and are submitted beside it.
    """
    names = list(names)
    spark = next(iter(sets.values())).sparkSession
    own = {n: v for n, v in learners.items() if not isinstance(v, Boosting)}
    shared = {n: v for n, v in learners.items() if isinstance(v, Boosting)}
    found: dict[str, dict[str, Fitted]] = {s: {} for s in sets}
    sets = {s: df.select(key, "label", *[F.col(f"`{n}`").cast("double").alias(n) for n in names]) for s, df in sets.items()}

    def grown() -> None:
        rows = materialise(_members(sets, key), "members")
        edges = boosting.bin_edges(rows, names)
        fits = [(s, n, bit) for n in shared for bit, s in enumerate(sets)]
        made = boosting.grow(boosting.blocks(rows, names, edges, key), edges, [(bit, shared[n]) for _, n, bit in fits])
        for (s, n, _), model in zip(fits, made):
            found[s][n] = Fitted(model, model.seconds)

    def alone(job: tuple[str, str]) -> None:
        s, n = job
        start = time.perf_counter()
        found[s][n] = Fitted(own[n].fit(tables[s]), time.perf_counter() - start)

    # Threads hand jobs to the cluster; a small job leaves cores to the others.
    with ThreadPool(1) as one, ThreadPool(parallelism) as pool:
        growing = one.apply_async(inheritable_thread_target(spark)(grown)) if shared else None
        if own:
            tables = dict(zip(sets, pool.map(
                inheritable_thread_target(spark)(lambda s: fit_table(sets[s], names)[0]), sets)))
            pool.map(inheritable_thread_target(spark)(alone), [(s, n) for n in own for s in sets], chunksize=1)
        if growing:
            growing.get()
    return {s: {n: found[s][n] for n in learners} for s in sets}


def score(model: Model, df: DataFrame, keep: Sequence[str] = (KEY, "label")) -> DataFrame:
    """Probability of the positive class and the predicted class, beside key and label."""
    out = model.transform(df)
    return out.select(
        *keep, vector_to_array("probability")[1].alias("score"), F.col("prediction").cast("int").alias("pred")
    )


def score_all(models: dict[str, Model], df: DataFrame, keep: Sequence[str] = (KEY, "label")) -> DataFrame:
    """Scored rows of all models, stacked by model. The rows are read once."""
    out = df
    for i, model in enumerate(models.values()):
        out = model.transform(out).withColumns({
            f"s{i}": vector_to_array("probability")[1], f"p{i}": F.col("prediction").cast("int"),
        }).drop("rawPrediction", "probability", "prediction")
    rows = ", ".join(f"'{name}', s{i}, p{i}" for i, name in enumerate(models))
    return out.selectExpr(*keep, f"stack({len(models)}, {rows}) as (model, score, pred)")


def folded_sets(
    train: DataFrame, names: Sequence[str], folds: int = 5, seed: int = SEED, leaky: bool = False, parallelism: int = 5,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The rows to fit each fold on, oversampled, by the fold's number; and all rows with their ``fold``.

    Oversampling happens inside each fold, on its training part only, so no synthetic row is built
    from a row it is judged on. ``leaky=True`` oversamples first and folds afterwards.
    """
    names = list(names)
    spark = train.sparkSession
    source = smote(train, names, seed=seed) if leaky else train
    folded = materialise(stratified_folds(source, "label", folds, seed), "folds")

    def part(fold: int) -> DataFrame:
        rest = folded.where(F.col("fold") != fold)
        return rest if leaky else materialise(smote(rest, names, seed=seed), f"fold-{fold}")

    with ThreadPool(parallelism) as pool:
        parts = pool.map(inheritable_thread_target(spark)(part), range(folds))
    return {str(f): p for f, p in enumerate(parts)}, folded


def fold_aucs(fitted: dict[str, dict[str, Fitted]], folded: DataFrame, names: Sequence[str]) -> DataFrame:
    """AUC as rows (model, fold, auc): each fold scored by the models fitted on the others."""
    scored = []
    for fold, models in fitted.items():
        held_out = assemble(folded.where(F.col("fold") == int(fold)), list(names)).select(KEY, "label", "features")
        rows = score_all({n: m.model for n, m in models.items()}, held_out)
        scored.append(rows.withColumn("fold", F.lit(int(fold))))
    every = materialise(reduce(DataFrame.unionByName, scored), "fold-scores")
    return roc_auc(every, ["model", "fold"]).select("model", "fold", F.col("roc_auc").alias("auc"))


def cross_validate(
    train: DataFrame, names: Sequence[str], learners: dict[str, Estimator | Boosting], folds: int = 5, seed: int = SEED,
    leaky: bool = False,
) -> DataFrame:
    """AUC per model and fold as rows (model, fold, auc); all folds and learners are fitted together."""
    sets, folded = folded_sets(train, names, folds, seed, leaky)
    return fold_aucs(fit_sets(sets, names, learners), folded, names)


def cv_summary(scores: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold scores per model."""
    return scores.groupBy("model").agg(F.avg("auc").alias("cv_mean"), F.stddev_pop("auc").alias("cv_std"))


def cv_overall(scores: DataFrame) -> DataFrame:
    """Mean of the models' mean scores."""
    return cv_summary(scores).agg(F.avg("cv_mean").alias("overall_mean"))
