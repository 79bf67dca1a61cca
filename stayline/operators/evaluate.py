"""Evaluation of scored rows: confusion counts, metrics, ROC, model comparison and choice.

Scored rows hold ``label`` (0/1), ``score`` (probability) and ``pred`` (0/1). ``by`` names grouping
columns such as the model, so all models are evaluated in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.columns import METRICS, SELECTION_WEIGHTS
from stayline.functions.exprs import half_even, one_row, ratio, ratio_or_zero
from stayline.operators.ordered import running_sum


def confusion(df: DataFrame, by: Sequence[str] = (), label: str = "label", pred: str = "pred") -> DataFrame:
    """Confusion counts and each cell's share of its actual class."""
    cells = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    counts = df.groupBy(*by).agg(*[
        F.expr(f"count_if({label} = {actual} and {pred} = {guess}) as {name}") for name, (actual, guess) in cells.items()
    ])
    return counts.selectExpr(
        "*",
        *[f"try_divide(double({cell}), double(tn + fp)) as {cell}_share" for cell in ("tn", "fp")],
        *[f"try_divide(double({cell}), double(fn + tp)) as {cell}_share" for cell in ("fn", "tp")],
    )


def class_metrics(df: DataFrame, by: Sequence[str] = (), label: str = "label", pred: str = "pred") -> DataFrame:
    """Accuracy, precision, recall and F1; a zero denominator gives 0."""
    return metrics_from_counts(confusion(df, by, label, pred), by)


def metrics_from_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *by,
        ratio_or_zero(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def _by_score(df: DataFrame, by: Sequence[str], label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score; combined before the shuffle."""
    return df.groupBy(*by, F.col(score).alias("score")).agg(
        F.expr(f"count_if({label} = 1) as pos"), F.expr(f"count_if({label} = 0) as neg")
    )


def roc_auc(df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve by rank sum, tied scores counted half; null with a single class."""
    ranked = running_sum(_by_score(df, by, label, score), "score", ["neg"], by)
    won = ranked.withColumn("won", F.expr("double(pos) * (cum_neg - neg / 2.0D)"))
    sums = won.groupBy(*by).agg(F.sum("won").alias("won"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return sums.select(*by, F.expr("try_divide(won, double(p) * n) as roc_auc"))


def roc_curve(df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "score") -> DataFrame:
    """ROC points, one per distinct score plus the origin at threshold infinity."""
    by = list(by)
    ranked = running_sum(_by_score(df, by, label, score), "score", ["pos", "neg"], by, descending=True)
    totals = df.groupBy(*by).agg(F.expr(f"count_if({label} = 1) as p"), F.expr(f"count_if({label} = 0) as n"))
    if by:
        joined = ranked.join(totals, by)
    else:
        joined = ranked.withColumn("t", one_row(totals)).select("*", "t.*")
    points = joined.select(
        *by, F.col("score").alias("threshold"),
        ratio(F.col("cum_neg"), F.col("n")).alias("fpr"), ratio(F.col("cum_pos"), F.col("p")).alias("tpr"),
    )
    origin = totals.select(*by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(origin)


def model_metrics(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """All five metrics per model as one wide row."""
    return class_metrics(df, by).join(roc_auc(df, by), list(by))


def metric_table(df: DataFrame, by: str = "model") -> DataFrame:
    """Comparison as rows (model, metric, value)."""
    return model_metrics(df, [by]).unpivot([by], METRICS, "metric", "value")


def composite() -> Column:
    return sum(
        (F.lit(w) * F.col(m) for m, w in list(SELECTION_WEIGHTS.items())[1:]),
        F.lit(SELECTION_WEIGHTS["f1"]) * F.col("f1"),
    )


def select_best(metrics: DataFrame, order: Sequence[str], by: str = "model") -> DataFrame:
    """Composite score per model, best first; the model listed first wins a tie."""
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col(by))
    scored = metrics.withColumn("composite", composite()).withColumn("place", place)
    rank = F.row_number().over(Window.orderBy(F.desc("composite"), "place"))  # one row per model
    return scored.select(by, "composite", rank.alias("rank"), (rank == 1).cast("int").alias("is_best"))


def rounded(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    return df.withColumns({c: half_even(F.col(c), digits) for c in cols})
