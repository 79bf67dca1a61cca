"""Risk tiers and distributions of the attrition score."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.columns import BAND_EDGES, HIGH_RISK, KEY, MEDIUM_RISK, PRIORITY_LABELS, RISK_LABELS
from stayline.functions.exprs import band_index, band_label, one_row


def tier(score: str = "score") -> str:
    """SQL of the left-closed key-figure tier."""
    return f"case when {score} >= {HIGH_RISK}D then 'high' when {score} >= {MEDIUM_RISK}D then 'medium' else 'low' end"


def tier_counts(df: DataFrame, score: str = "score") -> DataFrame:
    """One row: customers per key-figure tier."""
    return df.agg(*_tier_aggregates(score))


def _tier_aggregates(score: str = "score") -> list[Column]:
    return [F.expr(f"count_if({tier(score)} = '{t}') as n_{t}") for t in ("high", "medium", "low")]


def scored_summary(df: DataFrame, score: str = "score", pred: str = "pred") -> DataFrame:
    """One row: customers per key-figure tier and the predicted churn rate."""
    return df.agg(*_tier_aggregates(score), F.expr(f"avg({pred}) * 100 as predicted_rate"))


def risk_tiers(df: DataFrame, score: str = "score") -> DataFrame:
    return tier_counts(df, score).selectExpr(
        "stack(3, 'high', n_high, 'medium', n_medium, 'low', n_low) as (tier, n)"
    )


def risk_bands(df: DataFrame, score: str = "score", edges: Sequence[float] = tuple(BAND_EDGES),
               labels: Sequence[str] = tuple(RISK_LABELS)) -> DataFrame:
    """Customers per right-closed band in fixed order; empty bands stay, a score of 0 is in none."""
    index = band_index(F.col(score), edges)
    counts = df.agg(*[F.count_if(index == i + 1).alias(f"n{i}") for i in range(len(labels))])
    rows = ", ".join(f"{i + 1}, '{label}', n{i}" for i, label in enumerate(labels))
    return counts.selectExpr(f"stack({len(labels)}, {rows}) as (band_ord, band, n)")


def priority_tiers(df: DataFrame, score: str = "score", key: str = KEY) -> DataFrame:
    """Priority label of every scored customer; ``split.sample_n`` draws some of them for a chart."""
    return df.select(key, score).withColumn("priority", band_label(F.col(score), BAND_EDGES, PRIORITY_LABELS))


def proba_hist(df: DataFrame, bins: int = 40, score: str = "score", label: str = "label") -> DataFrame:
    """Score histogram on [0, 1] per actual class; only bins that hold rows."""
    index = F.expr(f"int(least(width_bucket({score}, 0.0D, 1.0D, {bins}), {bins}))")
    counts = df.select(label, index.alias("bin")).groupBy(label, "bin").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(label, "bin", ((F.col("bin") - 0.5) / bins).alias("centre"), "n")


def tenure_score_bins(df: DataFrame, column: str = "tenure", score: str = "score", bins: int = 10) -> DataFrame:
    """Mean score in equal-width, right-closed bins; the lowest edge reaches 0.1 % of the range lower."""
    data = df.select(F.col(column).cast("double").alias("x"), F.col(score).alias("s"))
    r = one_row(data.agg(F.min("x").alias("lo"), F.max("x").alias("hi")))
    placed = data.withColumn("r", r).selectExpr(
        "r", "s",
        f"int(greatest(1, least({bins}, coalesce(ceil(try_divide(x - r.lo, (r.hi - r.lo) / {bins})), 1)))) as bin",
    )
    grouped = placed.groupBy("bin").agg(
        F.expr("count(1) as n"), F.expr("avg(s) as mean_score"), F.expr("first(r.lo) as lo"), F.expr("first(r.hi) as hi")
    )
    left = f"if(bin = 1, lo - 0.001D * (hi - lo), lo + (bin - 1) * ((hi - lo) / {bins}))"
    return grouped.selectExpr("bin", "n", "mean_score", f"({left} + (lo + bin * ((hi - lo) / {bins}))) / 2 as mid")


def tenure_trend(df: DataFrame, column: str = "tenure", score: str = "score", degree: int = 3,
                 points: int = 100) -> DataFrame:
    """Least-squares polynomial of the score, evaluated on an even grid over the data's range.

    Two passes: the range, then the power sums of x mapped to [-1, 1], which keeps the small system
    well conditioned. Only those sums reach the driver.
    """
    data = df.select(F.col(column).cast("double").alias("x"), F.col(score).alias("s")).where(
        "x is not null and s is not null"
    )
    low, high = data.agg(F.min("x"), F.max("x")).first()
    if low is None or low == high:
        raise ValueError(f"{column} needs two distinct values for a trend")
    z = f"((2 * x - ({low!r}D + {high!r}D)) / ({high!r}D - {low!r}D))"
    powers = [F.expr(f"sum(pow({z}, {i}))") for i in range(2 * degree + 1)]
    crossed = [F.expr(f"sum(s * pow({z}, {i}))") for i in range(degree + 1)]
    sums = list(data.agg(*powers, *crossed).first())
    left = np.array([[sums[i + j] for j in range(degree + 1)] for i in range(degree + 1)])
    coefs = np.linalg.lstsq(left, np.array(sums[2 * degree + 1:]), rcond=None)[0]
    trend = " + ".join(f"({c!r}D) * pow(z, {i})" for i, c in enumerate(coefs.tolist()))
    grid = df.sparkSession.range(points).selectExpr(
        "int(id) as point", f"{low!r}D + id * ({high - low!r}D / {points - 1}) as x"
    )
    return grid.selectExpr("point", "x", f"{z} as z").selectExpr("point", "x", f"{trend} as trend")


def value_vs_score(df: DataFrame, key: str = KEY, score: str = "score") -> DataFrame:
    """Observed value against score, per customer."""
    return df.select(key, score, "total_charges", band_label(F.col(score), BAND_EDGES, PRIORITY_LABELS).alias("priority"))

