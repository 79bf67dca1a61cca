"""Cleaning: lenient cast, missing values, label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.exprs import to_number
from stayline.operators.ordered import exact_quantiles


def to_numeric(df: DataFrame, source: str, target: str | None = None) -> DataFrame:
    """Cast text to double; blank or malformed text becomes null."""
    return df.withColumn(target or source, to_number(F.col(source)))


def with_total_charges(df: DataFrame) -> DataFrame:
    """Replace the raw text column by the numeric one, in place."""
    return df.select(*[
        to_number(F.col(c)).alias("total_charges") if c == "total_charges_raw" else F.col(c) for c in df.columns
    ])


def missing_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).alias("n_missing"))


def median_of(df: DataFrame, column: str) -> Column:
    """Exact median as a scalar subquery."""
    return exact_quantiles(df, [column], [0.5]).select("value").scalar()


def fill_median(df: DataFrame, column: str, fit_on: str = "all", train_flag: str = "is_test") -> DataFrame:
    """Fill nulls with the exact median, fitted on all rows or on the training rows only."""
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on is 'all' or 'train'")
    fitted = df if fit_on == "all" else df.where(~F.col(train_flag))
    return df.withColumn(column, F.coalesce(F.col(column), median_of(fitted, column)))


def with_label(df: DataFrame, column: str = "churn", positive: str = "Yes") -> DataFrame:
    """0/1 label: 1 where the class is the positive one."""
    return df.withColumn("label", F.when(F.col(column) == positive, 1).otherwise(0))


def clean(df: DataFrame) -> DataFrame:
    """Raw customer table with numeric, filled total charges and a label."""
    return with_label(fill_median(with_total_charges(df), "total_charges"))
