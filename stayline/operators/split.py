"""Exact seeded draws: stratified split, folds, sample of n rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.columns import KEY, SEED
from stayline.functions.exprs import hash_key
from stayline.operators.ordered import cuts_by_class, rank_cuts, shuffle_position


def stratified_split(df: DataFrame, label: str = "label", share: float = 0.2, seed: int = SEED,
                     key: str = KEY) -> DataFrame:
    """Add ``is_test``: exactly ``round(share * n)`` rows of every class, drawn by seeded hash."""
    cuts = rank_cuts(df, label, key, seed, lambda n: [F.round(n * F.lit(share))])
    cut = cuts_by_class(cuts, label)[F.col(label)][0]
    return df.withColumn("is_test", F.coalesce(shuffle_position(key, seed) <= cut, F.lit(False)))


def stratified_folds(df: DataFrame, label: str = "label", folds: int = 5, seed: int = SEED,
                     key: str = KEY) -> DataFrame:
    """Add ``fold`` 0..folds-1; within every class the sizes differ by at most one."""
    # Rank r of n lies in fold floor((r - 1) * folds / n); the last rank of fold f is ceil((f + 1) * n / folds).
    cuts = rank_cuts(df, label, key, seed, lambda n: [
        F.ceil(n * F.lit(f) / F.lit(folds)) for f in range(1, folds)
    ])
    placed = df.withColumn("_cuts", cuts_by_class(cuts, label)[F.col(label)]).withColumn(
        "_here", shuffle_position(key, seed)
    )
    passed = " + ".join(f"coalesce(int(_here > get(_cuts, {i})), 0)" for i in range(folds - 1))
    return placed.withColumn("fold", F.expr(passed)).drop("_cuts", "_here")


def sample_n(df: DataFrame, n: int, seed: int = SEED, key: str = KEY) -> DataFrame:
    """Seeded sample of n rows without replacement: a top-n by hash, not a sort of the table."""
    return df.withColumn("_h", hash_key(F.col(key), seed)).orderBy("_h", key).limit(n).drop("_h")
