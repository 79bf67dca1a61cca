"""Feature preparation: codes, indicators, engineered columns, alignment, vector, scaling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.columns import (
    ADDONS, BINARY, BINARY_CODES, ENGINEERED, KEPT_FEATURES, KEY, MULTI_LEVEL, SCALED, public,
)
from stayline.functions.exprs import col, one_row, recode

MAX_LEVELS = 1000


def encode_binary(df: DataFrame, cols: Sequence[str] = tuple(BINARY)) -> DataFrame:
    """Yes/No and Male/Female to 1/0; anything else becomes null."""
    return df.withColumns({c: recode(F.col(c), BINARY_CODES) for c in cols})


def fit_levels(df: DataFrame, cols: Sequence[str] = tuple(MULTI_LEVEL)) -> dict[str, list[str]]:
    """Sorted levels of every column, found in one pass and kept with the model.

    Only the distinct pairs reach the driver, and no more than ``MAX_LEVELS`` per column are
    accepted: each becomes a column.
    """
    pairs = df.unpivot([], list(cols), "feature", "level").where("level is not null").distinct()
    found = pairs.limit(MAX_LEVELS * len(cols) + 1).collect()
    levels = {c: sorted(r.level for r in found if r.feature == c) for c in cols}
    wide = [c for c in cols if len(levels[c]) > MAX_LEVELS]
    if wide or len(found) > MAX_LEVELS * len(cols):
        raise ValueError(f"too many levels for indicator columns: {wide or list(cols)}")
    return levels


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _indicators(levels: dict[str, list[str]]) -> list[str]:
    """SQL of one 0/1 column per level, named ``Column_level``."""
    return [
        f"if({c} <=> {_text(level)}, 1, 0) as `{public(c)}_{level}`" for c in levels for level in levels[c]
    ]


def one_hot(df: DataFrame, levels: dict[str, list[str]], keep: Sequence[str] = ()) -> DataFrame:
    """One 0/1 column per level, named ``Column_level``; no level is dropped."""
    return df.selectExpr(*keep, *_indicators(levels))


def _any_of(names: Sequence[str]) -> str:
    return " or ".join(f"{n} <=> 'Yes'" for n in names)


COUNT_ADDONS = " + ".join(f"int({a} <=> 'Yes')" for a in ADDONS)
DERIVED = {
    "avg_monthly_charges": "total_charges / (tenure + 1)",
    "charge_per_tenure": "monthly_charges / (tenure + 1)",
    "has_streaming": f"int({_any_of(['streaming_tv', 'streaming_movies'])})",
    "has_security": f"int({_any_of(['online_security', 'tech_support'])})",
    "num_addon_services": COUNT_ADDONS,
    "has_any_addon": f"int(({COUNT_ADDONS}) > 0)",
}


def engineer(df: DataFrame) -> DataFrame:
    """Derived columns. ``num_addon_services`` is the count; ``has_any_addon`` is its 0/1 form."""
    return df.selectExpr("*", *[f"{sql} as {name}" for name, sql in DERIVED.items()])


@dataclass(frozen=True)
class FeatureSpec:
    """Fitted levels and the ordered feature names."""

    levels: dict[str, list[str]] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        flags = [f"{public(c)}_{level}" for c in self.levels for level in self.levels[c]]
        return [public(c) for c in KEPT_FEATURES] + flags + list(ENGINEERED.values())


def feature_frame(df: DataFrame, spec: FeatureSpec, keep: Sequence[str] = (KEY, "churn", "label")) -> DataFrame:
    """Key, label and all features of a cleaned table as named columns, in one narrow projection."""
    codes = " ".join(f"when {_text(level)} then {code}" for level, code in BINARY_CODES.items())
    coded = [
        f"case {c} {codes} end as {public(c)}" if c in BINARY else f"{c} as {public(c)}" for c in KEPT_FEATURES
    ]
    made = [f"{DERIVED[c]} as {name}" for c, name in ENGINEERED.items()]
    return df.selectExpr(*keep, *coded, *_indicators(spec.levels), *made)


def align(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Features in the stored order; those the frame lacks are 0, extra columns go."""
    present = set(df.columns)
    return df.selectExpr(
        *[f"`{k}`" for k in keep], *[f"`{n}`" if n in present else f"0 as `{n}`" for n in names]
    )


def fit_scaler(train: DataFrame, cols: Sequence[str] = tuple(SCALED)) -> DataFrame:
    """Mean and population deviation per column, as one row."""
    return train.agg(*[
        F.struct(F.avg(col(c)).alias("mean"), F.stddev_pop(col(c)).alias("std")).alias(c) for c in cols
    ])


def scale(df: DataFrame, fitted: DataFrame, cols: Sequence[str] = tuple(SCALED), suffix: str = "") -> DataFrame:
    """Standardise with fitted values; a constant column is only centred.

    With a ``suffix`` the scaled columns are added beside the raw ones.
    """
    stats = one_row(fitted)
    done = {}
    for c in cols:
        std = stats[c]["std"]
        done[f"{c}{suffix}"] = (col(c) - stats[c]["mean"]) / F.when(std == 0, F.lit(1.0)).otherwise(std)
    return df.withColumns(done)


def assemble(df: DataFrame, names: Sequence[str], output: str = "features") -> DataFrame:
    """Vector column in stored feature order; names stay in its metadata."""
    return VectorAssembler(inputCols=list(names), outputCol=output).transform(df)
