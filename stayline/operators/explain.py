"""Attribution of scores to features: forest (path dependent), linear, and their summaries."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from math import factorial

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.columns import KEY

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows that a task explains at once: the work per leaf that does not depend on rows is shared by them.
ATTRIBUTED_ROWS = 30_000
#: Features of a path up to which its patterns are numbered directly (4,096 of them); longer paths sort theirs.
TABLE_FEATURES = 12
#: Conditions whose rows a task keeps, some 60 KB each.
HELD_CONDITIONS = 1000


def _nodes(spark: SparkSession, path: str) -> DataFrame:
    n = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("id"), n["leftChild"].alias("left"),
        n["rightChild"].alias("right"), n["split"]["featureIndex"].alias("feature"),
        F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        n["impurityStats"].alias("stats"), n["prediction"].alias("prediction"),
    )


def forest_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Node table of a saved forest, one row per node; ``value`` is its share of the mean over all trees."""
    nodes = _nodes(spark, path).withColumn("positive", F.col("stats")[1]).withColumn(
        "cover", F.expr("aggregate(stats, 0D, (a, x) -> a + x)"))
    trees = nodes.agg(F.count_distinct("tree")).scalar()
    return nodes.withColumn("value", F.col("positive") / F.col("cover") / trees).drop("stats", "prediction")


def tree_leaves(nodes: DataFrame) -> list[tuple]:
    """Paths of all leaves: (features, lower bounds, upper bounds, cover ratios, value).

    A feature met more than once on a path is folded into one interval and one ratio. What is gathered
    is the model itself, which the driver and every executor hold to score with; it does not grow with rows.
    """
    trees: dict[int, dict[int, object]] = {}
    for r in nodes.collect():
        trees.setdefault(r.tree, {})[r.id] = r
    leaves = []
    for tree in trees.values():
        stack = [(0, {})]
        while stack:
            node_id, path = stack.pop()
            node = tree[node_id]
            if node.left < 0:
                feats = sorted(path)
                lo, hi, z = (np.array([path[f][i] for f in feats]) for i in range(3))
                leaves.append((np.array(feats, dtype=int), lo, hi, z, node.value))
                continue
            lo, hi, z = path.get(node.feature, (-np.inf, np.inf, 1.0))
            for child, bounds in ((node.left, (lo, min(hi, node.threshold))), (node.right, (max(lo, node.threshold), hi))):
                share = tree[child].cover / node.cover
                stack.append((child, {**path, node.feature: (*bounds, z * share)}))
    return leaves


def tree_base(leaves: list[tuple]) -> float:
    """Expected value with no feature known."""
    return float(sum(value * np.prod(z) for _, _, _, z, value in leaves))


def _leaf_shares(follows: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Shapley share of each path feature for each pattern of followed conditions.

    For feature j the other features k multiply out (z_k + o_k t); the coefficient of t^s sums all
    coalitions of size s, weighted s! (m - 1 - s)! / m!. The product over all features is formed once
    and divided by the factor of j: from the top where o_j = 1, by z_j where o_j = 0.
    """
    m = len(z)
    product = np.zeros((len(follows), m + 1))
    product[:, 0] = 1.0
    for k in range(m):
        shifted = product[:, :-1] * follows[:, [k]]
        product *= z[k]
        product[:, 1:] += shifted
    inside = follows > 0
    total, quotient = np.zeros(follows.shape), np.zeros(follows.shape)
    for s in range(m - 1, -1, -1):
        quotient = product[:, [s + 1]] - z * quotient
        weight = factorial(s) * factorial(m - 1 - s) / factorial(m)
        total += weight * np.where(inside, quotient, product[:, [s]] / z)
    return (follows - z) * total


def _tree_attribution(x: np.ndarray, leaves: list[tuple]) -> np.ndarray:
    columns = np.ascontiguousarray(x.T)
    out = np.zeros(columns.shape)
    known: dict[tuple, np.ndarray] = {}  # rows that meet a condition; leaves share many

    def met(f: int, low: float, high: float) -> np.ndarray:
        if (f, low, high) not in known:
            if len(known) >= HELD_CONDITIONS:
                known.clear()
            known[f, low, high] = ((columns[f] > low) & (columns[f] <= high)).astype("u2")
        return known[f, low, high]

    for feats, lo, hi, z, value in leaves:
        m = len(feats)
        if not m or value == 0.0:
            continue
        pattern = np.zeros(len(x), "u2" if m <= TABLE_FEATURES else "i8")
        for k, condition in enumerate(zip(feats.tolist(), lo.tolist(), hi.tolist())):
            pattern |= met(*condition).astype(pattern.dtype, copy=False) << pattern.dtype.type(k)
        # Rows that follow the same conditions share the result.
        if m <= TABLE_FEATURES:
            group = pattern.astype(np.intp)
            present = np.flatnonzero(np.bincount(group))
            shares = np.empty((m, present[-1] + 1))
        else:
            present, group = np.unique(pattern, return_inverse=True)
            shares = np.empty((m, len(present)))
        follows = (present[:, None] >> np.arange(m) & 1).astype(float)
        shares[:, present if m <= TABLE_FEATURES else slice(None)] = (value * _leaf_shares(follows, z)).T
        for k, f in enumerate(feats.tolist()):
            out[f] += shares[k].take(group)
    return np.ascontiguousarray(out.T)


def _joined(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Batches of at least ``rows`` rows, the last one excepted."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        held.append(pdf)
        if sum(map(len, held)) >= rows:
            yield pd.concat(held, ignore_index=True)
            held = []
    if sum(map(len, held)):
        yield pd.concat(held, ignore_index=True)


def long_form(df: DataFrame, names: Sequence[str], key: str = KEY) -> DataFrame:
    """Rows (key, feature, feature_value, shap) of a table with the arrays ``x`` and ``phi``."""
    listed = F.array(*[F.lit(n) for n in names])
    zipped = F.arrays_zip(listed.alias("feature"), F.col("x").alias("feature_value"), F.col("phi").alias("shap"))
    return df.select(key, F.inline(zipped))


def shap_tree(df: DataFrame, leaves: list[tuple], key: str = KEY, partitions: int | None = None) -> DataFrame:
    """Rows (key, x, phi): feature values and attributions of every row of ``df``, in feature order.

    ``df`` holds the assembled vector. The leaf table is broadcast once; rows stay where they are,
    unless ``partitions`` spreads a table too small to occupy the cores by itself.
    """
    shared = df.sparkSession.sparkContext.broadcast(leaves)

    def attribute(batches):
        for pdf in _joined(batches, ATTRIBUTED_ROWS):
            x = np.stack(pdf["x"].to_numpy())
            phi = _tree_attribution(x, shared.value)
            yield pd.DataFrame({key: pdf[key], "x": list(x), "phi": list(phi)})

    rows = df.select(key, vector_to_array("features").alias("x"))
    rows = rows.repartition(partitions, key) if partitions else rows
    return rows.mapInPandas(attribute, f"{key} string, x array<double>, phi array<double>")


def linear_base(background: DataFrame, names: Sequence[str]) -> list[float]:
    """Feature means over all background rows: one aggregation."""
    return list(background.agg(*[F.expr(f"avg(`{c}`)") for c in names]).first())


def shap_linear(df: DataFrame, names: Sequence[str], coefs: Sequence[float], means: Sequence[float],
                key: str = KEY) -> DataFrame:
    """Rows (key, x, phi) on the log-odds: coefficient x distance from the background mean. Columns only."""
    values = ", ".join(f"double(`{n}`)" for n in names)
    parts = ", ".join(f"({float(c)!r}D) * (`{n}` - ({float(m)!r}D))" for n, c, m in zip(names, coefs, means))
    return df.selectExpr(key, f"array({values}) as x", f"array({parts}) as phi")


def importance(shap: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    return shap.groupBy("feature").agg(F.avg(F.abs("shap")).alias("mean_abs_shap")).orderBy(
        F.desc("mean_abs_shap"), "feature"
    )


def top_features(ranked: DataFrame, n: int) -> DataFrame:
    return ranked.orderBy(F.desc("mean_abs_shap"), "feature").limit(n)


def of_top_features(shap: DataFrame, ranked: DataFrame, n: int) -> DataFrame:
    """Attributions of the n strongest features: 20 for the summary cloud, 3 for dependence."""
    return shap.join(top_features(ranked, n).select("feature"), "feature", "left_semi")


def waterfall(shap: DataFrame, key_value: str, base: float, n: int = 15, key: str = KEY) -> DataFrame:
    """The n strongest attributions of one customer, chosen by key, with the base value."""
    one = shap.where(F.col(key) == key_value).orderBy(F.desc(F.abs("shap")), "feature").limit(n)
    return one.withColumn("base_value", F.lit(base))


def cum_importance(ranked: DataFrame, n: int = 20) -> DataFrame:
    """Running share of importance over the n strongest features, and value relative to the largest."""
    return top_features(ranked, n).selectExpr(
        "feature", "mean_abs_shap",
        "row_number() over (order by mean_abs_shap desc, feature) as rank",
        "100 * sum(mean_abs_shap) over (order by mean_abs_shap desc, feature rows unbounded preceding)"
        " / sum(mean_abs_shap) over () as cum_pct",
        "mean_abs_shap / max(mean_abs_shap) over () as relative",
    )


def features_to_reach(cumulative: DataFrame, share: float = 80.0) -> DataFrame:
    """How many features it takes to reach a share of the importance."""
    return cumulative.where(F.col("cum_pct") >= share).agg(F.min("rank").alias("n_features"))
