"""Class balance: counts and synthetic minority oversampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.columns import KEY, SEED
from stayline.functions.exprs import hash_int, hash_unit
from stayline.operators.neighbours import BLOCK_ROWS, nearest
from stayline.operators.ordered import cuts_by_class, rank_cuts, shuffle_position
from stayline.session import materialise

HOT_POINTS = 1000


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def balance_report(before: DataFrame, after: DataFrame, label: str = "label") -> DataFrame:
    """Class counts before and after balancing."""
    return class_counts(before, label).withColumn("stage", F.lit("before")).unionByName(
        class_counts(after, label).withColumn("stage", F.lit("after"))
    )


def smote(
    train: DataFrame, names: Sequence[str], label: str = "label", key: str = KEY, k: int = 5, seed: int = SEED,
    block_rows: int = BLOCK_ROWS, stats: dict | None = None,
) -> DataFrame:
    """Training rows plus synthetic minority rows up to parity, as (key, label, base_key, features).

    Every minority row is the base of equally many synthetic rows (one more for a seeded share of
    them). Each takes one of the k nearest minority rows and a step u in [0, 1) from the hash of base
    and draw number, so a retried task makes the same rows. Indicator features take fractions.

    Equal minority rows are folded to one point with a count before the neighbour search, so a mass
    of copies costs one point; copies count as neighbours at distance 0.
    """
    names = list(names)
    sizes = {r[label]: r["n"] for r in class_counts(train, label).collect()}  # two classes
    if len(sizes) != 2:
        raise ValueError(f"two classes expected, found {len(sizes)}")
    minority = min(sizes, key=lambda c: (sizes[c], -c))
    n_min, n_new = sizes[minority], abs(sizes[0] - sizes[1])
    own = train.selectExpr(key, label, "cast(null as string) as base_key", *[f"double(`{n}`) as `{n}`" for n in names])
    if n_new == 0:
        return own
    if n_min <= k:
        raise ValueError(f"{n_min} minority rows are too few for {k} neighbours")

    f = [f"f{i}" for i in range(len(names))]
    rows = train.where(F.col(label) == minority).selectExpr(
        f"{key} as base_key", f"{label} as cls", *[f"double(`{n}`) as {c}" for n, c in zip(names, f)]
    )
    rows = rows.selectExpr("*", f"md5(concat_ws(',', {', '.join(f'string({c})' for c in f)})) as pid")
    first = ", ".join(f"'{c}', first({c})" for c in f)
    points = materialise(
        rows.groupBy("pid").agg(F.expr("count(1) as copies"), F.expr(f"named_struct({first}) as x"))
        .select("pid", "copies", "x.*"),
        "points",
    )
    near = nearest(points, f, k, block_rows, stats)

    # Place of each neighbour among all minority rows, copies counted: [since, upto).
    weights = points.select(F.col("pid").alias("nid"), "copies")
    itself = points.select("pid", (F.col("copies") - 1).alias("same"))
    upto = F.sum("copies").over(Window.partitionBy("pid").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    places = near.join(weights, "nid").withColumn("upto", upto).join(itself, "pid").select(
        "pid", "nid",
        (F.col("same") + F.col("upto") - F.col("copies")).alias("since"),
        (F.col("same") + F.col("upto")).alias("upto"),
    ).where(F.col("since") < k)
    places = places.unionByName(
        itself.where("same > 0").select("pid", F.col("pid").alias("nid"), F.lit(0).cast("bigint").alias("since"),
                                        F.col("same").alias("upto"))
    )

    each, extra = divmod(n_new, n_min)
    draws = rows
    if extra:
        cut = cuts_by_class(rank_cuts(rows, "cls", "base_key", seed, lambda n: [F.lit(extra)]), "cls")
        more = (shuffle_position("base_key", seed) <= cut[F.col("cls")][0]).cast("int")
        draws = draws.withColumn("times", F.lit(each) + more).where("times > 0")
    else:
        draws = draws.withColumn("times", F.lit(each))
    draws = draws.withColumn("draw", F.explode(F.sequence(F.lit(1), F.col("times"))))
    digest = F.md5(F.concat_ws("|", F.col("base_key"), F.lit(str(seed)), F.col("draw").cast("string")))
    draws = draws.withColumn("digest", digest).withColumn("pick", hash_int(F.col("digest"), 1) % k).withColumn(
        "u", hash_unit(F.col("digest"), 9)
    )
    # Points with a mass of copies: there are fewer than HOT_POINTS of them. Their nearest neighbours are their
    # own copies, so their draws repeat the base row and skip the joins they would weigh down.
    hot = points.where(F.col("copies") > max(k, n_min / HOT_POINTS)).select("pid")
    chosen = draws.join(hot, "pid", "left_anti").join(places, "pid").where(
        (F.col("pick") >= F.col("since")) & (F.col("pick") < F.col("upto"))
    )
    other = points.selectExpr("pid as nid", *[f"{c} as n{c}" for c in f])
    head = [f"concat_ws('|', 'synthetic', base_key, string(draw)) as {key}", f"cls as {label}", "base_key"]
    made = chosen.join(other, "nid").selectExpr(
        *head, *[f"{c} + u * (n{c} - {c}) as `{n}`" for c, n in zip(f, names)]
    )
    repeated = draws.join(hot, "pid", "left_semi").selectExpr(*head, *[f"{c} as `{n}`" for c, n in zip(f, names)])
    return own.unionByName(made).unionByName(repeated)
