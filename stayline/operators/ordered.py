"""Order-dependent building blocks that never sort a whole group in one task.

``exact_quantiles``  interpolated quantiles, per group
``rank_cuts``        the row that holds a given rank of a seeded shuffle, per class
``running_sum``      cumulative sums along an ordering
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.exprs import hash_key, one_row
from stayline.session import materialise

SKETCH_ACCURACY = 20_000
HASH_PREFIX = 4  # hex digits, 65,536 buckets


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), name: str = "feature"
) -> DataFrame:
    """Linearly interpolated quantiles as rows ``(*by, <name>, prob, value)``; nulls are skipped.

    The built-in ``percentile`` keeps every distinct value of a group in one task. Here the ranks are
    found in two light steps at every size: a mergeable sketch brackets each quantile within a few
    1e-4 of the rows; then one aggregate counts, for all columns and quantiles side by side, the rows below each
    bracket, and only rows inside a bracket are counted by value and ordered.
    """
    by, cols, k = list(by), list(cols), len(probs)
    values = df.select(*by, *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    # A bracket must reach a few rows to either side, so small groups take a wider one, the smallest all rows.
    margins = [5.0 / SKETCH_ACCURACY, 0.01, 0.1]
    places = [min(max(p + side * m, 0.0), 1.0) for m in margins for side in (-1, 1) for p in probs]
    sketch = values.groupBy(*by).agg(*[F.struct(
        F.count(f"v{i}").alias("n"), F.min(f"v{i}").alias("least"), F.max(f"v{i}").alias("most"),
        F.percentile_approx(f"v{i}", places, SKETCH_ACCURACY).alias("edges")).alias(f"s{i}") for i in range(len(cols))])

    def edge(i: int, j: int, upper: int) -> Column:
        s = F.col(f"s{i}")
        end = s["most"] if upper else s["least"]
        out = end
        for t in reversed(range(len(margins))):
            p, m = probs[j], margins[t]
            near = end if (p + m >= 1 if upper else p - m <= 0) else s["edges"][(2 * t + upper) * k + j]
            out = F.when(s["n"] * F.lit(m) >= 3, near).otherwise(out)
        return out

    # One row per group, with the brackets of all columns and quantiles.
    brackets = sketch.select(*by, F.struct(*[
        F.struct(F.col(f"s{i}")["n"].alias("n"),
                 *[F.struct(edge(i, j, 0).alias("lo"), edge(i, j, 1).alias("hi")).alias(f"p{j}") for j in range(k)])
        .alias(f"c{i}") for i in range(len(cols))]).alias("b"))
    brackets = materialise(brackets, "brackets")
    aimed = values.join(brackets, by) if by else values.withColumn("b", one_row(brackets)["b"])
    slots = [(i, j) for i in range(len(cols)) for j in range(k)]

    def bracket(i: int, j: int) -> Column:
        return F.col("b")[f"c{i}"][f"p{j}"]

    counted = aimed.groupBy(*by).agg(*[
        F.count_if(F.col(f"v{i}") < bracket(i, j)["lo"]).alias(f"n{i}_{j}") for i, j in slots])
    listed = F.array(*[F.struct(F.lit(i).alias("c"), F.lit(j).alias("p"), F.col(f"n{i}_{j}").alias("below"))
                       for i, j in slots])
    below = counted.select(*by, F.inline(listed))
    sizes = brackets.select(*by, F.inline(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col("b")[f"c{i}"]["n"].alias("n")) for i in range(len(cols))])))
    hits = F.filter(F.array(*[
        F.when(F.col(f"v{i}").between(bracket(i, j)["lo"], bracket(i, j)["hi"]),
               F.struct(F.lit(i).alias("c"), F.lit(j).alias("p"), F.col(f"v{i}").alias("value"))) for i, j in slots]),
        lambda hit: hit.isNotNull())
    slot = [*by, "c", "p"]
    inside = aimed.select(*by, F.inline(hits)).groupBy(*slot, "value").agg(F.count(F.lit(1)).alias("m"))
    order = Window.partitionBy(*slot).orderBy("value")
    ranked = inside.withColumn("upto", F.sum("m").over(order)).join(below, slot).join(sizes, [*by, "c"])
    prob = F.get(F.array(*[F.lit(float(p)) for p in probs]), F.col("p"))
    position = (F.col("n") - 1) * prob
    reached = F.col("below") + F.col("upto")
    found = ranked.groupBy(*slot).agg(
        F.first(position).alias("position"),
        F.first("below").alias("below"),
        F.min(F.when(reached > F.floor(position), F.col("value"))).alias("v0"),
        F.min(F.when(reached > F.ceil(position), F.col("value"))).alias("v1"),
    )
    whole = F.floor(F.col("position"))
    value = F.col("v0") + (F.col("position") - whole) * (F.col("v1") - F.col("v0"))
    sound = (F.col("below") <= whole) & F.col("v0").isNotNull() & F.col("v1").isNotNull()
    return found.select(
        *by, F.get(F.array(*[F.lit(c) for c in cols]), F.col("c")).alias(name), prob.alias("prob"),
        F.when(sound, value).otherwise(F.raise_error(F.lit("quantile bracket missed"))).alias("value"))


def rank_cuts(
    df: DataFrame, by: str, key: str, seed: int, ranks: Callable[[Column], list[Column]]
) -> DataFrame:
    """Rows ``(by, slot, cut)``: the (hash, key) pair that holds each asked rank within its class.

    ``ranks`` maps the class size to 1-based ranks. Rows ordered before or at a cut are then picked
    by comparing two values per row, so an exact seeded draw needs neither a sort nor a shuffle of
    the table. The hash is uniform: counts per prefix locate the bucket of each rank, and only that
    bucket (1/65,536 of the rows) is ordered.
    """
    rows = df.select(by, F.col(key).alias("k"), hash_key(F.col(key), seed).alias("h"))
    rows = rows.withColumn("bucket", F.substring("h", 1, HASH_PREFIX))
    counts = rows.groupBy(by, "bucket").agg(F.count(F.lit(1)).alias("n"))
    # At most 65,536 rows per class from here on.
    upto = F.sum("n").over(Window.partitionBy(by).orderBy("bucket"))
    total = F.sum("n").over(Window.partitionBy(by))
    located = (
        counts.withColumn("upto", upto).withColumn("total", total)
        .select(by, "bucket", "n", "upto",
                F.posexplode(F.array(*[r.cast("bigint") for r in ranks(F.col("total"))])).alias("slot", "rank"))
        .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
        .select(by, "bucket", "slot", (F.col("rank") - F.col("upto") + F.col("n")).alias("nth"))
    )
    # ``located`` has one row per class and slot.
    near = rows.join(located, [by, "bucket"])
    # Equal keys share a place, so a key that is not unique cannot crowd the ordering.
    folded = near.groupBy(by, "slot", "nth", "h", "k").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy(by, "slot").orderBy("h", "k"))
    reached = folded.withColumn("upto", upto).where("upto >= nth and upto - n < nth")
    return reached.select(by, "slot", F.struct("h", "k").alias("cut"))


def cuts_by_class(cuts: DataFrame, by: str) -> Column:
    """Cuts as a scalar map: class -> array of cuts in slot order."""
    listed = cuts.groupBy(by).agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
    return listed.agg(F.map_from_entries(F.collect_list(F.struct(by, "cuts")))).scalar()


def shuffle_position(key: str, seed: int) -> Column:
    """The (hash, key) pair a row is compared with."""
    return F.struct(hash_key(F.col(key), seed).alias("h"), F.col(key).alias("k"))


def running_sum(
    df: DataFrame, order: str, cols: Sequence[str], by: Sequence[str] = (), descending: bool = False,
    pieces: int | None = None,
) -> DataFrame:
    """Add ``cum_<col>``: sums of ``cols`` over all rows up to and including the current one.

    ``df`` holds one row per (``by``, ``order``). The ordering is dealt to ``pieces`` ranges (as many as
    shuffle partitions), written once; windows run inside a range and the totals of earlier ranges
    are added. No task orders more than its range.
    """
    by = list(by)
    spark = df.sparkSession
    n = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = materialise(df.repartitionByRange(n, order).withColumn("_piece", F.spark_partition_id()), "ordered")
    direction = F.col(order).desc() if descending else F.col(order).asc()
    piece = F.col("_piece").desc() if descending else F.col("_piece").asc()
    totals = cut.groupBy(*by, "_piece").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    earlier = Window.partitionBy(*by).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_piece", *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in cols]
    )
    inside = Window.partitionBy(*by, "_piece").orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.select("*", *[F.sum(c).over(inside).alias(f"_l_{c}") for c in cols])
    joined = local.join(offsets, [*by, "_piece"])
    return joined.select(
        *[F.col(c) for c in df.columns], *[(F.col(f"_l_{c}") + F.col(f"_o_{c}")).alias(f"cum_{c}") for c in cols]
    )
