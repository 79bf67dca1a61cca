"""Mixing sources to target weights by entropy balancing; DataFrame functions only.

Each document gets a rate between 0 and ``cap``. Among all rates whose words add up to the target of
their source, the ones of least (bounded) entropy relative to equal rates tilt exponentially with the
size: the odds rate : (cap - rate) are exp(lambda * size). The multipliers lambda, one per source,
minimise a convex dual; each Newton round is one distributed aggregation. Rates are then rounded into
whole copies so that the words of each source come within about half of one small document of its target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.common import boxed, boxed_text, join_on, with_rank
from stayline.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2
#: Newton stops when every source is this close to its target, relatively.
TOLERANCE = 1e-10
MAX_ROUNDS = 60
#: Documents of a class (source, size) are ranked in buckets of about this many.
BUCKET = 512


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Add ``target`` to rows (source, source_size).

    Sources in code point order, null last, take the weights in turn and share ``share`` of all words;
    a target stops at ``cap`` times its source, the excess is shared again by weight.
    """
    ranked = with_rank(sources, [F.col("source").asc_nulls_last()])
    turn = F.array(*[F.lit(float(w)) for w in weights])
    weighed = materialise(
        ranked.withColumn("weight", F.get(turn, (F.col("rank") % len(weights)).cast("int"))).drop("rank"), "weights"
    )
    limit = F.col("source_size") * cap
    level = 0.0  # words per unit of weight; a source is full when its share at this level reaches its limit
    while True:
        full = F.lit(level) * F.col("weight") >= limit
        total, held, weight = weighed.agg(
            F.sum("source_size"), F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if not weight:
            break
        found = ((total or 0) * share - (held or 0)) / weight
        if found <= level:
            break
        level = found
    return weighed.select(
        "source", "source_size", F.least(F.lit(level) * F.col("weight"), limit.cast("double")).alias("target")
    )


def _rate(tilt: Column, scaled: Column, cap: int) -> Column:
    return F.lit(float(cap)) / (F.lit(1.0) + F.exp(-tilt * scaled))


def multipliers(classes: DataFrame, goals: DataFrame, cap: int = CAP) -> DataFrame:
    """Rows (source, scale, tilt, fixed): the multiplier of each source, by guarded Newton rounds.

    ``fixed`` holds the rate of sources whose target leaves no choice (nothing, or everything ``cap`` times).
    """
    moments = classes.groupBy("source").agg(
        F.try_divide(F.sum(F.col("size") * F.col("size") * F.col("n")), F.sum(F.col("size") * F.col("n"))).alias("scale")
    )
    ratio = F.try_divide(F.col("target"), F.col("source_size"))
    fixed = F.when(F.col("source_size") == 0, 1.0).when(ratio >= cap - 1e-9, float(cap)).when(ratio <= 1e-9, 0.0)
    state = materialise(
        join_on(goals, moments, ["source"]).select(
            "source", "source_size", "target", F.coalesce("scale", F.lit(1.0)).alias("scale"), fixed.alias("fixed"),
            F.lit(0.0).alias("tilt"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"), F.lit(1.0).alias("miss")),
        "tilt")
    for _ in range(MAX_ROUNDS):
        open_ = state.where("fixed is null and miss > 0")
        joined = join_on(classes, open_, ["source"])
        scaled = F.col("size") / F.col("scale")
        rate = _rate(F.col("tilt"), scaled, cap)
        mass = F.col("n") * F.col("size")
        sums = joined.groupBy("source").agg(
            F.sum(mass * rate).alias("words"),
            F.sum(mass * scaled * rate * (1 - rate / cap)).alias("slope"),
        )
        both = join_on(state, sums, ["source"], "left")
        gap = F.col("words") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap >= 0, F.col("tilt")).otherwise(F.col("high"))
        moved = both.withColumn("low", low).withColumn("high", high).withColumn("gap", gap)
        step = F.col("tilt") - F.try_divide("gap", "slope")
        inside = F.coalesce((step > F.col("low")) & (step < F.col("high")), F.lit(False))
        # Outside the bracket: towards the open end by doubling, else halve the bracket.
        wide = F.when(F.col("high") >= 1e6, F.greatest(F.col("low") * 2, F.lit(1.0))).when(
            F.col("low") <= -1e6, F.least(F.col("high") * 2, F.lit(-1.0))
        ).otherwise((F.col("low") + F.col("high")) / 2)
        done = F.abs(F.col("gap")) <= F.col("target") * TOLERANCE
        state = materialise(
            moved.select(
                "source", "source_size", "target", "scale", "fixed",
                F.when(F.col("gap").isNull() | done, F.col("tilt")).when(inside, step).otherwise(wide).alias("tilt"),
                "low", "high",
                F.when(F.col("gap").isNull() | done, 0.0).otherwise(
                    F.try_divide(F.abs("gap"), F.col("target"))).alias("miss"),
            ), "tilt")
        if not state.agg(F.max(F.when(F.col("fixed").isNull(), F.col("miss")))).first()[0]:
            break
    # Sums of doubles depend on their order in the last digits; the rounded multiplier does not.
    return state.withColumn("tilt", F.round("tilt", 8))


def _extras(rated: DataFrame) -> DataFrame:
    """Whole extra copies ``k`` of each class: even spacing over the sizes, then the rest settled in words."""
    order = Window.partitionBy("source").orderBy(F.col("size").desc())
    upto = F.sum(F.col("n") * F.col("part")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    spaced = rated.withColumn("_upto", upto)
    before = F.col("_upto") - F.col("n") * F.col("part")
    spaced = spaced.withColumn("k", (F.floor(F.col("_upto") + 0.5) - F.floor(before + 0.5)).cast("bigint"))
    spaced = spaced.withColumn("k", F.greatest(F.lit(0), F.least("k", "n"))).drop("_upto")
    spaced = materialise(spaced, "spaced")
    taken = F.sum((F.col("whole") * F.col("n") + F.col("k")) * F.col("size"))
    # One entry per distinct size of a source, largest first; the state of the fold is the missing
    # words and the few corrections.
    listed = spaced.where("size > 0").groupBy("source").agg(
        (F.first("target") - taken).alias("gap"),
        F.reverse(F.sort_array(F.collect_list(F.struct("size", "n", "k", "part")))).alias("sizes"),
    )

    def settle(state: Column, c: Column) -> Column:
        wish = F.round(state["gap"] / c["size"]).cast("bigint")
        room = F.when(c["part"] > 0, c["n"] - c["k"]).otherwise(F.lit(0).cast("bigint"))
        more = F.greatest(-c["k"], F.least(wish, room))
        return F.struct(
            (state["gap"] - more * c["size"]).alias("gap"),
            F.when(more == 0, state["moves"]).otherwise(
                F.concat(state["moves"], F.array(F.struct(c["size"].alias("size"), more.alias("more"))))
            ).alias("moves"),
        )

    start = F.struct(F.col("gap"), F.array().cast("array<struct<size:bigint,more:bigint>>").alias("moves"))
    moves = listed.select("source", F.explode(F.aggregate("sizes", start, settle)["moves"]).alias("m"))
    moves = moves.select("source", F.col("m.size").alias("size"), F.col("m.more").alias("_more"))
    out = join_on(spaced, moves, ["source", "size"], "left")
    return out.withColumn("k", F.col("k") + F.coalesce("_more", F.lit(0))).drop("_more")


def _cuts(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Add ``cut``, the (hash, id) of the k-th row of each class, so that a row decides alone.

    Buckets of the hash order are counted; only the bucket with the k-th row is ordered.
    """
    split = classes.where("k > 0").select("source", "size", "n", "k")
    keyed = join_on(rows, split, ["source", "size"])
    share = F.col("h").cast("double") / F.lit(2.0**64) + 0.5
    keyed = keyed.withColumn("bucket", F.floor(share * F.ceil(F.col("n") / BUCKET)))
    counts = keyed.groupBy("source", "size", "k", "bucket").agg(F.count(F.lit(1)).alias("m"))
    upto = F.sum("m").over(Window.partitionBy("source", "size").orderBy("bucket"))
    located = counts.withColumn("upto", upto).where("k <= upto and k > upto - m").select(
        "source", "size", "bucket", (F.col("k") - F.col("upto") + F.col("m")).alias("nth"))
    near = join_on(keyed, located, ["source", "size", "bucket"])
    rank = F.row_number().over(Window.partitionBy("source", "size").orderBy("h", "id"))
    cut = near.withColumn("rank", rank).where("rank = nth").select("source", "size", F.struct("h", "id").alias("cut"))
    return join_on(classes, cut, ["source", "size"], "left")


def decide(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: int = CAP,
) -> DataFrame:
    """Rows (doc, size, source_size, target, rate, copies): ``doc`` holds the columns of ``docs``."""
    sized = boxed(docs).withColumn("source", F.col("doc")[source]).withColumn("size", word_count(boxed_text(text)))
    key = F.col("doc")[id_col]
    rows = materialise(sized.select("source", "size", key.alias("id"), F.xxhash64(key).alias("h")), "sizes")
    classes = materialise(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "classes")
    sums = classes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    tilts = multipliers(classes, targets(sums, weights, share, cap), cap)
    rated = join_on(classes, tilts, ["source"]).select(
        "source", "size", "n", "source_size", "target",
        F.coalesce("fixed", _rate(F.col("tilt"), F.col("size") / F.col("scale"), cap)).alias("rate"))
    rated = rated.withColumn("whole", F.floor("rate")).withColumn("part", F.col("rate") - F.col("whole"))
    decided = materialise(_cuts(rows, _extras(rated)), "decided")
    decided = decided.select("source", "size", "source_size", "target", "rate", "whole", "cut")
    own = F.struct(F.xxhash64(key).alias("h"), key.alias("id"))
    extra = F.when(F.col("cut").isNotNull() & (own <= F.col("cut")), 1).otherwise(0)
    return join_on(sized, decided, ["source", "size"]).select(
        "doc", "size", "source_size", "target", "rate", (F.col("whole") + extra).cast("bigint").alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", **settings) -> DataFrame:
    """``docs`` with ``mix_size, mix_source_size, mix_target, mix_rate, mix_copies`` added.

    The size is the number of words; a null text has none. Null sources form one source, weighed last.
    Rows with the same id and size are decided alike. A source without words gets no words; its rows
    keep one copy each. An empty table gives an empty one. Columns of ``docs`` are kept as they are.
    """
    added = ("size", "source_size", "target", "rate", "copies")
    return decide(docs, id_col, text, source, **settings).select("doc.*", *[F.col(c).alias(f"mix_{c}") for c in added])


def mixed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", **settings) -> DataFrame:
    """Rows of ``docs`` as often as the mix takes them, with their own columns."""
    taken = decide(docs, id_col, text, source, **settings).where("copies > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")
