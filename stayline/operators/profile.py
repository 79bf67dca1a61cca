"""Profiling and segment analytics over the customer table."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.columns import (
    BINARY, BINARY_CODES, CATEGORICAL, CLASSES, CORRELATED, NUMERIC, TENURE_EDGES, TENURE_LABELS,
)
from stayline.functions.exprs import (
    band_index, band_label, half_even, hash_key, one_row, ratio, recode,
)
from stayline.operators.ordered import exact_quantiles
from stayline.session import materialise


# --- overview --------------------------------------------------------------------------------

def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(df.columns)).alias("n_columns"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Occurrences after the first of identical full rows."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))


def missing_values(df: DataFrame) -> DataFrame:
    """Null count of every column that has nulls; one pass."""
    counted = df.agg(*[F.expr(f"count_if(`{c}` is null) as `{c}`") for c in df.columns])
    return counted.unpivot([], df.columns, "column_name", "n_missing").where("n_missing > 0")


def column_types(df: DataFrame) -> DataFrame:
    """Type and number of values of every column."""
    counted = df.agg(*[F.expr(f"count(`{c}`) as `{c}`") for c in df.columns])
    rows = ", ".join(f"'{c}', '{t}', `{c}`" for c, t in df.dtypes)
    return counted.selectExpr(f"stack({len(df.columns)}, {rows}) as (column_name, data_type, n_values)")


def class_balance(df: DataFrame, column: str = "churn") -> DataFrame:
    """Count and share per class, and the ratio of the largest class to each."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = one_row(counts.agg(F.sum("n").alias("all"), F.max("n").alias("top")))
    return counts.withColumn("t", total).select(
        column, "n", (F.lit(100.0) * F.col("n") / F.col("t.all")).alias("pct"),
        ratio(F.col("t.top"), F.col("n")).alias("imbalance"),
    )


# --- numeric columns ---------------------------------------------------------------------------

QUARTILES = [0.25, 0.5, 0.75]


def describe(df: DataFrame, cols: Sequence[str] = NUMERIC, digits: int | None = 2) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles, maximum; one row per column."""
    stats = ("count({0})", "avg({0})", "stddev_samp({0})", "double(min({0}))", "double(max({0}))")
    parts = df.agg(*[F.expr(f"{x.format(c)} as {c}_{i}") for c in cols for i, x in enumerate(stats)])
    rows = ", ".join(f"'{c}', " + ", ".join(f"{c}_{i}" for i in range(len(stats))) for c in cols)
    moments = parts.selectExpr(f"stack({len(cols)}, {rows}) as (feature, n, mean, std, min, max)")
    quartiles = exact_quantiles(df, cols, QUARTILES).groupBy("feature").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"q{int(p * 100)}") for p in QUARTILES
    ])
    joined = moments.join(quartiles, "feature")
    return joined.select("feature", "n", *[
        half_even(F.col(c), digits).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")
    ])


def mean_by(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(key).agg(*[F.avg(c).alias(f"mean_{c}") for c in cols])


# --- rates -------------------------------------------------------------------------------------

def _rate() -> Column:
    return F.expr("avg(label * 100.0D)")


def churn_rates(df: DataFrame, cols: Sequence[str] = CATEGORICAL, digits: int | None = 1) -> DataFrame:
    """Attrition rate per level of every column, in a single pass and a single small shuffle.

    Each task folds its rows to one partial sum per level before anything is exchanged.
    """
    long = df.selectExpr("label", *[f"string({c}) as {c}" for c in cols]).unpivot(
        ["label"], list(cols), "feature", "level"
    )
    rates = long.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"), _rate().alias("rate"))
    return rates.select("feature", "level", "n", half_even(F.col("rate"), digits).alias("rate"))


def churn_rate_by(df: DataFrame, column: str, sort: bool = False) -> DataFrame:
    rates = df.groupBy(column).agg(_rate().alias("rate"))
    return rates.orderBy("rate", column) if sort else rates


def crosstab(df: DataFrame, row: str, column: str = "churn", levels: Sequence[str] = tuple(CLASSES)) -> DataFrame:
    """Counts of ``row`` by ``column``; the levels are listed, so no pass is spent finding them."""
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(f"n_{v.lower()}") for v in levels])


def crosstab_pct(df: DataFrame, row: str, column: str = "churn", levels: Sequence[str] = tuple(CLASSES)) -> DataFrame:
    """Row percentages of the cross table."""
    names = [v.lower() for v in levels]
    total = sum((F.col(f"n_{v}") for v in names[1:]), F.col(f"n_{names[0]}"))
    return crosstab(df, row, column, levels).select(
        row, *[(F.lit(100.0) * F.try_divide(F.col(f"n_{v}").cast("double"), total.cast("double"))).alias(f"pct_{v}")
               for v in names]
    )


def contract_profile(df: DataFrame, column: str = "contract") -> DataFrame:
    return df.groupBy(column).agg(
        F.avg("label").alias("churn_rate"),
        F.count("label").alias("n"),
        F.avg("monthly_charges").alias("avg_monthly"),
        _rate().alias("churn_pct"),
    )


def tenure_bands(df: DataFrame, edges: Sequence[float] = tuple(TENURE_EDGES),
                 labels: Sequence[str] = tuple(TENURE_LABELS)) -> DataFrame:
    """Rate per right-closed tenure band; values outside every band are left out."""
    banded = df.select(
        band_index(F.col("tenure"), edges).alias("band_ord"),
        band_label(F.col("tenure"), edges, labels).alias("band"), "label",
    )
    return banded.where(F.col("band_ord").isNotNull()).groupBy("band_ord", "band").agg(
        F.count(F.lit(1)).alias("n"), _rate().alias("rate")
    )


# --- association -------------------------------------------------------------------------------

def numeric_frame(df: DataFrame) -> DataFrame:
    """Numeric and 0/1 columns used for correlations."""
    coded = [recode(F.col(c), BINARY_CODES).alias(c) if c in BINARY else F.col(c) for c in CORRELATED]
    return df.select(*coded)


def _correlations(df: DataFrame, cols: Sequence[str], pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson correlation of the listed pairs as rows (x, y, corr), pairwise complete.

    Two passes of plain sums, which stay in compiled code however many pairs there are: the means,
    then sums of centred values and products per pattern of nulls. A pair adds up the patterns in
    which both sides are present. Centring keeps the sums accurate; a constant side gives null.
    """
    v = {c: f"c{i}" for i, c in enumerate(cols)}
    numbers = df.selectExpr(*[f"double({c}) as {n}" for c, n in v.items()])
    means = one_row(numbers.agg(*[F.expr(f"avg({n}) as {n}") for n in v.values()]))
    absent = " + ".join(f"if({n} is null, {1 << i}L, 0L)" for i, n in enumerate(v.values()))
    centred = numbers.withColumn("m", means).selectExpr(
        f"{absent} as absent", *[f"coalesce({n} - m.{n}, 0D) as {n}" for n in v.values()]
    )
    products = sorted({(v[a], v[b]) for a, b in pairs} | {(n, n) for n in v.values()})
    sums = centred.groupBy("absent").agg(
        F.expr("count(1) as n"), *[F.expr(f"sum({n}) as s_{n}") for n in v.values()],
        *[F.expr(f"sum({a} * {b}) as p_{a}_{b}") for a, b in products],
    )
    place = {n: 1 << i for i, n in enumerate(v.values())}
    entries = ", ".join(
        f"'{x}', '{y}', {place[v[x]] | place[v[y]]}L, s_{v[x]}, s_{v[y]}, p_{v[x]}_{v[x]}, p_{v[y]}_{v[y]}, p_{v[x]}_{v[y]}"
        for x, y in pairs
    )
    patterns = sums.selectExpr(
        "absent", "n", f"stack({len(pairs)}, {entries}) as (x, y, needed, sx, sy, sxx, syy, sxy)"
    ).where("absent & needed = 0")
    total = patterns.groupBy("x", "y").agg(*[F.expr(f"sum({c}) as {c}") for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    spread = total.selectExpr(
        "x", "y", "sxx", "syy", "sxx - sx * sx / n as vx", "syy - sy * sy / n as vy", "sxy - sx * sy / n as cov"
    )
    # What remains of a constant column after centring is rounding noise.
    value = "if(x = y, 1D, cov / sqrt(vx * vy))"
    return spread.selectExpr("x", "y", f"if(vx > 1e-12D * sxx and vy > 1e-12D * syy, {value}, null) as corr")


def corr_matrix(df: DataFrame, cols: Sequence[str] = tuple(CORRELATED), digits: int | None = 2) -> DataFrame:
    """Pearson matrix as rows (x, y, corr)."""
    half = _correlations(df, cols, list(combinations_with_replacement(cols, 2)))
    cell = "named_struct('x', {0}, 'y', {1}, 'corr', corr)"
    one, other = cell.format("x", "y"), cell.format("y", "x")
    mirrored = half.selectExpr(f"inline(if(x = y, array({one}), array({one}, {other})))")
    return mirrored.select("x", "y", half_even(F.col("corr"), digits).alias("corr"))


def corr_with_target(df: DataFrame, target: str = "label", cols: Sequence[str] = tuple(CORRELATED),
                     digits: int | None = 2) -> DataFrame:
    """Correlation of every column with the target, largest first."""
    rows = _correlations(df, cols, [(c, target) for c in cols])
    return rows.select(F.col("x").alias("feature"), half_even(F.col("corr"), digits).alias("corr")).orderBy(
        F.desc("corr"), "feature"
    )


def association_rank(df: DataFrame, categorical: Sequence[str] = CATEGORICAL,
                     numeric: Sequence[str] = NUMERIC) -> DataFrame:
    """Features by strength: rate spread for levels, 100·|correlation| for numbers."""
    spread = churn_rates(df, categorical, None).groupBy("feature").agg(
        (F.max("rate") - F.min("rate")).alias("strength")
    )
    linear = corr_with_target(df, "label", [*numeric, "label"], None).where("feature <> 'label'").select(
        "feature", (F.abs("corr") * 100.0).alias("strength")
    )
    both = spread.withColumn("kind", F.lit("rate spread")).unionByName(linear.withColumn("kind", F.lit("correlation")))
    return both.orderBy(F.desc("strength"), "feature")


def insights(df: DataFrame, cols: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Level with the highest and the lowest rate of every feature."""
    rates = churn_rates(df, cols, None)
    ranked = F.struct("rate", "level")
    return rates.groupBy("feature").agg(F.max(ranked).alias("hi"), F.min(ranked).alias("lo")).select(
        "feature", F.col("hi.level").alias("highest_level"), F.col("hi.rate").alias("highest_rate"),
        F.col("lo.level").alias("lowest_level"), F.col("lo.rate").alias("lowest_rate"),
    )


# --- distributions -----------------------------------------------------------------------------

def _stacked(df: DataFrame, columns: str | Sequence[str], by: str) -> tuple[DataFrame, list[str]]:
    """Values ``x`` of one column, or of several under ``feature``, with their grouping columns."""
    if isinstance(columns, str):
        return df.select(F.col(by), F.col(columns).cast("double").alias("x")).where("x is not null"), [by]
    wide = df.select(F.col(by), *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot([by], list(columns), "feature", "x").where("x is not null"), ["feature", by]


def histogram(df: DataFrame, columns: str | Sequence[str], by: str = "churn", bins: int = 30,
              density: bool = True) -> DataFrame:
    """Equal-width bins over each group's own range, last bin closed, empty bins kept.

    A list of columns gives their histograms in one go, told apart by ``feature``.
    """
    data, keys = _stacked(df, columns, by)
    stats = data.groupBy(*keys).agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("total"))
    placed = data.join(stats, keys).selectExpr(
        *keys, f"coalesce(floor(try_divide(x - lo, (hi - lo) / {bins})), 0) as bin"
    )
    counts = placed.selectExpr(*keys, f"int(least(bin, {bins - 1})) as bin").groupBy(*keys, "bin").agg(
        F.count(F.lit(1)).alias("n"))
    grid = stats.select(*keys, "lo", "hi", "total", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = grid.join(counts, [*keys, "bin"], "left")
    step = (F.col("hi") - F.col("lo")) / bins
    n = F.coalesce(F.col("n"), F.lit(0))
    height = F.try_divide(n.cast("double"), F.col("total") * step) if density else n.cast("double")
    return full.select(*keys, "bin", (F.col("lo") + F.col("bin") * step).alias("left_edge"),
                       n.cast("bigint").alias("n"), height.alias("height"))


def box_stats(df: DataFrame, columns: str | Sequence[str], by: str = "churn") -> DataFrame:
    """Quartiles, whiskers at the furthest value within 1.5 interquartile ranges, outlier count.

    A list of columns gives one row per ``feature`` and group.
    """
    data, keys = _stacked(df, columns, by)
    quartiles = exact_quantiles(data, ["x"], QUARTILES, keys, "_column").groupBy(*keys).agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"q{int(p * 100)}") for p in QUARTILES
    ])
    ranged = data.join(quartiles, keys).selectExpr(
        *keys, "x", "q25", "q50", "q75",
        "x between q25 - 1.5D * (q75 - q25) and q75 + 1.5D * (q75 - q25) as inside",
    )
    return ranged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.first(q).alias(q) for q in ("q25", "q50", "q75")],
        F.min(F.when(F.col("inside"), F.col("x"))).alias("whisker_low"),
        F.max(F.when(F.col("inside"), F.col("x"))).alias("whisker_high"),
        F.count_if(~F.col("inside")).alias("n_outliers"),
    )


def kde(df: DataFrame, column: str, by: str = "churn", points: int = 1000) -> DataFrame:
    """Gaussian kernel density per group on a grid reaching half the range beyond both ends.

    Rows are folded to (value, count) first; every folded value then adds to the grid points inside
    its task, and only one partial sum per group and grid point is exchanged.
    """
    data = df.select(F.col(by), F.col(column).cast("double").alias("x")).where("x is not null")
    folded = data.groupBy(by, "x").agg(F.count(F.lit(1)).alias("c"))
    stats = data.groupBy(by).agg(
        F.count("x").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.stddev_samp("x").alias("std")
    ).where("n > 1 and std > 0")
    packed = stats.withColumn("h", F.col("std") * F.pow("n", F.lit(-0.2))).withColumn("span", F.col("hi") - F.col("lo"))
    packed = packed.select(by, F.struct("n", "lo", "span", "h").alias("g"))
    spread = folded.join(packed, by).select(
        by, "x", "c", "g", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    )
    at = F.col("g.lo") - 0.5 * F.col("g.span") + F.col("point") * (2.0 * F.col("g.span") / (points - 1))
    z = (at - F.col("x")) / F.col("g.h")
    scale = F.col("g.n") * F.col("g.h") * F.sqrt(F.lit(2.0) * F.pi())
    return spread.select(by, "point", at.alias("grid_x"), (F.col("c") * F.exp(-0.5 * z * z) / scale).alias("d")).groupBy(
        by, "point"
    ).agg(F.first("grid_x").alias("grid_x"), F.sum("d").alias("density"))


def scatter(df: DataFrame, x: str, y: str, by: str = "churn", key: str = "customer_id",
            sample: float | None = None, seed: int = 42) -> DataFrame:
    """Point pairs with their class; ``sample`` keeps a seeded share of the rows for drawing."""
    if sample is not None:
        limit = f"{int(sample * 16**8):08x}"
        df = df if sample >= 1 else df.where(F.substring(hash_key(F.col(key), seed), 1, 8) < limit)
    return df.select(key, x, y, by)


# --- report ------------------------------------------------------------------------------------

def report(df: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Findings as rows (section, item, value); ``df`` is cleaned and labelled.

    ``before`` is the table ahead of filling, for missing values and the description of the numbers.
    Two small tables, one row per class and one per level, are written once, and most sections read those.
    """
    classes = df.groupBy("churn").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.col(f"`{c}`")).alias(f"v_{c}") for c in df.columns],
        *[F.sum(F.col(c).cast("double")).alias(f"s_{c}") for c in NUMERIC],
    )
    classes = materialise(classes, "report-classes")
    rates = materialise(churn_rates(df, CATEGORICAL, None), "report-rates")

    def rows(frame: DataFrame, *entries: tuple[str, str, str]) -> DataFrame:
        listed = ", ".join(f"{section}, {item}, double({value})" for section, item, value in entries)
        return frame.selectExpr(f"stack({len(entries)}, {listed}) as (section, item, value)")

    whole = classes.agg(F.sum("n").alias("n"), *[F.sum(f"v_{c}").alias(f"v_{c}") for c in df.columns])
    shares = classes.withColumn("total", whole.select("n").scalar())
    ends = rates.groupBy("feature").agg(
        F.max(F.struct("rate", "level")).alias("hi"), F.min(F.struct("rate", "level")).alias("lo"))
    parts = [
        rows(whole, ("'overview'", "'rows'", "n"), ("'overview'", "'columns'", str(len(df.columns))),
             *[("'type'", f"'{c} {t}'", f"v_{c}") for c, t in df.dtypes]),
        rows(duplicate_rows(df), ("'overview'", "'duplicate rows'", "n_duplicates")),
        rows(shares, ("'target'", "churn", "n"), ("'target share'", "churn", "100.0D * n / total"),
             *[(f"'mean {c}'", "churn", f"s_{c} / v_{c}") for c in NUMERIC]),
        rows(rates, ("'rates'", "concat_ws('=', feature, level)", "rate")),
        rows(ends, ("'highest rate'", "concat_ws('=', feature, hi.level)", "hi.rate"),
             ("'lowest rate'", "concat_ws('=', feature, lo.level)", "lo.rate")),
        rows(corr_with_target(numeric_frame(df), digits=None), ("'correlation'", "feature", "corr")),
    ]
    if before is not None:
        parts.append(rows(missing_values(before), ("'missing'", "column_name", "n_missing")))
        stats = ("n", "mean", "std", "min", "q25", "q50", "q75", "max")
        parts.append(rows(describe(before, digits=None), *[("concat('describe ', feature)", f"'{x}'", x) for x in stats]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
