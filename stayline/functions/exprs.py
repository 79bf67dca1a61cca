"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Column by its literal name (feature names hold blanks, dashes and brackets)."""
    return F.col(f"`{name}`")


def to_number(value: Column) -> Column:
    """Lenient cast: blank or malformed text becomes null."""
    return F.trim(value.cast("string")).try_cast("double")


def half_even(value: Column, digits: int | None) -> Column:
    """Round half to even at ``digits`` decimals; ``None`` leaves the value alone."""
    if digits is None:
        return value
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def ratio(top: Column, bottom: Column) -> Column:
    """Division that is null where the denominator is 0."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(ratio(top, bottom), F.lit(0.0))


def recode(value: Column, codes: dict) -> Column:
    """Map listed values; anything else becomes null."""
    out = None
    for key, code in codes.items():
        hit = value == F.lit(key)
        out = F.when(hit, F.lit(code)) if out is None else out.when(hit, F.lit(code))
    return out


def band_index(value: Column, edges: Sequence[float]) -> Column:
    """1-based index of the right-closed interval (edge, next edge]; null outside."""
    out = None
    for i in range(1, len(edges)):
        inside = (value > F.lit(edges[i - 1])) & (value <= F.lit(edges[i]))
        out = F.when(inside, F.lit(i)) if out is None else out.when(inside, F.lit(i))
    return out


def band_label(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval; null outside."""
    return recode(band_index(value, edges), {i + 1: label for i, label in enumerate(labels)})


def hash_key(key: Column, seed: int) -> Column:
    """Seeded pseudo-random order of rows: the same on every run and in any partitioning."""
    return F.md5(F.concat_ws("|", key, F.lit(str(seed))))


def hash_int(digest: Column, start: int = 1) -> Column:
    """32 bits of a hex digest as a non-negative integer."""
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")


def hash_unit(digest: Column, start: int = 1) -> Column:
    """32 bits of a hex digest as a number in [0, 1)."""
    return hash_int(digest, start).cast("double") / F.lit(4294967296.0)


def slug(name: Column, suffix: str = "") -> Column:
    """Lower case with underscores, plus a suffix."""
    return F.concat(F.replace(F.lower(name), F.lit(" "), F.lit("_")), F.lit(suffix))


# Fixed rewrites of feature names for display, applied in this order.
LABEL_REWRITES = [
    ("_", " "),
    (" Yes", ""),
    (" No", ""),
    ("Contract ", "Contract: "),
    ("PaymentMethod ", "Payment: "),
    ("InternetService ", "Internet: "),
]


def clean_label(name: Column) -> Column:
    """Display label of a feature; every run of letters is capitalised."""
    for old, new in LABEL_REWRITES:
        name = F.replace(name, F.lit(old), F.lit(new))
    runs = F.regexp_extract_all(name, F.lit("([A-Za-z]+|[^A-Za-z]+)"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def one_row(stats: DataFrame) -> Column:
    """The single row of ``stats`` as a struct column (scalar subquery, no cross join)."""
    return stats.select(F.struct(*[F.col(f"`{c}`") for c in stats.columns])).scalar()
