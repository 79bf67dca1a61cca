"""Shared helpers: the documents table, and a global order without a single task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayline.session import materialise


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Rows (id, mark, text); ``mark``, a hash of the text, tells rows with one id and different texts apart."""
    value = text_of(text)
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(value).alias("mark"), value.alias("text"))


def boxed(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct column ``doc``: whatever its columns are called, added ones cannot clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def boxed_text(column: str = "text") -> Column:
    return F.coalesce(F.col("doc")[column].cast("string"), F.lit(""))


def shuffle_width(df: DataFrame) -> int:
    """Partitions for an explicit repartition: the session's setting."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add the 0-based rank of each row under ``order``.

    Rows are dealt by range and counted per range; only one count per range is gathered. The ranges
    are written first, so the counts and the ranks come from the same division even if a task reruns.
    """
    ranged = df.repartitionByRange(shuffle_width(df), *order).withColumn("_range", F.spark_partition_id())
    ranged = materialise(ranged, "ranged")
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_range", F.coalesce(before, F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    ranked = ranged.withColumn("_in", inside).join(F.broadcast(starts), "_range")  # one row per range
    return ranked.withColumn(name, F.col("_in") + F.col("_start")).drop("_range", "_in", "_start")


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null equals null; the keys of ``left`` stay."""
    renamed = right.select(*[F.col(f"`{c}`").alias(f"_r_{c}" if c in keys else c) for c in right.columns])
    on = None
    for k in keys:
        same = F.col(f"`{k}`").eqNullSafe(F.col(f"`_r_{k}`"))
        on = same if on is None else on & same
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


#: Rows per Arrow batch: bounds what a Python worker holds of long texts.
BATCH_ROWS = 256


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Arrow batches of few rows for the jobs run inside; the session's setting is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
