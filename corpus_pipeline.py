"""The corpus pipeline: quality, exact copies, near copies, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a DataFrame, which
is written as Parquet and read again for the next stage. All but the last return the columns of docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stayline.llm import jaccard_forest, mixing, packing, quality, stream_dedup
from stayline.llm.common import documents
from stayline.llm.queries import held_out
from stayline.session import materialise


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels, usable=~held_out())
    return quality.accepted(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of equal texts: that with the largest id."""
    return stream_dedup.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    return jaccard_forest.survivors(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("exact dedup", drop_copies),
    ("near duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The classifier, the forest and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
