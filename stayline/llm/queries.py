"""Registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm import (
    byte_pairs, conversations, filter_audit, fingerprints, jaccard_forest, license_scan, licenses, mixing, oracle,
    packing, quality, stream_dedup, suffix_dedup, token_counts, token_store,
)
from stayline.llm.common import documents
from stayline.session import new_path

#: Documents of more tokens are over the limit.
TOKEN_LIMIT = 512
#: One of this many rows is held out of learning.
HELD_OUT = 5


def op1_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-store")
    token_store.write(documents(spark, sf_dir), path)
    return token_store.read(spark, path, with_ids=False)


def op2_jaccard_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_forest.join_groups(documents(spark, sf_dir)).drop("_mark")


def op3_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


def op4_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_dedup.deduplicate(documents(spark, sf_dir))


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string")) % HELD_OUT == 0


def scored(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """``docs`` with ``score`` from the labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(documents(spark, sf_dir), labels, usable=~held_out())
    return quality.score(docs, model)


def op5_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scored(spark, sf_dir, documents(spark, sf_dir))
    return docs.select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(documents(spark, sf_dir), licenses.LICENSES)
    return found.select("doc_id", "license", "containment")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op8_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_copies") * F.col("mix_size")).alias("taken"),
        F.col("mix_copies").alias("copies"))


def op9_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.prefix_table(documents(spark, sf_dir), keep_table=False)
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir), with_kept=False)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.audit(conversations.damage(rows), rows)


def op12_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_pairs.Ranks(byte_pairs.read_ranks("byte_bpe_multi_50k.tiktoken"))
    ids = byte_pairs.encode(documents(spark, sf_dir), ranks)
    return ids.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(ranks.decoded(F.col("ids")), 256).alias("decoded_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_token_planes, op2_jaccard_forest, op3_merkle_fingerprints, op4_stream_dedup, op5_compression_quality,
        op6_license_scan, op7_best_fit_packing, op8_entropy_mixing, op9_prefix_token_counts,
        op10_suffix_dedup, op11_conversation_repair, op12_byte_pairs, op13_filter_audit,
    )}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
