"""Session helpers: the shared checkpoint folder and tables written into it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_memo: dict[tuple, object] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder named by the cluster. Only a local session may get a folder of its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(made)
    return made


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, grouped by application."""
    app = spark.sparkContext.applicationId
    return f"{checkpoint_dir(spark).rstrip('/')}/stayline/{app}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors and, unlike an RDD checkpoint, keeps column
    pruning and filter pushdown for every later reader.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def once(spark: SparkSession, key: tuple, build):
    """Build a shared intermediate once per application."""
    full = (spark.sparkContext.applicationId, *key)
    if full not in _memo:
        _memo[full] = build()
    return _memo[full]
