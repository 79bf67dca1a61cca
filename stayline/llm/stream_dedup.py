"""Exact deduplication as a stateful stream; DataFrame functions only.

Arrivals (digest, identifier, locator) are streamed into state keyed by digest, kept on disk by the
RocksDB store and never expired: the stable identifier (the largest), the locator of the row that
holds it (call and row) and the number of rows. Where a digest is hit again, the full bytes of its texts
are compared; should two texts share a digest, their rows are grouped by the whole text instead.

Later calls with the same ``state`` folder go on from there: each call keeps its distinct texts beside the
state, by call, and a hit on an earlier call's state is compared with those. A row is kept only if both its id
and its locator are those of the state, so of a text whose largest id came earlier no later row stays; of rows
with one id and text that of the earliest call stays.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import boxed, boxed_text, join_on, text_of
from stayline.session import materialise, new_path

#: The store that keeps state on disk. Many small stores must not reserve disk ahead of need.
STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: Arrivals per micro-batch; a row of arrivals has some hundred bytes.
BATCH_BYTES = 1 << 30
#: The copies of a text are compared in so many groups first.
SALTS = 16


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def feed(arrivals: DataFrame, state: str, batch_bytes: int = BATCH_BYTES, max_files: int | None = None) -> DataFrame:
    """Stream (digest, id, turn, row) into the state folder; the state as rows (digest, keep, n).

    ``keep`` is a struct (id, turn, row): the largest id, and the locator of its row; ``turn`` is the call's number
    below zero, so that an earlier call comes first. ``arrivals`` is written to a folder beside the state, in which
    each call adds files that the stream has not seen.
    """
    spark = arrivals.sparkSession
    inbox, checkpoint = f"{state}/arrivals", f"{state}/checkpoint"
    arrivals.write.mode("append").parquet(inbox)
    before = {key: spark.conf.get(key, None) for key in STORE}
    for key, value in STORE.items():
        spark.conf.set(key, value)
    try:
        source = spark.readStream.schema(arrivals.schema)
        source = source.option("maxFilesPerTrigger", max_files) if max_files else source.option(
            "maxBytesPerTrigger", batch_bytes)
        keyed = source.parquet(inbox).groupBy("digest").agg(
            F.max(F.struct("id", "turn", "row")).alias("keep"), F.count(F.lit(1)).alias("n"))
        # The sink has nothing to keep: the result is the state.
        query = (keyed.writeStream.outputMode("update").format("noop")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    stored = spark.read.format("statestore").load(checkpoint)
    keep, n = [F.col(f"value.`{f.name}`") for f in stored.schema["value"].dataType.fields][:2]
    return stored.select(F.col("key.digest").alias("digest"), keep.alias("keep"), n.alias("n"))


def _earlier(spark: SparkSession, path: str) -> DataFrame | None:
    """Texts of earlier calls as rows (digest, text, keep_id, n, turn), if there were any."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def _texts(rows: DataFrame, turn: int) -> DataFrame:
    """The distinct texts of a call."""
    return rows.groupBy("digest", "text").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n")).withColumn(
        "turn", F.lit(turn))


@dataclass
class Classes:
    """What a call found: its arrivals, the verified state, and the groups of colliding digests if there are any."""

    turn: int
    arrivals: DataFrame
    held: DataFrame
    exact: DataFrame | None


def classes(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", state: str | None = None,
    digest: Callable[[Column], Column] = sha256, **feeding,
) -> Classes:
    """The equal texts of ``docs``, and of earlier calls on ``state``."""
    spark = docs.sparkSession
    earlier = _earlier(spark, f"{state}/texts") if state else None
    turn = 0 if earlier is None else earlier.agg(F.min("turn")).first()[0] - 1
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text).alias("text"))
    hashed = rows.withColumn("digest", digest(F.col("text")))
    arrivals = materialise(
        hashed.select("digest", "id", F.lit(turn).alias("turn"), F.monotonically_increasing_id().alias("row")), "arrivals")
    held = materialise(feed(arrivals, state or new_path(spark, "dedup-state"), **feeding), "dedup-state-rows")

    # Full bytes of all hits: within a salt first, so that a text with a mass of copies is spread out.
    hit = held.where("n > 1").select("digest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("id", F.length("text")), F.lit(SALTS)).cast("int")
    salted = hashed.select("digest", salt.alias("salt"), "text")
    if earlier is not None:
        earlier = materialise(earlier, "earlier-texts")  # this call's texts join that folder below
        salted = salted.unionByName(earlier.select("digest", F.lit(0).alias("salt"), "text"))
    if state:
        _texts(hashed, turn).write.mode("append").parquet(f"{state}/texts")
    inner = salted.join(hit, ["digest", "salt"]).groupBy("digest", "salt").agg(
        F.min("text").alias("low"), F.max("text").alias("high"))
    differ = materialise(
        inner.groupBy("digest").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .where("low != high").select("digest"), "collisions")
    if differ.isEmpty():
        return Classes(turn, arrivals, held, None)
    colliding = _texts(hashed.join(differ, "digest"), turn)
    if earlier is not None:
        colliding = colliding.unionByName(earlier.join(differ, "digest").select(colliding.columns))
    exact = colliding.groupBy("digest", "text").agg(
        F.max(F.struct("keep_id", "turn")).alias("keep"), F.sum("n").alias("n"))
    exact = exact.select("digest", "text", "keep.keep_id", "keep.turn", "n")
    return Classes(turn, arrivals, held.join(differ, "digest", "left_anti"), materialise(exact, "collision-groups"))


def deduplicate(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", state: str | None = None,
    digest: Callable[[Column], Column] = sha256, **feeding,
) -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Null texts count as empty; texts are compared without any change. The largest id of equal texts
    stays; of repeated rows with that id one stays. Null ids come first in that order. On a resumed state
    ``keep_id`` and ``group_size`` cover the earlier calls' rows, too. An empty table gives an empty one.
    Only the id and the text are read, so other columns may be called anything.
    """
    found = classes(docs, id_col, text, state, digest, **feeding)
    joined = join_on(found.arrivals, found.held, ["digest"])
    here = (F.col("turn") == F.col("keep.turn")) & (F.col("row") == F.col("keep.row"))
    plain = joined.select(
        F.col("id").alias(id_col), F.col("keep.id").alias("keep_id"), F.col("n").alias("group_size"),
        here.alias("kept"), F.col("digest").alias("text_sha256"))
    if found.exact is None:
        return plain
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text).alias("text"))
    rows = rows.withColumn("digest", digest(F.col("text")))
    met = join_on(rows, found.exact, ["digest", "text"])
    # Copies of one id are numbered by partial counts only: one row per (text, id), then its copies.
    folded = met.groupBy("digest", "text", "id", "keep_id", "turn", "n").agg(F.count(F.lit(1)).alias("copies"))
    spread = folded.select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    first = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("turn") == found.turn) & (F.col("copy") == 1)
    return plain.unionByName(spread.select(
        F.col("id").alias(id_col), "keep_id", F.col("n").alias("group_size"), first.alias("kept"),
        F.col("digest").alias("text_sha256")))


def survivors(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", state: str | None = None,
    digest: Callable[[Column], Column] = sha256, **feeding,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; odd rows are met as ``deduplicate`` says."""
    found = classes(docs, id_col, text, state, digest, **feeding)
    own = F.col("doc")[id_col]
    marked = boxed(docs).withColumn("text", boxed_text(text)).withColumn("digest", digest(F.col("text")))
    keep = found.held.where(F.col("keep.turn") == found.turn).select("digest", F.col("keep.id").alias("keep_id"))
    kept = join_on(marked, keep, ["digest"]).where(own.eqNullSafe(F.col("keep_id")))
    if found.exact is not None:
        groups = found.exact.where(F.col("turn") == found.turn).select("digest", "text", "keep_id")
        again = join_on(marked, groups, ["digest", "text"])
        kept = kept.unionByName(again.where(own.eqNullSafe(F.col("keep_id"))))
    repeated = found.arrivals.groupBy("digest", "id").count().where("count > 1")
    if not repeated.isEmpty():
        kept = kept.dropDuplicates(["keep_id", "text"])
    return kept.select("doc.*")
