"""Best-fit packing of token pieces into sequences, with large pieces matched first.

Pieces above a third of the capacity go at most two to a sequence: the largest left takes the largest
that still fits. Smaller pieces then go, largest first, to the tightest gap. Both steps depend only on
how many pieces there are of each length, so they run on a histogram of at most ``capacity`` rows and
give runs: so many pieces of a length, to consecutive sequences, at an offset. Every piece then finds
its place by its rank among the pieces of its length; nothing else is gathered.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.common import small_batches, text_of
from stayline.llm.tokens import encoder
from stayline.session import materialise

CAPACITY = 2048
VOCABULARY = "byte_bpe_50k.json"
END_ID = 0

Run = tuple[int, int, int, int, int, int]  # length, first rank, rank after, first sequence, offset, per sequence


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Runs for ``counts`` pieces of each length."""
    left = {n: c for n, c in counts.items() if c > 0}
    rank = dict.fromkeys(left, 0)
    runs: list[Run] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, sequences)
    made = 0

    def put(length: int, pieces: int, sequence: int, offset: int, per: int = 1) -> None:
        runs.append((length, rank[length], rank[length] + pieces, sequence, offset, per))
        rank[length] += pieces
        left[length] -= pieces

    def leave(gap: int, sequence: int, n: int) -> None:
        if gap and n:
            gaps.setdefault(gap, []).append((sequence, n))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        first = large[-1]
        room = min(first, capacity - first)
        at = bisect.bisect_right(large, room) - 1
        if at >= 0 and large[at] == first and left[first] < 2:
            at -= 1
        if at < 0:
            n = left[first]
            leave(capacity - first, made, n)
            put(first, n, made, 0)
        else:
            second = large[at]
            n = left[first] // 2 if second == first else min(left[first], left[second])
            leave(capacity - first - second, made, n)
            put(first, n, made, 0)
            put(second, n, made, first)
            if not left[second]:
                large.remove(second)
        made += n
        if first in large and not left[first]:
            large.remove(first)

    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        for gap in sorted(g for g in gaps if g >= length):
            per = gap // length
            while left[length] and gaps.get(gap):
                sequence, n = gaps[gap].pop()
                # The tightest gap keeps taking pieces of this length until they no longer fit.
                full = min(n, left[length] // per)
                if full:
                    put(length, full * per, sequence, capacity - gap, per)
                    leave(gap - per * length, sequence, full)
                rest = min(left[length], per - 1) if full < n else 0
                if rest:
                    put(length, rest, sequence + full, capacity - gap, rest)
                    leave(gap - rest * length, sequence + full, 1)
                    full += 1
                if full < n:
                    gaps[gap].append((sequence + full, n - full))
            if not gaps.get(gap):
                gaps.pop(gap, None)
            if not left[length]:
                break
        per = capacity // length
        full, rest = divmod(left[length], per)
        if full:
            put(length, full * per, made, 0, per)
            leave(capacity - per * length, made, full)
            made += full
        if rest:
            put(length, rest, made, 0, rest)
            leave(capacity - rest * length, made, 1)
            made += 1
    return runs


def pieces(docs: DataFrame, id_col: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
           capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Token pieces (id, piece, start, length, ids_crc32, part, nth[, ids]), written to a table.

    Ids of the whole text, then ``end_id``; only longer documents are cut, the first piece takes the
    odd rest. ``nth`` numbers the pieces of a length within ``part``, the task that made them.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, seen, part = encoder(vocabulary, True), {}, TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[list] = [[] for _ in range(8)]
            encoded = tokens.encode(batch.column(1).to_pylist())
            for at, ids in enumerate(encoded):
                ids += end
                n = len(ids) // 4
                first = n % capacity or capacity
                edges = [0, *range(min(first, n), n + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    data = ids[4 * a : 4 * b]
                    nth = seen.get(b - a, 0)
                    seen[b - a] = nth + 1
                    for column, v in zip(rows, (at, k, a, b - a, zlib.crc32(data), part, nth, data), strict=True):
                        column.append(v)
            made = [batch.column(0).take(pa.array(rows[0], "int64")), pa.array(rows[1], "int32")]
            made += [pa.array(r, "int64") for r in rows[2:5]] + [pa.array(rows[5], "int32"), pa.array(rows[6], "int64")]
            names = ["id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            if with_ids:
                made.append(pa.array(rows[7], "binary"))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(made, names)

    source = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text).alias("text"))
    kind = dict(source.dtypes)["id"]
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"
    with small_batches(docs.sparkSession):
        return materialise(source.mapInArrow(cut, schema + ", ids binary" * with_ids), "pieces")


def pack(docs: DataFrame, id_col: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
         capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Per piece: ``id_col, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).

    A null text counts as empty: its one piece is the end id. Repeated rows are packed as often as
    they occur. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    made = pieces(docs, id_col, text, vocabulary, capacity, end_id, with_ids)
    counts = made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts, "piece-counts")
    # At most ``capacity`` rows: one per length.
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # Runs are bounded by lengths times gaps, whatever the number of documents.
    runs = spark.createDataFrame(
        plan(histogram, capacity), "_length bigint, low bigint, high bigint, first bigint, at bigint, per bigint")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("part").alias("_part"), F.col("length").alias("_l"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    ranked = made.join(starts, (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_l")))
    ranked = ranked.withColumn("rank", F.col("_base") + F.col("nth"))
    placed = ranked.join(
        F.broadcast(runs),
        (F.col("length") == F.col("_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    into = F.col("rank") - F.col("low")
    out = placed.select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.floor(into / F.col("per"))).cast("bigint").alias("sequence_id"),
        (F.col("at") + (into % F.col("per")) * F.col("length")).alias("offset"),
        *(["ids"] if with_ids else []))
    return out
