"""Exact k nearest neighbours among the rows of one table.

Columns that hold only 0 and 1 make a row's signature; rows of one signature form a cell. The squared distance of two
rows is the number of places in which their signatures differ plus the distance of the other, numeric columns, so the
first is a bound for whole cells that costs one exclusive-or. The cells nearest to a row by that bound give a limit
first; only rows of cells within the limit are compared in full.

Points are divided into blocks by halving, on signature columns that part a block evenly and else at the median of the
widest numeric column. Neighbours inside the own block give a limit per point; the bounding boxes of the other blocks
tell which of them can hold anything nearer, and only those are visited. They are visited in two turns, the few nearest
boxes first: the limit that these leave rules out most of the others. No candidate is dropped, so the result equals
brute force. Pairs never become rows: a task compares a bounded set of points with one block and keeps the k best.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayline.session import materialise

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 1024
ASKING_ROWS = 8192
#: Other blocks that a point visits in the first turn, and those as near as the last of them.
FIRST_BLOCKS = 8
#: A signature column halves a block if at least this share of its rows is on either side.
EVEN = 0.3


def _signatures(x: np.ndarray, indicators: Sequence[int]) -> np.ndarray:
    """The 0/1 columns of each row as bits, 64 to a word."""
    words = [indicators[i:i + 64] for i in range(0, len(indicators), 64)]
    made = [(x[:, w].astype("u8") << np.arange(len(w), dtype="u8")).sum(axis=1, dtype="u8") for w in words]
    return np.stack(made, axis=1) if made else np.zeros((len(x), 1), "u8")


def _differing(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    return sum(np.bitwise_count(q[:, [i]] ^ x[:, i]).astype("i4") for i in range(q.shape[1]))


def _squared(q: np.ndarray, x: np.ndarray, r: np.ndarray, c: np.ndarray, columns: Sequence[int] | None = None) -> np.ndarray:
    """Squared distances of pairs, column by column: equal pairs get equal sums wherever they are compared."""
    d2 = np.zeros(np.broadcast(r, c).shape)
    for i in range(q.shape[1]) if columns is None else columns:
        d2 += (q[r, i] - x[c, i]) ** 2
    return d2


def _best(q, x, sq, sx, ids, k: int, limit: np.ndarray, numeric: Sequence[int], own: int | None = None):
    """Up to k nearest rows of ``x`` for each of ``q`` within its limit, as sorted (row, place, distance), and the
    number of pairs compared in full. Of equal distances the least id stands.

    With ``own``, row i of ``q`` is row ``own + i`` of ``x`` and not its own neighbour. ``numeric`` are the columns
    outside the signatures.
    """
    apart = _differing(sq, sx)
    if own is not None:
        apart[np.arange(len(q)), np.arange(own, own + len(q))] = np.iinfo("i4").max
    compared = 0
    if len(x) - (own is not None) >= k and np.isinf(limit).any():
        near = np.argpartition(apart, k - 1, axis=1)[:, :k]  # of the nearest cells
        first = _squared(q, x, np.arange(len(q))[:, None], near)
        limit = np.minimum(limit, first.max(axis=1))
        compared = first.size
    # Rounding must not hide a cell or a point that just touches the limit.
    loose = limit * (1 + 1e-9) + 1e-9
    r, c = np.nonzero(apart <= np.minimum(loose, 2.0**30)[:, None])
    compared += len(r)
    touching = apart[r, c] + _squared(q, x, r, c, numeric) <= loose[r]
    r, c = r[touching], c[touching]
    d2 = _squared(q, x, r, c)
    within = d2 <= limit[r]
    r, c, d2 = r[within], c[within], d2[within]
    order = np.lexsort((ids[c], d2, r))
    r, c, d2 = r[order], c[order], d2[order]
    nth = np.arange(len(r)) - np.searchsorted(r, r)
    return r[nth < k], c[nth < k], d2[nth < k], compared


def _numeric(cols: Sequence[str], indicators: Sequence[int]) -> list[int]:
    return sorted(set(range(len(cols))) - set(indicators))


def _nearest_in_block(cols: Sequence[str], indicators: Sequence[int], k: int, compared):
    numeric = _numeric(cols, indicators)

    def search(pdf):
        pdf = pdf.sort_values("pid", ignore_index=True)
        x, ids = pdf[list(cols)].to_numpy(), pdf["pid"].to_numpy()
        places, sx = np.arange(len(ids)), _signatures(pdf[list(cols)].to_numpy(), indicators)  # in the order of the ids
        nids, d2s = [], []
        for start in range(0, len(pdf), 256):
            q = x[start:start + 256]
            r, c, d2, n = _best(q, x, sx[start:start + 256], sx, places, k, np.full(len(q), np.inf), numeric,
                                start)
            compared.add(n)
            ends = np.searchsorted(r, np.arange(len(q) + 1))
            nids += [ids[c[a:b]] for a, b in zip(ends, ends[1:])]
            d2s += [d2[a:b] for a, b in zip(ends, ends[1:])]
        bound = [d[-1] if len(d) == k else np.inf for d in d2s]
        return pdf.assign(_bound=np.array(bound, dtype=float), nids=nids, d2s=d2s)

    return search


def _blocks_within_bound(cols: Sequence[str], boxes: np.ndarray, first_turn: bool):
    """Visits (pid, _bound, _block) of one of the two turns. Which turn a block belongs to follows from the boxes alone."""
    ids, low, high = boxes[:, 0].astype("int32"), boxes[:, 1:len(cols) + 1], boxes[:, len(cols) + 1:]
    step = max(1, 2_000_000 // len(boxes))

    def visits(batches):
        for pdf in batches:
            x, own, bound = pdf[list(cols)].to_numpy(), pdf["_block"].to_numpy(), pdf["_bound"].to_numpy()
            for start in range(0, len(x), step):
                q = x[start:start + step]
                gap2 = np.zeros((len(q), len(boxes)))
                for i in range(len(cols)):
                    v = q[:, i, None]
                    gap2 += np.maximum(np.maximum(low[:, i] - v, v - high[:, i]), 0.0) ** 2
                # Rounding must not hide a block that just touches the bound.
                near = gap2 <= bound[start:start + step, None] * (1 + 1e-9) + 1e-18
                other = ids != own[start:start + step, None]
                if len(boxes) > FIRST_BLOCKS + 1:
                    gap2[~other] = np.inf
                    early = gap2 <= np.partition(gap2, FIRST_BLOCKS - 1, axis=1)[:, [FIRST_BLOCKS - 1]]
                    other &= early if first_turn else ~early
                r, b = np.nonzero(near & other)
                yield pdf[["pid", "_bound"]].iloc[start + r].assign(_block=ids[b])

    return visits


def _within_bound(cols: Sequence[str], indicators: Sequence[int], k: int, compared):
    numeric = _numeric(cols, indicators)

    def compare(asking, block):
        block = block.sort_values("pid", ignore_index=True)
        x, ids = block[list(cols)].to_numpy(), block["pid"].to_numpy()
        q, bound, pids = asking[list(cols)].to_numpy(), asking["_bound"].to_numpy(), asking["pid"].to_numpy()
        sq, sx, places = _signatures(q, indicators), _signatures(x, indicators), np.arange(len(ids))
        found = [pd.DataFrame({"pid": [], "nid": [], "d2": []}).astype({"pid": object, "nid": object})]
        for start in range(0, len(q), 256):
            some = slice(start, start + 256)
            r, c, d2, n = _best(q[some], x, sq[some], sx, places, k, bound[some], numeric)
            compared.add(n)
            found.append(pd.DataFrame({"pid": pids[start + r], "nid": ids[c], "d2": d2}))
        return pd.concat(found, ignore_index=True)

    return compare


def _halved(points: DataFrame, cols: Sequence[str], indicators: Sequence[int], blocks: int) -> DataFrame:
    """Add ``_block``: as many halvings as give at least ``blocks`` blocks.

    Each halving takes two small aggregations by block: which column parts it best, then the median of that
    column. Rows stay where they are until the blocks are used.
    """
    out = points.withColumn("_block", F.lit(0))
    listed = F.array(*[F.col(c) for c in cols])
    for _ in range(max(0, math.ceil(math.log2(blocks)))):
        # A signature column that parts the block evenly comes before any numeric one: its halves lie apart.
        even = {cols[i]: F.least(F.avg(cols[i]), 1 - F.avg(cols[i])) for i in indicators}
        spans = F.array(*[F.when(even[c] >= EVEN, 1e9 + even[c]).otherwise(0.0) if c in even else F.max(c) - F.min(c)
                          for c in cols])
        widest = out.groupBy("_block").agg(spans.alias("spans")).select(
            "_block", F.array_position("spans", F.array_max("spans")).cast("int").alias("_axis"))
        placed = out.join(widest, "_block").withColumn("_v", F.element_at(listed, F.col("_axis")))
        cuts = placed.groupBy("_block").agg(
            F.percentile_approx("_v", 0.5).alias("_cut"), F.max("_v").alias("_top"))
        # A median equal to the largest value still divides: that value goes to the upper half.
        above = (F.col("_v") > F.col("_cut")) | ((F.col("_cut") == F.col("_top")) & (F.col("_v") == F.col("_cut")))
        out = placed.join(cuts, "_block").withColumn("_block", F.col("_block") * 2 + above.cast("int")).drop(
            "_axis", "_v", "_cut", "_top")
        out = materialise(out, "halved")
    return out


def nearest(
    points: DataFrame, cols: Sequence[str], k: int, block_rows: int = BLOCK_ROWS, stats: dict | None = None,
) -> DataFrame:
    """Rows ``(pid, nid, d2, rank)``: the k nearest other points of every point.

    One plan at every size, with blocks of about ``block_rows`` points. ``points`` holds ``pid`` (unique text) and the
    double columns ``cols``. ``stats`` receives the share of all pairs that were compared in full.
    """
    cols = list(cols)
    spark = points.sparkSession
    odd = [F.count_if(~F.col(c).isin(0.0, 1.0) | F.col(c).isNull()) for c in cols]
    n, *others = points.agg(F.count(F.lit(1)), *odd).first()
    indicators = [i for i, found in enumerate(others) if not found]
    blocks = max(1, math.ceil(n / block_rows))
    compared = spark.sparkContext.accumulator(0)
    columns = ["pid", *cols]
    ddl = ", ".join(["pid string", *[f"{c} double" for c in cols]])
    found = "_bound double, nids array<string>, d2s array<double>"
    best = Window.partitionBy("pid").orderBy("d2", "nid")

    def listed(df: DataFrame) -> DataFrame:
        pairs = F.arrays_zip(F.col("nids").alias("nid"), F.col("d2s").alias("d2"))
        return df.select("pid", F.inline(pairs))

    blocked = _halved(points.select(*columns), cols, indicators, blocks)
    searched = materialise(
        blocked.groupBy("_block").applyInPandas(
            _nearest_in_block(cols, indicators, k, compared), f"{ddl}, _block int, {found}"),
        "block-neighbours",
    )
    def ranked(df: DataFrame) -> DataFrame:
        return materialise(df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "neighbours")

    asking_rows = searched.select(*columns, "_bound", "_block")
    found_so_far = listed(searched)
    if blocks == 1:
        found_so_far = ranked(found_so_far)
    else:
        extent = [F.expr(f"{f}({c}) as {f}_{c}") for f in ("min", "max") for c in cols]
        boxes = np.array(blocked.groupBy("_block").agg(*extent).collect(), dtype=float)  # one row per block
        boxes = boxes[np.argsort(boxes[:, 0])]
        for first_turn in (True, False)[:2 if len(boxes) > FIRST_BLOCKS + 1 else 1]:
            asked = materialise(
                asking_rows.mapInPandas(
                    _blocks_within_bound(cols, boxes, first_turn), "pid string, _bound double, _block int"
                ),
                "visits",
            )
            # A block asked by many points is compared in several tasks, each with a bounded share of them.
            chunks = asked.groupBy("_block").agg(F.expr(f"int(ceil(count(1) / {ASKING_ROWS})) as chunks"))
            asking = asked.join(chunks, "_block").withColumn("_chunk", F.expr("int(pmod(xxhash64(pid), chunks))")).join(
                points.select(*columns), "pid")
            shares = chunks.selectExpr("_block as _of_block", "explode(sequence(0, chunks - 1)) as _chunk")
            asked_of = blocked.select(*columns, "_block").join(shares, F.col("_block") == F.col("_of_block"))
            across = asking.groupBy("_block", "_chunk").cogroup(asked_of.groupBy("_of_block", "_chunk")).applyInPandas(
                _within_bound(cols, indicators, k, compared), "pid string, nid string, d2 double"
            )
            found_so_far = ranked(found_so_far.select("pid", "nid", "d2").unionByName(across))
            # The k-th nearest so far is the limit of the second turn; a point with fewer has none.
            limits = found_so_far.where(F.col("rank") == k).select("pid", F.col("d2").alias("_limit"))
            asking_rows = searched.select(*columns, "_block").join(limits, "pid", "left").select(
                *columns, F.coalesce("_limit", F.lit(float("inf"))).alias("_bound"), "_block")
    if stats is not None:
        stats["compared_share"] = compared.value / max(1, n * (n - 1))
    return found_so_far
