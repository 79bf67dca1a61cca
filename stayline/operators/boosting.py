"""Boosted trees grown from histograms, several fits at once.

A fit is a learner on a set of rows, such as one fold of a cross-validation. All fits share one binned table, each row of
which carries a bit per fit, and grow side by side: one pass over the table gives the histograms of the next level of the
current tree of every fit, keyed by fit, node, feature and bin. They are added up by fit and searched for splits where they
are added up. Gradients are rounded to multiples of 2^-30 before they are summed, so sums are exact whatever the order of
tasks, and a fit grows the same trees alone as beside others. Features of few bins are packed: a pack of them is counted at
the cost of one, and the sums are parted by feature before they leave the task. Margins lie beside the rows and are brought up
to date once a tree; what a tree draws, with its gradients, is kept for its levels. A table below a fixed number of blocks is
dealt by fits instead of by rows, and each task makes the passes of its fit by itself, to the same trees; it counts the
smaller child of a node only, as the sibling is the parent less that.

Splits maximise the second-order gain G^2 / (H + l2); a leaf is -G / (H + l2) times the rate. Each tree draws its rows by
hash and its columns once. A tree with a budget of leaves is grown best-first: as a split's gain does not depend on what else
is split, the levels are expanded first, and a queue by gain then picks the splits to keep.

What reaches the driver is one split per fit and node: neither rows nor bins change its size.
"""

from __future__ import annotations

import heapq
import json
import math
import sys
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.columns import KEY, SEED
from stayline.session import materialise

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 2048
BINS = 32
#: Trees after which the margins are written into the table; until then a pass adds them up from the trees.
KEPT_TREES = 20
#: Blocks up to which a task takes a whole fit: 262,144 rows, some 16 MB, an eighth of what Spark reads in one task. Beyond
#: that the rows are dealt, as then a pass is worth its job.
TASK_BLOCKS = 128
#: Blocks of a task where the rows are dealt.
MOST_BLOCKS = 100
#: Tasks above which histograms are added up by fit in tasks of their own; of one task they are whole already.
GATHERED_TASKS = 1
#: Blocks that a task joins to one chunk, so that an array operation is worth its call.
CHUNK_BLOCKS = 8
#: Cells of a histogram that counts several features at once, as long as the product of their bins stays below it.
PACK_CELLS = 64
UNIT = 2.0**30


@dataclass(frozen=True)
class Boosting:
    """A learner. ``leaves`` is the budget of a best-first tree; without it, levels are split to ``depth``."""

    rounds: int = 200
    depth: int = 6
    leaves: int | None = None
    rate: float = 0.05
    l2: float = 1.0
    min_hessian: float = 1.0
    min_rows: int = 1
    row_share: float = 0.8
    column_share: float = 0.8
    seed: int = SEED

    def columns(self, tree: int, n: int) -> np.ndarray:
        """The columns of a tree: one draw per tree."""
        drawn = np.random.default_rng([self.seed, tree, 1]).permutation(n)[:max(1, int(self.column_share * n))]
        return np.sort(drawn)


@dataclass
class Tree:
    """Nodes by number; ``feature`` is -1 at a leaf. Values up to the edge of ``bin`` go left."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float, cover: float) -> int:
        for name, v in (("feature", -1), ("bin", 0), ("left", 0), ("right", 0), ("value", value), ("cover", cover),
                        ("gain", 0.0)):
            getattr(self, name).append(v)
        return len(self.feature) - 1


# --- the binned table --------------------------------------------------------------------------

def bin_edges(df: DataFrame, names: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Upper edges of the bins of each feature, ascending: quantiles, one aggregation. The last bin has no edge."""
    probs = [i / bins for i in range(1, bins)]
    found = df.agg(*[
        F.struct(F.percentile_approx(f"`{n}`", probs, 10_000).alias("q"), F.max(f"`{n}`").alias("top")).alias(f"c{i}")
        for i, n in enumerate(names)]).first()
    return [sorted({float(q) for q in c["q"] or [] if q < c["top"]}) for c in found]


def _binned(edges: list[np.ndarray], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            bins = np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)]).astype("u1")
            n = len(x)
            parts = [bins.tobytes(), *[batch[c].to_numpy(zero_copy_only=False).astype(t).tobytes() for c, t in (
                ("label", "u1"), ("member", "<u8"), ("draw", "<u8"))]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int32()), *[pa.array([p], pa.binary()) for p in parts], pa.array([b""], pa.binary())],
                names=["n", "bins", "label", "member", "draw", "margin"])

    return run


def blocks(df: DataFrame, names: Sequence[str], edges: list[list[float]], key: str = KEY) -> DataFrame:
    """The binned table: rows in blocks of arrays. ``df`` has ``key``, label, member (a bit per fit) and the features."""
    spark = df.sparkSession
    wanted = df.select(
        F.array(*[F.col(f"`{n}`").cast("double") for n in names]).alias("x"), F.col("label").cast("int").alias("label"),
        F.col("member").cast("bigint").alias("member"), F.xxhash64(F.col(key)).alias("draw"))
    # Rows are dealt evenly, to as many tasks as there are blocks or cores.
    n = wanted.count()
    tasks = max(1, min(math.ceil(n / BLOCK_ROWS), spark.sparkContext.defaultParallelism if n < 1_000_000 else n // 100_000))
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(BLOCK_ROWS))
    try:
        made = wanted.repartition(tasks, "draw").sortWithinPartitions("draw").mapInArrow(
            _binned([np.array(e) for e in edges], len(names)),
            "n int, bins binary, label binary, member binary, draw binary, margin binary")
        return materialise(made, "blocks")
    finally:
        spark.conf.set(setting, before)


# --- one pass ----------------------------------------------------------------------------------

def _arrays(tree: Tree) -> tuple[np.ndarray, ...]:
    return tuple(np.array(getattr(tree, n), t) for n, t in (
        ("feature", "i4"), ("bin", "i4"), ("left", "i4"), ("right", "i4"), ("value", "f8")))


class _Packs:
    """Features that are counted together. A row's cell in a pack is the sum of its bins times the features' steps.

    A pack costs as much as a single feature, and the histogram of each feature is a sum over the pack's cells.
    """

    def __init__(self, starts: np.ndarray):
        self.size = np.diff(starts)
        self.of, self.step = np.zeros(len(self.size), np.intp), np.ones(len(self.size), np.intp)
        cells: list[int] = []
        for f in np.argsort(-self.size, kind="stable"):
            place = next((i for i, c in enumerate(cells) if c * self.size[f] <= PACK_CELLS), len(cells))
            if place == len(cells):
                cells.append(1)
            self.of[f], self.step[f] = place, cells[place]
            cells[place] *= int(self.size[f])
        self.count, self.width = len(cells), max(cells)
        #: Bin of each feature in each cell of its pack, and by pack the place of that bin among the pack's features.
        self.bins = np.arange(self.width) // self.step[:, None] % self.size[:, None]
        self.features = [np.flatnonzero(self.of == k) for k in range(self.count)]
        self.places = [np.concatenate([b[:, None] == np.arange(n) for b, n in zip(self.bins[f], self.size[f])], axis=1)
                       for f in self.features]

    def cells(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros((self.count, bins.shape[1]), "u1")
        for f, row in enumerate(bins):
            out[self.of[f]] += row * np.uint8(self.step[f])
        return out

    def parted(self, sums: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Sums (3, nodes, bins of all features) out of sums (3, packs, nodes, cells)."""
        out = np.zeros((3 * sums.shape[2], int(starts[-1])))
        for k, (features, places) in enumerate(zip(self.features, self.places)):
            columns = np.concatenate([np.arange(starts[f], starts[f + 1]) for f in features])
            out[:, columns] = sums[:, k].reshape(-1, self.width) @ places.astype("f8")
        return out.reshape(3, sums.shape[2], -1)


def _ways(tree: tuple, packs: _Packs) -> tuple[np.ndarray, np.ndarray]:
    """Pack that a node asks for, and the node that follows on it by the row's cell. Leaves follow on themselves."""
    feature, cut, left, right, _ = tree
    f = np.maximum(feature, 0)
    follows = np.where(packs.bins[f] <= cut[:, None], left[:, None], right[:, None])
    follows = np.where((feature >= 0)[:, None], follows, np.arange(len(feature))[:, None])
    return packs.of[f], follows.astype(np.intp).ravel()


def _leaf_of(cells: np.ndarray, rows: np.ndarray, tree: tuple, packs: _Packs, depth: int) -> np.ndarray:
    """Node of each row after ``depth`` steps down; leaves keep their rows."""
    pack, follows = _ways(tree, packs)
    begin, flat = pack * cells.shape[1], cells.ravel()
    node = np.zeros(len(rows), np.intp)
    for _ in range(depth):
        at = begin.take(node)
        at += rows
        node *= packs.width
        node += flat.take(at)
        node = follows.take(node)
    return node


def _mixed(draw: np.ndarray, seed: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from hashes and a seed (splitmix64)."""
    with np.errstate(over="ignore"):
        z = draw + np.uint64(0x9E3779B97F4A7C15) * np.uint64(2 * seed + 1)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype("f8") / 2.0**53


def _block_rows(row: tuple, fits: int) -> tuple[np.ndarray, ...]:
    n, *parts = row
    bins, label, member, draw, margin = map(np.frombuffer, parts, ("u1", "u1", "<u8", "<u8", "<f8"))
    return bins.reshape(-1, n), label, member, draw, margin.reshape(fits, n) if len(margin) else np.zeros((fits, n))


def _chunks(blocks: Sequence[tuple], served: Sequence[int], fits: int, packs: _Packs) -> Iterator[tuple]:
    """Blocks joined to chunks: cells, label, member, draw and the margins of the fits that are served. They go from task to
    task as plain tuples, as executors have no copy of this package."""
    for start in range(0, len(blocks), CHUNK_BLOCKS):
        bins, label, member, draw, margin = (
            np.concatenate(parts, axis=-1) for parts in zip(*[_block_rows(b, fits) for b in blocks[start:start + CHUNK_BLOCKS]]))
        yield packs.cells(bins), label, member, draw, {fit: margin[fit] for fit in served}


@dataclass
class _Ask:
    """What a pass has to know of one fit."""

    fit: int
    bit: int
    learner: Boosting
    tree: int
    grown: list[tuple]  # trees that the margins lack
    open: tuple  # the current tree
    level: int
    nodes: np.ndarray  # nodes to be counted
    columns: np.ndarray

    def own(self, member: np.ndarray) -> np.ndarray:
        """The rows of a chunk that belong to the fit."""
        return np.flatnonzero((member >> np.uint64(self.bit)) & np.uint64(1))

    def margins(self, cells: np.ndarray, member: np.ndarray, margin: np.ndarray, packs: _Packs) -> np.ndarray:
        """The margins of all rows, with those trees added to the fit's own."""
        if not self.grown:
            return margin
        own = self.own(member)
        now = margin[own]
        for tree in self.grown:
            now = now + tree[4].take(_leaf_of(cells, own, tree, packs, self.learner.depth))
        margin = margin.copy()
        margin[own] = now
        return margin


def _advanced(asks: list[_Ask], packs: _Packs):
    """Chunks with the margins brought up to date."""
    def run(chunks: Iterator[tuple]) -> Iterator[tuple]:
        for cells, label, member, draw, margins in chunks:
            now = {a.fit: a.margins(cells, member, margins[a.fit], packs) for a in asks if a.fit in margins}
            yield cells, label, member, draw, now

    return run


def _drawn(asks: list[_Ask]):
    """What a tree of each fit has to know of chunks: cells, and by fit the rows it draws with their gradients and hessians."""
    def run(chunks: Iterator[tuple]) -> Iterator[tuple]:
        for cells, label, member, draw, margins in chunks:
            drawn, place = {}, np.min_scalar_type(cells.shape[1])
            for a in asks:
                if a.fit not in margins:
                    continue
                began = time.process_time()
                rows = a.own(member)
                if a.learner.row_share < 1:
                    rows = rows[_mixed(draw[rows], a.learner.seed * 100_003 + a.tree) < a.learner.row_share]
                p = 1.0 / (1.0 + np.exp(-margins[a.fit][rows]))
                g, h = np.rint((p - label[rows]) * UNIT), np.rint(p * (1.0 - p) * UNIT)
                drawn[a.fit] = rows.astype(place), g.astype("i4"), h.astype("i4"), time.process_time() - began
            yield cells, drawn

    return run


def _count(asks: list[_Ask], starts: np.ndarray, packs: _Packs):
    """Histograms of the asked nodes: gradients, hessians and rows by node and bin; all exact multiples of a unit."""
    def run(chunks: Iterator[tuple]) -> Iterator[tuple]:
        sums: dict[int, np.ndarray] = {}
        spent: dict[int, float] = {}
        for cells, drawn in chunks:
            for a in asks:
                if a.fit not in drawn:
                    continue
                began = time.process_time()
                rows, g, h, before = drawn[a.fit]
                rows = rows.astype(np.intp)
                slots = np.full(len(a.open[0]), -1, np.intp)
                slots[a.nodes] = np.arange(len(a.nodes)) * packs.width
                slot = slots.take(_leaf_of(cells, rows, a.open, packs, a.level))
                counted = slot >= 0
                if not counted.all():
                    rows, slot, g, h = rows[counted], slot[counted], g[counted], h[counted]
                g, h, size = g.astype("f8"), h.astype("f8"), len(a.nodes) * packs.width
                total = sums.setdefault(a.fit, np.zeros((3, packs.count, size)))
                for k in np.unique(packs.of[a.columns]):
                    at = slot + cells[k].take(rows)
                    total[0, k] += np.bincount(at, g, size)
                    total[1, k] += np.bincount(at, h, size)
                    total[2, k] += np.bincount(at, minlength=size)
                spent[a.fit] = spent.get(a.fit, 0.0) + time.process_time() - began + (0.0 if a.level else before)
        for a in asks:
            if a.fit in sums:
                total = sums[a.fit].reshape(3, packs.count, len(a.nodes), packs.width)
                yield a.fit, (spent[a.fit], packs.parted(total, starts))

    return run


def _stored(asks: list[_Ask], packs: _Packs):
    """The table with the margins of all fits after the trees grown so far."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
                bins, _, member, _, stored = _block_rows(row, len(asks))
                cells = packs.cells(bins)
                margin = np.stack([a.margins(cells, member, stored[a.fit], packs) for a in asks])  # one of each fit, in order
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(i, 1) for c in batch.columns[:-1]], pa.array([margin.tobytes()], pa.binary())],
                    names=batch.schema.names)

    return run


# --- splits ------------------------------------------------------------------------------------

def best_splits(sums: np.ndarray, starts: np.ndarray, columns: np.ndarray, learner: Boosting) -> list[tuple | None]:
    """(gain, feature, bin, left sums) of the best split of each node; ``sums`` is (3, nodes, bins).

    Of equal gains the first feature and bin stand.
    """
    g, h, n = sums[0] / UNIT, sums[1] / UNIT, sums[2]
    first = slice(starts[columns[0]], starts[columns[0] + 1])
    totals = [v[:, first].sum(axis=1)[:, None] for v in (g, h, n)]
    feature = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    left = []
    for v in (g, h, n):
        run = np.cumsum(v, axis=1)
        before = np.concatenate([np.zeros((len(v), 1)), run], axis=1)[:, starts[:-1]]
        left.append(run - before[:, feature])
    right = [t - x for t, x in zip(totals, left)]
    l2 = learner.l2
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 0.5 * (left[0]**2 / (left[1] + l2) + right[0]**2 / (right[1] + l2) - totals[0]**2 / (totals[1] + l2))
    usable = np.zeros(int(starts[-1]), bool)
    for c in columns:
        usable[starts[c]:starts[c + 1] - 1] = True
    allowed = usable & (np.minimum(left[1], right[1]) >= learner.min_hessian) & (
        np.minimum(left[2], right[2]) >= learner.min_rows)
    gain = np.where(allowed, np.round(gain, 9), -np.inf)
    best = np.argmax(gain, axis=1)
    return [(float(gain[i, b]), int(feature[b]), int(b - starts[feature[b]]), [float(x[i, b]) for x in left])
            if gain[i, b] > 1e-6 else None for i, b in enumerate(best)]


def best_first(tree: Tree, leaves: int) -> Tree:
    """The tree that growth by the largest gain first reaches with that many leaves, out of all its splits."""
    kept, count = set(), 1
    queue = [(-tree.gain[0], 0)] if tree.feature[0] >= 0 else []
    while queue and count < leaves:
        _, node = heapq.heappop(queue)
        kept.add(node)
        count += 1
        for child in (tree.left[node], tree.right[node]):
            if tree.feature[child] >= 0:
                heapq.heappush(queue, (-tree.gain[child], child))
    out, place = Tree(), {}
    order = [0]
    for node in order:
        place[node] = out.add(tree.value[node], tree.cover[node])
        if node in kept:
            order += [tree.left[node], tree.right[node]]
    for node in kept:
        at = place[node]
        out.feature[at], out.bin[at], out.gain[at] = tree.feature[node], tree.bin[node], tree.gain[node]
        out.left[at], out.right[at] = place[tree.left[node]], place[tree.right[node]]
    return out


def _node_splits(sums: np.ndarray, starts: np.ndarray, columns: np.ndarray, learner: Boosting) -> list[tuple]:
    """(totals, best split) of each node; ``sums`` is (3, nodes, bins)."""
    first = slice(starts[columns[0]], starts[columns[0] + 1])
    totals = (sums[:, :, first].sum(axis=2) / np.array([[UNIT], [UNIT], [1.0]])).T.tolist()
    return list(zip(totals, best_splits(sums, starts, columns, learner)))


def _found(asks: list[_Ask], starts: np.ndarray):
    """The splits of one fit out of its summed histograms, where those lie."""
    by_fit = {a.fit: a for a in asks}

    def run(row: tuple) -> tuple:
        fit, (spent, total) = row
        a, began = by_fit[fit], time.process_time()
        found = _node_splits(total.reshape(3, len(a.nodes), -1), starts, a.columns, a.learner)
        return fit, spent + time.process_time() - began, found

    return run


class _Growing:
    """One fit between passes."""

    def __init__(self, fit: int, bit: int, learner: Boosting, n_features: int):
        self.fit, self.bit, self.learner, self.n_features = fit, bit, learner, n_features
        self.trees: list[Tree] = []
        self.since: list[tuple] = []
        self.seconds = 0.0
        self.begin()

    def begin(self) -> None:
        self.tree, self.level = Tree(), 0
        self.tree.add(0.0, 0.0)
        self.columns = self.learner.columns(len(self.trees), self.n_features)
        self.open, self.counted, self.sums = [0], [0], {}
        self.siblings: dict[int, tuple[int, int]] = {}

    @property
    def done(self) -> bool:
        return len(self.trees) == self.learner.rounds

    def ask(self, nodes: Sequence[int]) -> _Ask:
        return _Ask(self.fit, self.bit, self.learner, len(self.trees), [], _arrays(self.tree), self.level,
                    np.array(nodes, "i4"), self.columns)

    def beginning(self) -> _Ask:
        """What the next tree has to know of the last one, the only one that the margins lack."""
        return replace(self.ask([0]), grown=self.since[-1:])

    def _leaf(self, g: float, h: float) -> float:
        return -self.learner.rate * g / (h + self.learner.l2) if h + self.learner.l2 > 0 else 0.0

    def completed(self, sums: np.ndarray) -> np.ndarray:
        """Histograms of all open nodes from those of the smaller children and of their parents."""
        by_node = dict(zip(self.counted, np.moveaxis(sums.reshape(3, len(self.counted), -1), 1, 0)))
        for node, (parent, sibling) in self.siblings.items():  # the larger children
            by_node[node] = self.sums[parent] - by_node[sibling]
        self.sums = by_node
        return np.stack([by_node[v] for v in self.open], axis=1)

    def take(self, found: list[tuple]) -> None:
        """Split the open nodes; a tree that cannot go on is closed and the next one begun."""
        if not self.level:
            g, h, n = found[0][0]
            self.tree.value[0], self.tree.cover[0] = self._leaf(g, h), n
        nodes, self.open, self.counted, self.siblings = self.open, [], [], {}
        for node, (total, split) in zip(nodes, found, strict=True):
            if split is None:
                continue
            gain, feature, cut, (g, h, n) = split
            left = self.tree.add(self._leaf(g, h), n)
            right = self.tree.add(self._leaf(total[0] - g, total[1] - h), total[2] - n)
            t = self.tree
            t.feature[node], t.bin[node], t.gain[node], t.left[node], t.right[node] = feature, cut, gain, left, right
            small, large = (left, right) if n <= total[2] - n else (right, left)
            self.open += [left, right]
            self.counted.append(small)
            self.siblings[large] = (node, small)
        self.level += 1
        if self.level == self.learner.depth or not self.counted:
            self.trees.append(best_first(self.tree, self.learner.leaves) if self.learner.leaves else self.tree)
            self.since.append(_arrays(self.trees[-1]))
            if not self.done:
                self.begin()


def _whole_fits(fits: Sequence[tuple[int, Boosting]], n_features: int, starts: np.ndarray):
    """All passes of a fit over its blocks in one task."""
    packs = _Packs(starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks_of: dict[int, list[tuple]] = {}
        for batch in batches:
            for fit, *row in zip(*(c.to_pylist() for c in batch.columns)):
                blocks_of.setdefault(fit, []).append(tuple(row))
        for fit, rows in blocks_of.items():
            own = _Growing(fit, *fits[fit], n_features)
            chunks = list(_chunks(rows, [fit], len(fits), packs))
            while not own.done:
                if not own.level:
                    chunks = list(_advanced([own.beginning()], packs)(chunks))
                    drawn = list(_drawn([own.beginning()])(chunks))
                (_, (spent, total)), = _count([own.ask(own.counted)], starts, packs)(drawn)
                own.seconds += spent
                own.take(_node_splits(own.completed(total), starts, own.columns, own.learner))
            yield pa.RecordBatch.from_pydict({
                "fit": pa.array([fit], pa.int32()), "seconds": [own.seconds],
                "trees": [json.dumps([vars(t) for t in own.trees])]})

    return run


def grow(table: DataFrame, edges: list[list[float]], fits: Sequence[tuple[int, Boosting]]) -> list[BoostedTrees]:
    """The models of ``fits`` (bit of the member column, learner), grown together on the binned table."""
    width = len(fits)
    starts = np.concatenate([[0], np.cumsum([len(e) + 1 for e in edges])])

    stored = table.count()
    if stored <= TASK_BLOCKS:
        # Few rows: the fits are dealt to tasks instead of the rows, and each task makes the same passes by itself.
        each = table.select(F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("fit"), "*")
        grown = each.repartitionByRange(width, "fit").mapInArrow(
            _whole_fits(fits, len(edges), starts), "fit int, seconds double, trees string").collect()  # the models
        return [BoostedTrees.of([Tree(**t) for t in json.loads(r["trees"])], edges, 0.0, r["seconds"])
                for r in sorted(grown, key=lambda r: r["fit"])]
    cores = table.sparkSession.sparkContext.defaultParallelism
    copies = max(1, min(len(fits), cores // max(1, stored)))  # of few blocks each core gets one, for some of the fits
    # Beyond that each turn of tasks keeps all cores busy.
    tasks = stored * copies if stored * copies <= cores else cores * math.ceil(stored / (MOST_BLOCKS * cores))
    packs = _Packs(starts)

    def joined(placed: Iterator[tuple]) -> Iterator[tuple]:
        """A task's chunks. Copy c of a block serves the fits that leave c when divided by the number of copies."""
        by_copy: dict[int, list[tuple]] = {}
        for place, row in placed:
            by_copy.setdefault(place % copies, []).append(row)
        for c, rows in by_copy.items():
            yield from _chunks(rows, range(c, width, copies), width, packs)

    def opened(blocks_now: DataFrame) -> RDD:
        # A pass is one short job over a few arrays. As an RDD of chunks it starts in half the time of a DataFrame
        # query, which is planned anew each time; what is lost is read again from the stored table.
        spread = blocks_now.rdd.map(tuple).zipWithIndex().flatMap(
            lambda row: [(row[1] * copies + c, row[0]) for c in range(copies)])
        return spread.partitionBy(tasks, int).mapPartitions(joined).persist(StorageLevel.MEMORY_AND_DISK)

    current, drawn, before = opened(table), None, []
    growing = [_Growing(i, bit, learner, len(edges)) for i, (bit, learner) in enumerate(fits)]
    while open_fits := [g for g in growing if not g.done]:
        # All fits begin a tree together; one that closes its tree early waits for the others.
        trees = min(len(g.trees) for g in open_fits)
        turn = [g for g in open_fits if len(g.trees) == trees]
        if not turn[0].level:
            if max(len(g.since) for g in growing) >= KEPT_TREES:
                kept = [replace(g.ask([0]), grown=g.since) for g in growing]
                table = materialise(table.mapInArrow(_stored(kept, packs), table.schema), "margins")
                for g in growing:
                    g.since = []
                current.unpersist()
                current = opened(table)
            before = [current, drawn] if drawn else []
            begins = [g.beginning() for g in turn]
            if any(a.grown for a in begins):
                current = current.mapPartitions(_advanced(begins, packs)).persist(StorageLevel.MEMORY_AND_DISK)
            drawn = current.mapPartitions(_drawn(begins)).persist(StorageLevel.MEMORY_AND_DISK)
        asks = [g.ask(g.open) for g in turn]
        sums = drawn.mapPartitions(_count(asks, starts, packs))
        if tasks > GATHERED_TASKS:
            sums = sums.reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), min(len(turn), cores))
        for fit, spent, found in sums.map(_found(asks, starts)).collect():  # per fit: one split a node
            growing[fit].seconds += spent
            growing[fit].take(found)
        for old in before:
            if old is not current:
                old.unpersist()
        before = []
    current.unpersist()
    drawn.unpersist()
    return [BoostedTrees.of(g.trees, edges, 0.0, g.seconds) for g in growing]


# --- the model ---------------------------------------------------------------------------------

def _scores(nodes: dict[str, np.ndarray], roots: np.ndarray, depth: int, base: float):
    def run(x):
        rows = np.stack(x.to_numpy()) if len(x) else np.zeros((0, 1))
        at = np.arange(len(rows))
        margin = np.full(len(rows), base)
        for root in roots:
            node = np.full(len(rows), root)
            for _ in range(depth):
                f = nodes["feature"][node]
                left = rows[at, np.maximum(f, 0)] <= nodes["threshold"][node]
                node = np.where(f < 0, node, np.where(left, nodes["left"][node], nodes["right"][node]))
            margin += nodes["value"][node]
        import pandas as pd

        return pd.Series(1.0 / (1.0 + np.exp(-margin)))

    return run


@dataclass
class BoostedTrees(Model):
    """A fitted model on the log-odds: the base plus the leaves a row falls into."""

    nodes: list[dict]  # tree, id, left, right, feature, threshold, value, cover, gain; leaves have left -1
    base: float = 0.0
    seconds: float = 0.0

    def __post_init__(self):
        Model.__init__(self)

    __hash__ = object.__hash__

    @staticmethod
    def of(trees: list[Tree], edges: list[list[float]], base: float, seconds: float) -> BoostedTrees:
        nodes = []
        for t, tree in enumerate(trees):
            for i, f in enumerate(tree.feature):
                inner = f >= 0
                nodes.append({
                    "tree": t, "id": i, "left": tree.left[i] if inner else -1, "right": tree.right[i] if inner else -1,
                    "feature": f, "threshold": float(edges[f][tree.bin[i]]) if inner else 0.0,
                    "value": 0.0 if inner else float(tree.value[i]), "cover": float(tree.cover[i]), "gain": float(tree.gain[i])})
        return BoostedTrees(nodes, base, seconds)

    SCHEMA = ("tree int, id int, left int, right int, feature int, threshold double, value double, cover double, gain double")

    def node_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(n.values()) for n in self.nodes], self.SCHEMA)

    def probability(self, features: Column) -> Column:
        """Probability of the positive class from an array of features."""
        sizes = np.bincount([n["tree"] for n in self.nodes])
        roots = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        shift = np.repeat(roots, sizes)
        flat = {c: np.array([n[c] for n in self.nodes]) for c in ("feature", "threshold", "value", "left", "right")}
        flat["left"], flat["right"] = flat["left"] + shift, flat["right"] + shift
        depth = max(_depths(self.nodes))
        return F.pandas_udf(_scores(flat, roots, depth, self.base), "double")(features)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = self.probability(vector_to_array("features"))
        scored = dataset.withColumn("_p", p)
        return scored.withColumn("probability", array_to_vector(F.array(1 - F.col("_p"), "_p"))).withColumn(
            "prediction", (F.col("_p") > 0.5).cast("double")).drop("_p")

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        head = json.dumps({"base": self.base, "seconds": self.seconds})
        spark.createDataFrame([(head,)], "value string").coalesce(1).write.text(f"{path}/boosted")
        self.node_table(spark).coalesce(1).write.parquet(f"{path}/nodes")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        head = json.loads(spark.read.text(f"{path}/boosted").first()[0])
        rows = spark.read.parquet(f"{path}/nodes").orderBy("tree", "id").collect()  # the model itself
        return BoostedTrees([r.asDict() for r in rows], **head)


def _depths(nodes: list[dict]) -> Iterator[int]:
    """Steps from the root to each node; parents come before their children."""
    depth: dict[tuple, int] = {}
    for n in nodes:
        own = depth.setdefault((n["tree"], n["id"]), 0)
        if n["left"] >= 0:
            depth[n["tree"], n["left"]] = depth[n["tree"], n["right"]] = own + 1
        yield own
