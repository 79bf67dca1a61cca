"""Boosted trees: splits, leaves and growth against plain arrays and SQL; fits side by side against fits alone."""

import itertools
import pickle

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from stayline.columns import KEY
from stayline.operators import boosting, features
from stayline.operators.boosting import Boosting

NAMES = [f"f{i}" for i in range(8)]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 8)).round(2)
    x[:, 4:] = x[:, 4:] > 0.3
    y = (x[:, 0] * x[:, 4] + x[:, 1] - x[:, 5] + rng.normal(size=3000) * 0.5 > 0).astype(int)
    made = [(f"k{i}", int(y[i]), 7 ^ (1 << int(rng.integers(0, 3))) | 8, *map(float, x[i])) for i in range(3000)]
    return spark.createDataFrame(made, ", ".join([f"{KEY} string, label int, member bigint", *[f"{n} double" for n in NAMES]])).cache()


@pytest.fixture(scope="module")
def table(rows):
    edges = boosting.bin_edges(rows, NAMES)
    return boosting.blocks(rows, NAMES, edges), edges


def leaf_of(tree, row):
    node = 0
    while tree[node]["left"] >= 0:
        n = tree[node]
        node = n["left"] if row[NAMES[n["feature"]]] <= n["threshold"] else n["right"]
    return node


def by_tree(model):
    found = {}
    for n in model.nodes:
        found.setdefault(n["tree"], {})[n["id"]] = n
    return found


@pytest.fixture(params=[0, boosting.TASK_BLOCKS], ids=["rows dealt", "fits dealt"])
def dealt(request, monkeypatch):
    monkeypatch.setattr(boosting, "TASK_BLOCKS", request.param)


def test_rows_or_fits_dealt_grow_the_same_trees(table, monkeypatch):
    fits = [(bit, Boosting(rounds=3, depth=4, leaves=v, seed=5)) for bit in (1, 3) for v in (None, 7)]
    fewer = boosting.grow(*table, fits)
    monkeypatch.setattr(boosting, "TASK_BLOCKS", 0)
    assert [m.nodes for m in boosting.grow(*table, fits)] == [m.nodes for m in fewer]


def test_one_fold_alone_grows_the_same_trees(table, dealt):
    learners = [Boosting(rounds=6, depth=4), Boosting(rounds=6, depth=5, leaves=9, l2=0.0, min_hessian=1e-3, min_rows=20)]
    together = boosting.grow(*table, [(bit, v) for v in learners for bit in range(4)])
    for v, bit in itertools.product(range(2), (0, 2, 3)):
        alone, = boosting.grow(*table, [(bit, learners[v])])
        assert alone.nodes == together[4 * v + bit].nodes


def test_stored_margins_change_nothing(table, monkeypatch):
    fits = [(3, Boosting(rounds=7, depth=3)), (0, Boosting(rounds=4, depth=3, leaves=4))]
    monkeypatch.setattr(boosting, "TASK_BLOCKS", 0)
    whole = boosting.grow(*table, fits)
    monkeypatch.setattr(boosting, "KEPT_TREES", 2)
    monkeypatch.setattr(boosting, "GATHERED_TASKS", 0)
    assert [m.nodes for m in boosting.grow(*table, fits)] == [m.nodes for m in whole]


def test_first_tree_equals_brute_force(rows, table):
    """Every split is the best of all features and edges by the second-order gain; leaves are -G / (H + l2)."""
    learner = Boosting(rounds=1, depth=3, row_share=1.0, column_share=1.0, rate=0.1, l2=2.0)
    model, = boosting.grow(*table, [(3, learner)])
    tree = by_tree(model)[0]
    data = [r.asDict() for r in rows.collect()]
    x = np.array([[r[n] for n in NAMES] for r in data])
    g, h = 0.5 - np.array([r["label"] for r in data]), np.full(len(data), 0.25)

    def score(m):
        return g[m].sum() ** 2 / (h[m].sum() + 2.0)

    members = {0: np.ones(len(data), bool)}
    for i in sorted(tree):
        n, m = tree[i], members[i]
        best = max(
            ((0.5 * (score(m & (x[:, f] <= e)) + score(m & (x[:, f] > e)) - score(m)), -f, -e)
             for f, edges in enumerate(table[1]) for e in edges
             if min(h[m & (x[:, f] <= e)].sum(), h[m & (x[:, f] > e)].sum()) >= 1), default=(0,))
        assert n["cover"] == m.sum()
        if n["left"] < 0:
            assert n["value"] == pytest.approx(-0.1 * g[m].sum() / (h[m].sum() + 2.0), abs=1e-7)
            continue
        assert n["gain"] == pytest.approx(best[0], abs=1e-5)
        left = x[:, n["feature"]] <= n["threshold"]
        assert 0.5 * (score(m & left) + score(m & ~left) - score(m)) == pytest.approx(best[0], abs=1e-9)
        members[n["left"]], members[n["right"]] = m & left, m & ~left


def test_leaves_of_a_later_tree_by_sql(spark, rows, table):
    model, = boosting.grow(*table, [(3, Boosting(rounds=4, depth=3, row_share=1.0, column_share=1.0))])
    trees = by_tree(model)
    data = []
    for r in rows.collect():
        row = r.asDict()
        margin = sum(trees[t][leaf_of(trees[t], row)]["value"] for t in range(3))
        data.append((leaf_of(trees[3], row), row["label"], float(margin)))
    spark.createDataFrame(data, "leaf int, label int, margin double").createOrReplaceTempView("leaves")
    found = spark.sql("""select leaf, -0.05D * sum(p - label) / (sum(p * (1 - p)) + 1) as value, count(*) as n
        from (select *, 1 / (1 + exp(-margin)) as p from leaves) group by leaf""").collect()
    assert len(found) > 4
    for r in found:
        assert trees[3][r.leaf]["value"] == pytest.approx(r.value, abs=1e-7) and trees[3][r.leaf]["cover"] == r.n


def test_best_first_growth(table):
    learner = Boosting(rounds=2, depth=6, leaves=31, l2=0.0, min_hessian=1e-3, min_rows=20, row_share=1.0, column_share=1.0)
    full = Boosting(**{**learner.__dict__, "leaves": None})
    model, whole = boosting.grow(*table, [(3, learner), (3, full)])
    for t, tree in by_tree(model).items():
        leaves = [n for n in tree.values() if n["left"] < 0]
        assert len(leaves) == 31 and all(n["cover"] >= 20 for n in leaves)
    # Growth one split at a time, always the open leaf of the largest gain, on the first tree of the full growth.
    first, open_leaves, taken = by_tree(whole)[0], [0], []
    while len(open_leaves) < 31:
        best = max((n for n in open_leaves if first[n]["left"] >= 0), key=lambda n: (first[n]["gain"], -n))
        open_leaves.remove(best)
        taken.append(first[best]["gain"])
        open_leaves += [first[best]["left"], first[best]["right"]]
    assert sorted(n["gain"] for n in by_tree(model)[0].values() if n["left"] >= 0) == sorted(taken)
    depth = list(boosting._depths(model.nodes))
    assert max(depth) <= 6


def test_few_leaves_where_the_data_allow_no_more(spark):
    made = [(f"k{i}", i % 2, 1, float(i % 2)) for i in range(50)]
    df = spark.createDataFrame(made, f"{KEY} string, label int, member bigint, f0 double")
    edges = boosting.bin_edges(df, ["f0"])
    model, = boosting.grow(boosting.blocks(df, ["f0"], edges), edges, [(0, Boosting(rounds=2, leaves=31, row_share=1.0))])
    assert [sum(n["left"] < 0 for n in t.values()) for t in by_tree(model).values()] == [2, 2]


def test_each_tree_draws_its_columns_and_rows(table):
    model, = boosting.grow(*table, [(3, Boosting(rounds=12, depth=6))])
    used = [{n["feature"] for n in t.values() if n["left"] >= 0} for t in by_tree(model).values()]
    assert all(len(u) <= 6 for u in used) and len(set.union(*used)) == 8
    drawn = [t[0]["cover"] for t in by_tree(model).values()]
    assert len(set(drawn)) > 6 and all(abs(n - 2400) < 150 for n in drawn)


def test_model_scores_saves_and_loads(spark, rows, table, tmp_path):
    model, = boosting.grow(*table, [(3, Boosting(rounds=5, depth=3))])
    path = str(tmp_path / "model")
    model.save(path)
    back = boosting.BoostedTrees.load(spark, path)
    assert back.nodes == model.nodes and back.base == model.base
    trees = by_tree(model)
    scored = back.transform(features.assemble(rows, NAMES)).select(
        *NAMES, vector_to_array("probability")[1].alias("p"), "prediction").limit(100).collect()
    for r in scored:
        margin = sum(t[leaf_of(t, r.asDict())]["value"] for t in trees.values())
        assert r.p == pytest.approx(1 / (1 + np.exp(-margin))) and r.prediction == float(r.p > 0.5)


def test_the_driver_gets_one_split_a_node(table, monkeypatch):
    """With the rows dealt, what is gathered grows neither with bins nor with features."""
    monkeypatch.setattr(boosting, "TASK_BLOCKS", 0)
    sizes, take = [], boosting._Growing.take

    def recorded(self, found, *more):
        sizes.append((len(pickle.dumps(found)), len(self.open)))
        return take(self, found, *more)

    monkeypatch.setattr(boosting._Growing, "take", recorded)
    boosting.grow(*table, [(bit, Boosting(rounds=2, depth=4)) for bit in (1, 3)])
    assert len(sizes) == 16 and all(size <= 300 * nodes for size, nodes in sizes)


def test_a_tenth_of_a_gigabyte_of_orders_is_dealt_by_fits():
    """90,000 customers with their synthetic rows of six sets: 200,000 rows, 100 blocks."""
    assert 100 <= boosting.TASK_BLOCKS <= 128


@pytest.mark.parametrize("sizes", [[32, 2, 2, 7, 1, 2], [2] * 9, [32, 32], [200, 3]], ids=str)
def test_features_counted_together_have_the_histograms_of_their_own(sizes):
    rng = np.random.default_rng(3)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    bins = np.stack([rng.integers(0, n, 500) for n in sizes]).astype("u1")
    packs = boosting._Packs(starts)
    g, h = rng.integers(-2**30, 2**30, 500).astype("i4"), rng.integers(0, 2**28, 500).astype("i4")
    rows = np.flatnonzero(rng.random(500) < 0.7)
    tree = boosting.Tree()
    for _ in range(3):
        tree.add(0.0, 0.0)
    tree.feature[0], tree.bin[0], tree.left[0], tree.right[0] = 0, sizes[0] // 2, 1, 2
    ask = boosting._Ask(0, 0, Boosting(), 0, [], boosting._arrays(tree), 1, np.array([2, 1]), np.arange(len(sizes)))
    drawn = [(packs.cells(bins), {0: (rows, g[rows], h[rows], 0.0)})]
    (_, (_, sums)), = boosting._count([ask], starts, packs)(drawn)
    want = np.zeros_like(sums)
    for i in rows:
        node = 1 if bins[0, i] > sizes[0] // 2 else 0  # node 2 is asked first
        for f in range(len(sizes)):
            want[:, 1 - node, starts[f] + bins[f, i]] += g[i], h[i], 1
    assert (sums == want).all()
    assert packs.count == 2
