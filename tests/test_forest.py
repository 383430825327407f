"""Forests of unlimited depth against a plain recursive grower."""

import re
import time

import numpy as np
import pandas as pd
import pytest

from derrick.models import forest
from derrick.session import cut_lineage


def plain(x, y, w, path, subset):
    """Nested (feature, threshold, left, right) or a leaf's mean, one node at a time."""
    def build(rows, path):
        yy = y[rows]
        varies = np.array([x[rows, j].min() < x[rows, j].max() for j in range(x.shape[1])])
        best = None
        if yy.min() < yy.max():
            for j in np.flatnonzero(forest.competing(np.array([path], np.uint64), varies[None], subset)[0]):
                values = np.unique(x[rows, j])
                for a, b in zip(values[:-1], values[1:]):
                    left = x[rows, j] <= a
                    gain = sum((w[rows][s] * yy[s]).sum() ** 2 / w[rows][s].sum() for s in (left, ~left))
                    if best is None or gain > best[0]:
                        best = gain, j, (a + b) / 2, left
        if best is None:
            return (w[rows] * yy).sum() / w[rows].sum()
        own = np.array([path], np.uint64)
        return (best[1], best[2], build(rows[best[3]], int(forest.child_path(own, 0)[0])),
                build(rows[~best[3]], int(forest.child_path(own, 1)[0])))

    def value(node, row):
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node
    tree = build(np.arange(len(y)), path)
    return np.array([value(tree, r) for r in x])


def data(n, seed=0, classes=False):
    """Small whole numbers, so all sums are exact whatever their order."""
    rnd = np.random.default_rng(seed)
    x = rnd.integers(0, 40, (n, 3)).astype(float)
    x[:, 2] = rnd.integers(0, 3, n)
    y = (x[:, 0] > 20) * 8.0 + x[:, 1] % 4 + rnd.integers(0, 4, n)
    return x, (y > 6).astype(float) if classes else y


def frame(spark, x, y, w=None):
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=y, w=1.0 if w is None else w, id=np.arange(len(y)))
    return spark.createDataFrame(pdf)


@pytest.mark.parametrize("subset,classes", [(None, False), (2, True), (1, False)])
def test_grower_equals_plain_recursion(subset, classes):
    x, y = data(300, classes=classes)
    w = np.where(y > 0, 2.0, 1.0)
    arrays = forest.grow(x, y, w, forest.root_path(0, 1), subset)
    assert (arrays[1][forest.descend(x, *arrays)] == plain(x, y, w, forest.root_path(0, 1), subset)).all()


def test_depth_is_not_limited():
    """Labels that alternate along one feature need a leaf per row."""
    x = np.arange(3000.0)[:, None]
    y = np.tile([0.0, 1.0], 1500)
    y[1::4] += 2.0 ** 10 * np.arange(750)
    arrays = forest.grow(x, y, np.ones(3000), 1)
    assert (arrays[1][forest.descend(x, *arrays)] == y).all()


def predictions(spark, x, y, parts, **kw):
    df = frame(spark, x, y).repartition(parts)
    model = forest.fit(df, ["a", "b", "c"], "y", **kw)
    got = model.predict(df, "p").toPandas().sort_values("id")
    return got["p"].to_numpy()


def test_forest_equals_plain_forest(spark):
    x, y = data(120)
    got = predictions(spark, x, y, 3, num_trees=5, seed=3)
    df = frame(spark, x, y).selectExpr("xxhash64(a, b, c, y, 1.0D) AS k", "id").toPandas().sort_values("id")
    key = df["k"].to_numpy()
    total = np.zeros(len(y))
    for tree in range(5):
        times = forest.bootstrap(key, tree, 3)
        own = times > 0
        arrays = forest.grow(x[own], y[own], times[own].astype(float), forest.root_path(tree, 3))
        out_of_bag = arrays[1][forest.descend(x, *arrays)]
        assert (out_of_bag[own] == plain(x[own], y[own], times[own].astype(float), forest.root_path(tree, 3), None)).all()
        total += out_of_bag
    assert (got == total / 5).all()


def test_same_trees_for_any_partitioning(spark):
    x, y = data(400, 2)
    want = predictions(spark, x, y, 1, num_trees=12)
    assert (predictions(spark, x, y, 7, num_trees=12) == want).all()


def test_upper_levels_on_spark(spark):
    """Nodes of over 60 rows are split by histograms: any partitioning gives the same
    trees, no leaf is left mixed, and the quality is that of the exact grower."""
    x, y = data(700, 4)
    kw = {"num_trees": 6, "task_rows": 60}
    one, many = predictions(spark, x, y, 1, **kw), predictions(spark, x, y, 5, **kw)
    assert (one == many).all()
    exact = predictions(spark, x, y, 2, num_trees=6)
    assert abs(((one - y) ** 2).mean() - ((exact - y) ** 2).mean()) < 0.15 * ((exact - y) ** 2).mean() + 0.05
    model = forest.fit(frame(spark, x, y), ["a", "b", "c"], "y", **kw)
    assert model.trees.count() > 6 * 700 // 60 // 4 and all(len(u.feature) > 1 for u in model.uppers)


def test_upper_levels_look_at_large_nodes_only(spark, monkeypatch):
    """The histogram that splits a node also counts both sides, so rows are not read again
    to find that a node fits a task: every node looked at is split."""
    class Opened(set):
        def add(self, node):
            opened.append(node)
            super().add(node)
    opened, upper = [], forest.Upper
    monkeypatch.setattr(forest, "Upper", lambda path: upper(path=path, open=Opened({0})))
    x, y = data(700, 4)
    model = forest.fit(frame(spark, x, y), ["a", "b", "c"], "y", num_trees=3, task_rows=60)
    assert 3 + len(opened) == sum(f >= 0 for u in model.uppers for f in u.feature)


def test_bootstrap_table_is_the_distribution():
    key = np.random.default_rng(5).integers(-2 ** 63, 2 ** 63 - 1, 200_000)
    with np.errstate(over="ignore"):
        u = forest.mix(key.view(np.uint64) + forest._ODD * np.uint64(7 * 1_000_003 + 3))
    want = np.searchsorted(forest._STEPS, (u >> np.uint64(11)) * 2.0 ** -53, side="right")
    assert (forest.bootstrap(key, 2, 7) == want).all()


def test_rows_that_share_every_bin(spark):
    """Over 60 rows crowd into one bin of every feature; equal rows end in one leaf."""
    x = np.full((400, 3), 5.0)
    x[:5] = np.arange(15.0).reshape(5, 3) + 100
    x[200:, 0] = 5.0 + np.arange(200) * 2.0 ** -40
    y = np.arange(400.0) % 7
    got = predictions(spark, x, y, 3, num_trees=4, task_rows=60)
    assert np.isfinite(got).all() and len(np.unique(got[5:200])) == 1


def test_one_row_and_equal_labels(spark):
    assert predictions(spark, np.ones((1, 3)), np.array([4.0]), 1, num_trees=3).tolist() == [4.0]
    assert set(predictions(spark, data(50)[0], np.full(50, 2.0), 2, num_trees=3)) == {2.0}


def test_packets_give_back_every_double():
    """Columns travel in the shortest numbers that are exact: bit for bit, by node, in order."""
    columns = [np.array(v) for v in ([1.0, 2, 3, -4], [29.27, 0.01, -3.5, 7.0], [0.1 + 0.2, 1e300, 5e-324, 2.0],
                                     [-0.0, 0.0, 1.0, 2.0], [np.inf, 1.0, 2.0, 3.0], [3e9, 1.0, 2.0, 3.0])]
    packed = [forest.narrow(c) for c in columns]
    assert [c.dtype.itemsize for c, _ in packed] == [1, 2, 8, 8, 8, 8]
    node, many, packets = forest._packets(np.array([7, 2, 7, 2]), packed)
    assert node.tolist() == [2, 7] and many.tolist() == [2, 2]
    for rows, data in zip(([1, 3], [0, 2]), packets):
        for c, got in zip(columns, forest.wide(data, 2, len(columns))):
            assert got.tobytes() == c[rows].tobytes()


def test_packed_tree_is_the_tree():
    x, y = data(200)
    arrays = forest.grow(x, y, np.ones(200), 1)
    assert all((a == b).all() for a, b in zip(arrays, forest.unpack(forest.pack(*arrays))))


def test_scores_of_few_rows_and_cuts_of_dealt_forest(spark):
    """Rows broadcast to the subtrees and rows sent to them get the same scores, in rows as
    in the plan of a wide table; histogram cuts are exact quantiles of tied values."""
    x, y = data(300, 6)
    df = frame(spark, x, y).repartition(4)
    model = forest.fit(df, ["a", "b", "c"], "y", num_trees=3, task_rows=100)
    whole = {r["id"]: r["p"] for r in model.predict(df, "p").collect()}
    few = {r["id"]: r["p"] for r in model.predict(df.where("id % 7 = 0"), "p").collect()}
    assert len(whole) == 300 and len(few) == 43 and all(whole[k] == v for k, v in few.items())
    assert model.predict(df.where("id < 0"), "p").collect() == []
    cuts = forest._cuts(df, ["a", "c"])
    for c, j in zip(cuts, (0, 2)):
        want = np.unique(np.quantile(x[:, j], [k / forest.BINS for k in range(1, forest.BINS)]))
        assert c == pytest.approx(want)


@pytest.mark.parametrize("subset,classes", [(None, False), (2, True)])
def test_upper_levels_in_a_task_are_those_on_spark(spark, subset, classes):
    """A node of up to ``node_rows`` rows travels to one task, which splits it like the passes on Spark."""
    x, y = data(900, 8, classes)
    x[600:, 1] = 7.0
    kw = {"num_trees": 4, "task_rows": 60, "subset": subset}
    want = predictions(spark, x, y, 3, **kw)
    for rows in (150, 10_000):
        assert (predictions(spark, x, y, 2, node_rows=rows, **kw) == want).all()
    df = frame(spark, x, y)
    model = forest.fit(df, ["a", "b", "c"], "y", node_rows=10_000, **kw)
    assert model.trees.count() == 4 and all(len(u.feature) == 1 for u in model.uppers)
    few = model.predict(df.where("id % 19 = 0"), "p").toPandas().set_index("id")["p"]
    assert (few.to_numpy() == want[few.index]).all()


def test_batches_of_trees_leave_no_shuffles_and_change_nothing(spark, monkeypatch):
    """Disks hold the packets of some trees at a time; sums go on from batch to batch."""
    x, y = data(500, 9)
    kw = {"num_trees": 7, "task_rows": 60}
    want = predictions(spark, x, y, 3, **kw)
    monkeypatch.setattr(forest, "PAIRS", 1000)
    dealt, packets = [], forest._parts
    monkeypatch.setattr(forest, "_parts", lambda s, uppers: dealt.append(len(uppers)) or packets(s, uppers))
    assert (predictions(spark, x, y, 3, **kw) == want).all()
    assert dealt == [4, 3, 2, 2, 2, 1]


def test_table_removes_its_shuffles(spark):
    def shuffles():
        held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return set(re.findall(r"shuffle_[0-9_]+", held.mkString(" ")))
    old = shuffles()
    df = spark.range(1000).repartition(3, "id")
    made = forest._table(df), cut_lineage(df)
    for _ in range(100):                                   # files are removed in the background
        if not (left := shuffles() - old):
            break
        time.sleep(0.1)
    assert not left and [t.count() for t in made] == [1000, 1000]
