"""Isolation forest (Liu, Ting and Zhou, 2008) as a Spark job.

* Sampling, one rule at every size: tree ``t`` takes the ``max_samples`` rows of
  lowest hash of (id, seed, t), all rows if there are no more. Tasks keep the lowest
  rows of every tree while they read (bottom-k, mergeable) and send only those; a
  second level merges groups of tasks, so no task sees more than a share of them. The
  sample of a tree does not depend on partitioning, nor on rows that are not in it.
* Growth: ``groupBy(tree).applyInPandas``; each task grows one tree from at
  most ``max_samples`` rows (random feature, uniform split between the node's
  min and max, depth limit ceil(log2(max_samples))).
* Model: at most ``n_trees * (2 * max_samples - 1)`` nodes; fetched once and
  broadcast. Scoring is an Arrow ``pandas_udf`` over every row.
* score = 2 ** (-E[h(x)] / c(max_samples)); a row is an outlier when its
  score is above the ``1 - contamination`` quantile of all scores.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derrick.models.forest import mix
from derrick.operators.stats import quantiles
from derrick.session import cut_lineage, ship_package

#: tasks whose samples of a tree are merged before the last merge
MERGES = 64
EULER_GAMMA = 0.5772156649015329
TREE_SCHEMA = ("tree int, node int, feature int, threshold double, left int, right int, "
               "size long")


def average_path_length(n) -> np.ndarray:
    """c(n): mean path length of an unsuccessful BST search among n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def tree_hashes(key: np.ndarray, n_trees: int) -> np.ndarray:
    """63-bit hash of every row (columns) for every tree (rows)."""
    tree = np.arange(1, n_trees + 1, dtype=np.uint64)[:, None]
    with np.errstate(over="ignore"):
        return (mix(key[None] + tree * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1)).astype(np.int64)


def _grow(tree: int, x: np.ndarray, seed: int, max_depth: int) -> pd.DataFrame:
    rng = np.random.default_rng([seed, tree])
    rows = []  # node, feature, threshold, left, right, size

    def build(idx: np.ndarray, depth: int) -> int:
        node = len(rows)
        rows.append([node, -1, 0.0, -1, -1, len(idx)])
        if depth >= max_depth or len(idx) <= 1:
            return node
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            return node
        f = int(rng.choice(usable))
        thr = float(rng.uniform(lo[f], hi[f]))
        left_mask = sub[:, f] < thr
        rows[node][1], rows[node][2] = f, thr
        rows[node][3] = build(idx[left_mask], depth + 1)
        rows[node][4] = build(idx[~left_mask], depth + 1)
        return node

    build(np.arange(len(x)), 0)
    out = pd.DataFrame(rows, columns=["node", "feature", "threshold", "left", "right", "size"])
    out.insert(0, "tree", tree)
    return out


@dataclass
class IsolationForestModel:
    features: list[str]
    trees: pd.DataFrame          # TREE_SCHEMA rows
    max_samples: int
    threshold: float | None = None

    def arrays(self) -> list[tuple[np.ndarray, ...]]:
        """Per tree: feature, threshold, left, right, leaf adjustment."""
        out = []
        for _, t in self.trees.groupby("tree", sort=True):
            t = t.sort_values("node")
            out.append((t["feature"].to_numpy(), t["threshold"].to_numpy(),
                        t["left"].to_numpy(), t["right"].to_numpy(),
                        average_path_length(t["size"].to_numpy())))
        return out

    @staticmethod
    def path_lengths(arrays, x: np.ndarray) -> np.ndarray:
        """Mean adjusted path length of each row over all trees."""
        total = np.zeros(len(x))
        n_trees = 0
        for feat, thr, left, right, adj in arrays:
            node = np.zeros(len(x), dtype=np.int64)
            depth = np.zeros(len(x))
            active = feat[node] >= 0
            while active.any():
                idx = np.flatnonzero(active)
                f = feat[node[idx]]
                go_left = x[idx, f] < thr[node[idx]]
                node[idx] = np.where(go_left, left[node[idx]], right[node[idx]])
                depth[idx] += 1.0
                active = feat[node] >= 0
            total += depth + adj[node]
            n_trees += 1
        return total / max(n_trees, 1)

    def score_column(self, cols: Sequence[Column]) -> Column:
        """Anomaly score in (0, 1] as an Arrow-batched column expression."""
        from pyspark.sql import SparkSession
        arrays = self.arrays()
        try:
            shared = SparkSession.getActiveSession().sparkContext.broadcast(arrays)
            get = lambda: shared.value  # noqa: E731  (sent once per executor)
        except Exception:  # noqa: BLE001  (no SparkContext: ship with the function)
            get = lambda: arrays
        c_psi = float(average_path_length([self.max_samples])[0]) or 1.0
        path_lengths = IsolationForestModel.path_lengths

        @F.pandas_udf("double")
        def _score(*series: pd.Series) -> pd.Series:
            x = np.column_stack([s.to_numpy(dtype=float) for s in series])
            return pd.Series(np.power(2.0, -path_lengths(get(), x) / c_psi))

        return _score(*cols)


def fit(df: DataFrame, features: Sequence[str], id_col: str, n_trees: int = 100,
        max_samples: int = 256, seed: int = 42) -> IsolationForestModel:
    """Grow the forest on rows of ``df`` (rows with NULL features must be
    removed by the caller)."""
    feats = list(features)
    ship_package(df.sparkSession)
    rows = df.select(F.xxhash64(F.col(id_col), F.lit(seed)).alias("__k"),
                     *[F.col(c).cast("double").alias(f"x{j}") for j, c in enumerate(feats)])
    cols = [f"x{j}" for j in range(len(feats))]
    schema = "tree int, h long, " + ", ".join(f"{c} double" for c in cols)

    def lowest(tree: np.ndarray, h: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Row numbers of the ``max_samples`` lowest rows of every tree."""
        order = np.lexsort((*x.T, h, tree))
        t = tree[order]
        first = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
        place = np.arange(len(t)) - np.repeat(first, np.diff(np.append(first, len(t))))
        return order[place < max_samples]

    def bottom(batches):
        held = [np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros((0, len(cols)))]
        limit = np.full(n_trees, np.iinfo(np.int64).max)
        for b in batches:
            key = b.column("__k").to_numpy().view(np.uint64)
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in cols])
            for a in range(0, len(key), 2048):
                h = tree_hashes(key[a:a + 2048], n_trees)
                tree, row = np.nonzero(h <= limit[:, None])      # beyond the limit a row can't be in
                held = [np.concatenate(c) for c in zip(held, (tree.astype(np.int32), h[tree, row], x[a:a + 2048][row]))]
                if len(held[0]) > 4 * n_trees * max_samples:
                    held = [c[lowest(*held)] for c in held]
                    for t in np.flatnonzero(np.bincount(held[0], minlength=n_trees) >= max_samples):
                        limit[t] = held[1][held[0] == t].max()
        held = [c[lowest(*held)] for c in held]
        yield pa.RecordBatch.from_arrays(
            [pa.array(held[0]), pa.array(held[1]), *[pa.array(held[2][:, j]) for j in range(len(cols))]],
            names=["tree", "h", *cols])

    def merge(table: pa.Table) -> pa.Table:
        x = np.column_stack([table.column(c).to_numpy() for c in cols])
        return table.select(["tree", "h", *cols]).take(
            pa.array(lowest(table.column("tree").to_numpy(), table.column("h").to_numpy(), x)))

    # the id's upper bits are the task's number
    share = F.pmod(F.shiftright(F.monotonically_increasing_id(), 33), F.lit(MERGES))
    sample = (rows.mapInArrow(bottom, schema).withColumn("share", share)
              .groupBy("tree", "share").applyInArrow(merge, schema))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf.sort_values(["h", *cols], kind="stable").iloc[:max_samples]
        depth = int(math.ceil(math.log2(max(len(own), 2))))
        return _grow(int(own["tree"].iloc[0]), own[cols].to_numpy(dtype=float), seed, depth)

    # bounded: n_trees * (2 * max_samples - 1) node rows
    trees = sample.groupBy("tree").applyInPandas(grow, TREE_SCHEMA).toPandas()
    psi = int(trees.loc[trees["node"] == 0, "size"].max()) if len(trees) else 1
    return IsolationForestModel(feats, trees, psi)


def score(model: IsolationForestModel, df: DataFrame, out: str = "iforest_score") -> DataFrame:
    return df.withColumn(out, model.score_column([F.col(c).cast("double") for c in model.features]))


def fit_predict(df: DataFrame, features: Sequence[str], id_col: str, contamination: float = 0.1,
                n_trees: int = 100, max_samples: int = 256, seed: int = 42,
                score_col: str = "iforest_score", flag_col: str = "is_anomaly_iforest") -> DataFrame:
    """Scores every row and flags the top ``contamination`` share."""
    model = fit(df, features, id_col, n_trees, max_samples, seed)
    scored = cut_lineage(score(model, df, score_col))
    (thr,) = quantiles(scored, score_col, [1.0 - contamination])
    model.threshold = thr
    flag = F.coalesce(F.col(score_col) > F.lit(thr), F.lit(False)) if thr is not None else F.lit(False)
    return scored.withColumn(flag_col, flag)
