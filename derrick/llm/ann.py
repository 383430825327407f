"""Approximate nearest neighbours over balanced posting lists.

The index is fitted on a bounded sample (``SAMPLE`` distinct vectors of smallest
hash): a hierarchy of balanced two-way splits cuts it into lists of equal sample
size, whose means are the centroids; a neighbour graph over the centroids is
searched best-first in memory. Every row is indexed: a vector goes to its nearest
list and, near a boundary, to further lists within ``REPLICA_RATIO`` of the
nearest centroid's distance (at most ``REPLICAS``). A query's lists are those whose
centroid lies within ``PROBE_RATIO`` of its nearest one (at least ``LEAST_PROBES``,
at most ``PROBE_SHARE`` of all lists or ``PROBES``, whichever is more).

They are searched in two rounds. The ``FIRST`` nearest lists give each query a bound,
its k-th distance so far. In the second round a list is left out if its radius does
not reach inside the bound, and only rows within the bound leave a task, so what the
search puts out follows the queries and not the lists they visit. Distances are exact,
in double precision. Neighbouring lists (leaves in tree order) share a task group of
about ``PART`` rows, to which a query goes once; a longer list is searched in parts, and
the queries of a group in blocks of ``QUERIES``, so that no task holds more.

Equal vectors beyond the ``k`` + 1 smallest ids can't be in any answer (ties go to
smaller ids), so a per-key top-k keeps a hot vector out of the lists.

Defined results: vectors that are null, zero, of another length than the most
frequent one, or hold null or non-finite components take no part; identical rows
count once; rows without an id take no part; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from derrick.llm import common

SAMPLE = 16_384
#: rows aimed at per list; the sample's share per list is never below LEAST_SAMPLE
LIST, LEAST_SAMPLE = 100, 8
REPLICAS, REPLICA_RATIO = 6, 1.15
PROBES, PROBE_SHARE, LEAST_PROBES, PROBE_RATIO = 96, 0.25, 24, 1.6
NEIGHBOURS, BEAM = 24, 128
#: lists that give a query its bound; rows and queries that meet in a task
FIRST = 8
PART, QUERIES = 10_000, 20_000


def valid(rows: DataFrame) -> DataFrame:
    """(vec_id, v): usable vectors as arrays of doubles, identical rows once."""
    v = rows.select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.col("embedding").cast("array<double>").alias("v"))
    v = v.where("vec_id is not null and v is not null and size(v) > 0").where(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0.0))
    top = v.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return v.where(F.size("v") == (top["n"] if top else 0)).distinct()


def balanced_centroids(x: np.ndarray, leaf: int) -> np.ndarray:
    """Means of the leaves of balanced two-way splits (2-means directions)."""
    out, todo = [], [np.arange(len(x))]
    while todo:
        own = todo.pop()
        if len(own) <= leaf:
            out.append(x[own].mean(axis=0))
            continue
        y = x[own]
        a = y[np.argmax(((y - y.mean(axis=0)) ** 2).sum(axis=1))]
        b = y[np.argmax(((y - a) ** 2).sum(axis=1))]
        for _ in range(6):
            side = ((y - a) ** 2).sum(axis=1) - ((y - b) ** 2).sum(axis=1)
            order = np.argsort(side, kind="stable")
            half = len(own) // 2
            a, b = y[order[:half]].mean(axis=0), y[order[half:]].mean(axis=0)
        todo += [own[order[:half]], own[order[half:]]]
    return np.array(out)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(d, 0))


def centroid_graph(c: np.ndarray) -> np.ndarray:
    """Nearest other centroids of each centroid; a ring keeps the graph connected."""
    n = len(c)
    k = min(NEIGHBOURS, n - 1)
    out = np.empty((n, k + 2), np.int64)
    for a in range(0, n, 1024):
        d = distances(c[a:a + 1024], c)
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        out[a:a + 1024, :k] = np.argsort(d, axis=1, kind="stable")[:, :k]
    out[:, k] = (np.arange(n) + 1) % n
    out[:, k + 1] = (np.arange(n) - 1) % n
    return out


def graph_search(q: np.ndarray, c: np.ndarray, graph: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids nearest to q (best-first, beam of BEAM) and their distances."""
    beam = max(BEAM, want)
    seen = np.zeros(len(c), bool)
    entry = np.unique(np.linspace(0, len(c) - 1, min(16, len(c))).astype(np.int64))
    seen[entry] = True
    d = np.sqrt(((c[entry] - q) ** 2).sum(axis=1))
    open_ = [(x, i) for x, i in zip(d.tolist(), entry.tolist())]
    heapq.heapify(open_)
    best = sorted(open_)[:beam]
    while open_:
        x, i = heapq.heappop(open_)
        if len(best) >= beam and x > best[-1][0]:
            break
        new = graph[i][~seen[graph[i]]]
        new = np.unique(new)
        if not len(new):
            continue
        seen[new] = True
        dn = np.sqrt(((c[new] - q) ** 2).sum(axis=1))
        more = list(zip(dn.tolist(), new.tolist()))
        for m in more:
            heapq.heappush(open_, m)
        best = sorted(best + more)[:beam]
    best = best[:want]
    return np.array([b[1] for b in best]), np.array([b[0] for b in best])


def _matrix(col, dim: int) -> np.ndarray:
    flat = col.flatten() if isinstance(col, pa.ListArray) else col.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


def nearest(table: pa.Table, dim: int, k: int) -> pa.Table:
    """(query_id, vec_id, score): of the rows of one task group, the ``k`` nearest within
    each query's bound in the lists that it names."""
    out = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
    asked = table.column("q").to_numpy(zero_copy_only=False).astype(bool)
    if asked.any() and not asked.all():
        rows, ask = table.filter(pa.array(~asked)), table.filter(pa.array(asked))
        own = rows.column("list").to_numpy()
        order = np.argsort(own, kind="stable")
        own, ids = own[order], rows.column("vec_id").to_numpy()[order]
        m, qm = _matrix(rows.column("v"), dim)[order], _matrix(ask.column("v"), dim)
        qids, bound = ask.column("vec_id").to_numpy(), ask.column("bound").to_numpy()
        wanted = ask.column("lists").combine_chunks()
        who = np.repeat(np.arange(len(qm)), wanted.value_lengths().to_numpy())
        lists = wanted.flatten().to_numpy()
        sm, sq = (m * m).sum(axis=1), (qm * qm).sum(axis=1)
        for one in np.unique(lists):
            a, e = np.searchsorted(own, [one, one + 1])
            if a == e:
                continue
            few, mine = min(e - a, 4 * k + 8), who[lists == one]
            step = max(1, 2_000_000 // (e - a))
            for at in range(0, len(mine), step):
                q = mine[at:at + step]
                d = sq[q][:, None] + sm[None, a:e] - 2 * qm[q] @ m[a:e].T
                near = np.argpartition(d, few - 1, axis=1)[:, :few]
                # the quick distance only preselects, with room for its rounding
                room = bound[q] ** 2 * (1 + 1e-9) + 1e-9 * (sq[q] + sm[a:e].max())
                i, j = np.nonzero(np.take_along_axis(d, near, axis=1) <= room[:, None])
                r, i = a + near[i, j], q[i]
                exact = np.sqrt(((m[r] - qm[i]) ** 2).sum(axis=1))
                good = (ids[r] != qids[i]) & (exact <= bound[i])
                for o, x in zip(out, (i[good], ids[r][good], exact[good])):
                    o.append(x)
    i, found, exact = (np.concatenate(o) for o in out)
    # a replica may be met in several lists of the group
    order = np.lexsort((exact, found, i))
    order = order[np.diff(i[order], prepend=-1).astype(bool) | np.diff(found[order], prepend=0).astype(bool)]
    order = order[np.lexsort((found[order], exact[order], i[order]))]
    place = np.arange(len(order)) - np.searchsorted(i[order], i[order])
    order = order[place < k]
    names = qids[i[order]] if len(order) else np.zeros(0, np.int64)
    return pa.table([pa.array(names, pa.int64()), pa.array(found[order], pa.int64()),
                     pa.array(exact[order], pa.float64())], names=["query_id", "vec_id", "score"])


def search(rows: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows ``queries`` (a part of ``rows``)."""
    spark = rows.sparkSession
    common.ship_package(spark)
    v = common.shared_table(valid(rows))
    wanted = queries.select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    n = v.count()
    sample = v.select("v").distinct().orderBy(F.xxhash64("v")).limit(SAMPLE).collect()
    if not sample:
        sample = [([0.0],)]
    x = np.array([r[0] for r in sample])
    dim = x.shape[1]
    leaf = max(LEAST_SAMPLE, int(LIST * len(x) / max(n, 1)))
    c = balanced_centroids(x, leaf)
    graph = centroid_graph(c)
    probes_at_most = max(PROBES, math.ceil(PROBE_SHARE * len(c)))
    bc = spark.sparkContext.broadcast((c, graph))

    def rank_of(name):
        return F.row_number().over(Window.partitionBy(*name[0]).orderBy(*name[1]))

    kept = v.withColumn("_n", rank_of((["v"], ["vec_id"]))).where(F.col("_n") <= k + 1).drop("_n")

    def post(batches):
        cent, _ = bc.value
        for b in batches:
            m = _matrix(b.column("v"), dim)
            row, lst, far = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
            for a in range(0, len(m), 1024):
                d = distances(m[a:a + 1024], cent)
                near = np.argsort(d, axis=1, kind="stable")[:, :REPLICAS]
                dn = np.take_along_axis(d, near, axis=1)
                i, j = np.nonzero(dn <= REPLICA_RATIO * dn[:, :1])
                row.append(a + i)
                lst.append(near[i, j])
                far.append(dn[i, j])
            take = pa.array(np.concatenate(row), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(lst), pa.int64()), b.column("vec_id").take(take),
                 b.column("v").take(take), pa.array(np.concatenate(far), pa.float64())],
                names=["list", "vec_id", "v", "far"])

    def probe(batches):
        cent, g = bc.value
        for b in batches:
            m = _matrix(b.column("v"), dim)
            lst, dist = [], []
            for i in range(len(m)):
                who, far = graph_search(m[i], cent, g, probes_at_most)
                few = max(LEAST_PROBES, int((far <= PROBE_RATIO * far[0]).sum())) if len(far) else 0
                lst.append(who[:few])
                dist.append(far[:few])
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("v"), pa.array(lst, pa.list_(pa.int64())),
                 pa.array(dist, pa.list_(pa.float64()))], names=["vec_id", "v", "lists", "far"])

    lists = common.shared_table(kept.mapInArrow(post, "list long, vec_id long, v array<double>, far double"))
    probes = common.shared_table(v.join(wanted, "vec_id", "left_semi").repartition("vec_id").mapInArrow(
        probe, "vec_id long, v array<double>, lists array<long>, far array<double>"))
    # size, radius, task group and parts of every list: one row per centroid
    size, radius = np.zeros(len(c), np.int64), np.zeros(len(c))
    for r in lists.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("r")).collect():
        size[r["list"]], radius[r["list"]] = r["n"], r["r"]
    group = (np.cumsum(size) - size) // PART
    parts = np.maximum(1, -(-np.bincount(group, size).astype(np.int64) // (2 * PART)))
    blocks = common.groups_for(probes.count(), QUERIES)
    info = spark.createDataFrame([(i, int(g), int(parts[g])) for i, g in enumerate(group)],
                                 "list long, grp long, parts long")
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    stored = (lists.drop("far").join(F.broadcast(info), "list")
              .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts"))).withColumn("block", block)
              .select("grp", "part", "block", "list", "vec_id", "v", F.lit(False).alias("q"),
                      F.lit(None).cast("double").alias("bound"), F.lit(None).cast("array<long>").alias("lists")))

    def routed(first):
        def route(batches):
            for b in batches:
                row, grp, own = [], [], []
                for i, (lst, far, cut) in enumerate(zip(*(b.column(x).to_pylist() for x in ("lists", "far", "bound")))):
                    lst, far = np.array(lst, np.int64), np.array(far, float)
                    if first:
                        lst = lst[:FIRST]
                    else:
                        lst, far = lst[FIRST:], far[FIRST:]
                        # the triangle bound, with room for rounding
                        lst = lst[far - radius[lst] <= cut + 1e-6 * (1 + far)]
                    lst = np.sort(lst[size[lst] > 0])
                    for part in np.split(lst, np.flatnonzero(np.diff(group[lst])) + 1) if len(lst) else ():
                        row.append(i)
                        grp.append(int(group[part[0]]))
                        own.append(part)
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grp, pa.int64()), pa.array([int(parts[g]) for g in grp], pa.int64()),
                     b.column("vec_id").take(take), b.column("v").take(take), b.column("bound").take(take),
                     pa.array(own, pa.list_(pa.int64()))],
                    names=["grp", "parts", "vec_id", "v", "bound", "lists"])
        return route

    def found(asked, first):
        q = (asked.mapInArrow(routed(first), "grp long, parts long, vec_id long, v array<double>, bound double, "
                                             "lists array<long>")
             .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
             .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
             .select("grp", "part", "block", F.lit(None).cast("long").alias("list"), "vec_id", "v",
                     F.lit(True).alias("q"), "bound", "lists"))
        return (stored.unionByName(q).groupBy("grp", "part", "block")
                .applyInArrow(lambda table: nearest(table, dim, k), "query_id long, vec_id long, score double"))

    def best_of(df):
        one = df.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        return one.withColumn("rank", rank_of((["query_id"], ["score", "vec_id"]))).where(F.col("rank") <= k)

    near = common.shared_table(best_of(found(probes.withColumn("bound", F.lit(float("inf"))), True)))
    cut = near.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("bound"))
    second = probes.join(cut, "vec_id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    return (best_of(near.drop("rank").unionByName(found(second, False)))
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
