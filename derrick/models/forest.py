"""Random forests of unlimited depth as a Spark job.

A tree takes every row with a Poisson(1) weight from a hash of the row's content and
the tree (bootstrap), and splits until a node's labels or features are all equal. The
split of a node is the one with the least weighted squared error of the label; for 0/1
labels that is the Gini index, and a leaf's mean the probability. ``subset`` features,
drawn per node by hash among those that vary, compete; ties go to the first feature,
then to the smallest threshold. Nothing depends on partitioning or on row order.

1. A node of more than ``task_rows`` rows is split by histograms of its rows over ``BINS``
   exact quantiles per feature in whole numbers (labels and weights in fixed steps, so
   sums don't depend on order). If all rows of a node share a bin of every feature, the
   widest feature is halved. As long as a node holds more than ``node_rows`` rows, its tree
   grows level by level on Spark: tasks send histograms, grouped tasks add them up and
   choose the split. Only these upper nodes, about 2 n / ``node_rows`` per tree, are held
   by the driver. A smaller one travels to one task, which splits it the same way.
2. A node of at most ``task_rows`` rows is finished exactly: all nodes of a level at a time,
   on presorted features, without a limit of depth.

If all rows fit a task (a bound of ``task_rows`` rows of a few numbers), they are
broadcast once and tasks grow trees; otherwise rows travel to their (tree, node), in one
packet per task and node whose columns take the shortest numbers that keep them exact.
The trees stay a table of packed subtrees in the shared folder and never meet in one
place; scoring broadcasts the rows in the same bound, else sends such packets to the
subtrees and packets of leaf values back to blocks of rows. Trees are grown and scored in
batches of about ``PAIRS`` (row, tree) pairs, so that disks hold one batch's packets.
"""

from __future__ import annotations

import itertools
import math
import struct
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.operators.ranking import stretches
from derrick.session import default_parallelism, drop_folder, ensure_checkpoint_dir, ship_package, shuffles_dropped

#: rows of a node that are split exactly
TASK_ROWS = 200_000
#: rows of a node that one task finishes: about 80 bytes each
NODE_ROWS = 4_000_000
#: (row, tree) pairs whose packets are on the disks at a time
PAIRS = 1 << 28
BINS = 64
#: open (tree, node) pairs whose histograms one pass collects
OPEN = 4_096
#: trees whose predictions are added up in one task, in order
TREES = 10
#: rows that a task deals to the nodes at once; rows of a block that are scored together
BLOCK_BITS = 16
BLOCK = 1 << BLOCK_BITS
#: subtrees grown or scored in a task, about
SUBTREES = 8

#: levels after which a grower puts the rows of a node side by side again
RENUMBER = 3

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def _poisson_steps() -> np.ndarray:
    p, steps, total = np.exp(-1.0), [], 0.0
    for k in range(1, 16):
        total += p
        steps.append(total)
        p /= k
    return np.array(steps)


_STEPS = _poisson_steps()
#: steps below every 2^-16, and the 2^-16 that hold a step
_GRID = np.searchsorted(_STEPS, np.arange(1 << 16) * 2.0 ** -16, side="right").astype(np.int64)
_HOLDS = np.append(_GRID[1:], len(_STEPS)) > _GRID


def bootstrap(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in the tree's sample; ``key`` is a hash of its content."""
    with np.errstate(over="ignore"):
        u = mix(key.view(np.uint64) + _ODD * np.uint64(seed * 1_000_003 + tree + 1))
    cell = (u >> np.uint64(48)).astype(np.int64)
    times, near = _GRID[cell], np.flatnonzero(_HOLDS[cell])
    times[near] = np.searchsorted(_STEPS, (u[near] >> np.uint64(11)) * 2.0 ** -53, side="right")
    return times


def root_path(tree: int, seed: int) -> int:
    return int(mix(np.array([seed * 7_368_787 + tree + 1], np.uint64))[0])


def child_path(path: np.ndarray, right: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(path * np.uint64(2) + np.uint64(right + 1))


def competing(path: np.ndarray, varies: np.ndarray, subset: int | None) -> np.ndarray:
    """Which features (columns) may split each node (rows)."""
    if subset is None or subset >= varies.shape[1]:
        return varies
    with np.errstate(over="ignore"):
        key = mix(path[:, None] + _ODD * np.arange(1, varies.shape[1] + 1, dtype=np.uint64))
    key = np.where(varies, key >> np.uint64(1), np.uint64(1 << 63))
    return varies & (key <= np.sort(key, axis=1)[:, subset - 1:subset])


def middle(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A threshold t with a <= t < b."""
    m = a / 2 + b / 2
    return np.where((m >= a) & (m < b), m, a)


def _places(parts: np.ndarray, begin: np.ndarray, side: int) -> np.ndarray:
    """Where the rows of all left (0) or right (1) children go, whatever the feature."""
    own = parts[side::2]
    return np.arange(int(own.sum())) + np.repeat(begin[side::2] - (np.cumsum(own) - own), own)


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, path: int, subset: int | None = None,
         order: list[np.ndarray] | None = None):
    """(feature, value, left) of a fully grown tree, node 0 the root. Feature is -1 for
    a leaf, whose value is its mean; otherwise value is the threshold, rows up to it go
    to node ``left``, the others to ``left`` + 1. ``order`` are the rows sorted by each
    feature, if they are known. Rows of finished nodes leave all orders at once."""
    n, width = x.shape
    if order is None:
        order = [np.argsort(x[:, j], kind="stable") for j in range(width)]
    order = [np.asarray(o, np.intp) for o in order]
    both = np.empty(n, np.complex128)                     # weights and weighted labels add up in one pass
    both.real, both.imag = w, w * y
    # places of a feature's values among its distinct ones: shorter than the values, compared alike
    ranks, distinct = np.empty((width, n), np.int32), []
    for j, o in enumerate(order):
        xs = x[o, j]
        new = np.append(True, xs[:-1] < xs[1:])
        ranks[j, o] = np.cumsum(new, dtype=np.int32) - 1
        distinct.append(xs[new])
    feature, value, left = [], [], []
    made = 1

    def means(rows, size):
        starts, own = np.cumsum(size) - size, both[rows]
        return np.add.reduceat(own.imag.copy(), starts) / np.add.reduceat(own.real.copy(), starts)

    def differ(rows, size):
        """Whether the labels of a node differ, for every node."""
        yy, ends = y[rows], np.cumsum(size) - 1
        seen = np.cumsum(np.append(False, yy[:-1] != yy[1:]))
        return seen[ends] > seen[ends + 1 - size]
    rows, size, paths = order[0], np.array([n]), np.array([path], np.uint64)
    mixed = differ(rows, size) & ~np.isnan(y).any()
    for depth in itertools.count():
        feature.append(np.full(len(size), -1, np.int16))
        value.append(np.zeros(len(size)))
        left.append(np.full(len(size), -1, np.int32))
        if not mixed.all():
            value[-1][~mixed] = means(rows[np.repeat(~mixed, size)], size[~mixed])
        if not mixed.any():
            break
        # the orders hold the rows of mixed nodes only
        level = np.flatnonzero(mixed)
        size, paths = size[level], paths[level]
        if depth % RENUMBER == 0:                         # rows of a node lie side by side
            own = order[0]
            place = np.empty(len(y), np.intp)
            place[own] = np.arange(len(own))
            ranks, both, y = np.take(ranks, own, axis=1), both[own], y[own]
            order = [np.arange(len(own)), *(place[o] for o in order[1:])]
        ends = np.cumsum(size) - 1
        starts = ends + 1 - size
        of = np.repeat(np.arange(len(size)), size)
        varies = np.stack([r[o[starts]] < r[o[ends]] for r, o in zip(ranks, order)], axis=1)
        allowed = competing(paths, varies, subset)
        best = np.full(len(size), -np.inf)
        bf, bt = np.full(len(size), -1, np.int16), np.zeros(len(size))
        upto = np.zeros(len(size), np.int32)              # the place of the last value to the left
        for j, (r, o) in enumerate(zip(ranks, order)):
            here = np.flatnonzero(allowed[:, j])
            if not len(here):
                continue
            own = size[here]
            if len(here) < len(size):
                o = o[np.repeat(allowed[:, j], size)]
            last = np.cumsum(own) - 1
            # sums up to each row inside its node, and of the whole node
            xs, sums = r[o], np.cumsum(both[o])
            base = np.append(0.0, sums[last[:-1]])
            whole = sums[last] - base
            up = np.empty(len(xs), bool)
            np.less(xs[:-1], xs[1:], out=up[:-1])
            up[last] = False
            at = np.flatnonzero(up)
            # every node here varies, so it has a threshold
            cut = np.searchsorted(at, last + 1 - own)
            many = np.diff(np.append(cut, len(at)))
            part = sums[at]
            part -= np.repeat(base, many)
            lw, ls = part.real.copy(), part.imag.copy()
            rw = np.repeat(whole.real, many)
            rw -= lw
            rs = np.repeat(whole.imag, many)
            rs -= ls
            ls *= ls
            ls /= lw
            rs *= rs
            rs /= rw
            gain = ls
            gain += rs
            top = np.maximum.reduceat(gain, cut)
            winners = np.flatnonzero(gain == np.repeat(top, many))
            of_node = np.searchsorted(cut, winners, side="right") - 1
            first = np.append(True, of_node[1:] != of_node[:-1])
            winners, here = winners[first], here[of_node[first]]           # the smallest threshold of a tie
            better = gain[winners] > best[here]
            winners, here = winners[better], here[better]
            best[here], bf[here], upto[here] = gain[winners], j, xs[at[winners]]
            bt[here] = middle(distinct[j][xs[at[winners]]], distinct[j][xs[at[winners] + 1]])
        split = bf >= 0
        kept = np.repeat(split, size)
        if not split.all():
            value[-1][level[~split]] = means(order[0][~kept], size[~split])
        if not split.any():
            break
        parents = level[split]
        feature[-1][parents], value[-1][parents] = bf[split], bt[split]
        left[-1][parents] = made + 2 * np.arange(len(parents))
        made += 2 * len(parents)
        own, nodes = order[0][kept], of[kept]
        right = ranks.ravel()[bf[nodes].astype(np.intp) * ranks.shape[1] + own] > upto[nodes]
        size, paths = size[split], paths[split]
        n_right = np.diff(np.cumsum(right)[np.cumsum(size) - 1], prepend=0)
        size = np.stack([size - n_right, n_right], axis=1).ravel()
        begin = np.cumsum(size) - size
        rows = np.empty(len(own), np.intp)
        rows[_places(size, begin, 0)], rows[_places(size, begin, 1)] = own[~right], own[right]
        mixed = differ(rows, size)
        order[0] = rows[np.repeat(mixed, size)]
        # 1: to the left child, 2: to the right, 0: in a leaf
        stay = np.where(mixed, size, 0)
        side = np.zeros(len(y), np.int8)
        side[order[0]] = np.repeat(np.tile(np.array([1, 2], np.int8), len(size) // 2), stay)
        begin = np.cumsum(stay) - stay
        lefts, rights = _places(stay, begin, 0), _places(stay, begin, 1)
        for j in range(1, width):
            to = side[order[j]]
            new = np.empty(len(order[0]), np.intp)
            new[lefts], new[rights] = order[j][to == 1], order[j][to == 2]
            order[j] = new
        paths = np.stack([child_path(paths, 0), child_path(paths, 1)], axis=1).ravel()
    return tuple(np.concatenate(c) for c in (feature, value, left))


def descend(x: np.ndarray, feature: np.ndarray, value: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The leaf node of every row."""
    node = np.zeros(len(x), np.int64)
    todo = np.flatnonzero(feature[node] >= 0)
    while len(todo):
        at = node[todo]
        at = left[at] + (x[todo, feature[at]] > value[at])
        node[todo] = at
        todo = todo[feature[at] >= 0]
    return node


def pack(feature, value, left) -> bytes:
    """A grown tree; children are numbered in the order of their parents, so ``left`` follows."""
    raw = feature.astype("<i2").tobytes() + value.astype("<f8").tobytes()
    return struct.pack("<q", len(feature)) + pa.compress(raw, "zstd", asbytes=True)


def unpack(data: bytes):
    n, = struct.unpack_from("<q", data)
    raw = pa.decompress(data[8:], 10 * n, "zstd", asbytes=True)
    feature = np.frombuffer(raw, "<i2", n)
    split = feature >= 0
    return (feature, np.frombuffer(raw, "<f8", n, offset=2 * n),
            np.where(split, 2 * np.cumsum(split) - 1, -1).astype(np.int32))


def bundle(upper: bytes, parts: list[bytes]) -> bytes:
    """A tree in packed parts: its leaves, in the order of their numbers, are the roots of ``parts``."""
    sizes = [len(upper), *map(len, parts)]
    return struct.pack(f"<q{len(sizes)}q", -len(parts), *sizes) + upper + b"".join(parts)


def opened(data: bytes) -> tuple:
    """The arrays of a packed tree, and those of its parts (none: it came in one)."""
    many, = struct.unpack_from("<q", data)
    if many >= 0:
        return unpack(data), []
    sizes = struct.unpack_from(f"<{1 - many}q", data, 8)
    ends = np.cumsum([8 * (2 - many), *sizes])
    upper, *parts = [unpack(data[a:z]) for a, z in zip(ends[:-1], ends[1:])]
    return upper, parts


def leaf_values(x: np.ndarray, tree: tuple) -> np.ndarray:
    """The value of every row's leaf in an :func:`opened` tree."""
    upper, parts = tree
    leaf = descend(x, *upper)
    if not parts:
        return upper[1][leaf]
    part = (np.cumsum(upper[0] < 0) - 1)[leaf]
    out = np.empty(len(x))
    by = np.argsort(part, kind="stable")
    for own in np.split(by, np.flatnonzero(np.diff(part[by])) + 1) if len(by) else ():
        arrays = parts[part[own[0]]]
        out[own] = arrays[1][descend(x[own], *arrays)]
    return out


#: integer types a column of whole numbers, or of decimals by their scale, may take
_INTS = ("<i1", "<i2", "<i4")
_SCALES = (1.0, 100.0, 10_000.0)


def narrow(a: np.ndarray) -> tuple[np.ndarray, float]:
    """The shortest form that gives back every double exactly: (numbers, scale), the
    values are numbers / scale; scale 0 for doubles as they are."""
    if len(a) and np.isfinite(a).all() and not (np.signbit(a) & (a == 0)).any():
        reach = np.abs(a).max()
        for scale in _SCALES:
            if reach * scale >= 2 ** 31 - 1:
                break
            some = a[:64]                                 # most columns that need doubles show it soon
            if (np.rint(some * scale) / scale != some).any():
                continue
            whole = np.rint(a * scale)
            if (whole / scale == a).all():
                top = np.abs(whole).max()
                return whole.astype(next(t for t in _INTS if top <= np.iinfo(t).max)), scale
    return a.astype("<f8"), 0.0


def _head(columns: list[tuple[np.ndarray, float]]) -> bytes:
    return b"".join(struct.pack("<3sd", c.dtype.str.encode(), scale) for c, scale in columns)


def wide(data: bytes, n: int, number: int) -> list[np.ndarray]:
    """The ``number`` columns of ``n`` doubles in a packet: heads of :func:`narrow` columns, then their bytes."""
    out, at = [], 11 * number
    for k in range(number):
        kind, scale = struct.unpack_from("<3sd", data, 11 * k)
        c = np.frombuffer(data, kind.decode(), n, offset=at)
        at += c.nbytes
        out.append(c.astype(float) / scale if scale else c)
    return out


def _packets(nodes: np.ndarray, columns: list[tuple[np.ndarray, float]]):
    """(node, rows, packet) of every node with rows; rows keep their order inside a packet."""
    few = len(nodes) and nodes.max() < 1 << 15            # short keys sort in linear time
    by = np.argsort(nodes.astype(np.int16) if few else nodes, kind="stable")
    nodes = nodes[by]
    cut = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1])) if len(nodes) else np.zeros(0, np.int64)
    ends = np.append(cut[1:], len(nodes))
    head, sorted_ = _head(columns), [c[by] for c, _ in columns]
    return nodes[cut], ends - cut, [head + b"".join(c[a:b].tobytes() for c in sorted_) for a, b in zip(cut, ends)]


def _blocks(batches, columns: Sequence[str]):
    """Consecutive batches of a task as arrays of about ``BLOCK`` rows: {column: array}."""
    held, n = [], 0

    def join():
        t = pa.Table.from_batches(held)
        return {c: t.column(c).to_numpy() for c in columns}
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= BLOCK:
            yield join()
            held, n = [], 0
    if n:
        yield join()


@dataclass
class Upper:
    """The nodes of a tree that Spark grew: the same arrays as :func:`grow`, plus the path
    and whether the node is still open."""
    feature: list = field(default_factory=lambda: [-1])
    value: list = field(default_factory=lambda: [0.0])
    left: list = field(default_factory=lambda: [-1])
    path: list = field(default_factory=list)
    open: set = field(default_factory=lambda: {0})

    def arrays(self):
        return np.array(self.feature, np.int16), np.array(self.value), np.array(self.left, np.int32)


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/forest-{uuid.uuid4().hex}"


def _table(df: DataFrame, path: str | None = None) -> DataFrame:
    path = path or _folder(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _matrix(batch, features: Sequence[str]) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in features])


def _canonical(x, y, w, key):
    """Rows in an order that only depends on their content, and sorted by each feature."""
    by = np.lexsort((w, y, *x.T, key))
    x = x[by]
    return x, y[by], w[by], key[by], [np.argsort(c, kind="stable") for c in x.T]


class Forest:
    """A fitted forest: ``trees`` is (tree, node, packed), one row per subtree."""

    def __init__(self, features: list[str], num_trees: int, uppers: list[Upper], trees: DataFrame,
                 task_rows: int):
        self.features, self.num_trees, self.uppers = features, num_trees, uppers
        self.trees, self.task_rows = trees, task_rows

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the mean of all trees as ``out``; features must not be null."""
        spark, feats, trees = df.sparkSession, self.features, self.num_trees
        names = [c for c in df.columns if c != out]
        row = "__row"
        rows = _table(df.select(*names).withColumn(row, F.monotonically_increasing_id()))
        slim = rows.select(row, *[F.col(c).cast("double").alias(f"__x{j}") for j, c in enumerate(feats)])
        cols = [f"__x{j}" for j in range(len(feats))]
        uppers = spark.sparkContext.broadcast([u.arrays() for u in self.uppers])
        n = rows.count()
        if n <= self.task_rows and not any(len(u.feature) > 1 for u in self.uppers):
            t = slim.toArrow()
            held = spark.sparkContext.broadcast((_matrix(t, cols), t.column(row).to_numpy()))

            def score(table: pa.Table) -> pa.Table:
                x, ids = held.value
                group = table.column("group")[0].as_py()
                order = sorted(range(table.num_rows), key=lambda i: (table.column("tree")[i].as_py(),
                                                                     table.column("node")[i].as_py()))
                total, nodes, last = np.zeros(len(x)), None, None
                for i in order:
                    tree = table.column("tree")[i].as_py()
                    if tree != last:
                        nodes, last = descend(x, *uppers.value[tree]), tree
                    own = np.flatnonzero(nodes == table.column("node")[i].as_py())
                    total[own] += leaf_values(x[own], opened(table.column("packed")[i].as_py()))
                return pa.table([pa.array(ids), pa.array(np.full(len(ids), group), pa.int32()), pa.array(total)],
                                names=[row, "group", "s"])
            sums = (self.trees.withColumn("group", F.floor(F.col("tree") / TREES).cast("int")).groupBy("group")
                    .applyInArrow(score, f"{row} long, group int, s double"))
        else:
            return rows.join(self._scored(slim, row, cols, uppers, n, out), row).select(*names, out)
        # a fixed order of at most num_trees numbers per row
        mean = sums.groupBy(row).agg(F.array_sort(F.collect_list(F.struct("group", "s"))).alias("p")).select(
            row, (F.aggregate("p", F.lit(0.0), lambda a, s: a + s["s"]) / float(trees)).alias(out))
        return rows.join(mean, row).select(*names, out)


    def _scored(self, slim: DataFrame, row: str, cols: list[str], uppers, n: int, out: str) -> DataFrame:
        """(row, ``out``) if rows or trees are too many for a task: packets of rows travel to
        their subtrees (few rows are broadcast to where the subtrees lie), packets of leaf
        values to the block of their rows, where the trees are added up in order."""
        spark, trees, width = slim.sparkSession, self.num_trees, len(cols)
        low = BLOCK - 1
        schema = "block long, tree int, node long, n int, packed binary"
        names = ["block", "tree", "node", "n", "packed"]

        def answer(tree, node, block, at, values):
            """Of one node: leaf values by block, rows by their distance from the one before."""
            packet = [narrow(np.diff(at, prepend=0).astype(float)), narrow(values)]
            return block, tree, node, len(at), _head(packet) + b"".join(c.tobytes() for c, _ in packet)

        def table(rows_):
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
            return [pa.array(c, k) for c, k in zip(zip(*rows_) if rows_ else [[]] * 5, kinds)]

        if n <= self.task_rows:
            t = slim.orderBy(row).toArrow()
            held = spark.sparkContext.broadcast((_matrix(t, cols), t.column(row).to_numpy()))

            def visit(batches):
                x, ids = held.value
                last, nodes = None, None
                for b in batches:
                    for tree, node, packed in zip(*(b.column(c).to_pylist() for c in ("tree", "node", "packed"))):
                        if tree != last:
                            last, nodes = tree, descend(x, *uppers.value[tree])
                        own = np.flatnonzero(nodes == node)
                        if not len(own):
                            continue
                        values, block = leaf_values(x[own], opened(packed)), ids[own] >> BLOCK_BITS
                        cut = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
                        found = [answer(tree, node, int(block[a]), ids[own[a:z]] & low, values[a:z])
                                 for a, z in zip(cut, np.append(cut[1:], len(own)))]
                        yield pa.RecordBatch.from_arrays(table(found), names=names)
            answers = self.trees.mapInArrow(visit, schema)
        else:
            def spread(batches, some_trees):
                for held_ in _blocks(batches, [row, *cols]):
                    by = np.argsort(held_[row], kind="stable")
                    ids, x = held_[row][by], np.column_stack([held_[c][by] for c in cols])
                    block = ids >> BLOCK_BITS
                    cut = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
                    for a, z in zip(cut, np.append(cut[1:], len(ids))):
                        own = x[a:z]
                        packet = [((ids[a:z] & low).astype("<i4"), 1.0), *(narrow(c) for c in own.T)]
                        for tree in some_trees:
                            node, many, packed = _packets(descend(own, *uppers.value[tree]), packet)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(node), block[a])), pa.array(np.full(len(node), tree, np.int32)),
                                 pa.array(node), pa.array(many.astype(np.int32)), pa.array(packed, pa.binary())],
                                names=names)

            def own(left: pa.Table, right: pa.Table) -> pa.Table:
                found = []
                if left.num_rows:
                    grown = opened(right.column("packed")[0].as_py())
                    block, tree, node, n, packed = (left.column(c) for c in names)
                    tree, node, n = tree[0].as_py(), node[0].as_py(), n.to_numpy()
                    # small packets are scored together
                    batch = (np.cumsum(n) - n) >> BLOCK_BITS
                    for some in np.split(np.arange(len(n)), np.flatnonzero(np.diff(batch)) + 1):
                        rows_ = [wide(packed[int(i)].as_py(), int(n[i]), 1 + width) for i in some]
                        x = np.column_stack([np.concatenate(c) for c in list(zip(*rows_))[1:]])
                        values = np.split(leaf_values(x, grown), np.cumsum(n[some])[:-1])
                        found += [answer(tree, node, block[int(i)].as_py(), r[0], v)
                                  for i, r, v in zip(some, rows_, values)]
                return pa.table(table(found), names=names)
            ranged = slim.repartitionByRange(_tasks(spark, n), row)

            def answered(some_trees):
                parts = _parts(spark, [self.uppers[t] for t in some_trees])
                grown = self.trees.where(F.col("tree").between(some_trees[0], some_trees[-1]))
                return (ranged.mapInArrow(lambda batches: spread(batches, some_trees), schema)
                        .repartition(parts, "tree", "node").groupBy("tree", "node")
                        .cogroup(grown.repartition(parts, "tree", "node").groupBy("tree", "node"))
                        .applyInArrow(own, schema))

        def add(table_: pa.Table, held_: pa.Table | None = None) -> pa.Table:
            if held_ is not None and held_.num_rows:
                block = held_.column("block")[0].as_py()
                total = np.frombuffer(held_.column("total")[0].as_py()).copy()
                seen = np.unpackbits(np.frombuffer(held_.column("seen")[0].as_py(), np.uint8)).astype(bool)
            else:
                block = table_.column("block")[0].as_py()
                total, seen = np.zeros(BLOCK), np.zeros(BLOCK, bool)
            tree, node = (table_.column(c).to_numpy() for c in ("tree", "node"))
            for i in np.lexsort((node, tree)).tolist():
                steps, values = wide(table_.column("packed")[i].as_py(), table_.column("n")[i].as_py(), 2)
                at = np.cumsum(steps).astype(np.int64)
                total[at] += values
                seen[at] = True
            return pa.table([pa.array([block]), pa.array([np.packbits(seen).tobytes()], pa.binary()),
                             pa.array([total.tobytes()], pa.binary())], names=["block", "seen", "total"])

        def means(batches):
            for b in batches:
                for block, seen, total in zip(*(b.column(c).to_pylist() for c in ("block", "seen", "total"))):
                    at = np.flatnonzero(np.unpackbits(np.frombuffer(seen, np.uint8)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((block << BLOCK_BITS) + at), pa.array(np.frombuffer(total)[at] / trees)], names=[row, out])
        # the sums so far travel from batch to batch, so that a row's trees are added up in order
        sums, kept = "block long, seen binary, total binary", None
        per = trees if n <= self.task_rows else max(1, PAIRS // n)
        for a in range(0, trees, per):
            found = (answers if n <= self.task_rows else answered(range(a, min(a + per, trees)))).groupBy("block")
            if kept is None:
                added = found.applyInArrow(lambda t: add(t), sums)
            else:
                added = found.cogroup(kept.groupBy("block")).applyInArrow(lambda t, h: add(t, h), sums)
            if a + per < trees:
                before, path = (path if kept is not None else None), _folder(spark)
                kept = _table(added, path)
                if before:
                    drop_folder(spark, before)
        return added.mapInArrow(means, f"{row} long, {out} double")


def _tasks(spark, n: int) -> int:
    """Tasks that ``n`` rows are dealt by."""
    return max(2 * default_parallelism(spark), n >> BLOCK_BITS)


def _parts(spark, uppers: list[Upper]) -> int:
    """Tasks the subtrees are spread over: a task's time follows its rows, not its bytes."""
    subtrees = sum(u.feature.count(-1) for u in uppers)
    # hashes deal few subtrees unevenly, so there are more tasks than those
    return max(min(8 * subtrees, 16 * default_parallelism(spark)), subtrees // SUBTREES)


def fit(df: DataFrame, features: Sequence[str], label: str, weight: str | None = None, num_trees: int = 100,
        subset: int | None = None, seed: int = 42, task_rows: int = TASK_ROWS,
        node_rows: int | None = None) -> Forest:
    """Grow a forest on rows without nulls in ``features`` and ``label``. ``node_rows``
    (:data:`NODE_ROWS`, or ``task_rows`` if that is another than usual) only moves work:
    the trees are the same."""
    node_rows = node_rows or (NODE_ROWS if task_rows == TASK_ROWS else task_rows)
    spark = df.sparkSession
    ship_package(spark)
    width = len(features)
    cols = [f"x{j}" for j in range(width)]
    rows = df.select(*[F.col(c).cast("double").alias(f"x{j}") for j, c in enumerate(features)],
                     F.col(label).cast("double").alias("y"),
                     (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"))
    plain = _folder(spark)
    rows = _table(rows.withColumn("key", F.xxhash64(*rows.columns)), plain)
    n = rows.count()
    uppers = [Upper(path=[root_path(t, seed)]) for t in range(num_trees)]
    schema = "tree int, node long, packed binary"

    def finish(x, y, w, key, order, tree: int, path: int) -> bytes:
        times = bootstrap(key, tree, seed)
        own = times > 0
        if not own.any():                     # a sample can only be empty for a handful of rows
            own, times = np.ones(len(y), bool), np.ones(len(y))
        number = (np.cumsum(own) - 1).astype(np.int32)
        order = [number[o[own[o]]] for o in order]
        return pack(*grow(x[own], y[own], (w * times)[own], path, subset, order))

    if n <= task_rows:
        t = rows.toArrow()
        held = spark.sparkContext.broadcast(_canonical(
            _matrix(t, cols), t.column("y").to_numpy(), t.column("w").to_numpy(), t.column("key").to_numpy()))

        def whole(batches):
            for b in batches:
                for tree in b.column("id").to_pylist():
                    packed = finish(*held.value, tree, root_path(tree, seed))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tree], pa.int32()), pa.array([0], pa.int64()), pa.array([packed], pa.binary())],
                        names=["tree", "node", "packed"])
        per = min(num_trees, 4 * default_parallelism(spark))
        trees = _table(spark.range(0, num_trees, 1, per).mapInArrow(whole, schema))
        return Forest(list(features), num_trees, uppers, trees, task_rows)

    # few files would mean few tasks: their time follows the trees, not the bytes
    rows = _table(rows.repartition(_tasks(spark, n)))
    drop_folder(spark, plain)
    rule = _rule(rows, cols)
    # a tree's sample holds 0.63 of the rows
    if 0.65 * n <= node_rows:
        for u in uppers:
            u.open.clear()
    _grow_upper(rows, cols, uppers, subset, seed, node_rows, rule)
    shared = spark.sparkContext.broadcast([(u.arrays(), np.array(u.path, np.uint64)) for u in uppers])

    fields = (*cols, "y", "w")

    def deal(batches, some_trees):
        for held in _blocks(batches, [*fields, "key"]):
            x, key = np.column_stack([held[c] for c in cols]), held["key"]
            columns = [narrow(held[c]) for c in fields]
            for tree in some_trees:
                times = bootstrap(key, tree, seed)
                own = np.flatnonzero(times)
                node, many, packed = _packets(descend(x[own], *shared.value[tree][0]), [
                    *((c[own], scale) for c, scale in columns), (times[own].astype("<i1"), 1.0)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(node), tree, np.int32)), pa.array(node), pa.array(np.full(len(node), key[0])),
                     pa.array(many.astype(np.int32)), pa.array(packed, pa.binary())],
                    names=["tree", "node", "first", "n", "packed"])

    def subtree(table: pa.Table) -> pa.Table:
        tree, node = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        counts, packets = table.column("n").to_pylist(), table.column("packed")
        held = np.empty((width + 3, sum(counts)))
        at = 0
        for i in np.argsort(table.column("first").to_numpy(), kind="stable").tolist():
            for k, c in enumerate(wide(packets[i].as_py(), counts[i], width + 3)):
                held[k, at:at + counts[i]] = c
            at += counts[i]
        packed = _grown(held[:width], *held[width:], int(shared.value[tree][1][node]), subset, task_rows, rule)
        return pa.table([pa.array([tree], pa.int32()), pa.array([node], pa.int64()), pa.array([packed], pa.binary())],
                        names=["tree", "node", "packed"])
    # packets hold rows in the order of their content, so packets in order do as well; equal rows may share ranges
    ranged = (rows.withColumn("__r", F.rand(seed)).repartitionByRange(_tasks(spark, n), "key", "__r").drop("__r")
              .sortWithinPartitions("key", *reversed(cols), "y", "w"))
    path = _folder(spark)
    per = max(1, 2 * PAIRS // n)                          # a packet takes half the bytes of a scored one and its answer
    for a in range(0, num_trees, per):
        some = range(a, min(a + per, num_trees))
        dealt = ranged.mapInArrow(lambda batches, some=some: deal(batches, some),
                                  "tree int, node long, first long, n int, packed binary")
        grown = (dealt.repartition(_parts(spark, uppers[a:a + per]), "tree", "node").groupBy("tree", "node")
                 .applyInArrow(subtree, schema))
        with shuffles_dropped(spark):
            # a folder for each tree, so that a batch of scores reads its trees only
            grown.select("*").write.mode("append").partitionBy("tree").parquet(path)
    trees = spark.read.schema(schema).parquet(path).select("tree", "node", "packed")
    return Forest(list(features), num_trees, uppers, trees, task_rows)


def _cuts(rows: DataFrame, cols: list[str]) -> list[np.ndarray]:
    """The exact ``BINS``-quantiles of every feature, from one distributed sort of all of
    them; a random number spreads equal values."""
    spark = rows.sparkSession
    cells = F.array(*[F.struct(F.lit(j).alias("j"), F.col(c).alias("v")) for j, c in enumerate(cols)])
    values = rows.select(F.explode(cells).alias("e")).select("e.j", "e.v").withColumn("r", F.rand(0))
    n = rows.count()
    sorted_ = stretches(values, [F.col("j"), F.col("v"), F.col("r")], _tasks(spark, n))
    size = {r["__part"]: r["count"] for r in sorted_.groupBy("__part").count().collect()}
    parts = sorted(size)
    ends = np.cumsum([size[k] for k in parts])
    places = [k / BINS * (n - 1) for k in range(1, BINS)]
    # a feature's place p is place j * n + p of all
    ranks = sorted({j * n + r for j in range(len(cols)) for p in places for r in (math.floor(p), math.ceil(p))})
    which = np.searchsorted(ends, ranks, side="right")
    asked = spark.createDataFrame([(int(parts[k]), int(r - ends[k] + size[parts[k]]), int(r)) for k, r in
                                   zip(which, ranks)], "__part long, __at long, rank long")
    found = {r["rank"]: r["v"] for r in sorted_.join(F.broadcast(asked), ["__part", "__at"]).select("rank", "v").collect()}

    def quantile(j, p):
        lo, hi = found[j * n + math.floor(p)], found[j * n + math.ceil(p)]
        return lo + (hi - lo) * (p - math.floor(p))
    return [np.unique([quantile(j, p) for p in places]) for j in range(len(cols))]


@dataclass
class Rule:
    """What histograms are made with: cuts per feature, lowest label and the steps of labels and weights."""
    cuts: list[np.ndarray]
    low: float
    step: float
    heavy: float

    def labels(self, y: np.ndarray) -> np.ndarray:
        return np.rint((y - self.low) / self.step)

    def weights(self, w: np.ndarray) -> np.ndarray:
        return np.maximum(1.0, np.rint(w / self.heavy))

    def best(self, s: np.ndarray, allowed: np.ndarray) -> tuple[int, float, int]:
        """(feature, threshold, rows to the left) of the best cut of a node's histograms, or feature -1."""
        best, cut = -np.inf, (-1, 0.0, -1)
        for j in np.flatnonzero(allowed):
            w, sy = (np.cumsum(s[j, :, k]).astype(float) for k in (0, 1))
            for k in range(len(self.cuts[j])):
                if 0 < w[k] < w[-1]:
                    gain = sy[k] ** 2 / w[k] + (sy[-1] - sy[k]) ** 2 / (w[-1] - w[k])
                    if gain > best:
                        best, cut = gain, (int(j), float(self.cuts[j][k]), int(s[j, :k + 1, 2].sum()))
        return cut


def _rule(rows: DataFrame, cols: list[str]) -> Rule:
    top = rows.agg(F.min("y"), F.max("y"), F.max("w")).first()
    return Rule(_cuts(rows, cols), top[0], (top[1] - top[0]) / 2 ** 20 or 1.0, top[2] / 2 ** 8 or 1.0)


def _halved(lo: np.ndarray, hi: np.ndarray, allowed: np.ndarray) -> tuple[int, float]:
    """One bin of every feature holds all rows: the middle of the widest."""
    j = int(np.argmax(np.where(allowed, hi - lo, -1.0)))
    return j, float(middle(lo[j], hi[j]))


def _grown(x: np.ndarray, y: np.ndarray, w: np.ndarray, times: np.ndarray, path: int, subset: int | None,
           task_rows: int, rule: Rule) -> bytes:
    """A node's tree, packed; rows of ``x`` are features. Nodes of over ``task_rows`` rows are
    split as :func:`_grow_upper` does, whose rows are here at hand."""
    if len(y) <= task_rows:
        return pack(*grow(np.ascontiguousarray(x.T), y, w * times, path, subset))
    bins = [np.searchsorted(c, v).astype(np.uint8) for c, v in zip(rule.cuts, x)]
    weight = rule.weights(w) * times
    label = weight * rule.labels(y)
    feature, value, left, parts = [], [], [], []
    todo, made = [(np.arange(len(y), dtype=np.int32), path)], 1
    while todo:                                           # nodes in the order of their numbers
        own, path = todo.pop(0)
        cut = -1, 0.0
        if len(own) > task_rows:
            at = [b[own] for b in bins]
            varies = np.array([b.min() < b.max() or v[own].min() < v[own].max() for b, v in zip(at, x)])
            allowed = competing(np.array([path], np.uint64), varies[None], subset)[0]
            s = np.zeros((len(x), BINS, 3), np.int64)
            for a in range(0, len(own), 1 << 20):         # whole numbers below 2^53, so exact
                some = own[a:a + (1 << 20)]
                sums = weight[some], label[some], None
                for j in np.flatnonzero(allowed):
                    cell = at[j][a:a + (1 << 20)]
                    for k, v in enumerate(sums):
                        s[j, :, k] += np.bincount(cell, v, BINS).astype(np.int64)
            cut = rule.best(s, allowed)[:2]
            if cut[0] < 0 and allowed.any():
                cut = _halved(*(np.array([f(v[own]) for v in x]) for f in (np.min, np.max)), allowed)
        feature.append(cut[0])
        value.append(cut[1])
        left.append(-1 if cut[0] < 0 else made)
        if cut[0] < 0:
            parts.append(pack(*grow(np.stack([v[own] for v in x], axis=1), y[own], w[own] * times[own], path, subset)))
            continue
        right, child = x[cut[0]][own] > cut[1], np.array([path], np.uint64)
        todo += [(own[right == side], int(child_path(child, side)[0])) for side in (0, 1)]
        made += 2
    return bundle(pack(np.array(feature, np.int16), np.array(value), np.array(left, np.int32)), parts)


def _grow_upper(rows: DataFrame, cols: list[str], uppers: list[Upper], subset: int | None, seed: int,
                task_rows: int, rule: Rule) -> None:
    """Split all nodes of more than ``task_rows`` rows, level by level."""
    spark, width, cuts = rows.sparkSession, len(cols), rule.cuts
    shape = (width, BINS, 3)

    def histograms(todo, arrays):
        index = {t: {node: i for i, (tt, node) in enumerate(todo) if tt == t} for t, _ in todo}

        def run(batches):
            sums = np.zeros((len(todo), *shape), np.int64)
            ends = np.full((len(todo), width, 2), np.inf)
            for held in _blocks(batches, [*cols, "y", "w", "key"]):
                x, key = np.column_stack([held[c] for c in cols]), held["key"]
                yq, wq = rule.labels(held["y"]), rule.weights(held["w"])
                bins = [np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)]
                for tree, of in index.items():
                    times = bootstrap(key, tree, seed)
                    own = np.flatnonzero(times)
                    nodes = descend(x[own], *arrays.value[tree])
                    # the tree's open nodes are numbered in a row
                    number = np.full(len(arrays.value[tree][0]), -1)
                    number[list(of)] = np.arange(len(of))
                    at = number[nodes]
                    own, at = own[at >= 0], at[at >= 0]
                    w, first = wq[own] * times[own], of[min(of)]
                    # whole numbers below 2^53, so exact
                    weights = (w, w * yq[own], None)
                    by = np.argsort(at.astype(np.int16), kind="stable")        # at most OPEN
                    cut = np.flatnonzero(np.diff(at[by], prepend=-1))
                    seen = first + at[by[cut]]
                    for j in range(width):
                        cell = at * BINS + bins[j][own]
                        for k, v in enumerate(weights):
                            sums[first:first + len(of), j, :, k] += np.bincount(
                                cell, v, len(of) * BINS).reshape(len(of), BINS).astype(np.int64)
                        if len(cut):
                            xs = x[own[by], j]
                            ends[seen, j, 0] = np.minimum(ends[seen, j, 0], np.minimum.reduceat(xs, cut))
                            ends[seen, j, 1] = np.minimum(ends[seen, j, 1], -np.maximum.reduceat(xs, cut))
            some = np.flatnonzero(sums[:, 0, :, 2].any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array([sums[i].tobytes() for i in some], pa.binary()),
                 pa.array([ends[i].tobytes() for i in some], pa.binary())], names=["i", "sums", "ends"])
        return rows.mapInArrow(run, "i long, sums binary, ends binary")

    def choose(paths):
        def run(table: pa.Table) -> pa.Table:
            i = table.column("i")[0].as_py()
            s = sum(np.frombuffer(v, np.int64).reshape(shape) for v in table.column("sums").to_pylist())
            e = np.minimum.reduce([np.frombuffer(v).reshape(width, 2) for v in table.column("ends").to_pylist()])
            lo, hi = e[:, 0], -e[:, 1]
            allowed = competing(np.array([paths[i]], np.uint64), (lo < hi)[None], subset)[0]
            *cut, small = rule.best(s, allowed)             # rows to the left; -1: not known
            if cut[0] < 0 and allowed.any():
                cut = _halved(lo, hi, allowed)
            return pa.table([pa.array([i]), pa.array([cut[0]]), pa.array([cut[1]]),
                             pa.array([int(s[0, :, 2].sum())]), pa.array([small])],
                            names=["i", "feature", "value", "n", "n_left"])
        return run

    while any(u.open for u in uppers):
        everything = sorted((t, node) for t, u in enumerate(uppers) for node in u.open)
        arrays = spark.sparkContext.broadcast([u.arrays() for u in uppers])
        for a in range(0, len(everything), OPEN):
            todo = everything[a:a + OPEN]
            paths = [uppers[t].path[node] for t, node in todo]
            found = histograms(todo, arrays).groupBy("i").applyInArrow(
                choose(paths), "i long, feature long, value double, n long, n_left long").collect()
            for t, node in todo:
                uppers[t].open.discard(node)
            for r in found:
                t, node = todo[r["i"]]
                u = uppers[t]
                if r["n"] <= task_rows or r["feature"] < 0:
                    continue
                u.feature[node], u.value[node], u.left[node] = r["feature"], r["value"], len(u.feature)
                own = np.array([u.path[node]], np.uint64)
                for side in (0, 1):
                    # rows on each side of a cut are counted already: only nodes over the bound stay open
                    if r["n_left"] < 0 or (r["n"] - r["n_left"] if side else r["n_left"]) > task_rows:
                        u.open.add(len(u.feature))
                    u.feature.append(-1)
                    u.value.append(0.0)
                    u.left.append(-1)
                    u.path.append(int(child_path(own, side)[0]))
