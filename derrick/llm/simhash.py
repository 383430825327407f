"""SimHash near-duplicates through vantage-point trees.

Fingerprints: A-Z are lower-cased, words are runs without ASCII white space, and
every shingle of ``words`` words (repeats included) votes with its XXH64 (seed
42) on 64 bits; a bit is set if it is set in over half of the votes.

Links join fingerprints at ``max_bits`` or fewer differing bits. Work runs on
distinct fingerprints. Of the two 32-bit halves of a linked pair, one differs in
at most r = max_bits // 2 bits, so two vantage-point trees (one per half) find
every pair at radius r. A tree sends a fingerprint to the inner side of a node if
its half lies within the node's radius mu of the vantage point, else to the outer
side; those of distance mu + 1 .. mu + r overlap the boundary and also go to the
inner side. By the triangle bound two halves within r then always meet in a leaf,
and all other branches are pruned. Leaves are shards: inside, pairs are compared
exactly on all 64 bits. A shard returns one link per linked fingerprint (to its
group's smallest), never all pairs; shards above ``SHARD`` fingerprints are cut
into tiles in which any two still meet.

Trees are grown on a bounded sample of ``SAMPLE`` distinct fingerprints (smallest
hash first); every fingerprint is routed.

Defined results: a null or blank text has fingerprint 0 and links like any other;
rows that repeat an id stay rows and are linked by their texts alone; a row with a
null id links like any other and gets the smallest id of its group (null if there is
none); an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.llm import common
from derrick.llm.components import components, local_roots
from derrick.llm.rolling import runs

WORDS = 3
MAX_BITS = 3
SAMPLE = 16_384
#: fingerprints aimed at per leaf, and the most compared at once
LEAF = 1_000
SHARD = 8_192
#: shards handled per task group, in fingerprints
GROUP = 50_000

_HALVES = (np.uint64(0xFFFFFFFF), np.uint64(0xFFFFFFFF00000000))


def fingerprint(text: bytes, words: int = WORDS) -> int:
    w = text.lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    if len(w) <= words:
        h = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends, at = [], -1
        for x in w:
            at += len(x) + 1
            ends.append(at)
        starts = [0] + [e + 1 for e in ends[:-words]]
        digest = xxhash.xxh64_intdigest
        h = [digest(joined[a:b], 42) for a, b in zip(starts, ends[words - 1:])]
    votes = np.zeros(64, np.int64)
    for k in range(0, len(h), 65536):
        part = np.array(h[k:k + 65536], "<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, _th, fp) with the fingerprint as a signed long."""
    def run(batches):
        for b in batches:
            fp = np.array([0 if t is None else fingerprint(t.encode(), words)
                           for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("_th"),
                                              pa.array(fp.view(np.int64))], names=["doc_id", "_th", "fp"])
    return common.documents(docs).mapInArrow(run, "doc_id long, _th long, fp long")


def grow_tree(sample: np.ndarray, mask: np.uint64, leaf: int) -> list[tuple]:
    """Nodes (vantage point, mu, inner, outer) and leaves (None, number, 0, 0);
    node 0 is the root. ``leaf`` is the sample size at which a node stays whole."""
    nodes: list[tuple] = [()]
    todo = [(0, sample)]
    leaves = 0
    while todo:
        at, own = todo.pop()
        split = None
        if len(own) > leaf:
            best = 0.1
            for v in own[:: max(1, len(own) // 8)][:8]:
                d = np.bitwise_count((own ^ v) & mask)
                mu = int(np.median(d))
                mu -= int((d <= mu).mean() > 0.75 and (d < mu).any())
                inner = d <= mu
                share = min(inner.mean(), 1 - inner.mean()) - 0.5 * (d == mu + 1).mean()
                if inner.any() and not inner.all() and share > best:
                    best, split = share, (v, mu, inner)
        if split is None:
            nodes[at] = (None, leaves, 0, 0)
            leaves += 1
            continue
        v, mu, inner = split
        nodes += [(), ()]
        nodes[at] = (v, mu, len(nodes) - 2, len(nodes) - 1)
        todo += [(len(nodes) - 2, own[inner]), (len(nodes) - 1, own[~inner])]
    return nodes


def route(nodes: list[tuple], mask: np.uint64, radius: int, fp: np.ndarray):
    """(index into fp, leaf) arrays: every shard a fingerprint belongs to."""
    out_i, out_l = [], []
    todo = [(0, np.arange(len(fp)))]
    while todo:
        at, idx = todo.pop()
        if not len(idx):
            continue
        v, mu, inner, outer = nodes[at]
        if v is None:
            out_i.append(idx)
            out_l.append(np.full(len(idx), mu))
            continue
        d = np.bitwise_count((fp[idx] ^ v) & mask)
        todo += [(inner, idx[d <= mu + radius]), (outer, idx[d > mu])]
    if not out_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_i), np.concatenate(out_l)


def close_pairs(fp: np.ndarray, bits: int) -> tuple[list[int], list[int]]:
    """Index pairs at ``bits`` or fewer differing bits, spanning each group: once a
    fingerprint hangs on an earlier one, only one of its links is kept per block."""
    left, right = [], []
    step = max(1, (1 << 20) // max(1, len(fp)))
    for a in range(0, len(fp), step):
        near = np.bitwise_count(fp[a:a + step, None] ^ fp[None, a:]) <= bits
        i, j = np.nonzero(near)
        i, j = i + a, j + a
        up = i < j
        left += i[up].tolist()
        right += j[up].tolist()
        if len(left) > 1 << 20:
            roots = local_roots(len(fp), left, right)
            left = [x for x in range(len(fp)) if roots[x] != x]
            right = [roots[x] for x in left]
    return left, right


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (u, v) of ids over distinct fingerprints (fp, id): enough of them to
    give the same components as all pairs within ``max_bits``."""
    n = distinct.count()
    sample = np.array([r[0] for r in distinct.select("fp").orderBy(F.xxhash64(F.lit(1), "fp"), "fp")
                       .limit(SAMPLE).collect()], np.int64).view(np.uint64)
    target = max(2, int(LEAF * len(sample) / max(1, n)))
    radius = max_bits // 2
    trees = [grow_tree(sample, m, target) for m in _HALVES]

    def to_shards(batches):
        for b in batches:
            fp, ids = b.column("fp"), b.column("id")
            f = fp.to_numpy(zero_copy_only=False).view(np.uint64)
            for t, nodes in enumerate(trees):
                i, leaf = route(nodes, _HALVES[t], radius, f)
                take = pa.array(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf * 2 + t), fp.take(take), ids.take(take)], names=["shard", "fp", "id"])

    def compare(table: pa.Table) -> pa.Table:
        key = [table.column(c).to_numpy() for c in ("shard", "tile_i", "tile_j", "id")]
        fp = table.column("fp").to_numpy().view(np.uint64)
        order = np.lexsort((key[3], key[2], key[1], key[0]))
        tile = np.unique(np.stack(key[:3]), axis=1, return_inverse=True)[1].ravel()[order]
        fp, ids = fp[order], key[3][order]
        u, v = [], []
        cut = runs(tile)
        for a, e in zip(cut[:-1], cut[1:]):
            left, right = close_pairs(fp[a:e], max_bits)
            if left:
                roots = local_roots(e - a, left, right)
                for x, r in enumerate(roots):
                    if r != x:
                        u.append(ids[a + x])
                        v.append(ids[a + r])
        return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    shards = distinct.mapInArrow(to_shards, "shard long, fp long, id long")
    sizes = shards.groupBy("shard").agg(F.count(F.lit(1)).alias("weight"))
    tiles = common.tiled(shards, "shard", sizes, SHARD, "fp")
    groups = common.groups_for(4 * n, GROUP)
    return (tiles.withColumn("_g", F.pmod(F.xxhash64("shard", "tile_i", "tile_j"), F.lit(groups)))
            .groupBy("_g").applyInArrow(compare, "u long, v long"))


def near_duplicates(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, _th, fingerprint (16 hex digits), component_id
    (smallest doc_id of its group of linked fingerprints), n_copies (rows with the
    same fingerprint), _group (the group's smallest fingerprint, as a signed long)."""
    prints = common.shared_table(fingerprints(docs, words))
    distinct = common.shared_table(prints.groupBy("fp").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_copies")))
    # fingerprints are the nodes: ids may repeat or be null
    linked = components(links(distinct.select("fp", F.col("fp").alias("id")), max_bits))
    grouped = common.shared_table(distinct.join(linked, distinct["fp"] == linked["node"], "left").select(
        "fp", "least", "n_copies", F.coalesce("component", "fp").alias("_group")))
    smallest = grouped.groupBy("_group").agg(F.min("least").alias("component_id"))
    grouped = grouped.join(smallest, "_group").select("fp", "n_copies", "_group", "component_id")
    return prints.join(grouped, "fp").select(
        "doc_id", "_th", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id", "n_copies", "_group")


def one_of_each(docs: DataFrame, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates: the one with the
    smallest doc_id, ids before nulls, then the smallest text hash."""
    found = near_duplicates(docs, words, max_bits)
    stays = found.groupBy("_group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_th"))
                                        .alias("k")).select(
        F.coalesce("k.doc_id", F.lit(0).cast("long")), "k.none", "k._th")
    names = [common.free_name(docs, c) for c in ("_k_id", "_k_null", "_k_th")]
    stays = stays.toDF(*names)
    d = docs.withColumns({names[0]: F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")),
                          names[1]: F.col("doc_id").isNull(), names[2]: F.xxhash64("text")})
    return d.join(stays, names, "left_semi").dropDuplicates(names).select(*docs.columns)
