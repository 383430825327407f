"""MinHash near-duplicates through an LSH forest.

A text's set: A-Z lower-cased, words are runs without ASCII white space, and the
distinct shingles of ``words`` words as 64-bit hashes (a text of fewer words is one
shingle; without words the set is empty and links with nothing). Two documents link if
100 * intersection >= ``percent`` * union, confirmed on the full sets.

1. Equal sets become one class (128-bit hash); work goes on with classes. A class has a
   signature of ``TREES`` x ``LEVELS`` minima, 16 bits each. Classes of one signature
   hang on the smallest of them.
2. Forest: every tree orders the classes by the signature read from its own levels on,
   round the signature. A region of a tree shares the first ``DEPTH`` levels; regions
   are counted first, and classes alone in theirs go no further.
3. Candidates are the neighbours of longest common prefix: in a region of at most
   ``REGION`` classes all of them; a more crowded one is sorted over all tasks by the
   whole order, and a class meets the ``WINDOW`` nearest on either side, so the depth
   at which it is searched grows with the crowd. Of the candidates those stay that
   agree in ``AGREE`` minima.
4. The remaining links make blocks, inside which full sets are joined exactly. A block
   of over ``BLOCK`` tokens is dealt in chunks, which share the block's first class;
   then every class outside the block's largest confirmed group meets all chunks. So
   copies of one text never meet in pairs, and no pair of a block is lost.

A pair of similarity s lacks a common region of depth 3 in all 24 trees with a chance of
(1 - s^3)^24, 3e-8 at s = 0.8; it agrees in fewer than 54 of 96 minima with a chance
below 1e-7. In crowded regions (over ``REGION`` different texts that share at least a
part) a pair must also be near in the order of some tree.

Defined results: a row without a doc_id gets the smallest id of its group (null if there
is none); rows that repeat an id stay rows, and only texts link them; texts without words
stand alone; ``kept`` is true if the row's id is its component's (null-safe, so a row
without any id near it is kept); an empty table gives an empty result; columns other than
doc_id and text take no part, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from derrick.llm import common
from derrick.llm.components import components, local_roots
from derrick.llm.rolling import Prefix, runs

WORDS = 4
PERCENT = 80
TREES, LEVELS, DEPTH = 24, 4, 3
AGREE = 54
REGION, WINDOW = 1_024, 256
BLOCK = 1 << 21

_SIZE = TREES * LEVELS
_rng = np.random.default_rng(977)
_XOR = _rng.integers(0, 1 << 63, _SIZE, dtype=np.uint64) * np.uint64(2) + _rng.integers(0, 2, _SIZE, dtype=np.uint64)
_ODD = _rng.integers(0, 1 << 63, _SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    w = text.lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(words, len(w)) - 1
    return np.unique(Prefix(np.frombuffer(joined, np.uint8)).spans(starts[:len(w) - k], ends[k:]))


def signature(tokens: np.ndarray) -> np.ndarray:
    """The set's minima under _SIZE orders, 16 bits of each."""
    low = np.full(_SIZE, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(tokens), 2048):
        np.minimum(low, ((tokens[a:a + 2048, None] ^ _XOR) * _ODD).min(axis=0), out=low)
    return ((low >> np.uint64(8)) & np.uint64(0xFFFF)).astype(">u2")


def sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(row, doc_id, n, s1, s2, sig, tokens) of every document."""
    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            for a in range(0, len(texts), 256):
                own = [np.zeros(0, np.uint64) if t is None else shingles(t.encode(), words) for t in texts[a:a + 256]]
                raw = [x.astype("<u8").tobytes() for x in own]
                ids = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x) for x in raw), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(a, 256), pa.array([len(x) for x in own], pa.int64()),
                     pa.array(np.ascontiguousarray(ids[:, 0])), pa.array(np.ascontiguousarray(ids[:, 1])),
                     pa.array([signature(x).tobytes() if len(x) else None for x in own], pa.binary()),
                     pa.array(raw, pa.binary())], names=["doc_id", "n", "s1", "s2", "sig", "tokens"])
    common.ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, s1 long, s2 long, sig binary, tokens binary").withColumn(
        "row", F.monotonically_increasing_id())


def _matrix(col) -> np.ndarray:
    return np.frombuffer(b"".join(col), ">u2").reshape(-1, _SIZE)


def alike(sig: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Whether rows of ``sig`` agree with rows of ``others`` in AGREE minima."""
    out = np.empty((len(sig), len(others)), bool)
    for a in range(0, len(sig), 64):
        out[a:a + 64] = np.count_nonzero(sig[a:a + 64, None] == others[None], axis=2) >= AGREE
    return out


def _stars(ids: np.ndarray, left: list, right: list) -> tuple[list[int], list[int]]:
    roots = local_roots(len(ids), left, right)
    u = [x for x, r in enumerate(roots) if r != x]
    return ids[u].tolist(), ids[[roots[x] for x in u]].tolist()


def candidates(classes: DataFrame, crowded: int = REGION, window: int = WINDOW) -> DataFrame:
    """Probable links (u, v) between classes (id, sig): one per class and region."""
    def regions(batches):
        trees = np.arange(TREES, dtype=np.uint64)
        for b in batches:
            for a in range(0, b.num_rows, 4096):
                part = b.slice(a, 4096)
                sig = _matrix(part.column("sig").to_pylist()).astype(np.uint64).reshape(-1, TREES, LEVELS)
                key = trees[None, :] * np.uint64(0x9E3779B97F4A7C15)
                for k in range(DEPTH):
                    key = (key ^ sig[:, :, k]) * np.uint64(0xD6E8FEB86659FD93)
                    key = key ^ (key >> np.uint64(32))
                key = np.ascontiguousarray(key).ravel().view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), part.column("id").take(pa.array(np.repeat(np.arange(part.num_rows), TREES))),
                     pa.array(np.tile(np.arange(TREES, dtype=np.int32), part.num_rows))],
                    names=["region", "id", "tree"])

    rows = classes.mapInArrow(regions, "region long, id long, tree int")
    crowd = rows.groupBy("region").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1")
    rows = common.shared_table(rows.join(crowd, "region").join(classes, "id"))
    small, large = rows.where(F.col("crowd") <= crowded), rows.where(F.col("crowd") > crowded)
    schema = "u long, v long"

    def whole(batches):
        """Regions come one behind the other; each is compared as a whole."""
        for region, ids, sig in _stretches(batches):
            near = np.triu(alike(sig, sig), 1)
            u, v = _stars(ids, *(x.tolist() for x in np.nonzero(near)))
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    def windows(batches):
        """Sorted rows of crowded regions: each row meets the ``window`` before it."""
        region, ids, sig = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, _SIZE), ">u2")
        for b in batches:
            cols = b.column("region").to_numpy(), b.column("id").to_numpy(), _matrix(b.column("sig").to_pylist())
            for a in range(0, b.num_rows, window):
                new = [c[a:a + window] for c in cols]
                old = len(ids)
                region, ids, sig = (np.concatenate(x) for x in zip((region, ids, sig), new))
                near = alike(new[2], sig) & (new[0][:, None] == region[None])
                i, j = np.nonzero(near)
                u, v = _stars(ids, (i + old).tolist(), j.tolist())
                region, ids, sig = region[-window:], ids[-window:], sig[-window:]
                if u:
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    links = (small.select("region", "id", "sig").repartition("region").sortWithinPartitions("region", "id")
             .mapInArrow(whole, schema))
    if large.limit(1).count():
        at = F.col("tree") * (2 * LEVELS)
        order = F.concat(F.col("sig").substr(at + 1, F.lit(2 * _SIZE)), F.col("sig").substr(F.lit(1), at))
        links = links.unionByName(
            large.select("region", "id", "sig", order.alias("order")).repartitionByRange("region", "order", "id")
            .sortWithinPartitions("region", "order", "id").drop("order").mapInArrow(windows, schema))
    return links.distinct()


def _stretches(batches):
    """(region, ids, signatures) of every run of equal regions in a sorted stream."""
    held = None
    for b in batches:
        region, ids, sig = b.column("region").to_numpy(), b.column("id").to_numpy(), b.column("sig").to_pylist()
        if held is not None:
            region = np.concatenate([np.full(len(held[1]), held[0]), region])
            ids, sig = np.concatenate([held[1], ids]), held[2] + sig
        cut = runs(region)
        for a, e in zip(cut[:-2], cut[1:-1]):
            yield region[a], ids[a:e], _matrix(sig[a:e])
        held = (region[cut[-2]], ids[cut[-2]:], sig[cut[-2]:]) if len(region) else held
    if held is not None and len(held[1]):
        yield held[0], held[1], _matrix(held[2])


class Sets:
    """Full sets of one task, for exact comparisons of one with all."""

    def __init__(self, raw: list[bytes]):
        self.size = np.array([len(x) // 8 for x in raw], np.int64)
        tokens, self.of = np.unique(np.frombuffer(b"".join(raw), "<u8"), return_inverse=True)
        self.starts = np.cumsum(self.size) - self.size
        self.mark = np.zeros(len(tokens), bool)

    def links(self, i: int, percent: int) -> np.ndarray:
        """All sets that link with set i (itself included)."""
        own = self.of[self.starts[i]:self.starts[i] + self.size[i]]
        self.mark[own] = True
        both = np.add.reduceat(self.mark[self.of].astype(np.int64), self.starts)
        self.mark[own] = False
        return np.flatnonzero(100 * both >= percent * (self.size + self.size[i] - both))


def confirmed(raw: list[bytes], percent: int) -> list[int]:
    """Groups of full sets under confirmed links, as the smallest member of each. Two
    sets are compared unless they are known to be in one group already."""
    s = Sets(raw)
    roots = np.arange(len(raw))
    todo = np.ones(len(raw), bool)
    while True:
        groups, size = np.unique(roots[todo], return_counts=True)
        if len(groups) < 2:
            return roots.tolist()
        # the sets outside the largest open group are compared with all others, one by one
        i = int(np.flatnonzero(todo & (roots != groups[np.argmax(size)]))[0])
        todo[i] = False
        met = np.unique(roots[s.links(i, percent)])
        roots[np.isin(roots, met)] = met[0]


def _many(table: pa.Table, keys: list[str]):
    """(row numbers, in the order of ``row``) of every combination of ``keys``."""
    held: dict[tuple, list[int]] = {}
    order = np.argsort(table.column("row").to_numpy(), kind="stable").tolist()
    cols = [table.column(k).to_pylist() for k in keys]
    for r in order:
        held.setdefault(tuple(c[r] for c in cols), []).append(r)
    return held


def confirmed_links(full: DataFrame, links: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """(u, v) links that give the groups of all confirmed links within the blocks that
    ``links`` makes. ``full`` is (row, n, tokens)."""
    blocks = components(links)
    members = common.shared_table(blocks.join(full.select("row", "n", "tokens"), blocks["node"] == full["row"])
                                  .select(F.col("component").alias("block"), "row", "n", "tokens"))
    size = members.groupBy("block").agg(F.sum("n").alias("weight"))
    chunks = size.select("block", F.ceil(F.col("weight") / F.lit(float(block))).cast("long").alias("k"))
    total = size.agg(F.sum("weight")).first()[0] or 0
    groups = common.groups_for(total, max(1, block // 2))
    members = members.join(chunks, "block")
    # one chunk for most blocks; else the block's first class goes to all of its chunks
    own = F.array(F.pmod(F.xxhash64("row"), F.col("k")))
    dealt = members.withColumn("chunk", F.explode(F.when(
        F.col("row") == F.col("block"), F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).otherwise(own)))

    def in_chunk(table: pa.Table) -> pa.Table:
        ids, data = table.column("row").to_numpy(), table.column("tokens").to_pylist()
        out = [[], []]
        for rows in _many(table, ["block", "chunk"]).values():
            for x, r in enumerate(confirmed([data[i] for i in rows], percent)):
                if r != x:
                    out[0].append(ids[rows[x]])
                    out[1].append(ids[rows[r]])
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["u", "v"])

    found = common.shared_table(
        dealt.withColumn("_g", F.pmod(F.xxhash64("block", "chunk"), F.lit(groups)))
        .select("_g", "block", "chunk", "row", "tokens").groupBy("_g").applyInArrow(in_chunk, "u long, v long"))
    large = members.where("k > 1")
    if not large.limit(1).count():
        return found
    # large blocks: what is outside the largest confirmed group meets every chunk
    part = components(found)
    named = common.shared_table(large.join(part, large["row"] == part["node"], "left").select(
        "block", "row", "tokens", "k", F.coalesce("component", "row").alias("part")))
    counts = named.groupBy("block", "part").agg(F.count(F.lit(1)).alias("size"))
    first = Window.partitionBy("block").orderBy(F.desc("size"), "part")
    rest = counts.withColumn("_r", F.row_number().over(first)).where("_r > 1").select("block", "part")
    open_blocks = rest.select("block").distinct()
    named = named.join(open_blocks, "block", "left_semi")
    everyone = named.withColumn("chunk", F.pmod(F.xxhash64("row"), F.col("k"))).withColumn("asks", F.lit(False))
    asking = (named.join(rest, ["block", "part"], "left_semi")
              .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
              .withColumn("asks", F.lit(True)))

    def across(table: pa.Table) -> pa.Table:
        ids, data = table.column("row").to_numpy(), table.column("tokens").to_pylist()
        asks, parts = table.column("asks").to_pylist(), table.column("part").to_pylist()
        out = set()
        for rows in _many(table, ["block", "chunk"]).values():
            s = Sets([data[i] for i in rows])
            for x, i in enumerate(rows):
                if asks[i]:
                    met = {parts[rows[y]]: int(ids[rows[y]]) for y in s.links(x, percent).tolist()}
                    out |= {(int(ids[i]), v) for p, v in met.items() if p != parts[i]}
        got = list(zip(*sorted(out))) if out else [(), ()]
        return pa.table([pa.array(c, pa.int64()) for c in got], names=["u", "v"])

    cross = (everyone.unionByName(asking).withColumn("_g", F.pmod(F.xxhash64("block", "chunk"), F.lit(groups)))
             .select("_g", "block", "chunk", "row", "tokens", "asks", "part")
             .groupBy("_g").applyInArrow(across, "u long, v long"))
    return found.unionByName(cross)


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, crowded: int = REGION,
                    window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, n_copies (rows with
    the same set). ``crowded``, ``window`` and ``block`` bound what one task compares."""
    found = common.shared_table(sets(docs, words))
    classes = common.shared_table(found.where("n > 0").groupBy("s1", "s2").agg(
        F.min("row").alias("id"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n_copies")))
    # one row per class, and of those one per signature
    first = common.shared_table(found.join(classes.select(F.col("id").alias("row")), "row", "left_semi").select(
        F.col("row").alias("id"), "sig", F.xxhash64("sig").alias("h")))
    lead = first.groupBy("h").agg(F.min("id").alias("lead"))
    led = first.join(lead, "h")
    same = led.where("id <> lead").select(F.col("id").alias("u"), F.col("lead").alias("v"))
    links = candidates(led.where("id = lead").select("id", "sig"), crowded, window).unionByName(same)
    linked = components(confirmed_links(found, links, percent, block))
    grouped = common.shared_table(classes.join(linked, classes["id"] == linked["node"], "left").select(
        "s1", "s2", "least", "n_copies", F.coalesce("component", "id").alias("component")))
    smallest = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    grouped = grouped.join(smallest, "component").select("s1", "s2", "n_copies", "component_id")
    out = found.select("doc_id", "n", "s1", "s2").join(
        grouped.withColumn("_some", F.lit(True)), ["s1", "s2"], "left")
    component = F.when(F.col("_some"), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"),
                      F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies"))
