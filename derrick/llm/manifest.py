"""Merkle manifest of a dataset with octopus multiproofs.

H is the lowercase hex SHA-256 of its inputs concatenated, digests as hex text. A
row's leaf is H of ``FIELDS``, each ``-`` if null, else its UTF-8 byte count, ``:``
and its value. Per source the leaves ascend by doc_id; every ``ARITY`` consecutive
nodes (the last run: fewer, even one) become their H until one node, the subroot,
remains (a lone leaf is its own). The subroots, ordered by source (null first, UTF-8
bytewise), make the top tree in the same way; its last node is the root.

1. Leaves are hashed where the text lies; only digests travel. They are range
   partitioned by (source, doc_id, leaf), so a hot source spreads along its ids, and
   numbered from the counts of each (partition, source).
2. Levels: one grouped aggregate each, over groups of at most ``ARITY`` rows.
3. Octopus multiproof: leaves are dealt to leaf partitions (aligned blocks of
   ``BLOCK`` positions of a source, several small ones together). A partition
   computes the coordinates that its own leaves can't supply: per level the members
   of its runs that it does not know, the known nodes being the runs of the level
   below. This is the smallest such set; every coordinate is asked for once however
   many proofs of the partition use it.
4. All requests are answered by one join per level against the stored nodes (levels
   of few nodes are broadcast, as every partition asks for them).
5. A partition hashes its shared inner nodes once and expands every leaf's proof
   from them: the siblings, level by level up to the root, left to right.

Defined results: rows without a doc_id come first in their source; rows that repeat
an id are ordered by leaf, and equal rows are leaves of their own; null and empty
text differ (``-`` and ``0:``); an empty table has no leaves and no root; columns
other than ``FIELDS`` take no part, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from derrick.llm import common
from derrick.operators.ranking import global_row_number

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
ARITY = 16
#: leaves of a source in one leaf partition, a power of ARITY
BLOCK = 4_096
#: levels with at most so many nodes (about 100 bytes each) are broadcast
BROADCAST_NODES = 50_000
#: the tree above the sources
TOP = -1

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_of(**changed: Column) -> Column:
    """The leaf of a row, with some fields replaced."""
    parts = []
    for name in FIELDS:
        c = changed.get(name, F.col(name)).cast("string")
        parts.append(F.when(c.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)))
    return F.sha2(F.concat(*parts), 256)


def place(leaves: DataFrame) -> DataFrame:
    """``leaves`` (source, doc_id, leaf, ...) with src (0, 1, ... in the order of the
    sources), pos (0, 1, ... inside the source) and n (leaves of the source)."""
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()]
    rows = common.shared_table(
        common.shared_table(leaves).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id()))
    rows = (rows.withColumn("_part", F.shiftright("_id", 33))
            .withColumn("_at", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))))
    # one row per partition and source; a hot source has at most as many as there are partitions
    pieces = common.shared_table(rows.groupBy("_part", "source").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")))
    earlier = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first"))
    sources = global_row_number(
        pieces.groupBy("source").agg(F.sum("_n").alias("n")).withColumn("_has", F.col("source").isNotNull()),
        "_has", False, ["source"], "src").withColumn("src", F.col("src") - 1).drop("_has")
    pieces = common.null_safe(pieces, sources, ["source"], "inner").select(
        "_part", "source", "_before", "src", "n")
    return common.shared_table(
        common.null_safe(rows, common.broadcast_if_small(pieces), ["_part", "source"], "inner")
        .withColumn("pos", F.col("_at") + F.col("_before")).drop("_id", "_at", "_part", "_before"))


def _levels(base: DataFrame, largest: int) -> list[DataFrame]:
    """Nodes (tree, level, idx, n, h) of every level from ``base``, level 0. n is the
    number of nodes of the tree at that level."""
    out, level = [base], 0
    while largest > 1:
        up = (out[-1].where("n > 1")
              .groupBy("tree", F.expr(f"idx div {ARITY}").alias("idx"), F.col("n"))
              .agg(F.array_sort(F.collect_list(F.struct("idx", "h"))).alias("run")))
        level += 1
        out.append(common.shared_table(up.select(
            "tree", F.lit(level).alias("level"), "idx", F.expr(f"(n + {ARITY - 1}) div {ARITY}").alias("n"),
            F.sha2(F.concat_ws("", F.transform("run", lambda x: x["h"])), 256).alias("h"))))
        largest = -(-largest // ARITY)
    return out


class Tree:
    """All nodes of a manifest: ``levels`` are lists of stored tables (tree, level,
    idx, n, h), of the sources' trees and of the top tree; ``root`` is None for an
    empty table."""

    def __init__(self, placed: DataFrame):
        size = placed.agg(F.max("n"), F.max("src")).first()
        base = placed.select(F.col("src").alias("tree"), F.lit(0).alias("level"), F.col("pos").alias("idx"),
                             "n", F.col("leaf").alias("h"))
        self.sources = 0 if size[1] is None else size[1] + 1
        self.levels = {False: _levels(base, size[0] or 0)}
        subroots = None
        for x in self.levels[False]:
            one = x.where("n = 1")
            subroots = one if subroots is None else subroots.unionByName(one)
        self.subroots = common.shared_table(subroots.select(F.col("tree").alias("src"), "h"))
        top = self.subroots.select(
            F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("src").alias("idx"),
            F.lit(self.sources).cast("long").alias("n"), "h")
        self.levels[True] = _levels(top, self.sources)
        last = self.levels[True][-1].first() if self.sources else None
        self.root = last["h"] if last else None

    def answer(self, requests: DataFrame) -> DataFrame:
        """``requests`` (part, tree, level, idx) with the digests ``h``."""
        requests = common.shared_table(requests)
        out = None
        asked = requests.select((F.col("tree") == TOP).alias("top"), "level").distinct().collect()
        for top, level in sorted((r["top"], r["level"]) for r in asked):
            nodes = self.levels[top][level].select("tree", "idx", "h")
            some = requests.where((F.col("level") == level) & ((F.col("tree") == TOP) == F.lit(top)))
            if level and nodes.count() <= BROADCAST_NODES:
                nodes = F.broadcast(nodes)
            found = some.join(nodes, ["tree", "idx"]).select("part", "tree", "level", "idx", "h")
            out = found if out is None else out.unionByName(found)
        return requests.withColumn("h", F.lit("")).limit(0) if out is None else out


def missing(tree: np.ndarray, idx: np.ndarray, n: np.ndarray, sources: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """The multiproof's coordinates (level, trees, idxs) for leaves ``idx`` of trees
    of ``n`` leaves; the top tree's are those of tree ``TOP``."""
    out = []
    for top in (False, True):
        if top:
            idx, tree = np.unique(tree), np.full(len(np.unique(tree)), TOP)
            n = np.full(len(idx), sources)
        size = dict(zip(tree.tolist(), n.tolist()))
        known = {t: np.unique(idx[tree == t]) for t in size}
        level = 0
        while any(s > 1 for s in size.values()):
            trees, idxs = [], []
            for t, s in size.items():
                if s == 1:
                    continue
                run = np.unique(known[t] // ARITY)
                every = (run[:, None] * ARITY + np.arange(ARITY)).ravel()
                lack = np.setdiff1d(every[every < s], known[t], assume_unique=True)
                trees.append(np.full(len(lack), t))
                idxs.append(lack)
                known[t], size[t] = run, -(-s // ARITY)
            out.append((level, np.concatenate(trees), np.concatenate(idxs)))
            level += 1
    return out


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def expand(leaves: list[tuple], fetched: dict, sources: int):
    """Inner nodes of one leaf partition, once each. ``leaves`` are (src, pos, n, h)
    tuples, ``fetched`` maps (tree, level, idx) to a digest. Gives ``runs``, a map of
    (tree, level, number of the run) to the run's digests as one string, and the
    number of levels of every tree."""
    own: dict[int, dict[int, str]] = {}
    size: dict[int, int] = {}
    for src, pos, n, h in leaves:
        own.setdefault(src, {})[pos] = h
        size[src] = n
    runs, heights = {}, {}

    def climb(tree: int, known: dict[int, str], n: int) -> str:
        level = 0
        while n > 1:
            up = {}
            for r in {i // ARITY for i in known}:
                text = "".join(known.get(i) or fetched[tree, level, i]
                               for i in range(r * ARITY, min((r + 1) * ARITY, n)))
                runs[tree, level, r] = text
                up[r] = digest(text)
            known, n, level = up, -(-n // ARITY), level + 1
        heights[tree] = level
        return known[0]
    subroots = {t: climb(t, known, size[t]) for t, known in own.items()}
    root = climb(TOP, subroots, sources) if subroots else None
    return runs, heights, subroots, root


def siblings(src: int, pos: int, runs: dict, heights: dict):
    """(digests left of the node, digests right of it) for every level up to the root."""
    for tree, i in ((src, pos), (TOP, src)):
        for level in range(heights[tree]):
            text, at = runs[tree, level, i // ARITY], 64 * (i % ARITY)
            yield text[:at], text[at + 64:]
            i //= ARITY


def prove(placed: DataFrame, tree: Tree, with_proof: bool = False) -> DataFrame:
    """Proofs of the leaves ``placed`` (doc_id, src, pos, n, leaf, presented), which may
    be a part of the tree's. ``presented`` is the leaf a reader recomputed from the
    row at hand (null: the leaf itself); folded_root follows it and the siblings up,
    verified tells whether that is the root. With ``with_proof`` the siblings
    themselves are a column too."""
    parts = common.groups_for(placed.count(), BLOCK)
    # leaf partition: blocks of consecutive leaves of one source; small sources share one
    rows = common.shared_table(placed.withColumn(
        "part", F.pmod(F.xxhash64("src", F.expr(f"pos div {BLOCK}")), F.lit(parts)))
        .select("part", "doc_id", "src", "pos", "n", "leaf", F.coalesce("presented", "leaf").alias("presented")))
    sources, root = tree.sources, tree.root

    def ask(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        src, pos, n = (table.column(c).to_numpy() for c in ("src", "pos", "n"))
        got = missing(src, pos, n, sources)
        size = [len(i) for _, _, i in got]
        return pa.table([pa.array(np.full(sum(size), part)),
                         pa.array(np.concatenate([t for _, t, _ in got] or [np.zeros(0)]).astype(np.int64)),
                         pa.array(np.repeat([x for x, _, _ in got], size).astype(np.int32)),
                         pa.array(np.concatenate([i for _, _, i in got] or [np.zeros(0)]).astype(np.int64))],
                        names=["part", "tree", "level", "idx"])

    asked = rows.select("part", "src", "pos", "n").groupBy("part").applyInArrow(
        ask, "part long, tree long, level int, idx long")
    answers = tree.answer(asked)

    def local(leaves: pa.Table, nodes: pa.Table) -> pa.Table:
        cols = {c: leaves.column(c).to_pylist() for c in leaves.column_names}
        fetched = dict(zip(zip(*(nodes.column(c).to_pylist() for c in ("tree", "level", "idx"))),
                           nodes.column("h").to_pylist()))
        runs, heights, subroots, _ = expand(list(zip(cols["src"], cols["pos"], cols["n"], cols["leaf"])),
                                            fetched, sources)
        shas, folded, whole = [], [], []
        for src, pos, node in zip(cols["src"], cols["pos"], cols["presented"]):
            sha, text = hashlib.sha256(), []
            for left, right in siblings(src, pos, runs, heights):
                both = left + right
                sha.update(both.encode())
                if with_proof:
                    text.append(both)
                node = digest(left + node + right)
            shas.append(sha.hexdigest())
            folded.append(node)
            whole.append("".join(text))
        out = [leaves.column("doc_id"), leaves.column("leaf"), pa.array([subroots[s] for s in cols["src"]], pa.string()),
               pa.array([root] * len(shas), pa.string()), pa.array(shas, pa.string()), pa.array(folded, pa.string()),
               pa.array([f == root for f in folded], pa.bool_())]
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        if with_proof:
            out.append(pa.array(whole, pa.string()))
            names.append("proof")
        return pa.table(out, names=names)

    schema = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
              "folded_root string, verified boolean") + (", proof string" if with_proof else "")
    return rows.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(local, schema)


def leaves(docs: DataFrame, presented: Column | None = None) -> DataFrame:
    """(doc_id, source, leaf, presented); ``presented`` is a leaf to be checked, a
    column over ``docs``."""
    common.ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       leaf_of().alias("leaf"),
                       (F.lit(None).cast("string") if presented is None else presented).alias("presented"))


def lower_cased(every: int) -> Column:
    """The leaf of a row whose text lost its capitals A-Z, for ids whose CRC-32 ``every``
    divides; null for the others."""
    return F.when(F.crc32(F.col("doc_id").cast("string")) % every == 0,
                  leaf_of(text=F.translate("text", UPPER, LOWER)))


def manifest(docs: DataFrame, presented: Column | None = None, with_proof: bool = False) -> DataFrame:
    """Leaf, subroot, root and proof of every row of ``docs`` (see :func:`prove`)."""
    placed = place(leaves(docs, presented))
    return prove(placed, Tree(placed), with_proof)
