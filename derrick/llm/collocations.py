"""Phrase collocations from a weighted de Bruijn graph of words.

A-Z are lower-cased, texts are cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces
into words ``[^\\x20\\x09]+``. Per lang (null: ``und``) the graph's nodes are two
consecutive words and its edges three: edge w1 w2 w3 leads from node w1 w2 to the
overlapping node w2 w3 and weighs as much as it occurs. Only edges are counted in the
texts. The last words of a piece, behind which no third (or second) word comes, are
its piece-end corrections: edges to an empty word.

1. Tasks count the edges of some million words at a time by numbers of their own and
   deal them by node to buckets. What goes to a bucket is one packed row: the words it
   uses and arrays of numbers and counts. One shuffle by bucket adds them up; there are
   as many buckets as the bytes of all texts ask for, so a bucket fits a task.
2. Shorter counts come from the flow: f(w1 w2) is the weight that leaves the node plus
   its piece ends, f(w) the flow of all nodes that begin with w plus the pieces that
   end with it, n the flow of all words.
3. Unary paths: a node is unary if one edge brings and one edge takes all its
   occurrences (both weigh as much as the node). Chains of unary nodes are compacted by
   pointer doubling, log2(longest) joins; a path is part of one piece, and all its
   edges and inner nodes share one weight.
4. Candidates are phrases of two or three words that occur ``least`` times or more: the
   edges of all paths and the nodes. The inner nodes of a path are within an edge of
   their own weight, so only nodes at the ends are compared with their edges. Only nodes
   at the ends of paths need a look-up for the scores, too.

Candidates that lie in a longer candidate with at least ``share`` percent of their
count are dropped. Cutting a phrase after k words gives l and r; its score is the
smallest floor(10^6 a^2 / (l r)) over k, in decimals of 38 digits, ties to smaller k.

Defined results: null text is empty; rows that repeat an id or a text all count; an
empty table gives no phrases; columns other than text and lang take no part, whatever
their names; texts and words may be of any length (words are never cut).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from derrick.llm import common
from derrick.llm.rolling import mix, runs

LEAST = 10
SHARE = 50
PER_LANG = 2_000
#: words a task counts at a time
WORDS = 1 << 22
#: bytes of text per bucket
BUCKET = 12 << 20
_BITS = 21
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: characters of text split into words at a time (at most half as many words)
_CUT = 1 << 21

_BREAK = b"\xff"                     # no byte of UTF-8 text
_PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _BREAK * 10)


class _Numbers(dict):
    """Words numbered as they come; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def words(text: str) -> list[bytes]:
    """The words of a text and one ``_BREAK`` for every cut between pieces."""
    return text.encode().lower().translate(_PIECES).replace(_BREAK, b" \xff ").split()


def _segments(text: str):
    """``text`` in segments of some megabytes that end behind a space, or whole."""
    at = 0
    while len(text) - at > _CUT:
        end = text.rfind(" ", at, at + _CUT) + 1
        if end <= at:
            end = text.find(" ", at + _CUT) + 1 or len(text)
        yield text[at:end]
        at = end
    yield text[at:]


class EdgeCounts:
    """Counts edges of a stream of texts and gives them out block by block, packed."""

    def __init__(self, buckets: int, block: int = WORDS):
        self.buckets, self.block = buckets, block
        self.numbers = _Numbers({_BREAK: 0})
        self.held: dict[str, list[np.ndarray]] = {}
        self.size = 0

    def add(self, lang: str, text: str):
        held = self.held.setdefault(lang, [])
        for part in _segments(text):
            w = words(part)
            ids = np.fromiter(map(self.numbers.__getitem__, w), np.int64, len(w))
            held.append(ids)
            self.size += len(ids)
            if self.size >= self.block or len(self.numbers) >> (_BITS - 1):
                yield from self.flush(lang)
                held = self.held.setdefault(lang, [])
        held.append(np.zeros(2, np.int64))

    def flush(self, going_on: str | None = None):
        """(lang, bucket, packed edges) of everything held. A text that goes on keeps its
        last two words."""
        names = list(self.numbers)
        names[0] = b""
        hashes = np.fromiter(map(_hash, names), np.uint64, len(names))
        remap = np.zeros(len(names), np.uint32)
        tails, mask = {}, (1 << _BITS) - 1
        for lang, held in self.held.items():
            ids = np.concatenate([*held, np.zeros(0 if lang == going_on else 2, np.int64)])
            if lang == going_on:
                tails[lang] = [names[i] or _BREAK for i in ids[-2:].tolist()]
            a, b, c = ids[:-2], ids[1:-1], ids[2:]
            c = np.where(b > 0, c, 0)
            key = (a << (2 * _BITS) | b << _BITS | c)[a > 0]
            edges, n = np.unique(key, return_counts=True)
            w = [(edges >> k) & mask for k in (2 * _BITS, _BITS, 0)]
            node = mix((hashes[w[0]] ^ np.uint64(_hash(lang.encode()))) * _ODD + hashes[w[1]])
            bucket = (node % np.uint64(self.buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cut = runs(bucket[order])
            for s, e in zip(cut[:-1], cut[1:]):
                own = order[s:e]
                used = np.unique(np.concatenate([x[own] for x in w]))
                remap[used] = np.arange(len(used), dtype=np.uint32)
                yield lang, int(bucket[own[0]]), pack([names[i] for i in used.tolist()],
                                                      [remap[x[own]] for x in w], n[own])
        self.numbers, self.held, self.size = _Numbers({_BREAK: 0}), {}, 0
        for lang, tail in tails.items():
            self.held[lang] = [np.array([self.numbers[x] for x in tail], np.int64)]


def _hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def pack(names: list[bytes], w: list[np.ndarray], n: np.ndarray) -> bytes:
    """Words and edges as one zstandard frame; numbers byte plane by byte plane. No word
    holds a line feed."""
    text = b"\n".join(names)
    planes = [x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for x in (*w, n)]
    head = np.array([len(text), len(n)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + text + b"".join(planes))


def unpack(data: bytes) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
    raw = common.unpack(data)
    size, rows = np.frombuffer(raw, "<i8", 2).tolist()
    x = np.frombuffer(raw, np.uint8, offset=16 + size).reshape(4, 4, rows).transpose(0, 2, 1)
    cols = [np.ascontiguousarray(c).view("<u4").ravel().astype(np.int64) for c in x]
    return raw[16:16 + size].split(b"\n"), cols[:3], cols[3]


def edge_counts(docs: DataFrame, buckets: int, block: int = WORDS) -> DataFrame:
    """(lang, bucket, packed): edges w1 w2 w3 as counted by the tasks; w3, or w2 and w3,
    are empty behind the last words of a piece."""
    common.ship_package(docs.sparkSession)

    def run(batches):
        counts = EdgeCounts(buckets, block)

        def rows(found):
            for lang, bucket, data in found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()), pa.array([bucket], pa.int64()), pa.array([data], pa.binary())],
                    names=["lang", "bucket", "packed"])
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                if text:
                    yield from rows(counts.add(lang, text))
        yield from rows(counts.flush())
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text").mapInArrow(
        run, "lang string, bucket long, packed binary")


def merged(packed: list[bytes]) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
    """(words, edges as three arrays of numbers, counts) of several packed rows, sorted
    by node; every edge once."""
    numbers = _Numbers()
    cols, counts = [[], [], []], []
    for data in packed:
        names, w, n = unpack(data)
        to = np.fromiter(map(numbers.__getitem__, names), np.int64, len(names))
        for held, x in zip(cols, w):
            held.append(to[x])
        counts.append(n)
    w1, w2, w3 = (np.concatenate(c) for c in cols)
    nodes_, of = np.unique(w1 << 32 | w2, return_inverse=True)
    edges, at = np.unique(of.ravel() << 32 | w3, return_inverse=True)
    n = np.zeros(len(edges), np.int64)
    np.add.at(n, at.ravel(), np.concatenate(counts))
    node = nodes_[edges >> 32]
    return list(numbers), [node >> 32, node & 0xFFFFFFFF, edges & 0xFFFFFFFF], n


def nodes(docs: DataFrame, least: int = LEAST, block: int = WORDS) -> DataFrame:
    """(lang, w1, w2, f, edges): nodes of flow ``least`` or more with their edges (w3, c)
    of ``least`` or more; and, with w2 null, a bucket's flow of all nodes that begin with
    w1."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = common.groups_for(size, BUCKET)

    def add_up(table: pa.Table) -> pa.Table:
        by_lang: dict[str, list[bytes]] = {}
        for lang, data in zip(table.column("lang").to_pylist(), table.column("packed").to_pylist()):
            by_lang.setdefault(lang, []).append(data)
        parts = []
        for lang, packed in by_lang.items():
            names, (w1, w2, w3), n = merged(packed)
            words_ = pa.array(names, pa.binary()).cast(pa.string())
            end = names.index(b"") if b"" in names else -1
            first = runs(w1 << 32 | w2)
            f = np.add.reduceat(n, first[:-1])
            a, b = w1[first[:-1]], w2[first[:-1]]
            # flow of the words
            start = runs(a)
            parts.append((lang, words_.take(pa.array(a[start[:-1]])), None, np.add.reduceat(f, start[:-1]), None))
            # frequent nodes and their frequent edges
            keep = (f >= least) & (b != end)
            heavy = (n >= least) & (w3 != end) & np.repeat(keep, np.diff(first))
            per_node = np.add.reduceat(heavy.astype(np.int64), first[:-1])[keep]
            edges = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(per_node)]).astype(np.int32)),
                pa.StructArray.from_arrays([words_.take(pa.array(w3[heavy])), pa.array(n[heavy])], names=["w3", "c"]))
            parts.append((lang, words_.take(pa.array(a[keep])), words_.take(pa.array(b[keep])), f[keep], edges))
        kind = pa.list_(pa.struct([("w3", pa.string()), ("c", pa.int64())]))
        schema = pa.schema([("lang", pa.string()), ("w1", pa.string()), ("w2", pa.string()), ("f", pa.int64()),
                            ("edges", kind)])
        return pa.concat_tables([pa.table([
            pa.array([lang] * len(f), pa.string()), w1, pa.nulls(len(f), pa.string()) if w2 is None else w2,
            pa.array(f), pa.nulls(len(f), kind) if edges is None else edges], schema=schema)
            for lang, w1, w2, f, edges in parts])

    return edge_counts(docs, buckets, block).groupBy("bucket").applyInArrow(
        add_up, "lang string, w1 string, w2 string, f long, edges array<struct<w3:string,c:long>>")


def unary_paths(edges: DataFrame, flow: DataFrame) -> DataFrame:
    """(lang, words, c): ``edges`` (lang, w1, w2, w3, c) with the unary ones strung
    together; every edge is in exactly one path. ``flow`` is (lang, w1, w2, f)."""
    ends = flow.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("f_end"))
    e = edges.join(flow.withColumnRenamed("f", "f_start"), ["lang", "w1", "w2"]).join(ends, ["lang", "w2", "w3"])
    e = common.shared_table(e.withColumn("id", F.monotonically_increasing_id()))
    # a node all of whose occurrences come by one edge and leave by one edge
    takes = e.where("c = f_start").select("lang", "w1", "w2", F.col("id").alias("next"))
    brings = e.where("c = f_end").select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"),
                                         F.col("id").alias("prev"))
    # pointer doubling towards the first edge of the path, `far` edges away
    ptr = common.shared_table(takes.join(brings, ["lang", "w1", "w2"]).where("next <> prev").select(
        F.col("next").alias("id"), F.col("prev").alias("to"), F.lit(1).cast("long").alias("far")))
    moving = ptr.count()
    while moving:
        step = ptr.select(F.col("id").alias("to"), F.col("to").alias("to2"), F.col("far").alias("far2"))
        ptr = common.shared_table(ptr.join(step, "to", "left").select(
            "id", F.coalesce("to2", "to").alias("to"), (F.col("far") + F.coalesce("far2", F.lit(0))).alias("far"),
            F.col("to2").isNotNull().alias("moved")))
        moving = ptr.where("moved").count()
        ptr = ptr.drop("moved")
    path = e.join(ptr, "id", "left").withColumns({
        "path": F.coalesce("to", "id"), "far": F.coalesce("far", F.lit(0).cast("long"))})
    # a path's words are those of one piece of text: bounded by a text, not by the corpus
    return path.groupBy("path").agg(
        F.first("lang").alias("lang"), F.first("c").alias("c"),
        F.array_sort(F.collect_list(F.struct("far", "w1", "w2", "w3"))).alias("s")).select(
        "lang", F.concat(F.array(F.col("s")[0]["w1"], F.col("s")[0]["w2"]),
                         F.transform("s", lambda x: x["w3"])).alias("words"), "c")


def _score(a: Column, l_: Column, r: Column) -> Column:
    """floor(10^6 a^2 / (l r)), exactly: whole decimals."""
    wide = [c.cast("decimal(19,0)") for c in (a, l_, r)]
    top = wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top, wide[1] * wide[2]).cast("long")


def mine(docs: DataFrame, least: int = LEAST, share: int = SHARE, per_lang: int = PER_LANG) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each lang's ``per_lang`` best phrases."""
    graph = common.shared_table(nodes(docs, least))
    flow = graph.where("w2 is not null").select("lang", "w1", "w2", "f")
    every = common.shared_table(graph.where("w2 is null").groupBy("lang", F.col("w1").alias("w")).agg(F.sum("f").alias("f")))
    total = every.groupBy("lang").agg(F.sum("f").alias("n"))
    edges = graph.select("lang", "w1", "w2", F.explode("edges").alias("e")).select(
        "lang", "w1", "w2", "e.w3", "e.c")
    paths = common.shared_table(unary_paths(edges, flow))

    # edges of the paths; inner nodes weigh as much as the path, its two end nodes are looked up
    at = F.posexplode(F.expr("transform(sequence(0, size(words) - 3), i -> slice(words, i + 1, 3))"))
    inner = (paths.select("lang", "c", F.size("words").alias("size"), at.alias("i", "w"))
             .select("lang", "c", *[F.col("w")[k].alias(f"w{k + 1}") for k in range(3)],
                     (F.col("i") == 0).alias("first"), (F.col("i") == F.col("size") - 3).alias("last")))
    inner = common.shared_table(inner)
    starts = flow.withColumnRenamed("f", "f_start")
    ends = flow.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("f_end"))
    known = inner.where("not first and not last").withColumns({"l2": F.col("c"), "r1": F.col("c")})
    asked = (inner.where("first or last").join(starts, ["lang", "w1", "w2"]).join(ends, ["lang", "w2", "w3"])
             .withColumnsRenamed({"f_start": "l2", "f_end": "r1"}))
    three = known.unionByName(asked)

    # nodes within an edge that weighs enough are dropped: end nodes by their edges, inner ones always
    heaviest = (inner.select("lang", "w1", "w2", "c")
                .unionByName(inner.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "c"))
                .groupBy("lang", "w1", "w2").agg(F.max("c").alias("most")))
    two = (flow.join(heaviest, ["lang", "w1", "w2"], "left")
           .where(F.col("most").isNull() | (F.col("most") * 100 < F.col("f") * share)))

    f1 = common.broadcast_if_small(every.where(F.col("f") >= least))
    fa = f1.select("lang", F.col("w").alias("w1"), F.col("f").alias("f1"))
    fb2 = f1.select("lang", F.col("w").alias("w2"), F.col("f").alias("f2"))
    fb3 = f1.select("lang", F.col("w").alias("w3"), F.col("f").alias("f3"))
    pairs = (two.join(fa, ["lang", "w1"]).join(fb2, ["lang", "w2"])
             .select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f").alias("a"),
                     F.col("f1").alias("l"), F.col("f2").alias("r"),
                     _score(F.col("f"), F.col("f1"), F.col("f2")).alias("score")))
    s1, s2 = _score(F.col("c"), F.col("f1"), F.col("r1")), _score(F.col("c"), F.col("l2"), F.col("f3"))
    triples = (three.join(fa, ["lang", "w1"]).join(fb3, ["lang", "w3"])
               .withColumns({"s1": s1, "s2": s2})
               .select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("c").alias("a"),
                       F.when(F.col("s1") <= F.col("s2"), F.col("f1")).otherwise(F.col("l2")).alias("l"),
                       F.when(F.col("s1") <= F.col("s2"), F.col("r1")).otherwise(F.col("f3")).alias("r"),
                       F.least("s1", "s2").alias("score")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = pairs.unionByName(triples).withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= per_lang)
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase",
                                           "a", "l", "r", "n", "score")
