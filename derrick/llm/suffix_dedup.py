"""Exact repeated-substring removal by bucket-pointer refinement.

A byte is removed when some ``length``-byte string that covers it also starts
anywhere else in the corpus (same document included). With q = length / 2:

1. Initial q-gram buckets. Of all suffixes only *anchors* are kept: positions
   whose q-gram hash is the minimum of some run of length - q + 1 starts. Every
   ``length``-byte string holds such an anchor at an offset that depends on its
   bytes alone, so equal strings share an anchor bucket at the same offset.
   Buckets of one anchor drop out by a map-side combined count.
2. Anchors whose whole context (all strings around the anchor) also repeats are
   settled: everything in the context is removed.
3. In the other buckets, one representative per context is refined: strings are
   sorted on the bucket identifiers of their start and of the start + q, where
   identifiers found once are reused for every string that passes them.
4. Buckets of more contexts than fit a task are first refined by longer grams:
   the range of possible offsets is halved, each half has a longer gram common
   to all its strings, and its hash is the identifier of the finer bucket. Halves
   are refined recursively until a bucket fits or its gram is the string itself.

Identifiers are 64-bit hashes used in pairs (gram and context, or two grams).

Defined results: null text is an empty document; texts under ``length`` bytes
keep everything; rows that repeat an id and its text are documents of their own
(each is the other's copy); an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.llm import common
from derrick.llm.rolling import Prefix, mix, runs, sliding

LENGTH = 200
#: bytes hashed at once, so a very long text never needs more memory
BLOCK = 1 << 20
#: contexts of one bucket that are refined in a task (some 2.5 kB each); larger
#: buckets are halved
BUCKET = 50_000
#: contexts per task group
GROUP = 8_000

_SIGN = np.uint64(1)


def block_anchors(buf: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor positions of a buffer of pieces (``starts`` has their bounds) and
    their q-gram hashes."""
    q = length // 2
    w = length - q + 1
    n = len(buf)
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = Prefix(buf).grams(q) | _SIGN
    m = sliding(g, w, np.minimum, np.uint64(0xFFFFFFFFFFFFFFFF))
    # starts whose string would cross the end of its piece
    edge = np.zeros(len(m) + 1, np.int32)
    begin, end = starts[:-1], starts[1:] - length + 1
    keep = end > begin
    np.add.at(edge, begin[keep], 1)
    np.add.at(edge, end[keep], -1)
    m[np.cumsum(edge[:-1]) == 0] = 0
    pad = np.zeros(w - 1, np.uint64)
    top = sliding(np.concatenate([pad, m, pad]), w, np.maximum, np.uint64(0))
    at = np.flatnonzero((g == top) & (top != 0))
    return at, g[at]


def pieces(texts: list[bytes], length: int, block: int = BLOCK):
    """Blocks of (document number, first byte, bytes); texts over ``block`` bytes
    are cut into pieces that overlap by length - 1."""
    held, size = [], 0
    for i, t in enumerate(texts):
        if len(t) < length:
            continue
        for at in range(0, max(1, len(t) - length + 1), block):
            part = t[at:at + block + length - 1]
            held.append((i, at, part))
            size += len(part)
            if size >= block:
                yield held
                held, size = [], 0
    if held:
        yield held


def text_anchors(texts: list[bytes], length: int, with_context: bool, block: int = BLOCK):
    """(document number, position, gram hash, context hash) arrays per block, every
    anchor once."""
    q = length // 2
    open_doc, seen = -1, np.zeros(0, np.int64)      # the last text of the block before
    for held in pieces(texts, length, block):
        starts = np.cumsum([0] + [len(p[2]) for p in held])
        at, g = block_anchors(np.frombuffer(b"".join(p[2] for p in held), np.uint8), starts, length)
        piece = np.searchsorted(starts, at, "right") - 1
        doc = np.array([p[0] for p in held], np.int64)[piece]
        pos = at - starts[piece] + np.array([p[1] for p in held], np.int64)[piece]
        # pieces of one text overlap and may find the same anchor
        order = np.lexsort((pos, doc))
        doc, pos, g = doc[order], pos[order], g[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1])
        # a text cut between two blocks shows the anchors of the overlap in both
        new &= (doc != open_doc) | ~np.isin(pos, seen)
        doc, pos, g = doc[new], pos[new], g[new]
        last = held[-1][0]
        seen = np.concatenate([seen if last == open_doc else seen[:0], pos[doc == last]])
        seen, open_doc = seen[seen >= held[-1][1]], last
        ctx = None
        if with_context:
            low, high = np.maximum(0, pos - (length - q)), pos + length
            ctx = np.fromiter((xxhash.xxh3_64_intdigest(texts[d][a:b], d_) for d, a, b, d_ in
                               zip(doc.tolist(), low.tolist(), high.tolist(), (pos - low).tolist())),
                              np.uint64, len(doc))
        yield doc, pos, g, ctx


def _texts(batch) -> list[bytes]:
    return [b"" if t is None else t.encode() for t in batch.column("text").to_pylist()]


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, _th, a, h, c) of every anchor."""
    def run(batches):
        for b in batches:
            ids, th = b.column("doc_id"), b.column("_th")
            for doc, pos, g, ctx in text_anchors(_texts(b), length, True):
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), th.take(take), pa.array(pos), pa.array(g.view(np.int64)),
                     pa.array(ctx.view(np.int64))], names=["doc_id", "_th", "a", "h", "c"])
    return docs.mapInArrow(run, "doc_id long, _th long, a long, h long, c long")


def _contexts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Context bytes of the wanted anchors: (doc_id, _th, a, h, single, start, ctx)."""
    q = length // 2
    per_doc = wanted.groupBy(*common.KEY).agg(
        F.collect_list(F.struct("a", "h", "single")).alias("w"))
    joined = common.null_safe(common.packed_texts(docs), per_doc, common.KEY, "inner")

    def run(batches):
        for b in batches:
            out = []
            for i, th, z, w in zip(b.column("doc_id").to_pylist(), b.column("_th").to_pylist(),
                                   b.column("z").to_pylist(), b.column("w").to_pylist()):
                t = common.unpack(z)
                for x in w:
                    low = max(0, x["a"] - (length - q))
                    out.append((i, th, x["a"], x["h"], x["single"], low, t[low:x["a"] + length]))
                if len(out) > 5000:
                    yield _batch(out)
                    out = []
            yield _batch(out)

    def _batch(rows):
        cols = list(zip(*rows)) if rows else [()] * 7
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                          names=["doc_id", "_th", "a", "h", "single", "start", "ctx"])
    return joined.mapInArrow(
        run, "doc_id long, _th long, a long, h long, single boolean, start long, ctx binary")


def repeated_starts(doc: np.ndarray, anchor: np.ndarray, start: np.ndarray, texts: list[bytes],
                    length: int) -> list[np.ndarray]:
    """For every context (document number, anchor, first byte, bytes), the sorted
    starts of its strings that also start elsewhere in these contexts. Equal strings
    have their anchor at the same offset, so each offset is sorted by itself."""
    q = length // 2
    far = length - q
    left = anchor - start
    size = np.array([len(t) for t in texts], np.int64)
    n = len(texts)
    key, two = np.zeros((far + 1, n), np.uint64), np.zeros((far + 1, n), np.uint64)
    fits = np.zeros((far + 1, n), bool)
    for x in range(0, n, 2000):
        own = slice(x, min(n, x + 2000))
        base = np.cumsum(size[own]) - size[own]
        gram = Prefix(np.frombuffer(b"".join(texts[own]), np.uint8)).grams(q)   # initial buckets
        for d in range(far + 1):
            s = left[own] - d
            ok = (s >= 0) & (s + length <= size[own])
            at = (base + s)[ok]
            one, later = gram[at], gram[at + far]       # refinement: the identifier further on
            i = x + np.flatnonzero(ok)
            key[d, i], two[d, i], fits[d, i] = mix(one * np.uint64(3) + later), later, True
    hits = np.zeros((far + 1, n), bool)
    for d in range(far + 1):
        i = np.flatnonzero(fits[d])
        if len(i) < 2:
            continue
        i = i[np.argsort(key[d, i], kind="stable")]
        k1, k2 = key[d, i], two[d, i]
        cut = np.concatenate([[0], np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1])
        place = doc[i] * (1 << 40) + anchor[i] - d
        many = np.minimum.reduceat(place, cut) != np.maximum.reduceat(place, cut)
        hits[d, i] = np.repeat(many, np.diff(np.append(cut, len(i))))
    return [anchor[i] - np.flatnonzero(hits[:, i])[::-1] for i in range(n)]


def merged(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal runs covered by the strings at these sorted starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length) + 1
    first = starts[np.concatenate([[0], cut])]
    last = starts[np.concatenate([cut - 1, [len(starts) - 1]])]
    return list(zip(first.tolist(), (last + length).tolist()))


_SPANS = "doc_id long, _th long, start long, stop long"


def _refined(contexts: DataFrame, groups: int, length: int) -> DataFrame:
    """Removed spans found inside the buckets of ``contexts``."""
    def run(table: pa.Table) -> pa.Table:
        ids, th = table.column("doc_id").to_pylist(), table.column("_th").to_pylist()
        number: dict = {}
        doc = np.array([number.setdefault(k, len(number)) for k in zip(ids, th)], np.int64)
        anchor, start = table.column("a").to_numpy(), table.column("start").to_numpy()
        single = table.column("single").to_pylist()
        out = []
        found = repeated_starts(doc, anchor, start, table.column("ctx").to_pylist(), length)
        for i, s in enumerate(found):
            if single[i] and len(s):
                out += [(ids[i], th[i], a, b) for a, b in merged(s, length)]
        cols = list(zip(*out)) if out else [()] * 4
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "_th", "start", "stop"])
    return (contexts.withColumn("_g", common.hashed("h", groups)).groupBy("_g")
            .applyInArrow(run, _SPANS))


def _halved(contexts: DataFrame, length: int) -> DataFrame:
    """Finer buckets: each half of the offset range with its longer gram. Rows
    whose range is a single offset come back with lo = hi and their own string."""
    def run(batches):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                ctx, left = r["ctx"], r["a"] - r["start"]
                lo, hi = r["lo"], r["hi"]
                mid = (lo + hi) // 2
                for x, y in ((lo, mid), (mid + 1, hi)) if lo < hi else ():
                    # offsets d in x..y for which the string fits in this context
                    least, most = max(x, left + length - len(ctx)), min(y, left)
                    if least > most:
                        continue
                    gram = ctx[left - x:left + length - y]
                    h = xxhash.xxh3_64_intdigest(gram, 1 + x * 1000 + y)
                    low, high = left - most, left + length - least
                    rows.append((r["doc_id"], r["_th"], r["a"], h - (1 << 64) if h >> 63 else h,
                                 r["single"], r["start"] + low, ctx[low:high], x, y))
            cols = list(zip(*rows)) if rows else [()] * 9
            types = [pa.int64()] * 4 + [pa.bool_(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=_NODE_COLS)
    return contexts.mapInArrow(run, _NODE)


_NODE_COLS = ["doc_id", "_th", "a", "h", "single", "start", "ctx", "lo", "hi"]
_NODE = ("doc_id long, _th long, a long, h long, single boolean, start long, ctx binary, "
         "lo long, hi long")


def removed_spans(docs: DataFrame, length: int = LENGTH, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, _th, start, stop): overlapping byte spans to remove."""
    q = length // 2
    d = common.documents(docs)
    anchors = _anchors(d, length)
    # one gram value with one context value needs no comparison: all copies
    # (written before the join: AQE splits a hot gram only if no aggregate shares its stage)
    counts = common.shared_table(anchors.groupBy("h").agg(
        F.count(F.lit(1)).alias("n"), F.min("c").alias("c0"), F.max("c").alias("c1")).where("n > 1")
        .select("h", (F.col("c0") != F.col("c1")).alias("mixed")))
    shared = common.shared_table(anchors.join(counts, "h"))
    whole = shared.where("not mixed")
    mixed = shared.where("mixed").groupBy("h", "c").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "_th", "a")).alias("rep"))
    settled = (shared.where("mixed").join(mixed.where("n > 1").select("h", "c"), ["h", "c"], "left_semi")
               .select(*common.KEY, "a"))
    buckets = mixed.groupBy("h").agg(F.count(F.lit(1)).alias("k"),
                                     F.max((F.col("n") == 1).cast("int")).alias("open")).where("open = 1")
    wanted = mixed.join(buckets, "h").select(
        F.col("rep.doc_id").alias("doc_id"), F.col("rep._th").alias("_th"),
        F.col("rep.a").alias("a"), "h", (F.col("n") == 1).alias("single"), "k")
    full = whole.select(*common.KEY, "a").unionByName(settled).select(
        *common.KEY, F.greatest(F.lit(0).cast("long"), F.col("a") - (length - q)).alias("start"),
        (F.col("a") + length).alias("stop"))
    contexts = common.shared_table(_contexts(d, wanted, length).join(buckets.select("h", "k"), "h"))
    spans = full
    todo, lo_hi = contexts, (0, length - q)
    todo = todo.withColumn("lo", F.lit(lo_hi[0]).cast("long")).withColumn("hi", F.lit(lo_hi[1]).cast("long"))
    while True:
        sizes = todo.agg(F.count_if(F.col("k") <= bucket).alias("s"),
                         F.count_if(F.col("k") > bucket).alias("b")).first()
        if sizes["s"]:
            spans = spans.unionByName(_refined(todo.where(F.col("k") <= bucket),
                                               common.groups_for(sizes["s"], GROUP), length))
        if not sizes["b"]:
            return spans
        big = todo.where(F.col("k") > bucket)
        # a bucket whose gram is the whole string: all its members are repeats
        spans = spans.unionByName(big.where("lo = hi and single").select(
            *common.KEY, F.col("start"), (F.col("start") + length).alias("stop")))
        finer = _halved(big.where("lo < hi").drop("k"), length)
        # distinct places decide, as one document may hold overlapping contexts
        ks = finer.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
        todo = common.shared_table(finer.join(ks, "h"))


def dedup(docs: DataFrame, length: int = LENGTH, bucket: int = BUCKET) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans
    (array of start and stop bytes) and kept (the remaining bytes)."""
    spans = removed_spans(docs, length, bucket)
    per_doc = spans.groupBy(*common.KEY).agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("s"))
    joined = common.null_safe(common.packed_texts(common.documents(docs)), per_doc, common.KEY, "left")

    def run(batches):
        for b in batches:
            out = []
            for z, s in zip(b.column("z").to_pylist(), b.column("s").to_pylist()):
                t = common.unpack(z)
                cut: list[list[int]] = []
                for x in s or ():
                    stop = min(x["stop"], len(t))
                    if cut and x["start"] <= cut[-1][1]:
                        cut[-1][1] = max(cut[-1][1], stop)
                    else:
                        cut.append([x["start"], stop])
                edges = [0] + [e for c in cut for e in c] + [len(t)]
                kept = b"".join(t[a:e] for a, e in zip(edges[::2], edges[1::2]))
                out.append((len(t), len(t) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(),
                            [{"start": a, "stop": e} for a, e in cut], kept))
            cols = list(zip(*out)) if out else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id")] + [pa.array(c, t) for c, t in zip(cols, _TYPES)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, "
                             "kept_sha256 string, spans array<struct<start:long,stop:long>>, kept binary")


_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(),
          pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.binary()]
