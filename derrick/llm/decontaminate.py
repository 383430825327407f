"""Benchmark decontamination with one Aho-Corasick automaton.

Documents and benchmark items (questions and answers) are normalised alike: A-Z
are lower-cased and words are runs of digits, letters and non-ASCII bytes, joined
by single spaces. A window is ``window`` consecutive words of an item; an item of
fewer words, but not none, is one window. All windows, each between two spaces, go
into one automaton, and one pass over a document finds every occurrence,
overlapping ones included. Matches are mapped to word numbers and from there to
character offsets of the original text.

The automaton is broadcast. Its size is checked first: window bytes are summed per
item, items are dealt to groups of at most ``GROUP_BYTES``, and each group gets
its own scan; hits of the groups are united per document. One group is one
automaton and one scan.

Defined results: null text and null items have no words; items without an id hit
and contaminate like any other, but are not among the items counted and named; items
that repeat count once per item_id; rows that repeat an id stay rows; empty tables give no hits (or
no rows); other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derrick.llm import common

WINDOW = 10
#: bytes of window text per automaton (its tables take some ten times as much)
GROUP_BYTES = 4 << 20

#: A-Z to a-z; everything below 0x80 that is no digit or letter to a space
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode().translate(_NORMAL).split()


def windows(text: str | None, window: int) -> list[bytes]:
    """Distinct windows of an item, as the strings searched for."""
    w = words(text)
    if not w:
        return []
    return list(dict.fromkeys(b" " + b" ".join(w[i:i + window]) + b" "
                              for i in range(max(1, len(w) - window + 1))))


def automaton(items: list[tuple[int, str]], window: int):
    """One automaton over the windows of the items; a match gives (words, item ids)."""
    owners: dict[bytes, set] = {}
    for item, text in items:
        for x in windows(text, window):
            owners.setdefault(x, set()).add(item)
    if not owners:
        return None
    a = ahocorasick.Automaton()
    for x, who in owners.items():
        # one character per byte
        a.add_word(x.decode("latin-1"), (x.count(b" ") - 1, tuple(who)))
    a.make_automaton()
    return a


def scan(text: str | None, a) -> tuple[int, list[tuple[int, int]], set]:
    """Words of a text, hit word ranges (merged) and the items found."""
    w = words(text)
    if not w or a is None:
        return len(w), [], set()
    joined = b" " + b" ".join(w) + b" "
    found = list(a.iter(joined.decode("latin-1")))
    if not found:
        return len(w), [], set()
    ends = np.cumsum([len(x) + 1 for x in w])         # place of the space behind each word
    last = np.searchsorted(ends, [f[0] for f in found])
    spans: list[list[int]] = []
    items: set = set()
    ranges = set()
    for k, (_, (n, who)) in zip(last.tolist(), found):
        ranges.add((k - n + 1, k + 1))
        items.update(who)
    for x, y in sorted(ranges):
        if spans and x <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], y)
        else:
            spans.append([x, y])
    return len(w), [tuple(s) for s in spans], items


def original_spans(text: str, spans: list) -> list[dict]:
    """Character offsets in the original text of ranges of words."""
    at = [m.span() for m in _WORD.finditer(text)]
    return [{"start": at[x][0], "stop": at[y - 1][1]} for x, y in spans]


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
_HIT = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                  ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("spans", _SPAN)])
_HIT_SQL = ("struct<n_words:long,n_hit:long,n_items:long,items_sha256:string,contaminated:boolean,"
            "spans:array<struct<start:long,stop:long>>>")


def _result(text: str | None, n: int, spans: list, items: set) -> dict:
    named = sorted(str(i) for i in items if i is not None)
    names = ",".join(named)
    return {"n_words": n, "n_hit": sum(y - x for x, y in spans), "n_items": len(named),
            "items_sha256": hashlib.sha256(names.encode()).hexdigest(), "contaminated": bool(spans),
            "spans": original_spans(text, spans) if spans else []}


def decontaminate(docs: DataFrame, benchmark: DataFrame, name: str = "_hit", window: int = WINDOW,
                  group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``docs`` with a struct column ``name``: n_words, n_hit, n_items, items_sha256,
    contaminated, spans (start and stop characters in the original text)."""
    spark = docs.sparkSession
    common.ship_package(spark)
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(
        "text is not null")
    # an item's windows take at most `window` times its own bytes
    total = bench.agg(F.sum(F.octet_length("text").cast("double") * window)).first()[0] or 0.0
    groups = common.groups_for(int(total), group_bytes)
    held = []
    for g in range(groups):
        own = bench if groups == 1 else bench.where(common.hashed(F.struct("item_id", "text"), groups) == g)
        held.append(spark.sparkContext.broadcast([tuple(r) for r in own.collect()]))
    schema = T.StructType([*docs.schema.fields,
                           T.StructField(name, T._parse_datatype_string(_HIT_SQL))])
    where = docs.columns.index("text")

    def append(b, results):
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(results, _HIT)], names=[*b.schema.names, name])

    if groups == 1:
        def whole(batches):
            a = automaton(held[0].value, window)
            for b in batches:
                yield append(b, [_result(t, *scan(t, a)) for t in b.column(where).to_pylist()])
        return docs.mapInArrow(whole, schema)

    def ranges(items):
        def run(batches):
            a = automaton(items.value, window)
            for b in batches:
                found = [scan(t, a) for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("_th"),
                     pa.array([[{"start": x, "stop": y} for x, y in f[1]] for f in found], _SPAN),
                     pa.array([sorted(i for i in f[2] if i is not None) for f in found], pa.list_(pa.int64()))],
                    names=["doc_id", "_th", "_ranges", "_items"])
        return run
    parts = None
    for h in held:
        x = common.documents(docs).mapInArrow(ranges(h), "doc_id long, _th long, "
                                              "_ranges array<struct<start:long,stop:long>>, _items array<long>")
        parts = x if parts is None else parts.unionByName(x)
    hits = parts.where("size(_ranges) > 0").groupBy(*common.KEY).agg(
        F.flatten(F.collect_set("_ranges")).alias("_ranges"), F.flatten(F.collect_set("_items")).alias("_items")) \
        .withColumnsRenamed({"doc_id": "_r_id", "_th": "_r_th"})
    joined = docs.join(hits, docs["doc_id"].cast("long").eqNullSafe(hits["_r_id"])
                       & F.xxhash64(docs["text"]).eqNullSafe(hits["_r_th"]), "left")

    def unite(batches):
        for b in batches:
            out = []
            cols = b.columns
            for t, r, items in zip(cols[where].to_pylist(), cols[-2].to_pylist(), cols[-1].to_pylist()):
                spans: list[list[int]] = []
                for x in sorted((y["start"], y["stop"]) for y in r or ()):
                    if spans and x[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], x[1])
                    else:
                        spans.append(list(x))
                out.append(_result(t, len(words(t)), spans, set(items or ())))
            yield append(pa.RecordBatch.from_arrays(cols[:-2], names=b.schema.names[:-2]), out)
    return joined.select(*[docs[c] for c in docs.columns], hits["_ranges"], hits["_items"]).mapInArrow(unite, schema)
