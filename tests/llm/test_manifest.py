import hashlib
import random
import zlib

import pytest
from pyspark.sql import types as T

from derrick.llm import manifest
from tests.llm.conftest import EDGE, EDGE_IDS, SCHEMA, make


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    vals = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for pos, (_, _, own, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            low = "".join(c.lower() if c.isascii() else c for c in r["text"]) if r["text"] is not None else None
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            node, proof = leaf(r, low) if bad else own, ""
            for tree, i in ((trees[s], pos), (top, k)):
                for lv in tree[:-1]:
                    a = i // 16 * 16
                    left, right = "".join(lv[a:i]), "".join(lv[i + 1:a + 16])
                    node, proof, i = H(left, node, right), proof + left + right, i // 16
            out.append((r["doc_id"], own, trees[s][-1][0], top[-1][0], H(proof), node, node == top[-1][0]))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in manifest.manifest(df, manifest.lower_cased(5)).collect()), key=str)


def test_whole_sample(spark, sample):
    rows, df = sample
    assert got(df) == brute([r.asDict() for r in rows])


@pytest.mark.parametrize("sizes", [[1], [16], [17], [1, 1, 300, 16, 17, 256, 257] + [1] * 20])
def test_runs_of_every_size(spark, sizes):
    rnd = random.Random(1)
    rows = [(rnd.randrange(10 ** 6), f"Text {i} É", "en", None if s == 3 else f"s{s}", i)
            for s, n in enumerate(sizes) for i in range(n)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == brute([r.asDict() for r in df.collect()])


def test_several_leaf_partitions(spark, monkeypatch):
    monkeypatch.setattr(manifest, "BLOCK", 16)
    monkeypatch.setattr(manifest, "BROADCAST_NODES", 3)
    df = make(spark, [f"T {i}" for i in range(700)])
    assert got(df) == brute([r.asDict() for r in df.collect()])


def test_part_of_the_leaves(spark):
    """Proofs of a few leaves fetch what those leaves lack, down to the lowest level."""
    df = make(spark, [f"T {i}" for i in range(300)])
    placed = manifest.place(manifest.leaves(df))
    tree = manifest.Tree(placed)
    some = placed.where("pos in (0, 1, 40, 299)")
    found = manifest.prove(some, tree, with_proof=True).collect()
    want = {x[0]: x for x in brute([r.asDict() for r in df.collect()])}
    assert len(found) == 4 and all(r.verified and r.proof_sha256 == want[r.doc_id][4] == H(r.proof) for r in found)


def test_missing_is_minimal():
    """Leaves 0 and 1 of 300 supply each other; nothing is asked that they can derive."""
    import numpy as np
    got = manifest.missing(np.array([0, 0]), np.array([0, 1]), np.array([300, 300]), 1)
    assert [(lv, i.tolist()) for lv, _, i in got] == [(0, list(range(2, 16))), (1, list(range(1, 16))), (2, [1])]
    whole = manifest.missing(np.zeros(300, int), np.arange(300), np.full(300, 300), 1)
    assert sum(len(i) for _, _, i in whole) == 0


def test_edges(spark):
    df = make(spark, EDGE, EDGE_IDS)
    for name in ("src", "pos", "n", "h", "leaf", "part", "_id", "presented"):
        df = df.withColumn(name, df["n_chars"])
    assert got(df) == brute([r.asDict() for r in df.collect()])
    empty = manifest.manifest(df.limit(0))
    assert empty.count() == 0 and "verified" in empty.columns


def test_nulls_in_every_column(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "", "", 0), (1, "A", None, "b", None)]
    df = spark.createDataFrame(rows, T.StructType(SCHEMA.fields))
    assert got(df) == brute([r.asDict() for r in df.collect()])
