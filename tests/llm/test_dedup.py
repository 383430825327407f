import hashlib
import os
import random
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from derrick.llm import line_dedup, simhash, suffix_dedup
from derrick.llm.components import components
from derrick.session import ensure_checkpoint_dir
from tests.llm.conftest import EDGE, EDGE_IDS, make


def brute_suffix(texts, length):
    count, out = {}, []
    for t in texts:
        for a in range(len(t) - length + 1):
            count[t[a:a + length]] = count.get(t[a:a + length], 0) + 1
    for t in texts:
        hit = np.zeros(len(t) + 1, int)
        for a in range(len(t) - length + 1):
            if count[t[a:a + length]] > 1:
                hit[a:a + length] = 1
        kept = bytes(c for c, h in zip(t, hit) if not h)
        out.append((len(t), int(hit.sum()), int((np.diff(np.concatenate([[0], hit])) == 1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return out


def suffix_rows(df, length, bucket=suffix_dedup.BUCKET):
    cols = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted(tuple(r) for r in suffix_dedup.dedup(df, length, bucket).select(*cols).collect())


@pytest.mark.parametrize("bucket", [4096, 5])
def test_suffix_matches_brute_force(spark, sample, bucket):
    rows, df = sample
    got = suffix_rows(df, 200, bucket)
    assert got == sorted(brute_suffix([(r.text or "").encode() for r in rows], 200))


@pytest.mark.parametrize("seed", [1, 2])
def test_suffix_random_small_alphabet(spark, seed):
    rnd = random.Random(seed)
    bits = ["".join(rnd.choice("ab") for _ in range(rnd.randint(0, 60))) for _ in range(12)]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 4))) for _ in range(25)] + ["a" * 90]
    assert suffix_rows(make(spark, texts), 20, 6) == sorted(brute_suffix([t.encode() for t in texts], 20))


def test_suffix_hot_passage(spark):
    rnd = random.Random(3)
    word = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    shared = word(260)
    texts = [word(150) + shared + word(150) for _ in range(60)]
    assert suffix_rows(make(spark, texts), 200, 8) == sorted(brute_suffix([t.encode() for t in texts], 200))


def test_suffix_edges(spark):
    got = suffix_rows(make(spark, EDGE, EDGE_IDS), 200)
    assert got == sorted(brute_suffix([(t or "").encode() for t in EDGE], 200))
    assert suffix_dedup.dedup(make(spark, [])).count() == 0


@pytest.mark.parametrize("block", [30, 64, 1000])
def test_suffix_anchors_of_cut_texts_come_once(block):
    rnd = random.Random(block)
    texts = ["".join(rnd.choice("ab") for _ in range(n)).encode() for n in (3, 500, 25, 700, 90)]
    whole = [np.concatenate(x) for x in zip(*((d, p) for d, p, _, _ in suffix_dedup.text_anchors(texts, 20, False)))]
    parts = [np.concatenate(x) for x in zip(*((d, p) for d, p, _, _ in
                                              suffix_dedup.text_anchors(texts, 20, False, block)))]
    assert len(set(zip(*(x.tolist() for x in parts)))) == len(parts[0])
    assert set(zip(*(x.tolist() for x in parts))) == set(zip(*(x.tolist() for x in whole)))


def test_suffix_keeps_long_clean_texts(spark):
    rnd = random.Random(8)
    text = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=2_300_000))
    got = suffix_dedup.dedup(make(spark, [text, None])).select("n_bytes", "n_removed").collect()
    assert sorted(map(tuple, got)) == [(0, 0), (2_300_000, 0)]


def brute_print(text):
    raw = b"" if text is None else text.encode()
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in raw)
    w = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    sh = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_groups(prints, ids, bits=3):
    root = list(range(len(prints)))
    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits and root[a] != root[b]:
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    low = {r: min((i for i, x in zip(ids, root) if x == r and i is not None), default=None) for r in set(root)}
    return [low[r] for r in root]


def test_simhash_matches_brute_force(spark, sample):
    rows, df = sample
    prints = [brute_print(r.text) for r in rows]
    groups = brute_groups(prints, [r.doc_id for r in rows])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()}
    assert got == {r.doc_id: (f"{p:016x}", g) for r, p, g in zip(rows, prints, groups)}


def test_simhash_is_spark_xxhash64(spark):
    words = ["ab", "cd ef", "é ü z"]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w")).collect()]
    assert [x % (1 << 64) for x in got] == [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]


def test_simhash_edges(spark):
    df = make(spark, EDGE, EDGE_IDS)
    got = sorted((r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect())
    prints = [brute_print(t) for t in EDGE]
    assert got == sorted((f"{p:016x}", g) for p, g in zip(prints, brute_groups(prints, EDGE_IDS)))
    assert simhash.near_duplicates(make(spark, [])).count() == 0
    kept = simhash.one_of_each(df.withColumn("_th", F.lit("clash")))
    assert kept.columns == [*df.columns, "_th"]
    assert kept.count() == len(set(brute_groups(prints, list(range(len(EDGE))))))


def test_simhash_repeated_and_null_ids(spark):
    """Unlinked texts under one id stay apart; rows without an id link and bridge."""
    rnd = np.random.default_rng(9)

    def text(n):
        return " ".join(f"w{rnd.integers(0, 10 ** 6)}" for _ in range(n))
    a, b, c = text(400), text(400), text(400)
    rows = [(5, a), (5, b), (3, b + " end"), (None, c), (None, c + " z"), (None, a + " x"), (8, a + " x y"), (8, c)]
    prints = [brute_print(t) for _, t in rows]
    ids = [i for i, _ in rows]
    df = make(spark, [t for _, t in rows], ids)
    got = sorted(((r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()))
    groups = brute_groups(prints, ids)
    assert got == sorted((f"{p:016x}", g) for p, g in zip(prints, groups))
    place = brute_groups(prints, list(range(len(rows))))
    kept = sorted((r.doc_id is None, r.doc_id, r.text) for r in simhash.one_of_each(df).collect())
    best = {}
    for (i, t), g in zip(rows, place):
        best.setdefault(g, []).append((i is None, i or 0))
    assert len(kept) == len(best)
    assert sorted((k[0], k[1] or 0) for k in kept) == sorted(min(v) for v in best.values())


def test_trees_and_tiles_find_every_close_pair(spark, monkeypatch):
    rnd = np.random.default_rng(4)
    base = rnd.integers(0, 1 << 63, 60, dtype=np.uint64)
    flips = [np.uint64(sum(1 << int(b) for b in rnd.choice(64, k, replace=False))) for k in rnd.integers(0, 6, 900)]
    fp = np.unique(np.array([base[i % 60] ^ f for i, f in enumerate(flips)]))
    monkeypatch.setattr(simhash, "LEAF", 20)
    monkeypatch.setattr(simhash, "SHARD", 16)
    df = spark.createDataFrame([(int(x) - (1 << 64) if int(x) >> 63 else int(x), i) for i, x in enumerate(fp)],
                               "fp long, id long")
    found = {r.node: r.component for r in components(simhash.links(df)).collect()}
    expected = brute_groups([int(x) for x in fp], list(range(len(fp))))
    assert [found.get(i, i) for i in range(len(fp))] == expected


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + k: 100 for k in range(30)}}


def brute_lines(docs, shingle=5, t=0.8):
    """[(key, line)] to remove; docs are (id, text) of distinct ids."""
    lines = []
    for i, text in sorted((d for d in docs if d[1] is not None), key=lambda d: d[0]):
        for k, x in enumerate(text.split("\n")):
            w = x.lower().encode().split()
            if w:
                s = {b" ".join(w[a:a + shingle]) for a in range(max(1, len(w) - shingle + 1))}
                lines.append((i, k, s))
    out = set()
    for a, (i, k, s) in enumerate(lines):
        if any(len(s & u) / len(s | u) >= t - 1e-12 for _, _, u in lines[:a]):
            out.add((i, k))
    return out


def removed(df, *args):
    return {(r.doc_id, r.line) for r in line_dedup.removed_lines(df, *args).collect()}


def test_lines_match_brute_force(spark, sample):
    rows, df = sample
    assert removed(df) == brute_lines([(r.doc_id, r.text) for r in rows])


@pytest.mark.parametrize("shingle,tile", [(1, 4_000_000), (2, 40)])
def test_lines_random(spark, monkeypatch, shingle, tile):
    monkeypatch.setattr(line_dedup, "TILE_TOKENS", tile)
    rnd = random.Random(shingle)
    words = [f"w{i}" for i in range(40)]
    base = [[rnd.choice(words) for _ in range(rnd.randint(3, 25))] for _ in range(12)]
    texts = []
    for _ in range(40):
        lines = []
        for _ in range(rnd.randint(0, 5)):
            x = list(rnd.choice(base))
            for _ in range(rnd.randint(0, 2)):
                x[rnd.randrange(len(x))] = rnd.choice(words)
            lines.append(" ".join(x).title())
        texts.append("\n".join(lines))
    assert removed(make(spark, texts), shingle) == brute_lines(list(enumerate(texts)), shingle)


def test_lines_that_repeat_a_phrase(spark):
    """Different lines with one and the same small token set."""
    phrases = ["der", "ja nein", "eins zwei drei", "one two three four"]
    texts = [" ".join((p.split() * 50)[:n]) for n in (3, 5, 8, 9, 24, 41) for p in phrases]
    texts += ["der " * 7 + "ende", "der " * 12 + "ende", "nur der der der der der", "a b c d e f", "A b  c d e f"]
    docs = list(enumerate(texts))
    expected = brute_lines(docs)
    assert (20, 0) in expected and (25, 0) in expected
    assert removed(make(spark, texts)) == expected
    assert removed(make(spark, texts), 1) == brute_lines(docs, 1)


def test_lines_leave_no_tables_or_shuffles_behind(spark, sample):
    """Disk holds one step's shuffles at a time; the tables of the steps go with the last one."""
    def shuffles():
        held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return set(re.findall(r"shuffle_[0-9_]+", held.mkString(" ")))

    def tables():
        at = ensure_checkpoint_dir(spark).removeprefix("file:")
        return {os.path.join(d, f) for d, _, files in os.walk(at) for f in files if f.endswith(".parquet")}
    old, kept = shuffles(), tables()
    gone = line_dedup.removed_lines(sample[1])
    for _ in range(100):                                   # files are removed in the background
        if not (left := shuffles() - old):
            break
        time.sleep(0.1)
    assert not left
    assert len({os.path.dirname(t) for t in tables() - kept}) == 1 and gone.count() > 0


def test_lines_edges(spark):
    df = make(spark, EDGE, EDGE_IDS).withColumn("_th", F.lit(1)).withColumn("_n_removed", F.lit("x"))
    out = line_dedup.dedup(df).collect()
    assert len(out) == len(EDGE)
    by_text = {r.doc_id: r.text for r in out if r.doc_id is not None}
    assert by_text[0] is None and by_text[1] == "" and by_text[5] == "same text here"
    assert by_text[7] == "long words of text \n"           # all but the first line go
    assert line_dedup.dedup(make(spark, [])).count() == 0


def test_line_normalisation_and_token_order():
    """The quick ways (even texts, radix sort) give what the plain ones give."""
    rnd = np.random.default_rng(8)
    for _ in range(300):
        text = "".join(rnd.choice(list("Ab  \n\t\r\v\f\u0130\u00df."), size=rnd.integers(0, 40)).tolist())
        raw = text.lower().encode()
        assert line_dedup.normal_lines(text) == [b" ".join(x.split()) for x in raw.split(b"\n")]
    rank = line_dedup.rarity(rnd.integers(0, 9, line_dedup.CELLS))
    lines = [" ".join(rnd.choice(list("abc"), size=rnd.integers(1, 30))).encode() for _ in range(70_000)]
    line, token = line_dedup.line_tokens(lines, 5)
    got = line_dedup.ordered_sets(line, token, rank)
    full = rank[line_dedup.cell(token)].astype(np.uint64) << np.uint64(56) | token
    want = np.unique(np.array(list(zip(line.tolist(), full.tolist())), dtype=[("l", "i8"), ("t", "u8")]))
    assert (got[0] == want["l"]).all() and (got[1] == want["t"]).all()
    assert [len(x) for x in line_dedup.line_tokens([], 5)] == [0, 0]
