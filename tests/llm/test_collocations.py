import random
import re
from collections import Counter

import pytest

from derrick.llm import collocations
from tests.llm.conftest import EDGE, EDGE_IDS, SCHEMA, make

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, share=50, top=2000):
    f = {}
    for lang, text in rows:
        own = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            own.update(tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for k, v in c.items() if len(k) == 1)
        cand = {k: v for k, v in c.items() if len(k) > 1 and v >= least}
        rows = []
        for p, a in cand.items():
            if len(p) == 2 and any(100 * v >= share * a and p in (q[:2], q[1:]) for q, v in cand.items() if len(q) == 3):
                continue
            cuts = [(1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]], n))
        for rank, (s, a, p, l_, r, n) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l_, r, n, -s))
    return sorted(out)


def check(spark, df, **kw):
    got = sorted(tuple(r) for r in collocations.mine(df, **kw).collect())
    assert got == brute([(r.lang, r.text) for r in df.collect()], **{"top": kw.get("per_lang", 2000), **{
        k: v for k, v in kw.items() if k != "per_lang"}})
    return got


def test_whole_sample(spark, sample):
    assert check(spark, sample[1])


def test_paths_branches_and_ties(spark):
    rnd = random.Random(4)
    long = " ".join(f"p{i}" for i in range(40))                     # one unary path
    texts = [f"{rnd.choice('abc')} {long} {rnd.choice('de')}." for _ in range(30)]
    texts += [" ".join(rnd.choice("a b c d e".split()) for _ in range(rnd.randint(0, 30))) for _ in range(60)]
    texts += ["der " * 50, "x y z", "x y z! x y; Z x y"] * 12 + ["É é É é"] * 11
    rnd.shuffle(texts)
    assert check(spark, make(spark, texts))
    check(spark, make(spark, texts), least=3, share=80, per_lang=7)


def test_langs_and_nulls(spark):
    rows = [(i, t, lang, None, None) for i, (t, lang) in enumerate(
        [("one two three", "en"), ("one two", None), ("one two", "und"), (None, "fr"), ("one two", "")] * 8)]
    got = check(spark, spark.createDataFrame(rows, SCHEMA), least=8)
    assert {r[0] for r in got} == {"en", "und", ""}


@pytest.mark.parametrize("block", [1, 50])
def test_blocks_of_a_task_do_not_matter(spark, sample, block):
    df = sample[1].limit(20)

    def total(b):
        rows = collocations.edge_counts(df, 3, b).collect()
        assert {r.bucket for r in rows} <= {0, 1, 2}
        out = Counter()
        for r in rows:
            names, w, n = collocations.merged([r.packed])
            for i in range(len(n)):
                out[r.lang, r.bucket, *(names[x[i]] for x in w)] += int(n[i])
        return out
    assert total(block) == total(1 << 22)


def test_flow_from_several_tasks(spark, sample):
    """Edges of many blocks and buckets add up to the same nodes."""
    df = sample[1].limit(40)

    def total(block, per):
        collocations.BUCKET, old = per, collocations.BUCKET
        try:
            rows = collocations.nodes(df.repartition(5), 2, block).collect()
        finally:
            collocations.BUCKET = old
        words = Counter()
        for r in rows:
            if r.w2 is None:
                words[r.lang, r.w1] += r.f
        return words, sorted((r.lang, r.w1, r.w2, r.f, sorted(tuple(e) for e in r.edges)) for r in rows if r.w2 is not None)
    assert total(300, 4000) == total(1 << 22, 1 << 30)


def test_long_text_in_segments(monkeypatch):
    monkeypatch.setattr(collocations, "_CUT", 16)
    text = "one two\tthree.four five six\nseven " * 20 + "x" * 100
    whole = collocations.words(text)
    assert [w for s in collocations._segments(text) for w in collocations.words(s)] == whole


def test_edges(spark):
    df = make(spark, EDGE, EDGE_IDS)
    for name in ("w1", "w2", "c", "f", "e", "path", "phrase", "id"):
        df = df.withColumn(name, df["n_chars"])
    check(spark, df)
    empty = collocations.mine(df.limit(0))
    assert empty.count() == 0 and empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
