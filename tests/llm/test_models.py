import hashlib
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from derrick.llm import ann, decontaminate, language, quality, secret_scan
from tests.llm.conftest import EDGE, EDGE_IDS, make

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_windows(text):
    raw = b"" if text is None else text.encode()
    return WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in raw))


def brute_hits(texts, items):
    out = []
    for t in texts:
        w, hit, found = brute_windows(t), set(), set()
        for item, x in items:
            iw = brute_windows(x)
            for a in range(max(1, len(iw) - 9)) if iw else ():
                win = iw[a:a + 10]
                for k in range(len(w) - len(win) + 1):
                    if w[k:k + len(win)] == win:
                        hit.update(range(k, k + len(win)))
                        found |= set() if item is None else {str(item)}
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit)))
    return out


def hits(df, items, **more):
    return [tuple(r) for r in decontaminate.decontaminate(df, items, **more).orderBy("doc_id").select(
        "_hit.n_words", "_hit.n_hit", "_hit.n_items", "_hit.items_sha256", "_hit.contaminated").collect()]


def test_decontamination(spark, sample):
    rows, df = sample
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    expected = brute_hits([r.text for r in rows], [(b.item_id, b.text) for b in bench.collect()])
    assert sum(e[4] for e in expected) >= 3
    assert hits(df, bench) == expected
    assert hits(df, bench, group_bytes=20_000) == expected


def test_decontamination_edges(spark):
    items = [(1, "Word"), (2, "same text here"), (2, "same text here"), (3, None), (4, "--"), (None, "x"), (None, "tail"),
             (10, "é ü"), (11, " ".join(["of text long words"] * 5))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = make(spark, EDGE, range(len(EDGE))).withColumn("n_hit", F.lit("clash"))
    expected = brute_hits(EDGE, items)
    assert expected[10][1:3] == (1, 0) and expected[10][4]          # hit by an item without an id
    assert hits(df, bench) == expected and hits(df, bench, group_bytes=50) == expected
    spans = {r.doc_id: [tuple(s) for s in r._hit.spans] for r in decontaminate.decontaminate(df, bench).collect()}
    assert spans[3] == [(0, 4)] and spans[4] == [(6, 7)]    # by an item without an id
    none = bench.limit(0)
    assert {r[4] for r in hits(df, none)} == {False} and hits(make(spark, []), bench) == []


def test_nearest_neighbours(spark):
    v = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {}
    for r in ann.search(v, v.where("vec_id % 100 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    rows = v.orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    same = total = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        best = [(s, i) for s, i in sorted(zip(d, ids)) if i != q][:10]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 11))
        assert all(abs(d[ids == m[1]][0] - m[2]) < 1e-12 for m in mine)
        assert [(m[2], m[1]) for m in mine] == sorted((m[2], m[1]) for m in mine)
        same += len({i for _, i in best} & {m[1] for m in mine})
        total += 10
    assert same / total >= 0.9


def test_nearest_neighbours_recall_with_many_lists(spark):
    """Spread-out vectors in more lists than a query visits."""
    rnd = np.random.default_rng(20)
    x = rnd.normal(size=(20_000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    v = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": list(x)}),
                              "vec_id long, embedding array<double>")
    asked = np.arange(0, len(x), 200)
    got = {}
    for r in ann.search(v, v.where("vec_id % 200 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    d = ann.distances(x[asked], x)
    d[np.arange(len(asked)), asked] = np.inf
    best = np.argsort(d, axis=1)[:, :10]
    assert np.mean([i in got[q] for q, own in zip(asked.tolist(), best.tolist()) for i in own]) >= 0.95


def test_nearest_neighbours_do_not_depend_on_parts_and_blocks(spark, monkeypatch):
    """Small task groups, lists in parts and queries in blocks give the same rows, and
    with all lists visited the answer is the brute-force one, ties to smaller ids."""
    rnd = np.random.default_rng(4)
    x = np.round(rnd.normal(size=(900, 3)) * 2) + [0.5, 0, 0]              # many ties
    v = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": list(x)}),
                              "vec_id long, embedding array<double>")
    asked = v.where("vec_id % 10 = 0")
    run = lambda: sorted(map(tuple, ann.search(v, asked, 5).collect()))
    whole = run()
    monkeypatch.setattr(ann, "PART", 20)
    monkeypatch.setattr(ann, "QUERIES", 7)
    monkeypatch.setattr(ann, "FIRST", 2)
    assert run() == whole
    want = []
    for q in range(0, len(x), 10):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        near = sorted((s, i) for i, s in enumerate(d.tolist()) if i != q)[:5]
        want += [(q, r, i, s) for r, (s, i) in enumerate(near, 1)]
    assert whole == sorted(want)


def test_nearest_neighbours_edges(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(60)]                      # one vector, many ids
    rows += [(100 + i, rnd.normal(size=3).tolist()) for i in range(40)] + [(200, rnd.normal(size=3).tolist())] * 2
    rows += [(300, None), (301, [0.0, 0.0, 0.0]), (302, [1.0, None, 1.0]), (303, [float("nan")] * 3),
             (304, [1.0, 2.0]), (305, []), (None, [1.0, 1.0, 1.0]), (400, [float("inf"), 0.0, 0.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = ann.search(v, v.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()
    assert {r.query_id for r in got} == {0, 100, 200}
    assert [(r.vec_id, r.score) for r in got if r.query_id == 0] == [(i, 0.0) for i in range(1, 11)]
    assert ann.search(v.limit(0), v.limit(0)).count() == 0
    two = v.where("vec_id in (0, 100)")
    assert [(r.query_id, r.vec_id) for r in ann.search(two, two).orderBy("query_id").collect()] == [(0, 100), (100, 0)]


def test_language_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in df.select("doc_id", "lang").collect()}
    got = language.identify(df, sample=600).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edges_and_switches(spark, sample):
    df = make(spark, EDGE, EDGE_IDS)
    got = language.identify(df).collect()
    assert sorted(r.lang_pred for r in got) == ["en"] * 7 + ["und"] * 4
    assert {r.lang_pred for r in language.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.identify(make(spark, [])).count() == 0
    model = language.train([("a", "xx xy yx " * 30), ("b", "mm mn nm " * 30)])
    words = [x for c in language.chains("xx xy yx mm mn nm") for x in c]
    post = model.posteriors(model.emissions(words)[None], np.array([6]))[0]
    assert post.argmax(axis=1).tolist() == [0, 0, 0, 1, 1, 1]
    # forward-backward equals the sum over all label sequences
    e, a = model.emissions(words[1:5]).astype(float), model.a.astype(float)
    paths = [(i, j, k, m) for i in (0, 1) for j in (0, 1) for k in (0, 1) for m in (0, 1)]
    weight = np.array([np.exp(sum(e[s, p[s]] for s in range(4)) + sum(a[p[s], p[s + 1]] for s in range(3)))
                       for p in paths])
    exact = [[weight[[p[s] == y for p in paths]].sum() / weight.sum() for y in (0, 1)] for s in range(4)]
    pad = np.zeros((1, 6, 2), np.float32)
    pad[0, :4] = e
    assert np.allclose(model.posteriors(pad, np.array([4]))[0, :4], exact, atol=1e-4)


KEYWORD = "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|" \
          "[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"


def brute_secrets(t):
    t = t or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(
        KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m.group(1)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]
    return [(("assign", "access", "hex")[k], a, e) for a, k, e in sorted(out)]


SECRETS = ["Api_Key='abcdef' x", "password:token:abcdef123", "secret = short", "token=\"" + "0f" * 20 + "\"",
           "AKIAAKIA" + "X" * 16 + " é AKIA12", "ſecret=abcdefgh toKen=abcdefgh", "f" * 24 + "g" + "0" * 23,
           "key q7Rz/81kLmXp0TtVw93bZy41Qa22 end", "passwd: \"a.b-c=d/e+f\"", "PASSWORD  :=  abcdefg"] + EDGE


def test_secrets(spark, sample):
    texts = SECRETS + [r.text for r in sample[0]]
    got = {r.doc_id: r for r in secret_scan.scan(make(spark, texts)).collect()}
    for i, t in enumerate(texts):
        base = brute_secrets(t)
        r = got[i]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(b[0] == k for b in base) for k in ("assign", "access", "hex"))
        line = ",".join(f"{k}:{a}:{e}" for k, a, e in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        own = [s for s in r.spans.split(",") if s and not s.startswith("model")]
        assert ",".join(own) == line
    # the key without a pattern is found by the models, and few ordinary words are
    assert "model:4:32" in got[7].spans
    assert sum(got[i].n_model > 0 for i in range(len(SECRETS), len(texts))) <= 0.02 * len(texts)
    assert secret_scan.scan(make(spark, [])).count() == 0


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    train, test = labels.where("doc_id % 4 <> 0"), labels.where("doc_id % 4 = 0")
    got = quality.judge(docs, train, *quality.site(docs)).join(test, "doc_id").select(
        F.col("_quality.rejected").alias("_rejected"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")).collect()
    caught = np.mean([r._rejected for r in got if r.bad])
    wrong = np.mean([r._rejected for r in got if not r.bad])
    assert caught > 0.85 and wrong < 0.01, (caught, wrong)


def test_quality_shrinks_sparse_sites(spark):
    model = {"": (-2.0,), "bad": (4.0,)}
    rows = [("bad text" if h == "dirty" and k % 10 else "fine text", h) for h in ("clean", "dirty") for k in range(200)]
    rows += [("bad text", "rare")]
    docs = spark.createDataFrame(rows, "text string, source string").withColumn("lang", F.lit(None).cast("string"))
    import derrick.llm.quality as q
    old, q.fit = q.fit, lambda *a, **k: model
    try:
        got = quality.judge(docs, docs, *quality.site(docs)).groupBy("source", "text").agg(
            F.max("_quality.posterior").alias("p")).collect()
    finally:
        q.fit = old
    p = {(r.source, r.text): r.p for r in got}
    assert p["clean", "fine text"] < p["dirty", "fine text"] and p["rare", "bad text"] < p["dirty", "bad text"]


def test_quality_edges(spark):
    df = make(spark, EDGE, EDGE_IDS).withColumn("source", F.lit(None).cast("string"))
    labels = spark.createDataFrame([(0, 1, None), (5, 0, 1), (5, 0, 1), (None, 1, 0), (999, 1, 0), (3, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality.judge(df, labels, *quality.site(df))
    assert got.count() == len(EDGE)
    assert quality.judge(df, labels.limit(0), *quality.site(df)).where("_quality.rejected").count() == 0
    none = make(spark, [])
    assert quality.judge(none, labels, *quality.site(none)).count() == 0
