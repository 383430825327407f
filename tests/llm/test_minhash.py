import random

import pytest

from derrick.llm import minhash
from tests.llm.conftest import EDGE, EDGE_IDS, make


def brute(texts, words=4, percent=80):
    """Smallest index of every text's group; every text an index."""
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        k = min(words, len(w))
        sets.append({b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


def check(spark, texts, **kw):
    got = sorted(tuple(r) for r in minhash.near_duplicates(make(spark, texts), **kw).select(
        "doc_id", "n_shingles", "component_id", "kept").collect())
    n, root = brute(texts)
    assert got == [(i, n[i], root[i], root[i] == i) for i in range(len(texts))]


def edited(rnd, base, n):
    """``base`` with n words replaced."""
    w = list(base)
    for i in rnd.sample(range(len(w)), n):
        w[i] = f"x{rnd.randrange(10 ** 6)}"
    return w


def test_whole_sample(spark, sample):
    rows, _ = sample
    check(spark, [r.text for r in rows])


@pytest.mark.parametrize("kw", [{}, {"crowded": 8, "window": 16, "block": 3000}])
def test_groups_at_the_threshold(spark, kw):
    """Texts of 60 to 200 words with 0 to 5 words changed lie on both sides of 0.8; the
    second run takes the crowded regions and the blocks of several chunks."""
    rnd = random.Random(5)
    texts = []
    for g in range(12):
        base = [f"w{rnd.randrange(5000)}" for _ in range(rnd.randint(60, 200))]
        texts += [" ".join(edited(rnd, base, rnd.randint(0, 5))) for _ in range(rnd.choice([1, 2, 10, 40]))]
    rnd.shuffle(texts)
    check(spark, texts, **kw)


def test_large_group_and_hangers_on(spark):
    """One group far beyond a chunk, and others that share half of its text."""
    rnd = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(edited(rnd, base, 1)) for _ in range(150)]
    texts += [" ".join(base[:70] + [f"y{g}_{i}" for i in range(50)]) for g in range(40)]
    texts += [texts[-1] + " tail", texts[-1].replace("y39_7 ", "")]
    check(spark, texts, crowded=8, window=32, block=2000)


def test_short_texts(spark):
    check(spark, ["a", "A", "a b", "a  b", "a b c d", "a b c d e", "a b c d", "", " \n", None, "é É", "é é"])


def test_edges(spark):
    df = make(spark, EDGE, EDGE_IDS)
    for name in ("sig", "row", "tokens", "component", "s1", "kept"):
        df = df.withColumn(name, df["n_chars"])
    got = sorted((tuple(r) for r in minhash.near_duplicates(df).select(
        "doc_id", "n_shingles", "component_id", "kept", "n_copies").collect()), key=str)
    assert got == sorted([
        (0, 0, 0, True, 1), (1, 0, 1, True, 1), (2, 0, 2, True, 1), (3, 1, 3, True, 1), (4, 1, 4, True, 1),
        (5, 1, 5, True, 2), (5, 1, 5, True, 2), (6, 1, 6, True, 1), (7, 4, 7, True, 1),
        (None, 0, None, True, 1), (None, 1, None, True, 1)], key=str)
    empty = minhash.near_duplicates(df.limit(0))
    assert empty.count() == 0 and empty.columns[:2] == ["doc_id", "n_shingles"]


def test_rows_without_an_id_and_repeated_ids(spark):
    base = " ".join(f"w{i}" for i in range(60))
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(make(
        spark, [base, base + " z", base + " z z", "other text of id seven", "quite another one here"],
        [9, None, 7, 7, None])).collect()), key=str)
    assert got == sorted([(9, 7, False), (None, 7, False), (7, 7, True), (7, 7, True), (None, None, True)], key=str)
