"""Change log against a sequential replay of the item rules."""

import random
from datetime import datetime, timedelta

from derrick.operators import changes as CH
from tests.conftest import rows


def replay(log):
    items, rejects = {}, []
    created = set()
    for seq, op, i, title, desc, done, ts in sorted(log):
        def bad_title(t):
            return t is not None and not (1 <= len(t) <= 200)
        if op == "create":
            if title is None or bad_title(title) or (desc is not None and len(desc) > 2000):
                rejects.append(seq)
            elif i in created:
                rejects.append(seq)
            else:
                created.add(i)
                items[i] = [title, desc, False, ts]
        elif op == "update":
            if bad_title(title) or (desc is not None and len(desc) > 2000):
                rejects.append(seq)
            elif i not in items:
                rejects.append(seq)
            else:
                it = items[i]
                it[0] = title if title is not None else it[0]
                it[1] = desc if desc is not None else it[1]
                it[2] = done if done is not None else it[2]
        else:
            if i not in items:
                rejects.append(seq)
            else:
                del items[i]
    return sorted((i, *v) for i, v in items.items()), sorted(rejects)


def random_log(n=600, ids=25, seed=0):
    rnd = random.Random(seed)
    t0 = datetime(2024, 1, 1)
    titles = [None, "", "a", "t" * 200, "t" * 201, "ok"]
    out = []
    for seq in range(n):
        op = rnd.choice(["create", "create", "update", "update", "update", "delete"])
        title = rnd.choice(titles) if op != "delete" else None
        desc = rnd.choice([None, "d", "x" * 2001]) if op != "delete" else None
        done = rnd.choice([None, True, False]) if op == "update" else None
        out.append((seq, op, rnd.randrange(ids), title, desc, done, t0 + timedelta(seconds=seq)))
    return out


def test_changes_apply_equals_replay(spark):
    for seed in range(3):
        log = random_log(seed=seed)
        df = spark.createDataFrame(log, "seq long, op string, id long, title string, "
                                        "description string, completed boolean, ts timestamp")
        snap, rej = CH.changes_apply(df)
        exp_items, exp_rej = replay(log)
        assert rows(snap.select(*CH.ITEM_COLUMNS)) == exp_items
        assert sorted(r["seq"] for r in rej.collect()) == exp_rej


def test_validation_title_lengths(spark):
    log = [(i, "create", i, "t" * n, None, None, datetime(2024, 1, 1)) for i, n in
           enumerate([0, 1, 200, 201])]
    df = spark.createDataFrame(log, "seq long, op string, id long, title string, "
                                    "description string, completed boolean, ts timestamp")
    assert [r["valid"] for r in CH.changes_validate(df).orderBy("seq").collect()] == \
        [False, True, True, False]


def test_lookup_and_newest_first(spark):
    items = spark.createDataFrame([(1, "a", None, False, datetime(2024, 1, 1)),
                                   (3, "c", None, True, datetime(2024, 1, 1))],
                                  "id long, title string, description string, completed boolean, "
                                  "created_at timestamp")
    req = spark.createDataFrame([(1,), (2,)], "id long")
    assert rows(CH.lookup_by_id(items, req).select("id", "found")) == [(1, True), (2, False)]
    assert [r["id"] for r in CH.snapshot_newest_first(items).collect()] == [3, 1]


def test_changes_apply_equals_replay_large(spark):
    log = random_log(n=4000, ids=200, seed=42)
    df = spark.createDataFrame(log, "seq long, op string, id long, title string, "
                                    "description string, completed boolean, ts timestamp")
    snap, rej = CH.changes_apply(df)
    exp_items, exp_rej = replay(log)
    assert rows(snap.select(*CH.ITEM_COLUMNS)) == exp_items
    assert sorted(r["seq"] for r in rej.collect()) == exp_rej
