"""Model jobs: least squares, forests, isolation forest, splits."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from derrick.models import isolation_forest as IF
from derrick.models import training as M


def test_ols_matches_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    y = x @ np.array([1.5, -2.0, 0.5]) + 3.0 + rng.normal(scale=0.1, size=300)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=y)
    model = M.fit_linear(spark.createDataFrame(pdf), ["a", "b", "c"], "y")
    lr = model.stages[-1]
    X = np.column_stack([np.ones(300), x])
    beta = np.linalg.lstsq(X, y, rcond=None)[0]
    assert np.allclose([lr.intercept, *lr.coefficients], beta, atol=1e-8)


def test_forest_beats_mean_and_is_deterministic(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(size=(600, 2))
    y = np.where(x[:, 0] > 0.5, 10.0, 0.0) + x[:, 1]
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"]).assign(y=y))
    m1 = M.fit_forest_regressor(df, ["a", "b"], "y", num_trees=10)
    m2 = M.fit_forest_regressor(df, ["a", "b"], "y", num_trees=10)
    p1 = M.predict(m1, df, "p")
    mse = p1.agg(F.avg((F.col("y") - F.col("p")) ** 2)).first()[0]
    assert mse < np.var(y) / 10
    a = [r["p"] for r in p1.orderBy("a").collect()]
    b = [r["p"] for r in M.predict(m2, df, "p").orderBy("a").collect()]
    assert a == b


def test_isolation_forest_flags_planted_outliers(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 3))
    x[:10] += 12.0
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(rid=np.arange(2000))
    df = spark.createDataFrame(pdf)
    out = IF.fit_predict(df, ["a", "b", "c"], "rid", contamination=0.1, n_trees=50)
    res = out.toPandas()
    assert abs(res["is_anomaly_iforest"].mean() - 0.1) < 0.01
    assert res.loc[res.rid < 10, "is_anomaly_iforest"].all()
    assert res.iforest_score.between(0, 1).all()
    # same model whatever the partitioning
    out2 = IF.fit_predict(df.repartition(7), ["a", "b", "c"], "rid", contamination=0.1, n_trees=50)
    s1 = res.sort_values("rid").iforest_score.to_numpy()
    s2 = out2.toPandas().sort_values("rid").iforest_score.to_numpy()
    assert np.allclose(s1, s2)


def test_splits(spark):
    df = spark.range(20000).withColumn("label", (F.col("id") % 5 == 0).cast("int"))
    share = M.split_train_test(df, ["id"]).agg(F.avg(F.col("is_test").cast("double"))).first()[0]
    assert abs(share - 0.25) < 0.02
    strat = M.split_stratified(df, ["id"], "label")
    got = {r["label"]: r["n"] for r in strat.where("is_test").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert got == {0: 4000, 1: 1000}                       # the share is exact
    w = M.balanced_weights(df, "label")
    got = {r["label"]: r["weight"] for r in w.select("label", "weight").distinct().collect()}
    assert got == {0: 20000 / (2 * 16000), 1: 20000 / (2 * 4000)}


def test_isolation_forest_samples_by_one_rule(spark):
    """Every tree has the rows of lowest hash, at any size and partitioning."""
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(9000, 2)), 6)
    for n, parts in ((20, 1), (31, 2), (9000, 1), (9000, 5)):
        df = spark.createDataFrame(pd.DataFrame(x[:n], columns=["a", "b"]).assign(rid=np.arange(n))).repartition(parts)
        model = IF.fit(df, ["a", "b"], "rid", n_trees=4, max_samples=32)
        keys = df.select("rid", F.xxhash64("rid", F.lit(42)).alias("k")).toPandas().sort_values("rid")["k"].to_numpy()
        h = IF.tree_hashes(keys.view(np.uint64), 4)
        for t in range(4):
            own = np.argsort(h[t])[:32]
            depth = int(np.ceil(np.log2(max(len(own), 2))))
            want = IF._grow(t, x[own], 42, depth)
            got = model.trees[model.trees.tree == t].sort_values("node").reset_index(drop=True)
            assert (got[want.columns] == want).all().all()


def test_isolation_forest_is_blind_to_rows_outside_the_samples(spark):
    """More rows change scores only through the samples: no switch at a size."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 2))
    x[:5] += 15.0
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"]).assign(rid=np.arange(4000)))
    a = IF.fit(df.where("rid < 1279"), ["a", "b"], "rid", n_trees=10, max_samples=32).trees
    b = IF.fit(df.where("rid < 1281"), ["a", "b"], "rid", n_trees=10, max_samples=32).trees
    same = sum(a[a.tree == t].equals(b[b.tree == t]) or
               a[a.tree == t].reset_index(drop=True).equals(b[b.tree == t].reset_index(drop=True)) for t in range(10))
    assert same >= 9
    res = IF.fit_predict(df, ["a", "b"], "rid", contamination=0.05, n_trees=10, max_samples=32).toPandas()
    assert res.loc[res.rid < 5, "is_anomaly_iforest"].all()


def test_stratified_split_of_many_classes(spark):
    """20,000 classes, NULL one of them, and one class with a third of all rows."""
    df = spark.range(60000).selectExpr(
        "id", "IF(id % 3 = 0, 'hot', IF(id % 30000 = 1, NULL, concat('c', id % 20000))) AS label")
    sizes = {r[0]: r[1] for r in df.groupBy("label").count().collect()}
    got = M.split_stratified(df, ["id"], "label", 0.25).where("is_test").groupBy("label").count().collect()
    assert {r[0]: r[1] for r in got} == {c: n for c, v in sizes.items() if (n := int(v * 0.25 + 0.5))}
    first = sorted(r.id for r in M.split_stratified(df, ["id"], "label").where("is_test").collect())
    again = sorted(r.id for r in M.split_stratified(df.repartition(5), ["id"], "label").where("is_test").collect())
    assert first == again
    w = M.balanced_weights(df, "label")
    assert w.where("weight is null").count() == 0 and w.count() == 60000
