"""Operators against pandas / brute force."""

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from derrick.operators import aggregates as AG
from derrick.operators import clean as CL
from derrick.operators import joins as J
from derrick.operators import windows as WN
from derrick.operators import group_stats, stats
from derrick.operators.stats import quantiles, quantiles_multi
from tests.conftest import rows


def test_quantiles_exact_small_and_bracketed(spark):
    rng = np.random.default_rng(1)
    vals = rng.normal(size=3000).round(6)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    exp = list(np.quantile(vals, probs))
    got = quantiles(df, "x", probs)
    assert np.allclose(got, exp, rtol=0, atol=1e-12)


@pytest.mark.parametrize("k,error,values", [(1024, 0.01, 3), (8, 0.001, 3), (8, 0.2, 100)])
def test_quantiles_in_several_rounds(spark, monkeypatch, k, error, values):
    """Brackets that are too wide, or miss the rank as the sketch is bad, end exactly."""
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=4000).round(6), rng.integers(0, 3, 4000).astype(float)
    b[:1500], b[1500:2990] = -7.0, 9.0                        # heavy ends around the middle
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": b}))
    for name, v in (("KLL_K", k), ("ERROR", error), ("VALUES", values)):
        monkeypatch.setattr(stats, name, v)
    probs = [0.0, 0.01, 0.25, 0.37, 0.5, 0.62, 0.75, 1.0]
    got = quantiles_multi(df, {"a": probs, "b": probs})
    for c, v in (("a", a), ("b", b)):
        assert np.allclose(got[c], np.quantile(v, probs), rtol=0, atol=1e-12)


def test_quantiles_all_null_and_ties(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert quantiles(df, "x", [0.5]) == [None]
    df2 = spark.createDataFrame([(1.0,)] * 5 + [(2.0,)], "x double")
    assert quantiles(df2, "x", [0.5, 0.9]) == list(np.quantile([1.0] * 5 + [2.0], [0.5, 0.9]))


def test_iqr_filter_sequential(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"a": rng.normal(size=400).round(3), "b": rng.normal(size=400).round(3)})
    pdf.loc[::37, "a"] = 9.0
    pdf.loc[::41, "b"] = None
    out = pdf.copy()
    for c in ["a", "b"]:
        q1, q3 = out[c].quantile(0.25), out[c].quantile(0.75)
        out = out[(out[c] >= q1 - 1.5 * (q3 - q1)) & (out[c] <= q3 + 1.5 * (q3 - q1))]
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double")
    got = CL.iqr_filter(df, ["a", "b"])
    assert got.count() == len(out)


def test_impute_group_median_pandas(spark):
    pdf = pd.DataFrame({"k": [1, 1, 1, 2, 2, None, 3], "x": [1.0, None, 3.0, None, None, None, 5.0]})
    exp = pdf.groupby("k")["x"].transform(lambda s: s.fillna(s.median()))
    df = spark.createDataFrame([(None if pd.isna(k) else int(k), None if pd.isna(x) else x, i)
                                for i, (k, x) in enumerate(zip(pdf.k, pdf.x))], "k long, x double, i int")
    got = [r["x"] for r in CL.impute_group_median(df, "k", ["x"]).orderBy("i").collect()]
    assert got == [None if pd.isna(v) else v for v in exp]


def test_rank_pct_matches_pandas(spark):
    vals = [3.0, 1.0, 3.0, None, 2.0, 3.0, 1.0, float("nan")]
    exp = pd.Series(vals).rank(pct=True)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = [r["r"] for r in WN.rank_pct(df, "x", "r").orderBy("i").collect()]
    assert got == [None if pd.isna(v) else v for v in exp]


def test_latest_per_key_null_time_wins(spark):
    df = spark.createDataFrame(
        [(1, 1, datetime(2024, 1, 1)), (1, 2, datetime(2024, 1, 3)), (1, 3, None),
         (2, 4, datetime(2024, 1, 2)), (2, 5, datetime(2024, 1, 2))],
        "k long, rid long, ts timestamp")
    got = rows(WN.latest_per_key(df, "k", ["ts", "rid"]).select("k", "rid"))
    assert got == [(1, 3), (2, 5)]


def _sensor_frames(spark, n_pumps=5, n_sensors=400, n_fail=40, seed=3):
    rnd = random.Random(seed)
    t0 = datetime(2024, 1, 1)
    sens = [(i, rnd.randrange(n_pumps), t0 + timedelta(minutes=rnd.randrange(60 * 24 * 10)))
            for i in range(n_sensors)]
    fails = [(100 + j, rnd.randrange(n_pumps), t0 + timedelta(minutes=rnd.randrange(60 * 24 * 10)))
             for j in range(n_fail)]
    # exact-boundary cases: reading at failure time and exactly 24 h before
    fails.append((999, 0, sens[0][2]))
    fails.append((998, 1, sens[1][2] + timedelta(hours=24)))
    s = spark.createDataFrame(sens, "record_id long, pump_id long, timestamp timestamp_ntz")
    f = spark.createDataFrame(fails, "failure_id long, pump_id long, failure_date timestamp_ntz")
    return s, f, sens, fails


@pytest.mark.parametrize("parts", [None, 1, 40])
def test_join_next_event_equals_theta_join(spark, parts):
    s, f, sens, fails = _sensor_frames(spark)
    got = {r["record_id"]: r["nxt"] for r in
           J.join_next_event(s, f, "pump_id", "timestamp", "failure_date", "nxt", parts).collect()}
    assert len(got) == len(sens)
    for rid, pump, ts in sens:
        cands = [fd for _, p, fd in fails if p == pump and fd >= ts]
        assert got[rid] == (min(cands) if cands else None)


def test_join_next_event_far_events_and_null_keys(spark):
    """An event in the year 2999, 40 % rows without a key, a row without a time, equal times,
    and a key whose readings fill several partitions."""
    from datetime import datetime
    start = datetime(2024, 1, 1)
    sens = [(i, None if i % 5 < 2 else (7 if i % 5 < 4 else i % 11), None if i == 44 else start + timedelta(hours=i))
            for i in range(600)]
    fails = [(7, datetime(2999, 1, 1)), (7, start + timedelta(hours=100)), (7, start + timedelta(hours=102)),
             (3, start + timedelta(hours=64)), (None, start + timedelta(hours=300)), (8, None)]
    s = spark.createDataFrame(sens, "rid long, k long, t timestamp_ntz")
    f = spark.createDataFrame(fails, "k long, ft timestamp_ntz")
    for parts in (1, 13):
        got = {r.rid: r.n for r in J.join_next_event(s, f, "k", "t", "ft", "n", parts).collect()}
        assert len(got) == 600
        for rid, k, t in sens:
            after = [x for fk, x in fails if k is not None and fk == k and t and x and x >= t]
            assert got[rid] == (min(after) if after else None)


def test_join_time_range_equals_brute_force(spark):
    s, f, sens, fails = _sensor_frames(spark)
    got = rows(J.join_time_range(s, f, "pump_id", "timestamp", "failure_date", 24.0)
               .select("failure_id", "record_id"))
    exp = sorted((fid, rid) for fid, fp, fd in fails for rid, sp, ts in sens
                 if sp == fp and fd - timedelta(hours=24) <= ts <= fd)
    assert got == exp


def test_join_left_composite_null_safe(spark):
    l = spark.createDataFrame([(1, "a"), (None, "b")], "k long, x string")
    r = spark.createDataFrame([(1, "r1"), (None, "rn")], "k long, y string")
    assert rows(J.join_left_composite(l, r, ["k"], null_safe=True)) == [(1, "a", "r1"), (None, "b", "rn")]
    assert rows(J.join_left_composite(l, r, ["k"])) == [(1, "a", "r1"), (None, "b", None)]


def test_broadcast_if_small_bound(spark):
    df = spark.range(10)
    small = J.broadcast_if_small(df, 100)
    plan = small._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan.lower()
    assert J.broadcast_if_small(df, 5) is df


def test_corr_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, None)], "x double, y double")
    assert df.agg(AG.corr_pairwise("x", "y").alias("c")).first()["c"] is None
    df2 = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, 5.9), (None, 1.0)], "x double, y double")
    exp = pd.DataFrame({"x": [1.0, 2.0, 3.0, None], "y": [2.0, 4.1, 5.9, 1.0]}).corr().iloc[0, 1]
    assert abs(df2.agg(AG.corr_pairwise("x", "y").alias("c")).first()["c"] - exp) < 1e-12


def test_group_by_dropna_and_total(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, 1.0)], "k string, v double")
    out = AG.group_by_dropna(df, ["k"]).agg(AG.total("v").alias("s")).collect()
    assert [(r["k"], r["s"]) for r in out] == [("a", 0.0)]


def test_full_domain_empty_buckets(spark):
    df = spark.createDataFrame([("short", 1.0), ("short", 3.0)], "b string, d double")
    out = AG.agg_full_domain(df, "b", ["short", "medium"], F.count("d").alias("trips"),
                             F.avg("d").alias("avg"), zero_cols=["trips"])
    assert rows(out) == [("medium", 0, None), ("short", 2, 2.0)]


def test_result_independent_of_shuffle_partitions(spark):
    from derrick.plans.catalog import QUERIES
    import derrick.plans.catalog_ops  # noqa: F401
    outs = []
    for n in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        outs.append(rows(QUERIES["mart_route_optimization"](spark, "/root/testdata/sf0.001")))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert outs[0] == outs[1]


def test_global_ranks_many_buckets_match_pandas(spark):
    from derrick.operators.ranking import global_rank_pct, global_row_number
    rng = np.random.default_rng(5)
    vals = rng.integers(0, 300, size=2000).astype(float)
    vals[::97] = np.nan
    pdf = pd.DataFrame({"i": np.arange(2000), "x": vals})
    df = spark.createDataFrame([(int(i), None if np.isnan(x) else float(x)) for i, x in
                                zip(pdf.i, pdf.x)], "i long, x double")
    exp_pct = pdf.x.rank(pct=True)
    got = {r["i"]: r["p"] for r in global_rank_pct(df, F.col("x"), "p", partitions=50).collect()}
    for i, e in zip(pdf.i, exp_pct):
        assert (got[i] is None) if pd.isna(e) else abs(got[i] - e) < 1e-12
    exp_rn = pdf.sort_values(["x", "i"], ascending=[False, True], na_position="last").i.tolist()
    rn = global_row_number(df, "x", True, ["i"], "rn", partitions=20)
    got_rn = [r["i"] for r in rn.orderBy("rn").collect()]
    assert got_rn == exp_rn
    assert [r["rn"] for r in rn.orderBy("rn").collect()] == list(range(1, 2001))


def test_group_quantile_hot_group_exact(spark):
    from derrick.operators.clean import group_medians
    rng = np.random.default_rng(11)
    n = 20_000
    k = np.where(rng.uniform(size=n) < 0.35, 0, rng.integers(1, 6, size=n))
    v = rng.normal(size=n).round(6)
    v[::500] = np.nan
    pdf = pd.DataFrame({"k": k, "v": v, "w": (v * 0).round(1)})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "k long, v double, w double")
    got = {r["k"]: (r["__med_v"], r["__med_w"]) for r in
           group_medians(df, "k", ["v", "w"]).collect()}
    exp_v, exp_w = pdf.groupby("k")["v"].median(), pdf.groupby("k")["w"].median()
    for kk in exp_v.index:
        assert abs(got[kk][0] - exp_v[kk]) < 1e-12
        assert got[kk][1] == exp_w[kk]


@pytest.mark.parametrize("k,error,values", [(256, 0.03, 5), (8, 0.001, 5), (8, 0.3, 50)])
def test_group_quantiles_in_several_rounds(spark, monkeypatch, k, error, values):
    rng = np.random.default_rng(12)
    n = 6000
    g = np.where(rng.uniform(size=n) < 0.35, 0, rng.integers(1, 9, size=n))
    pdf = pd.DataFrame({"k": g, "v": rng.normal(size=n).round(6), "t": rng.integers(0, 3, n).astype(float)})
    pdf.loc[pdf.k == 8, "v"] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "k long, v double, t double")
    for name, v in (("KLL_K", k), ("ERROR", error), ("VALUES", values)):
        monkeypatch.setattr(group_stats, name, v)
    for p in (0.0, 0.3, 0.5, 1.0):
        got = {r["k"]: (r["v"], r["t"]) for r in group_stats.group_quantiles(df, ["k"], ["v", "t"], p).collect()}
        assert len(got) == 9 and got[8][0] is None
        for kk, own in pdf.groupby("k"):
            assert got[kk][1] == own["t"].quantile(p)
            assert kk == 8 or abs(got[kk][0] - own["v"].quantile(p)) < 1e-12


def test_global_row_number_heavy_tie_split(spark):
    from derrick.operators.ranking import global_row_number
    rng = np.random.default_rng(9)
    n = 3000
    x = np.where(rng.uniform(size=n) < 0.4, 5.0, rng.integers(0, 50, size=n).astype(float))
    pdf = pd.DataFrame({"i": rng.permutation(n), "x": x})
    df = spark.createDataFrame([(int(i), float(v)) for i, v in zip(pdf.i, pdf.x)], "i long, x double")
    for desc in (False, True):
        rn = global_row_number(df, "x", desc, ["i"], "rn", partitions=15)
        got = [r["i"] for r in rn.orderBy("rn").collect()]
        exp = pdf.sort_values(["x", "i"], ascending=[not desc, True]).i.tolist()
        assert got == exp
        assert sorted(r["rn"] for r in rn.collect()) == list(range(1, n + 1))


def test_global_row_number_string_tiebreak_and_nulls(spark):
    """A string tie-break, 30 % NULLs, a heavy tie, many partitions and int results
    past what one partition holds: still 1..n in order."""
    from derrick.operators.ranking import global_row_number
    rng = np.random.default_rng(4)
    n = 4000
    u = rng.uniform(size=n)
    data = [(f"k{i:05d}", None if a < 0.3 else 7.0 if a < 0.6 else float(rng.integers(0, 500)))
            for i, a in zip(rng.permutation(n), u)]
    df = spark.createDataFrame(data, "k string, x double")
    got = global_row_number(df, "x", True, ["k"], "rn", partitions=500)
    assert dict(got.dtypes)["rn"] == "bigint" and got.columns == ["k", "x", "rn"]
    exp = sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0.0), r[0]))
    assert [(r["k"], r["rn"]) for r in got.orderBy("rn").collect()] == [
        (k, i + 1) for i, (k, _) in enumerate(exp)]
    assert global_row_number(df.limit(0), "x", True, ["k"], "rn").count() == 0


def test_temporal_joins_with_a_hot_pump(spark):
    """One pump holds 40 % of readings and failures: both joins still equal
    the brute-force theta join."""
    rnd = random.Random(21)
    t0 = datetime(2024, 1, 1)
    pump = lambda: 0 if rnd.random() < 0.4 else rnd.randrange(1, 6)
    sens = [(i, pump(), t0 + timedelta(minutes=rnd.randrange(60 * 24 * 20))) for i in range(600)]
    fails = [(1000 + j, pump(), t0 + timedelta(minutes=rnd.randrange(60 * 24 * 20)))
             for j in range(60)]
    s = spark.createDataFrame(sens, "record_id long, pump_id long, timestamp timestamp_ntz")
    f = spark.createDataFrame(fails, "failure_id long, pump_id long, failure_date timestamp_ntz")
    got = {r["record_id"]: r["nxt"] for r in
           J.join_next_event(s, f, "pump_id", "timestamp", "failure_date", "nxt", 11).collect()}
    for rid, p, ts in sens:
        cands = [fd for _, fp, fd in fails if fp == p and fd >= ts]
        assert got[rid] == (min(cands) if cands else None)
    pairs = rows(J.join_time_range(s, f, "pump_id", "timestamp", "failure_date", 24.0)
                 .select("failure_id", "record_id"))
    assert pairs == sorted((fid, rid) for fid, fp, fd in fails for rid, sp, ts in sens
                           if sp == fp and fd - timedelta(hours=24) <= ts <= fd)


def test_rank_pct_reads_its_input_once(spark):
    """The ranked rows are joined back to what was ranked, not computed anew."""
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(40).selectExpr("id", "double(id % 5) AS x").mapInArrow(look, "id long, x double")
    got = WN.rank_pct(df, "x", "r").collect()
    assert len(got) == 40 and {r["r"] for r in got if r["x"] == 0} == {4.5 / 40}
    assert seen.value == 40


def test_exact_agg_of_many_groups(spark):
    """Rows brought together first: the same sums, to the last bit, and one exchange of
    rows instead of cells for every measure."""
    from derrick.operators.aggregates import exact_agg
    df = spark.range(500).selectExpr(
        "IF(id % 11 = 0, NULL, id % 7) AS k", "IF(id % 5 = 0, NULL, id / 3 - 40) AS v",
        "IF(id % 13 = 0, double('nan'), pow(2, id % 90 - 45)) AS w").repartition(5)
    kw = {"counts": {"n": "v"}, "sums": {"s": "v", "t": "w"}, "means": {"m": "w"}}
    few, many = exact_agg(df, ["k"], **kw), exact_agg(df, ["k"], **kw, many=True)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) and few.count() == 7
    assert exact_agg(df.where("k > 99"), ["k"], **kw, many=True).count() == 0
