"""Scalar functions against pandas semantics (G1-G10 of the survey)."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from derrick.functions import exprs as X


def one_col(spark, values, dtype="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")


def col_values(df, name="y"):
    return [r[name] for r in df.orderBy("i").collect()]


def test_clip_keeps_null(spark):
    vals = [-1.0, 0.5, None, 2.0]
    got = col_values(one_col(spark, vals).select("i", X.clip("x", 0.0, 1.0).alias("y")))
    exp = pd.Series(vals, dtype="float64").clip(0, 1)
    assert [None if pd.isna(v) else v for v in exp] == got


def test_safe_div_zero_is_null(spark):
    df = spark.createDataFrame([(0, 10.0, 0.0), (1, 10.0, 4.0), (2, None, 1.0)],
                               "i int, a double, b double")
    got = col_values(df.select("i", X.safe_div("a", "b").alias("y")))
    assert got == [None, 2.5, None]


def test_concat_route_null(spark):
    df = spark.createDataFrame([(0, "A", "B"), (1, "A", None)], "i int, s string, d string")
    assert col_values(df.select("i", X.concat_route("s", "d").alias("y"))) == ["A -> B", None]


def test_bool_flag_null_is_zero(spark):
    got = col_values(one_col(spark, [1.0, -1.0, None]).select("i", X.bool_flag(F.col("x") > 0).alias("y")))
    assert got == [1, 0, 0]


@pytest.mark.parametrize("edge", [-1.0, 0.0, 120.0, 160.0, 200.0, 201.0, math.inf])
def test_bin_distance_edges(spark, edge):
    got = col_values(one_col(spark, [edge]).select("i", X.bin_distance("x").alias("y")))[0]
    exp = pd.cut(pd.Series([edge]), bins=[0, 120, 160, 200, np.inf],
                 labels=["short", "medium", "long", "very_long"], include_lowest=True)[0]
    assert got == (None if pd.isna(exp) else exp)


@pytest.mark.parametrize("edge", [-0.2, -0.1, 0.0, 33.0, 33.1, 66.0, 100.0, 100.1])
def test_bin_risk_edges(spark, edge):
    got = col_values(one_col(spark, [edge]).select("i", X.bin_risk("x").alias("y")))[0]
    exp = pd.cut(pd.Series([edge]), bins=[-0.1, 33, 66, 100], labels=["low", "medium", "high"])[0]
    assert got == (None if pd.isna(exp) else exp)


def test_case_action(spark):
    df = spark.createDataFrame([(0, "high"), (1, "medium"), (2, "low"), (3, None)], "i int, x string")
    assert col_values(df.select("i", X.case_action("x").alias("y"))) == [
        "replan immediately", "monitor and optimize", "keep current", "keep current"]


def test_round_half_even_matches_numpy(spark):
    vals = [66.05, 0.25, 12.35, 33.45, 1.15, 2.5]
    got = col_values(one_col(spark, vals).select("i", X.round_half_even("x", 1).alias("y")))
    assert got == [float(np.round(v, 1)) for v in vals]


def test_coerce_numeric(spark):
    vals = ["1.5", "bad", None, " 2 ", "1e3", "nan"]
    got = col_values(one_col(spark, vals, "string").select("i", X.coerce_numeric("x").alias("y")))
    exp = pd.to_numeric(pd.Series(vals), errors="coerce")
    assert got == [None if pd.isna(v) else v for v in exp]


def test_hours_between_ntz_and_ltz(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:00' a, TIMESTAMP_NTZ'2024-01-02 06:30:00' b")
    assert df.select(X.hours_between("a", "b").alias("h")).first()["h"] == 30.5
    df2 = df.select(F.col("a").cast("timestamp").alias("a"), F.col("b").cast("timestamp").alias("b"))
    assert df2.select(X.hours_between("a", "b").alias("h")).first()["h"] == 30.5


def test_row_max_abs_skips_null(spark):
    df = spark.createDataFrame([(0, -3.0, None), (1, 1.0, 2.0)], "i int, a double, b double")
    assert col_values(df.select("i", X.row_max_abs(["a", "b"]).alias("y"))) == [3.0, 2.0]


def _agg(df, **kw):
    from derrick.operators.aggregates import exact_agg
    return exact_agg(df, ["k"], **kw)


def test_exact_sums_need_no_scale(spark):
    df = spark.createDataFrame([(1, 0.12345), (1, 0.12345), (2, 1e300), (2, 1.0), (2, -1e300), (2, 5e-324),
                                (3, None), (None, 7.0), (4, float("inf")), (4, 1.0), (5, float("nan")), (5, -0.0)],
                               "k int, x double")
    got = {r.k: (r.s, r.m, r.n) for r in _agg(df, sums={"s": "x"}, means={"m": "x"}, counts={"n": "x"}).collect()}
    assert got == {1: (0.2469, 0.12345, 2), 2: (1.0, 0.25, 4), 3: (0.0, None, 0),
                   4: (float("inf"), float("inf"), 2), 5: (0.0, 0.0, 2)}


def test_exact_sums_are_order_independent_and_correctly_rounded(spark):
    import math
    rng = np.random.default_rng(8)
    x = rng.normal(size=4000) * 10.0 ** rng.integers(-6, 7, 4000)
    df = spark.createDataFrame([(int(i % 7), float(v)) for i, v in enumerate(x)], "k int, x double")
    a = sorted(tuple(r) for r in _agg(df, sums={"s": "x"}).collect())
    b = sorted(tuple(r) for r in _agg(df.orderBy("x").repartition(5), sums={"s": "x"}).collect())
    assert a == b == [(k, math.fsum(x[k::7])) for k in range(7)]


def test_double_parts_lose_nothing(spark):
    from fractions import Fraction
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.integers(-2 ** 63, 2 ** 63 - 1, 3000).view(np.float64),
                        2.0 ** np.arange(-1074, 1024), [0.0, 1.0, -1.0, 5e-324]])
    x = x[np.isfinite(x)]
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    b = X.double_bin(F.col("x"), X.double_size(F.col("x")))
    for r in df.withColumn("b", b).withColumn("p", X.double_part(F.col("x"), F.col("b"))).collect():
        assert Fraction(r.p) * Fraction(2) ** (8 * r.b) == Fraction(r.x) and abs(r.p) < 2 ** 62
