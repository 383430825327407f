"""Marts: the literal golden of the top-products mart and edge cases."""

from datetime import date, datetime, timedelta

import pytest

from derrick.plans import equipment as EQ
from derrick.plans import forecast as FC
from derrick.plans import logistics as L
from derrick.plans import production as P
from derrick.plans import products as PR
from derrick.sources import tables as TB
from tests.conftest import rows

# --- fixed values: the 14 literal input rows of the top-products mart ---
USERS = [("u1", "Berlin"), ("u2", "Berlin"), ("u3", "Munich"), ("u4", "Hamburg")]
ORDERS = [("o1", "u1", "p1", 2, 10.0), ("o2", "u1", "p2", 1, 30.0),
          ("o3", "u2", "p1", 1, 10.0), ("o4", "u2", "p3", 5, 7.0),
          ("o5", "u3", "p2", 3, 30.0), ("o6", "u3", "p3", 1, 7.0),
          ("o7", "u4", "p1", 10, 10.0)]
PRODUCTS = [("p1", "Ring VOLA"), ("p2", "Ring POROG"), ("p3", "Ring TISHINA")]
# --- end of fixed values ---


def test_city_top_products_literal_golden(spark):
    users = TB.scan_literal(spark, USERS, "user_id string, city string")
    orders = TB.scan_literal(spark, ORDERS, "order_id string, user_id string, product_id string, "
                                            "qty long, price double")
    prods = TB.scan_literal(spark, PRODUCTS, "product_id string, product_name string")
    got = rows(PR.city_top_products(users, orders, prods, n=2))
    assert got == [
        ("Berlin", "p1", "Ring VOLA", 2, 3, 30.0),
        ("Berlin", "p3", "Ring TISHINA", 1, 5, 35.0),
        ("Hamburg", "p1", "Ring VOLA", 1, 10, 100.0),
        ("Munich", "p2", "Ring POROG", 1, 3, 90.0),
        ("Munich", "p3", "Ring TISHINA", 1, 1, 7.0),
    ]


def _empty(spark, table):
    from derrick.schemas import INPUTS
    return spark.createDataFrame([], INPUTS[table])


def test_empty_inputs_keep_schemas(spark):
    prod, tele, wells = (_empty(spark, t) for t in ("production", "telemetry", "wells"))
    feats = P.feature_table(P.clean_production(prod), tele)
    assert P.daily_production(feats).columns == P.DAILY_COLUMNS
    assert P.daily_production(feats).count() == 0
    assert P.well_kpi(feats, wells).columns == P.WELL_KPI_COLUMNS
    sens, fails = _empty(spark, "pump_sensors"), _empty(spark, "pump_failures")
    pre = EQ.pre_failure_signals(sens, fails)
    assert pre.columns == EQ.PRE_FAILURE_COLUMNS and pre.count() == 0


def test_best_worst_overlap_with_few_wells(spark):
    kpi = spark.createDataFrame([(1, 10.0, 1), (2, 5.0, 2)],
                                "well_id long, avg_oil_ton double, performance_rank int")
    got = rows(P.best_worst_wells(kpi).select("well_id", "segment"))
    assert got == [(1, "best"), (1, "worst"), (2, "best"), (2, "worst")]


def test_zscore_zero_spread(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0), (1.0, 6.0)], "a double, b double")
    got = [r["m"] for r in EQ.zscore_global(df, ["a", "b"], "m").collect()]
    assert sorted(got) == pytest.approx([0.0, 1.224744871391589, 1.224744871391589])


def _deliveries(spark, dist):
    d = spark.createDataFrame(
        [(i, date(2024, 1, 1), 1, 1, "A", "B", "rain", 10.0, 100.0, 1.0, x)
         for i, x in enumerate(dist)], TB.INPUTS["deliveries"])
    dr = spark.createDataFrame([(1, "Ann", 3, "North")], TB.INPUTS["drivers"])
    v = spark.createDataFrame([(1, 0.0, "diesel")], TB.INPUTS["vehicles"])
    return L.enrich_deliveries(d, dr, v)


def test_delay_factors_full_domain_and_zero_capacity(spark):
    e = _deliveries(spark, [0.0, 50.0, 150.0])
    f = {(r["factor_type"], r["factor_value"]): r["trips"] for r in L.delay_factors(e).collect()}
    assert f[("distance_bucket", "long")] == 0 and f[("distance_bucket", "very_long")] == 0
    assert f[("distance_bucket", "short")] == 2 and f[("distance_bucket", "medium")] == 1
    assert f[("weather", "rain")] == 3 and f[("driver", "Ann")] == 3
    assert {r["load_factor"] for r in e.collect()} == {None}
    assert [r["cost_per_km"] for r in e.orderBy("delivery_id").collect()][0] is None


def test_unmatched_driver_drops_out(spark):
    d = spark.createDataFrame(
        [(1, date(2024, 1, 1), 1, 1, "A", "B", "rain", 1.0, 1.0, 1.0, 1.0),
         (2, date(2024, 1, 1), 9, 1, "A", "B", "rain", 1.0, 1.0, 1.0, 1.0)], TB.INPUTS["deliveries"])
    dr = spark.createDataFrame([(1, "Ann", 3, "North")], TB.INPUTS["drivers"])
    v = spark.createDataFrame([(1, 2.0, "diesel")], TB.INPUTS["vehicles"])
    assert [r["driver_id"] for r in L.driver_kpi(L.enrich_deliveries(d, dr, v)).collect()] == [1]


def test_pump_risk_heuristic_branch_one_class(spark):
    t0 = datetime(2024, 1, 1)
    sens = spark.createDataFrame(
        [(i, i % 3, t0 + timedelta(hours=i), str(20.0 + i), str(i % 5), "3", "1000", "5")
         for i in range(30)], TB.INPUTS["pump_sensors"])
    fails = _empty(spark, "pump_failures")
    risk, metrics = EQ.pump_risk(sens, fails, num_trees=5)
    m = metrics.first()
    assert m["model"] == "heuristic_risk" and m["rows_used"] == 30 and m["mae"] is None
    assert risk.count() == 3
    assert all(0 < r["risk_probability"] <= 1 for r in risk.collect())


def test_train_and_score_too_few_rows(spark):
    ds = spark.createDataFrame([(1, date(2024, 1, d), 1.0, 1.0, 1.0, 1.0, 1.0) for d in range(1, 6)],
                               "well_id long, date date, target_oil_ton double, pressure double, "
                               "temperature double, pump_power_kw double, pump_runtime_hours double")
    metrics, preds, err = FC.train_and_score(ds)
    assert [(r["model"], r["mae"], r["rows_used"]) for r in metrics.collect()] == [
        ("LinearRegression", None, 5), ("RandomForestRegressor", None, 5)]
    assert preds.count() == 0 and err.count() == 0
    assert preds.columns == FC.PRED_COLUMNS


def test_pre_failure_exact_bounds(spark):
    t0 = datetime(2024, 1, 2)
    sens = spark.createDataFrame(
        [(1, 7, t0, "1", "1", "1", "1", "1"), (2, 7, t0 - timedelta(hours=24), "1", "1", "1", "1", "1"),
         (3, 7, t0 - timedelta(hours=24, seconds=1), "1", "1", "1", "1", "1"),
         (4, 8, t0, "1", "1", "1", "1", "1")], TB.INPUTS["pump_sensors"])
    fails = spark.createDataFrame([(10, 7, t0, "seal"), (11, 7, t0 + timedelta(hours=1), "motor")],
                                  TB.INPUTS["pump_failures"])
    got = rows(EQ.pre_failure_signals(sens, fails).select("failure_id", "hours_before_failure"))
    assert got == [(10, 0.0), (10, 24.0), (11, 1.0)]


def test_approximate_paths_run_and_stay_close(spark):
    """The bounded-memory settings for huge inputs: percentile_approx for the
    IQR bounds and the medians. Same schema; row counts close to exact."""
    from derrick.sources import adapters as A
    prod, tele, targets = A.load_many(spark, "/root/testdata/sf0.01", "production", "telemetry",
                                      "well_targets")
    exact = P.clean_production(prod)
    approx = P.clean_production(prod, quantile_method="approx", approx_medians=True)
    assert approx.columns == exact.columns
    n_e, n_a = exact.count(), approx.count()
    assert abs(n_e - n_a) <= 0.02 * n_e
    feats = P.feature_table(approx, tele, approx_medians=True)
    assert feats.count() == n_a
    ds_e = FC.target_dataset(targets, tele, prod)
    ds_a = FC.target_dataset(targets, tele, prod, approx_medians=True)
    assert ds_a.count() == ds_e.count()
    assert ds_a.where("pressure IS NULL OR temperature IS NULL").count() == 0
