"""Registered queries: one callable per operator of the inventory.

Each takes ``(spark, sf_dir)``, reads the driver tables through the adapters
and returns a DataFrame normalised for cross-engine comparison
(:func:`for_compare`: doubles snapped to single precision, dates and
timestamps as ISO text). Column names equal those of the oracle SQL. Marts
add doubles without error, so results do not depend on summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derrick.sources import adapters as A
from derrick.plans import products

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    """Add ``fn(spark, sf_dir)`` as query ``name``; its result is passed
    through :func:`for_compare`."""
    def deco(fn):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return for_compare(fn(spark, sf_dir))
        query.__name__ = query.__qualname__ = f"q_{name}"
        query.__doc__ = fn.__doc__
        query.__wrapped__ = fn
        QUERIES[name] = query
        return fn
    return deco


def normalise_double(c):
    """Snap a double to the nearest single-precision value (as a double).

    Engines add in different orders, so the last bits of a mean differ; and
    decimal rounding disagrees between engines on values that sit exactly on
    a rounding midpoint (common for means of fixed-decimal data). The IEEE
    double-to-float conversion is the same everywhere, so two results agree
    unless they straddle a float32 rounding boundary (about 1e-8 relative).
    """
    return c.cast("float").cast("double")


def for_compare(df: DataFrame) -> DataFrame:
    """Normalise columns for cross-engine comparison: doubles and decimals
    snapped to single precision; dates and timestamps as ISO text
    (``2024-01-01``, ``2024-01-01 00:03:52.824425``), which both engines
    print identically, while their pandas datetime units differ (ns / us)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            cols.append(normalise_double(F.col(f.name).cast("double")).alias(f.name))
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            cols.append(F.col(f.name).cast("string").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


@register("mart_city_top_products")
def q_city_top_products(spark, sf):
    users, orders, prods = A.load_many(spark, sf, "shop_users", "shop_orders", "shop_products")
    return products.city_top_products(users, orders, prods, n=2)


# ---------------------------------------------------------------- production
from derrick.plans import production as P  # noqa: E402


def _features(spark, sf):
    prod, tele = A.load_many(spark, sf, "production", "telemetry")
    return P.feature_table(P.clean_production(prod), tele)


@register("clean_production")
def q_clean_production(spark, sf):
    return P.clean_production(A.load(spark, sf, "production"))


@register("feature_table")
def q_feature_table(spark, sf):
    return _features(spark, sf)


@register("mart_daily_production")
def q_daily_production(spark, sf):
    return P.daily_production(_features(spark, sf))


@register("mart_well_kpi")
def q_well_kpi(spark, sf):
    return P.well_kpi(_features(spark, sf), A.load(spark, sf, "wells"))


@register("best_worst_wells")
def q_best_worst(spark, sf):
    kpi = P.well_kpi(_features(spark, sf), A.load(spark, sf, "wells"))
    return P.best_worst_wells(kpi)


@register("corr_influence")
def q_influence(spark, sf):
    return P.influence_factors(_features(spark, sf))


# ----------------------------------------------------------------- logistics
from derrick.plans import logistics as L  # noqa: E402


def _enriched(spark, sf):
    return L.enrich_deliveries(*A.load_many(spark, sf, "deliveries", "drivers", "vehicles"))


@register("enrich_deliveries")
def q_enrich(spark, sf):
    return _enriched(spark, sf)


@register("mart_delay_vs_weather")
def q_delay_weather(spark, sf):
    return L.delay_vs_weather(_enriched(spark, sf))


@register("mart_cost_vs_distance")
def q_cost_distance(spark, sf):
    return L.cost_vs_distance(_enriched(spark, sf))


@register("mart_driver_kpi")
def q_driver_kpi(spark, sf):
    return L.driver_kpi(_enriched(spark, sf))


@register("agg_factor_long")
def q_delay_factors(spark, sf):
    return L.delay_factors(_enriched(spark, sf))


@register("agg_full_domain")
def q_full_domain(spark, sf):
    return (L.delay_factors(_enriched(spark, sf))
                       .where(F.col("factor_type") == "distance_bucket"))


@register("mart_route_optimization")
def q_routes(spark, sf):
    return L.route_optimization(_enriched(spark, sf))


# ----------------------------------------------------------------- equipment
from derrick.plans import equipment as EQ  # noqa: E402


def _pumps(spark, sf):
    return A.load_many(spark, sf, "pump_sensors", "pump_failures")


@register("zscore_global")
def q_zscore(spark, sf):
    sens, _ = _pumps(spark, sf)
    z = EQ.pump_zscores(sens)
    return (z.select("record_id", "pump_id", "timestamp", "max_abs_zscore",
                                "is_anomaly_zscore"))


@register("join_time_range")
def q_pre_failure(spark, sf):
    return EQ.pre_failure_signals(*_pumps(spark, sf), horizon_hours=24)


@register("join_next_event")
def q_next_failure(spark, sf):
    lab = EQ.label_next_failure(*_pumps(spark, sf))
    return (lab.select("record_id", "pump_id", "timestamp", "hours_to_failure",
                                  "will_fail_24h"))


@register("latest_per_key")
def q_latest(spark, sf):
    lab = EQ.label_next_failure(*_pumps(spark, sf))
    return (EQ.latest_readings(lab).select("pump_id", "record_id", "timestamp",
                                                      "will_fail_24h"))


@register("risk_heuristic")
def q_heuristic(spark, sf):
    return EQ.risk_heuristic(EQ.label_next_failure(*_pumps(spark, sf)))


@register("mart_pump_anomalies")
def q_anomalies(spark, sf):
    sens, _ = _pumps(spark, sf)
    return EQ.pump_anomalies(sens, contamination=0.1, n_trees=100, seed=42)


@register("isolation_forest")
def q_iforest(spark, sf):
    sens, _ = _pumps(spark, sf)
    return (EQ.pump_anomalies(sens).select(
        "record_id", "iforest_score", "is_anomaly_iforest"))


@register("mart_pump_risk")
def q_pump_risk(spark, sf):
    risk, _ = EQ.pump_risk(*_pumps(spark, sf), num_trees=300, seed=42)
    return risk


@register("fit_failure_classifier")
def q_pump_risk_metrics(spark, sf):
    _, metrics = EQ.pump_risk(*_pumps(spark, sf), num_trees=300, seed=42)
    return metrics


# ------------------------------------------------------------------ forecast
from derrick.models import training as MT  # noqa: E402
from derrick.operators.aggregates import regression_metrics  # noqa: E402
from derrick.plans import forecast as FC  # noqa: E402


def _target_inputs(spark, sf):
    return A.load_many(spark, sf, "well_targets", "telemetry", "production")


@register("agg_telemetry_daily")
def q_tele_daily(spark, sf):
    return P.telemetry_daily(A.load(spark, sf, "telemetry"))


@register("agg_telemetry_power")
def q_tele_power(spark, sf):
    return FC.telemetry_power_daily(A.load(spark, sf, "telemetry"))


@register("target_dataset")
def q_target_dataset(spark, sf):
    return FC.target_dataset(*_target_inputs(spark, sf))


@register("fit_linear")
def q_fit_linear(spark, sf):
    """Least squares of target on pressure over the whole training set."""
    ds = FC.target_dataset(*_target_inputs(spark, sf)).dropna(subset=["pressure"])
    model = MT.fit_linear(ds, ["pressure"], "target_oil_ton")
    lr = model.stages[-1]
    n = lr.summary.numInstances
    return (spark.createDataFrame(
        [(float(lr.coefficients[0]), float(lr.intercept), int(n))],
        "slope double, intercept double, rows_used long"))


@register("regression_metrics")
def q_regression_metrics(spark, sf):
    """Reported production as a naive forecast of the target, per dataset."""
    targets, _, prod = _target_inputs(spark, sf)
    pairs = (targets.join(prod.select("well_id", "date", "oil_ton"), ["well_id", "date"])
             .dropna(subset=["daily_oil_ton", "oil_ton"]))
    return regression_metrics(pairs, "daily_oil_ton", "oil_ton")


@register("score_and_stack")
def q_actual_vs_predicted(spark, sf):
    _, preds, _ = FC.train_and_score(FC.target_dataset(*_target_inputs(spark, sf)))
    return preds


@register("fit_target_forest")
def q_target_metrics(spark, sf):
    metrics, _, _ = FC.train_and_score(FC.target_dataset(*_target_inputs(spark, sf)))
    return metrics


@register("error_over_time")
def q_error_over_time(spark, sf):
    """Errors by day of two forecasts that SQL has too: the reported production, and the
    target of the well's day before (both models stacked, as the fitted ones are)."""
    targets, _, prod = _target_inputs(spark, sf)
    t = targets.select("well_id", "date", F.col("daily_oil_ton").alias("actual")).dropna()
    reported = t.join(prod.select("well_id", "date", F.col("oil_ton").alias("predicted")), ["well_id", "date"])
    before = t.select("well_id", F.date_add("date", 1).alias("date"), F.col("actual").alias("predicted"))
    stacked = reported.withColumn("model", F.lit("reported")).unionByName(
        t.join(before, ["well_id", "date"]).withColumn("model", F.lit("day_before")))
    err = F.col("actual") - F.col("predicted")
    return FC.error_over_time(stacked.dropna(subset=["predicted"]).select(
        "model", "date", F.abs(err).alias("abs_error"), (err * err).alias("sq_error")))


@register("fit_production_forest")
def q_ml_metrics(spark, sf):
    return FC.production_forest_metrics(_features(spark, sf))


@register("split_train_test")
def q_split(spark, sf):
    ds = FC.target_dataset(*_target_inputs(spark, sf))
    s = MT.split_train_test(ds, ["well_id", "date"], 0.25, 42)
    return s.groupBy("is_test").agg(F.count(F.lit(1)).alias("rows"))


@register("split_stratified")
def q_split_strat(spark, sf):
    lab = EQ.label_next_failure(*_pumps(spark, sf))
    s = MT.split_stratified(lab, ["record_id"], "will_fail_24h", 0.25, 42)
    return s.groupBy("will_fail_24h", "is_test").agg(F.count(F.lit(1)).alias("rows"))


# ------------------------------------------------------------------- changes
from derrick.operators import changes as CH  # noqa: E402


def _changes(spark, sf):
    return A.load(spark, sf, "item_changes")


@register("changes_validate")
def q_changes_validate(spark, sf):
    return CH.changes_validate(_changes(spark, sf)).select("seq", "op", "id", "reason", "valid")


@register("changes_apply")
def q_changes_apply(spark, sf):
    snap, _ = CH.changes_apply(_changes(spark, sf))
    return snap


@register("changes_rejects")
def q_changes_rejects(spark, sf):
    _, rejects = CH.changes_apply(_changes(spark, sf))
    return rejects.select("seq", "op", "id", "reason")


@register("lookup_by_id")
def q_lookup(spark, sf):
    """Every id an update or delete asked for: found or not. (``completed`` is compared
    as 0/1 text: a nullable boolean reaches pandas as object in Spark but as an
    extension dtype in DuckDB.)"""
    ch = _changes(spark, sf)
    snap, _ = CH.changes_apply(ch)
    found = CH.lookup_by_id(snap, ch.where(F.col("op") != "create"))
    return found.select("id", "found", "title", "description", "created_at",
                        F.col("completed").cast("int").cast("string").alias("completed"))


@register("snapshot_newest_first")
def q_snapshot_newest(spark, sf):
    snap, _ = CH.changes_apply(_changes(spark, sf))
    return CH.snapshot_newest_first(snap)
