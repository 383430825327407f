"""Forecast marts: the target training set, least squares and forest
models, predictions for every row, and error over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.functions.exprs import clip, fallback, nan_to_null, to_day
from derrick.models import training as M
from derrick.operators.aggregates import group_by_dropna, regression_metrics
from derrick.operators.clean import impute_group_then_global
from derrick.operators.joins import join_left_composite
from derrick.session import cut_lineage

TARGET_FEATURES = ["pressure", "temperature", "pump_power_kw", "pump_runtime_hours"]
DATASET_COLUMNS = ["well_id", "date", "target_oil_ton", *TARGET_FEATURES]
PRED_COLUMNS = ["model", "well_id", "date", "actual_oil_ton", "predicted_oil_ton", "abs_error",
                "sq_error"]
METRIC_SCHEMA = "model string, mae double, rmse double, r2 double, rows_used long"
ERROR_SCHEMA = "model string, date date, mae_day double, rmse_day double"
PRED_SCHEMA = ("model string, well_id long, date date, actual_oil_ton double, "
               "predicted_oil_ton double, abs_error double, sq_error double")


def telemetry_power_daily(telemetry: DataFrame) -> DataFrame:
    """Per (well, day): mean pressure, temperature, pump power (current x rpm
    / 1000) and the number of readings as runtime hours."""
    t = (telemetry.withColumn("date", to_day("timestamp"))
         .withColumn("power_kw", F.col("pump_current") * F.col("pump_speed_rpm") / 1000.0))
    return group_by_dropna(t, ["well_id", "date"]).agg(
        F.avg(nan_to_null("pressure_out")).alias("pressure"),
        F.avg(nan_to_null("temperature")).alias("temperature"),
        F.avg(nan_to_null("power_kw")).alias("pump_power_kw"),
        F.count("timestamp").cast("double").alias("pump_runtime_hours"))


def production_fallbacks(production: DataFrame) -> DataFrame:
    """Raw production reshaped into fallback values per (well, day)."""
    p = production.withColumn("date", F.col("date").cast("date"))
    return p.select(
        "well_id", "date",
        nan_to_null("pressure").alias("prod_pressure"),
        nan_to_null("temperature").alias("prod_temperature"),
        (nan_to_null("energy_kwh") / 24.0).alias("prod_power_kw"),
        clip(F.lit(24.0) - nan_to_null("downtime_hours"), 0.0, 24.0).alias("prod_runtime_hours"))


def target_with_fallbacks(targets: DataFrame, telemetry: DataFrame,
                          production: DataFrame) -> DataFrame:
    """Targets with daily telemetry features; a missing feature takes the
    production-derived value of the same well and day."""
    t = (targets.withColumn("date", F.col("date").cast("date"))
         .withColumnRenamed("daily_oil_ton", "target_oil_ton")
         .withColumn("target_oil_ton", nan_to_null("target_oil_ton")))
    ds = join_left_composite(t, telemetry_power_daily(telemetry), ["well_id", "date"])
    ds = join_left_composite(ds, production_fallbacks(production), ["well_id", "date"],
                             null_safe=True)
    ds = ds.withColumns({
        "pressure": fallback("pressure", "prod_pressure"),
        "temperature": fallback("temperature", "prod_temperature"),
        "pump_power_kw": fallback("pump_power_kw", "prod_power_kw"),
        "pump_runtime_hours": fallback("pump_runtime_hours", "prod_runtime_hours"),
    })
    return ds.select(*DATASET_COLUMNS)


def target_dataset(targets: DataFrame, telemetry: DataFrame, production: DataFrame,
                   approx_medians: bool = False) -> DataFrame:
    """Targets with telemetry features, production fallbacks, well-median then
    overall-median fills; rows without a target dropped at the end."""
    ds = target_with_fallbacks(targets, telemetry, production)
    ds = impute_group_then_global(ds, "well_id", TARGET_FEATURES, approx=approx_medians)
    return ds.dropna(subset=["target_oil_ton"]).select(*DATASET_COLUMNS)


def train_and_score(dataset: DataFrame, forest_trees: int = 300,
                    seed: int = 42, test_share: float = 0.25, min_rows: int = 12
                    ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Least squares and a forest on a seeded 75/25 split; every row scored
    (training rows too); metrics on the test rows; error per model and day.

    Returns (metrics, predictions, error_over_time).
    """
    spark = dataset.sparkSession
    data = cut_lineage(dataset)
    n = data.count()
    if n < min_rows:
        metrics = spark.createDataFrame(
            [("LinearRegression", None, None, None, n),
             ("RandomForestRegressor", None, None, None, n)], METRIC_SCHEMA)
        return (metrics, spark.createDataFrame([], PRED_SCHEMA),
                spark.createDataFrame([], ERROR_SCHEMA))
    split = M.split_train_test(data, ["well_id", "date"], test_share, seed)
    train = split.where(~F.col("is_test"))
    fitted = {
        "LinearRegression": M.fit_linear(train, TARGET_FEATURES, "target_oil_ton"),
        "RandomForestRegressor": M.fit_forest_regressor(train, TARGET_FEATURES, "target_oil_ton",
                                                        num_trees=forest_trees, seed=seed),
    }
    metrics, preds = None, None
    for name, model in fitted.items():
        scored = M.predict(model, split, "predicted_oil_ton").withColumn("model", F.lit(name))
        m = (regression_metrics(scored.where(F.col("is_test")), "target_oil_ton",
                                "predicted_oil_ton")
             .select(F.lit(name).alias("model"), "mae", "rmse", "r2",
                     F.lit(n).cast("long").alias("rows_used")))
        err = F.col("target_oil_ton") - F.col("predicted_oil_ton")
        p = scored.select("model", "well_id", "date",
                          F.col("target_oil_ton").alias("actual_oil_ton"), "predicted_oil_ton",
                          F.abs(err).alias("abs_error"), (err * err).alias("sq_error"))
        metrics = m if metrics is None else metrics.unionByName(m)
        preds = p if preds is None else preds.unionByName(p)
    return metrics, preds, error_over_time(preds)


def error_over_time(preds: DataFrame) -> DataFrame:
    """MAE and RMSE per model and day."""
    return group_by_dropna(preds, ["model", "date"]).agg(
        F.avg("abs_error").alias("mae_day"),
        F.sqrt(F.avg("sq_error")).alias("rmse_day"))


def production_forest_metrics(features: DataFrame, num_trees: int = 200,
                              seed: int = 42, test_share: float = 0.25,
                              min_rows: int = 10) -> DataFrame:
    """Forest of oil on seven production features: MAE and R^2 on the test
    share, or NULL metrics below ``min_rows`` complete rows."""
    spark = features.sparkSession
    cols = ["avg_pressure", "avg_temperature", "energy_kwh", "downtime_coef", "avg_vibration",
            "avg_rpm", "avg_current"]
    data = features.select("well_id", "date", "oil_ton", *cols).dropna()
    data = cut_lineage(data)
    n = data.count()
    if n < min_rows:
        return spark.createDataFrame([("RandomForestRegressor", None, None, n)],
                                     "model string, mae double, r2 double, rows_used long")
    split = M.split_train_test(data, ["well_id", "date"], test_share, seed)
    model = M.fit_forest_regressor(split.where(~F.col("is_test")), cols, "oil_ton",
                                   num_trees=num_trees, seed=seed)
    scored = M.predict(model, split.where(F.col("is_test")), "pred")
    m = regression_metrics(scored, "oil_ton", "pred")
    return m.select(F.lit("RandomForestRegressor").alias("model"), "mae", "r2",
                    F.lit(n).cast("long").alias("rows_used"))
