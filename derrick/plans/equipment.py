"""Equipment marts: pump anomalies (z-score and isolation forest),
pre-failure signals, failure risk per pump."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derrick.functions.exprs import (bin_risk, bool_flag, coerce_numeric, hours_between,
                                     round_half_even, row_max_abs)
from derrick.models import isolation_forest as iforest
from derrick.models import training as M
from derrick.operators.joins import join_next_event, join_time_range
from derrick.operators.windows import latest_per_key, rank_pct
from derrick.session import cut_lineage

ANOMALY_FEATURES = ["temperature", "vibration", "current", "rpm"]
RISK_FEATURES = ["temperature", "vibration", "current", "rpm", "pressure"]
SENSOR_COLUMNS = ["temperature", "vibration", "current", "rpm", "pressure"]
ANOMALY_COLUMNS = ["record_id", "pump_id", "timestamp", "temperature", "vibration", "current",
                   "rpm", "pressure", "max_abs_zscore", "iforest_score", "is_anomaly_zscore",
                   "is_anomaly_iforest", "is_anomaly", "anomaly_zscore_flag",
                   "anomaly_iforest_flag", "anomaly_flag"]
PRE_FAILURE_COLUMNS = ["failure_id", "pump_id", "failure_type", "timestamp",
                       "hours_before_failure", "temperature", "vibration", "current", "rpm",
                       "pressure"]
RISK_COLUMNS = ["pump_id", "timestamp", "temperature", "vibration", "current", "rpm", "pressure",
                "risk_probability", "risk_score", "risk_level"]
METRIC_COLUMNS = "model string, mae double, rmse double, r2 double, rows_used long"


def coerce_sensors(sensors: DataFrame, columns=ANOMALY_FEATURES) -> DataFrame:
    return sensors.withColumns({c: coerce_numeric(c) for c in columns})


def zscore_global(df: DataFrame, columns, out: str = "max_abs_zscore") -> DataFrame:
    """Population z-score per column over the whole frame (0 where the spread
    is 0 or undefined); ``out`` is the largest absolute z of the row.

    The means and deviations are one aggregate row: 2 numbers per column.
    """
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns],
                   *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()
    zs = []
    for c in columns:
        m, s = stats[f"m_{c}"], stats[f"s_{c}"]
        if s is None or s == 0 or math.isnan(s):
            zs.append(F.lit(0.0))
        else:
            zs.append((F.col(c) - F.lit(m)) / F.lit(s))
    return df.withColumn(out, row_max_abs(zs))


def pump_zscores(sensors: DataFrame) -> DataFrame:
    """Coerced sensors without missing features, with max |z| and its flag."""
    clean = coerce_sensors(sensors).dropna(subset=ANOMALY_FEATURES)
    z = zscore_global(clean, ANOMALY_FEATURES)
    return z.withColumn("is_anomaly_zscore", F.col("max_abs_zscore") > 3)


def pump_anomalies(sensors: DataFrame, contamination: float = 0.1, n_trees: int = 100,
                   seed: int = 42) -> DataFrame:
    """z-score detector OR isolation forest, with 0/1 flags."""
    z = pump_zscores(sensors)
    scored = iforest.fit_predict(z, ANOMALY_FEATURES, "record_id", contamination=contamination,
                                 n_trees=n_trees, seed=seed)
    out = scored.withColumn("is_anomaly", F.col("is_anomaly_zscore") | F.col("is_anomaly_iforest"))
    out = out.withColumns({
        "anomaly_zscore_flag": F.col("is_anomaly_zscore").cast("int"),
        "anomaly_iforest_flag": F.col("is_anomaly_iforest").cast("int"),
        "anomaly_flag": F.col("is_anomaly").cast("int"),
    })
    return out.select(*ANOMALY_COLUMNS)


def pre_failure_signals(sensors: DataFrame, failures: DataFrame,
                        horizon_hours: float = 24.0) -> DataFrame:
    """Sensor rows within ``horizon_hours`` before (and at) each failure of
    the same pump, repeated for overlapping failures."""
    f = (failures.where(F.col("pump_id").isNotNull())
         .select("failure_id", "pump_id", "failure_type", "failure_date"))
    s = sensors.select("pump_id", "timestamp", *SENSOR_COLUMNS)
    j = join_time_range(s, f, "pump_id", "timestamp", "failure_date", horizon_hours)
    return (j.withColumn("hours_before_failure", hours_between("timestamp", "failure_date"))
            .select(*PRE_FAILURE_COLUMNS))


def label_next_failure(sensors: DataFrame, failures: DataFrame,
                       horizon_hours: float = 24.0) -> DataFrame:
    """Coerced sensors (complete features) with hours to the next failure of
    the pump at or after the reading (infinity when none) and the 0/1 label
    ``will_fail_24h``."""
    s = coerce_sensors(sensors, RISK_FEATURES).dropna(subset=RISK_FEATURES)
    f = failures.where(F.col("pump_id").isNotNull()).select("pump_id", "failure_date")
    nxt = join_next_event(s, f, "pump_id", "timestamp", "failure_date", out="__next")
    hours = F.coalesce(hours_between("timestamp", "__next"), F.lit(float("inf")))
    return (nxt.withColumn("hours_to_failure", hours)
            .withColumn("will_fail_24h", bool_flag(F.col("hours_to_failure") <= horizon_hours))
            .drop("__next"))


def latest_readings(labelled: DataFrame) -> DataFrame:
    """Last reading per pump by time (NULL time sorts last, so it wins)."""
    return latest_per_key(labelled, "pump_id", ["timestamp", "record_id"])


def _finish(latest: DataFrame, prob_col: str = "risk_probability") -> DataFrame:
    return (latest.withColumn("risk_score", round_half_even(F.col(prob_col) * 100.0, 1))
            .withColumn("risk_level", bin_risk("risk_score"))
            .select(*RISK_COLUMNS))


def risk_heuristic(labelled: DataFrame) -> DataFrame:
    """Mean percentile rank of vibration, temperature and current over the
    latest reading of each pump."""
    # one row per pump, read by the three rank passes
    latest = latest_readings(labelled).persist(StorageLevel.MEMORY_AND_DISK)
    r = rank_pct(latest, "vibration", "__rv")
    r = rank_pct(r, "temperature", "__rt")
    r = rank_pct(r, "current", "__rc")
    r = r.withColumn("risk_probability", (F.col("__rv") + F.col("__rt") + F.col("__rc")) / 3.0)
    return _finish(r)


def pump_risk(sensors: DataFrame, failures: DataFrame, num_trees: int = 300,
              seed: int = 42, min_rows: int = 20) -> tuple[DataFrame, DataFrame]:
    """Failure risk of each pump's latest reading and the model metrics.

    A balanced forest on the 24 h label when there are two classes and at
    least ``min_rows`` rows; otherwise the rank heuristic.
    """
    spark = sensors.sparkSession
    labelled = cut_lineage(label_next_failure(sensors, failures))
    stats = labelled.agg(F.count(F.lit(1)).alias("n"),
                         F.count_distinct("will_fail_24h").alias("k")).first()
    n, k = stats["n"], stats["k"]
    if k < 2 or n < min_rows:
        metrics = spark.createDataFrame([("heuristic_risk", None, None, None, n)], METRIC_COLUMNS)
        return risk_heuristic(labelled), metrics
    split = M.split_stratified(labelled, ["record_id"], "will_fail_24h", 0.25, seed)
    weighted = M.balanced_weights(split, "will_fail_24h")
    train = weighted.where(~F.col("is_test"))
    test = weighted.where(F.col("is_test"))
    model = M.fit_forest_classifier(train, RISK_FEATURES, "will_fail_24h", "weight",
                                    num_trees=num_trees, seed=seed)
    scored = M.predict(model, test, "p")
    e = F.col("will_fail_24h").cast("double") - F.col("p")
    m = scored.agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"))
    metrics = m.select(F.lit("RandomForestClassifier").alias("model"), "mae", "rmse",
                       F.lit(None).cast(T.DoubleType()).alias("r2"),
                       F.lit(n).cast("long").alias("rows_used"))
    latest = M.predict(model, latest_readings(labelled), "risk_probability")
    return _finish(latest), metrics
