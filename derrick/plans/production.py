"""Production marts: cleaning, the daily feature table, daily production,
well KPIs, best/worst wells and influence factors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.functions.exprs import clip, date_parts, fill_const, nan_to_null, to_day
from derrick.operators.aggregates import corr_pairwise, exact_agg, group_by_dropna
from derrick.operators.clean import iqr_filter, impute_group_median
from derrick.operators.joins import join_left_composite, join_left_dim
from derrick.operators.windows import head_tail_segments, row_number_rank

FLOW_MEASURES = ["oil_ton", "gas_m3", "water_m3", "energy_kwh", "downtime_hours"]
STATE_MEASURES = ["temperature", "pressure"]
IQR_COLUMNS = ["oil_ton", "temperature", "pressure"]
TELEMETRY_FEATURES = {
    "avg_pressure": "pressure_out",
    "avg_temperature": "temperature",
    "avg_vibration": "vibration",
    "avg_rpm": "pump_speed_rpm",
    "avg_current": "pump_current",
}
DAILY_COLUMNS = ["date", "total_oil_ton", "avg_pressure", "avg_temperature",
                 "avg_downtime_coef", "year", "month"]
WELL_KPI_COLUMNS = ["well_id", "avg_oil_ton", "downtime_pct", "avg_pressure",
                    "avg_temperature", "name", "field_name", "region", "status",
                    "performance_rank"]


def clean_production(production: DataFrame, quantile_method: str = "exact",
                     approx_medians: bool = False) -> DataFrame:
    """Date cast; temperature/pressure NULL -> the well's median; flows NULL
    -> 0; downtime_coef = downtime/24 in [0, 1]; sequential IQR filter on
    oil, temperature, pressure."""
    df = production.withColumn("date", F.col("date").cast("date"))
    df = df.withColumns({c: nan_to_null(c) for c in FLOW_MEASURES + STATE_MEASURES})
    df = impute_group_median(df, "well_id", STATE_MEASURES, approx=approx_medians)
    df = df.withColumns({c: fill_const(c, 0.0) for c in FLOW_MEASURES})
    df = df.withColumn("downtime_coef", clip(F.col("downtime_hours") / 24.0, 0.0, 1.0))
    return iqr_filter(df, IQR_COLUMNS, method=quantile_method)


def telemetry_daily(telemetry: DataFrame) -> DataFrame:
    """Five means per (well_id, day) of the raw readings."""
    t = telemetry.withColumn("date", to_day(F.col("timestamp")))
    return group_by_dropna(t, ["well_id", "date"]).agg(
        *[F.avg(nan_to_null(src)).alias(dst) for dst, src in TELEMETRY_FEATURES.items()])


def feature_table(production_clean: DataFrame, telemetry: DataFrame,
                  approx_medians: bool = False) -> DataFrame:
    """Cleaned production left-joined with daily telemetry means; missing
    means take the well's median."""
    joined = join_left_composite(production_clean, telemetry_daily(telemetry), ["well_id", "date"])
    return impute_group_median(joined, "well_id", list(TELEMETRY_FEATURES), approx=approx_medians)


def daily_production(features: DataFrame) -> DataFrame:
    """Per day: total oil, mean pressure/temperature/downtime; plus year and
    month for partitioned output."""
    out = exact_agg(features, ["date"], sums={"total_oil_ton": "oil_ton"}, means={
        "avg_pressure": "avg_pressure", "avg_temperature": "avg_temperature",
        "avg_downtime_coef": "downtime_coef"})
    return out.withColumns(date_parts("date")).select(*DAILY_COLUMNS)


def well_kpi(features: DataFrame, wells: DataFrame) -> DataFrame:
    """Per well: mean oil, downtime share in %, mean pressure and temperature,
    the well's attributes, and a 1..n rank by mean oil (ties: lower id first)."""
    kpi = exact_agg(features, ["well_id"], means={
        "avg_oil_ton": "oil_ton", "downtime_pct": "downtime_coef", "avg_pressure": "avg_pressure",
        "avg_temperature": "avg_temperature"})
    kpi = kpi.withColumn("downtime_pct", F.col("downtime_pct") * 100.0)
    kpi = join_left_dim(kpi, wells, "well_id", ["name", "field_name", "region", "status"])
    ranked = row_number_rank(kpi, "avg_oil_ton", True, ["well_id"], "performance_rank")
    return ranked.select(*WELL_KPI_COLUMNS)


def best_worst_wells(kpi: DataFrame, n: int = 3) -> DataFrame:
    """Best ``n`` and worst ``n`` wells by rank, tagged; overlap kept."""
    return head_tail_segments(kpi, [F.col("performance_rank").asc()],
                              [F.col("performance_rank").desc()], n=n)


def influence_factors(features: DataFrame) -> DataFrame:
    """Pearson correlation of mean temperature and mean pressure with oil."""
    wide = features.agg(corr_pairwise("avg_temperature", "oil_ton").alias("avg_temperature"),
                        corr_pairwise("avg_pressure", "oil_ton").alias("avg_pressure"))
    return wide.unpivot([], ["avg_temperature", "avg_pressure"], "factor", "corr_with_oil_ton")
