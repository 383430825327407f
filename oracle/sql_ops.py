"""Oracle SQL for the single-operator queries."""

from __future__ import annotations

from derrick.sources.adapters import with_clause as W
from oracle.sql import (ENRICHED, EXACT_AVG, EXACT_SUM, LABELLED, ORACLE, PCT, R, TARGETS,
                        WELL_KPI)

# ------------------------------------------------------------- scans
ORACLE["scan_table"] = W("production") + "SELECT well_id, date, " + ", ".join(
    R(c, c) for c in ["oil_ton", "gas_m3", "water_m3", "energy_kwh", "downtime_hours",
                      "temperature", "pressure"]) + " FROM production"

ORACLE["scan_ordered"] = W("telemetry") + "SELECT well_id, timestamp, " + ", ".join(
    R(c, c) for c in ["pressure_out", "temperature", "vibration", "pump_speed_rpm",
                      "pump_current"]) + " FROM telemetry ORDER BY timestamp, well_id"

ORACLE["scan_parquet"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus,
       CAST(l_shipdate AS VARCHAR) AS l_shipdate, """ + ", ".join(
    R(c, c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")) + " FROM lineitem"

# ------------------------------------------------------------- scalar functions
ORACLE["cast_datetime"] = W("pump_failures") + """
SELECT failure_id, CAST(failure_date AS DATE) AS failure_day,
       CAST(CAST(failure_date AS VARCHAR) AS TIMESTAMP) AS failure_ts
FROM pump_failures"""

ORACLE["cast_numeric_coerce"] = W("pump_sensors") + "SELECT record_id, " + ", ".join(
    R(f"TRY_CAST({c} AS DOUBLE)", c) for c in ["temperature", "vibration", "current", "rpm",
                                                "pressure"]) + " FROM pump_sensors"

ORACLE["fill_const"] = W("production") + "SELECT well_id, date, " + ", ".join(
    R(f"coalesce({c}, 0)", c) for c in ["oil_ton", "gas_m3", "water_m3", "energy_kwh",
                                         "downtime_hours"]) + " FROM production"

ORACLE["fallback_coalesce"] = W("well_targets", "telemetry", "production") + TARGETS + \
    "SELECT well_id, date, " + ", ".join(
        R(c, c) for c in ["target_oil_ton", "pressure", "temperature", "pump_power_kw",
                          "pump_runtime_hours"]) + " FROM ds0"

ORACLE["clip_range"] = W("production") + f"""
SELECT well_id, date,
  {R('CASE WHEN downtime_hours IS NOT NULL THEN least(greatest(downtime_hours / 24.0, 0), 1) END', 'downtime_coef')},
  {R('CASE WHEN downtime_hours IS NOT NULL THEN least(greatest(24 - downtime_hours, 0), 24) END', 'runtime_hours')},
  {R('CASE WHEN pressure IS NOT NULL THEN greatest(pressure - 100, 0) END', 'excess_pressure')}
FROM production"""

ORACLE["safe_ratio"] = W("deliveries", "vehicles") + f"""
SELECT d.delivery_id, d.vehicle_id,
  {R('CASE WHEN d.distance_km <> 0 THEN d.cost_usd / d.distance_km END', 'cost_per_km')},
  {R('CASE WHEN v.capacity_ton <> 0 THEN d.volume_ton / v.capacity_ton END', 'load_factor')}
FROM deliveries d LEFT JOIN vehicles v ON d.vehicle_id = v.vehicle_id"""

ORACLE["arith_derive"] = W("telemetry") + f"""
SELECT well_id, timestamp, {R('pump_current * pump_speed_rpm / 1000.0', 'power_kw')},
  {R('24 - vibration', 'hours_left')}, {R('abs(temperature - pressure_out)', 'abs_gap')},
  {R('pow(temperature - 40, 2)', 'sq_gap')}
FROM telemetry"""

ORACLE["concat_route"] = W("deliveries") + """
SELECT delivery_id, source, destination, source || ' -> ' || destination AS route FROM deliveries"""

ORACLE["bool_flag"] = W("deliveries") + """
SELECT delivery_id, CAST(CAST(delay_hours AS FLOAT) AS DOUBLE) AS delay_hours,
       CASE WHEN delay_hours > 0 THEN 1 ELSE 0 END AS delay_flag
FROM deliveries"""

ORACLE["bin_distance"] = W("deliveries") + f"""
SELECT delivery_id, {R('distance_km', 'distance_km')},
  CASE WHEN distance_km >= 0 AND distance_km <= 120 THEN 'short'
       WHEN distance_km > 120 AND distance_km <= 160 THEN 'medium'
       WHEN distance_km > 160 AND distance_km <= 200 THEN 'long'
       WHEN distance_km > 200 THEN 'very_long' END AS distance_bucket
FROM deliveries"""

RISK_LEVEL = """CASE WHEN {s} > -0.1 AND {s} <= 33 THEN 'low'
       WHEN {s} > 33 AND {s} <= 66 THEN 'medium'
       WHEN {s} > 66 AND {s} <= 100 THEN 'high' END"""

ORACLE["bin_risk"] = f"""
WITH s AS (SELECT event_id, round_even(value / 3.5 * 10, 0) / 10 AS score FROM events)
SELECT event_id, {R('score', 'score')}, {RISK_LEVEL.format(s='score')} AS level FROM s"""

ORACLE["case_action"] = f"""
WITH s AS (SELECT event_id, round_even(value / 3.5 * 10, 0) / 10 AS score FROM events),
l AS (SELECT event_id, {RISK_LEVEL.format(s='score')} AS level FROM s)
SELECT event_id, level, CASE WHEN level = 'high' THEN 'replan immediately'
  WHEN level = 'medium' THEN 'monitor and optimize' ELSE 'keep current' END AS action FROM l"""

ORACLE["date_truncate"] = W("telemetry") + \
    "SELECT well_id, timestamp, CAST(timestamp AS DATE) AS date FROM telemetry"

ORACLE["date_parts"] = W("production") + """
SELECT well_id, date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month
FROM production"""

ORACLE["hours_between"] = f"""
SELECT event_id,
  {R('(epoch_us(ts) - epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP))) / 3.6e9', 'hours')}
FROM events"""

ORACLE["round_half_even"] = f"""
SELECT event_id, {R('round_even(value * 0.05 * 10, 0) / 10', 'rounded')} FROM events"""

ORACLE["sqrt_metric"] = W("telemetry") + f"""
SELECT well_id, {R('sqrt(avg(temperature * temperature))', 'rms_temperature')}
FROM telemetry WHERE well_id IS NOT NULL GROUP BY well_id"""

ORACLE["row_max_abs"] = W("telemetry") + f"""
SELECT well_id, timestamp,
  {R('greatest(abs(pressure_out - 250), abs(temperature - 100), abs(vibration - 4))', 'max_abs_dev')}
FROM telemetry"""

ORACLE["bool_or"] = ORACLE["zscore_global"].replace(
    f"SELECT record_id, pump_id, timestamp, {R('m', 'max_abs_zscore')}, m > 3 AS is_anomaly_zscore FROM z",
    "SELECT z.record_id, (z.m > 3) OR (c.temperature > 400) AS is_flagged "
    "FROM z JOIN clean c ON z.record_id = c.record_id")

ORACLE["select_rename"] = W("drivers") + \
    "SELECT driver_id, name AS driver_name, region AS driver_region FROM drivers"

ORACLE["tag_constant"] = W("wells") + "SELECT well_id, name, 'all' AS segment FROM wells"

# ------------------------------------------------------------- filters
ORACLE["iqr_filter"] = W("deliveries") + f""",
b1 AS (SELECT quantile_cont(cost_usd, 0.25) AS q1, quantile_cont(cost_usd, 0.75) AS q3 FROM deliveries),
d1 AS (SELECT d.* FROM deliveries d, b1
       WHERE cost_usd >= q1 - 1.5 * (q3 - q1) AND cost_usd <= q3 + 1.5 * (q3 - q1)),
b2 AS (SELECT quantile_cont(distance_km, 0.25) AS q1, quantile_cont(distance_km, 0.75) AS q3 FROM d1),
d2 AS (SELECT d1.* FROM d1, b2
       WHERE distance_km >= q1 - 1.5 * (q3 - q1) AND distance_km <= q3 + 1.5 * (q3 - q1))
SELECT delivery_id, {R('cost_usd', 'cost_usd')}, {R('distance_km', 'distance_km')} FROM d2"""

ORACLE["dropna_subset"] = W("pump_sensors", "pump_failures") + LABELLED + \
    "SELECT record_id, pump_id FROM complete"

ORACLE["filter_time_range"] = W("telemetry") + """,
ends AS (SELECT well_id, max(timestamp) AS e FROM telemetry WHERE well_id IS NOT NULL GROUP BY well_id)
SELECT t.well_id, t.timestamp FROM telemetry t JOIN ends ON t.well_id = ends.well_id
WHERE t.timestamp >= ends.e - INTERVAL 24 HOUR AND t.timestamp <= ends.e"""

ORACLE["filter_topn"] = f"""
SELECT user_id, event_id, {R('value', 'value')} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn
  FROM events) WHERE rn <= 2"""

ORACLE["filter_threshold"] = W("telemetry") + \
    f"SELECT well_id, timestamp, {R('pump_current', 'pump_current')} FROM telemetry WHERE pump_current > 50"

# ------------------------------------------------------------- joins
ORACLE["join_left_composite"] = W("production", "telemetry") + f""",
td AS (
  SELECT well_id, CAST(timestamp AS DATE) AS date, avg(pressure_out) AS avg_pressure,
         avg(temperature) AS avg_temperature, avg(vibration) AS avg_vibration,
         avg(pump_speed_rpm) AS avg_rpm, avg(pump_current) AS avg_current
  FROM telemetry WHERE well_id IS NOT NULL AND timestamp IS NOT NULL GROUP BY 1, 2)
SELECT p.well_id, p.date, {R('p.oil_ton', 'oil_ton')}, {R('td.avg_pressure', 'avg_pressure')},
  {R('td.avg_temperature', 'avg_temperature')}, {R('td.avg_vibration', 'avg_vibration')},
  {R('td.avg_rpm', 'avg_rpm')}, {R('td.avg_current', 'avg_current')}
FROM production p LEFT JOIN td ON p.well_id = td.well_id AND p.date = td.date"""

ORACLE["join_left_dim"] = W("deliveries", "drivers") + """
SELECT d.driver_id, d.delivery_id, dr.name AS driver_name, dr.region
FROM deliveries d LEFT JOIN drivers dr ON d.driver_id = dr.driver_id"""

ORACLE["join_inner"] = W("shop_users", "shop_orders", "shop_products") + f"""
SELECT o.order_id, o.product_id, o.user_id, u.city, p.product_name, o.qty,
       {R('o.qty * o.price', 'revenue')}
FROM shop_orders o JOIN shop_users u ON o.user_id = u.user_id
JOIN shop_products p ON o.product_id = p.product_id"""

ORACLE["join_using_limit"] = W("production", "telemetry", "wells") + WELL_KPI + f"""
SELECT k.well_id, {R('k.avg_pressure', 'avg_pressure')}, {R('k.avg_temperature', 'avg_temperature')},
       p.date, {R('p.oil_ton', 'oil_ton')}
FROM well_kpi k JOIN production p USING (well_id)
ORDER BY k.well_id, p.date LIMIT 1000"""

# ------------------------------------------------------------- aggregates
LOGI = W("deliveries", "drivers", "vehicles") + ENRICHED

ORACLE["rate_pct"] = LOGI + f"""
SELECT source, {R('avg(delay_flag) * 100', 'delay_rate_pct')}
FROM enriched WHERE source IS NOT NULL GROUP BY source"""

ORACLE["quantiles"] = "\nUNION ALL\n".join(
    f"SELECT {R(str(p), 'p')}, {R(f'quantile_cont(l_extendedprice, {p})', 'q')} FROM lineitem"
    for p in (0.1, 0.25, 0.5, 0.75, 0.9))

ORACLE["group_median"] = W("production") + f"""
SELECT well_id, {R('median(oil_ton)', 'median_oil_ton')}, {R('median(pressure)', 'median_pressure')}
FROM production WHERE well_id IS NOT NULL GROUP BY well_id"""

ORACLE["count_distinct_class"] = W("pump_sensors", "pump_failures") + LABELLED + \
    "SELECT count(DISTINCT will_fail_24h) AS classes FROM lab"

ORACLE["row_count"] = W("production", "telemetry", "deliveries") + """
SELECT count(*) AS rows, 'production' AS table_name FROM production
UNION ALL SELECT count(*), 'telemetry' FROM telemetry
UNION ALL SELECT count(*), 'deliveries' FROM deliveries"""

ORACLE["agg_product_revenue"] = W("shop_users", "shop_orders", "shop_products") + f""",
agg AS (
  SELECT u.city, o.product_id, count(o.order_id) AS orders_cnt, CAST(sum(o.qty) AS BIGINT) AS qty_sum,
         sum(o.qty * o.price) AS revenue_sum
  FROM shop_orders o JOIN shop_users u ON o.user_id = u.user_id GROUP BY u.city, o.product_id)
SELECT a.product_id, a.city, a.orders_cnt, a.qty_sum, {R('a.revenue_sum', 'revenue_sum')}, p.product_name
FROM agg a JOIN shop_products p ON a.product_id = p.product_id"""

ORACLE["pivot_mean"] = W("production", "telemetry", "wells") + WELL_KPI + """,
j AS (
  SELECT CAST(floor(k.avg_temperature / 10.0) * 10 AS INTEGER) AS temperature_band,
         CAST(floor(k.avg_pressure / 50.0) AS INTEGER) AS pressure_band, p.oil_ton
  FROM well_kpi k JOIN production p USING (well_id))
SELECT temperature_band, """ + ", ".join(
    R(f"avg(CASE WHEN pressure_band {c} THEN oil_ton END)", f'"{b}"') for b, c in
    [("below", "< 0"), *((str(b), f"= {b}") for b in range(8)), ("above", "> 7")]) + \
    " FROM j GROUP BY temperature_band"

# ------------------------------------------------------------- windows
ORACLE["impute_group_median"] = W("production") + f"""
SELECT well_id, date,
  {R('CASE WHEN well_id IS NOT NULL THEN coalesce(temperature, median(temperature) OVER (PARTITION BY well_id)) END', 'temperature')},
  {R('CASE WHEN well_id IS NOT NULL THEN coalesce(pressure, median(pressure) OVER (PARTITION BY well_id)) END', 'pressure')}
FROM production"""

_DS_ALL = TARGETS.replace("FROM ds1 WHERE target_oil_ton IS NOT NULL)", "FROM ds1)")
ORACLE["impute_group_then_global"] = W("well_targets", "telemetry", "production") + _DS_ALL + \
    "SELECT well_id, date, " + ", ".join(
        R(c, c) for c in ["target_oil_ton", "pressure", "temperature", "pump_power_kw",
                          "pump_runtime_hours"]) + " FROM ds"

DRIVER_KPI = f""",
dk AS (
  SELECT driver_id, {EXACT_SUM('cost_usd')} AS total_cost_usd,
         {EXACT_AVG('delay_hours')} AS avg_delay_hours
  FROM enriched
  WHERE driver_id IS NOT NULL AND driver_name IS NOT NULL AND experience_years IS NOT NULL
    AND driver_region IS NOT NULL
  GROUP BY driver_id, driver_name, experience_years, driver_region)
"""
ORACLE["row_number_rank"] = LOGI + DRIVER_KPI + f"""
SELECT driver_id, {R('total_cost_usd', 'total_cost_usd')},
       CAST(ROW_NUMBER() OVER (ORDER BY total_cost_usd DESC, driver_id) AS BIGINT) AS cost_rank
FROM dk"""

ORACLE["rank_pct"] = LOGI + DRIVER_KPI + f"""
, k AS (SELECT *, avg_delay_hours AS kd FROM dk)
SELECT driver_id, {R(f"CASE WHEN kd IS NOT NULL THEN {PCT.format(c='kd')} END", 'delay_rank')} FROM k"""

_ROUTES = ORACLE["mart_route_optimization"]
ORACLE["weighted_risk_score"] = _ROUTES[:_ROUTES.rindex("SELECT route, source")] + \
    f"SELECT route, {R('route_risk_score', 'route_risk_score')} FROM prio"

ORACLE["topn_per_group"] = f"""
SELECT event_type, event_id, {R('value', 'value')} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rn
  FROM events) WHERE rn <= 3"""

# ------------------------------------------------------------- sort / limit / union
ORACLE["sort_output"] = ORACLE["mart_driver_kpi"] + \
    "\nORDER BY delay_rate_pct ASC NULLS LAST, avg_delay_hours ASC NULLS LAST, driver_id"

ORACLE["head_tail_segments"] = _ROUTES[:_ROUTES.rindex("SELECT route, source")] + f"""
(SELECT route, {R('route_risk_score', 'route_risk_score')}, 'best' AS segment FROM prio
 ORDER BY route_risk_score DESC, route LIMIT 3)
UNION ALL
(SELECT route, {R('route_risk_score', 'route_risk_score')}, 'worst' AS segment FROM prio
 ORDER BY route_risk_score ASC, route DESC LIMIT 3)"""

ORACLE["limit_n"] = W("production", "telemetry", "wells") + WELL_KPI + f"""
SELECT well_id, name, {R('avg_oil_ton', 'avg_oil_ton')} FROM well_kpi
ORDER BY performance_rank LIMIT 10"""

ORACLE["union_all"] = W("production", "well_targets") + f"""
SELECT well_id, date, {R('oil_ton', 'value')}, 'production' AS kind FROM production
UNION ALL
SELECT well_id, date, {R('daily_oil_ton', 'value')}, 'target' AS kind FROM well_targets"""



# Dates and timestamps leave both engines as ISO text (identical in both; the
# pandas datetime units of the two engines differ).
TEMPORAL_COLUMNS = {
    "agg_telemetry_daily": ["date"], "agg_telemetry_power": ["date"], "arith_derive": ["timestamp"],
    "cast_datetime": ["failure_day", "failure_ts"], "changes_apply": ["created_at"],
    "clean_production": ["date"], "clip_range": ["date"], "date_parts": ["date"],
    "date_truncate": ["timestamp", "date"], "enrich_deliveries": ["date"],
    "fallback_coalesce": ["date"], "feature_table": ["date"], "fill_const": ["date"],
    "filter_threshold": ["timestamp"], "filter_time_range": ["timestamp"],
    "impute_group_median": ["date"], "impute_group_then_global": ["date"],
    "join_left_composite": ["date"], "join_next_event": ["timestamp"],
    "join_time_range": ["timestamp"], "join_using_limit": ["date"], "latest_per_key": ["timestamp"],
    "lookup_by_id": ["created_at"], "mart_cost_vs_distance": ["date"],
    "mart_daily_production": ["date"], "risk_heuristic": ["timestamp"], "row_max_abs": ["timestamp"],
    "scan_ordered": ["timestamp"], "scan_table": ["date"], "snapshot_newest_first": ["created_at"],
    "target_dataset": ["date"], "union_all": ["date"], "zscore_global": ["timestamp"],
}


def _as_text(sql: str, cols: list[str]) -> str:
    rep = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"


for _name, _cols in TEMPORAL_COLUMNS.items():
    ORACLE[_name] = _as_text(ORACLE[_name], _cols)
