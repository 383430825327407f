"""Oracle SQL per registered query. Every double is snapped to single
precision, matching :func:`derrick.plans.catalog.for_compare`."""

from __future__ import annotations

from derrick.sources.adapters import with_clause as W

ORACLE: dict[str, str] = {}

ORACLE["mart_city_top_products"] = W("shop_users", "shop_orders", "shop_products") + """,
agg AS (
  SELECT u.city, o.product_id, p.product_name, COUNT(o.order_id) AS orders_cnt,
         CAST(SUM(o.qty) AS BIGINT) AS qty_sum, SUM(o.qty * o.price) AS revenue_sum
  FROM shop_orders o JOIN shop_users u ON o.user_id = u.user_id
  JOIN shop_products p ON o.product_id = p.product_id
  GROUP BY u.city, o.product_id, p.product_name),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY city ORDER BY revenue_sum DESC, product_id) AS rn
  FROM agg)
SELECT city, product_id, product_name, orders_cnt, qty_sum,
       CAST(CAST(CAST(revenue_sum AS DOUBLE) AS FLOAT) AS DOUBLE) AS revenue_sum
FROM ranked WHERE rn <= 2"""


def R(expr: str, alias: str) -> str:
    """Double output column snapped to single precision (see
    ``derrick.plans.catalog.normalise_double``)."""
    return f"CAST(CAST(CAST({expr} AS DOUBLE) AS FLOAT) AS DOUBLE) AS {alias}"


def EXACT_AVG(col: str) -> str:
    return f"fsum({col}) / count({col})"


def EXACT_SUM(col: str) -> str:
    return f"coalesce(fsum({col}), 0)"


def KEY_HASH(*keys: str, seed: int = 42) -> str:
    """60 bits of the MD5 of the keys as text; NULL is ``~``."""
    text = ", ".join(f"coalesce(CAST({k} AS VARCHAR), '~')" for k in keys)
    return f"CAST('0x' || substr(md5(concat_ws('|', {text}, '{seed}')), 1, 15) AS BIGINT)"


# ---------------------------------------------------------------- production
# pandas: flows fillna(0); temperature/pressure fillna(well median);
# downtime_coef = clip(downtime/24, 0, 1); then the IQR rule on oil,
# temperature, pressure, each on the rows the previous one left.
CLEAN = """,
p0 AS (
  SELECT well_id, CAST(date AS DATE) AS date,
         coalesce(oil_ton, 0) AS oil_ton, coalesce(gas_m3, 0) AS gas_m3,
         coalesce(water_m3, 0) AS water_m3, coalesce(energy_kwh, 0) AS energy_kwh,
         coalesce(downtime_hours, 0) AS downtime_hours,
         CASE WHEN well_id IS NOT NULL THEN
           coalesce(temperature, median(temperature) OVER (PARTITION BY well_id)) END AS temperature,
         CASE WHEN well_id IS NOT NULL THEN
           coalesce(pressure, median(pressure) OVER (PARTITION BY well_id)) END AS pressure,
         least(greatest(coalesce(downtime_hours, 0) / 24.0, 0), 1) AS downtime_coef
  FROM production),
b1 AS (SELECT quantile_cont(oil_ton, 0.25) AS q1, quantile_cont(oil_ton, 0.75) AS q3 FROM p0),
p1 AS (SELECT p0.* FROM p0, b1
       WHERE oil_ton >= q1 - 1.5 * (q3 - q1) AND oil_ton <= q3 + 1.5 * (q3 - q1)),
b2 AS (SELECT quantile_cont(temperature, 0.25) AS q1, quantile_cont(temperature, 0.75) AS q3 FROM p1),
p2 AS (SELECT p1.* FROM p1, b2
       WHERE temperature >= q1 - 1.5 * (q3 - q1) AND temperature <= q3 + 1.5 * (q3 - q1)),
b3 AS (SELECT quantile_cont(pressure, 0.25) AS q1, quantile_cont(pressure, 0.75) AS q3 FROM p2),
clean AS (SELECT p2.* FROM p2, b3
       WHERE pressure >= q1 - 1.5 * (q3 - q1) AND pressure <= q3 + 1.5 * (q3 - q1))
"""

FEATURES = CLEAN + """,
td AS (
  SELECT well_id, CAST(timestamp AS DATE) AS date, avg(pressure_out) AS avg_pressure,
         avg(temperature) AS avg_temperature, avg(vibration) AS avg_vibration,
         avg(pump_speed_rpm) AS avg_rpm, avg(pump_current) AS avg_current
  FROM telemetry WHERE well_id IS NOT NULL AND timestamp IS NOT NULL GROUP BY 1, 2),
f0 AS (SELECT c.*, td.avg_pressure, td.avg_temperature, td.avg_vibration, td.avg_rpm, td.avg_current
       FROM clean c LEFT JOIN td ON c.well_id = td.well_id AND c.date = td.date),
features AS (
  SELECT well_id, date, oil_ton, gas_m3, water_m3, energy_kwh, downtime_hours, temperature,
         pressure, downtime_coef,
         coalesce(avg_pressure, median(avg_pressure) OVER (PARTITION BY well_id)) AS avg_pressure,
         coalesce(avg_temperature, median(avg_temperature) OVER (PARTITION BY well_id)) AS avg_temperature,
         coalesce(avg_vibration, median(avg_vibration) OVER (PARTITION BY well_id)) AS avg_vibration,
         coalesce(avg_rpm, median(avg_rpm) OVER (PARTITION BY well_id)) AS avg_rpm,
         coalesce(avg_current, median(avg_current) OVER (PARTITION BY well_id)) AS avg_current
  FROM f0)
"""

CLEAN_COLS = ("well_id, date, " + ", ".join(
    R(c, c) for c in ["oil_ton", "gas_m3", "water_m3", "energy_kwh", "downtime_hours",
                      "temperature", "pressure", "downtime_coef"]))
FEATURE_COLS = CLEAN_COLS + ", " + ", ".join(
    R(c, c) for c in ["avg_pressure", "avg_temperature", "avg_vibration", "avg_rpm", "avg_current"])

ORACLE["clean_production"] = W("production") + CLEAN + f"SELECT {CLEAN_COLS} FROM clean"
ORACLE["feature_table"] = W("production", "telemetry") + FEATURES + f"SELECT {FEATURE_COLS} FROM features"

ORACLE["mart_daily_production"] = W("production", "telemetry") + FEATURES + f"""
SELECT date, {R(EXACT_SUM('oil_ton'), 'total_oil_ton')},
       {R('avg(avg_pressure)', 'avg_pressure')}, {R('avg(avg_temperature)', 'avg_temperature')},
       {R('avg(downtime_coef)', 'avg_downtime_coef')},
       CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month
FROM features WHERE date IS NOT NULL GROUP BY date"""

WELL_KPI = FEATURES + f""",
kpi AS (
  SELECT well_id, {EXACT_AVG('oil_ton')} AS avg_oil_ton, avg(downtime_coef) * 100 AS downtime_pct,
         avg(avg_pressure) AS avg_pressure, avg(avg_temperature) AS avg_temperature
  FROM features WHERE well_id IS NOT NULL GROUP BY well_id),
well_kpi AS (
  SELECT k.*, w.name, w.field_name, w.region, w.status,
         ROW_NUMBER() OVER (ORDER BY k.avg_oil_ton DESC NULLS LAST, k.well_id) AS performance_rank
  FROM kpi k LEFT JOIN wells w ON k.well_id = w.well_id)
"""
KPI_COLS = ("well_id, " + ", ".join(R(c, c) for c in ["avg_oil_ton", "downtime_pct", "avg_pressure",
                                                      "avg_temperature"])
            + ", name, field_name, region, status, CAST(performance_rank AS BIGINT) AS performance_rank")

ORACLE["mart_well_kpi"] = W("production", "telemetry", "wells") + WELL_KPI + f"SELECT {KPI_COLS} FROM well_kpi"

ORACLE["best_worst_wells"] = W("production", "telemetry", "wells") + WELL_KPI + f"""
SELECT {KPI_COLS}, 'best' AS segment FROM well_kpi WHERE performance_rank <= 3
UNION ALL
SELECT {KPI_COLS}, 'worst' AS segment FROM well_kpi
WHERE performance_rank > (SELECT count(*) FROM well_kpi) - 3"""

ORACLE["corr_influence"] = W("production", "telemetry") + FEATURES + f"""
SELECT 'avg_temperature' AS factor, {R('corr(avg_temperature, oil_ton)', 'corr_with_oil_ton')} FROM features
UNION ALL
SELECT 'avg_pressure' AS factor, {R('corr(avg_pressure, oil_ton)', 'corr_with_oil_ton')} FROM features"""


# ----------------------------------------------------------------- logistics
ENRICHED = """,
enriched AS (
  SELECT d.delivery_id, CAST(d.date AS DATE) AS date, d.driver_id, d.vehicle_id, d.source,
         d.destination, d.weather_conditions, d.volume_ton, d.cost_usd, d.delay_hours,
         d.distance_km, dr.name AS driver_name, CAST(dr.experience_years AS DOUBLE) AS experience_years,
         dr.region AS driver_region,
         v.capacity_ton, v.fuel_type,
         d.source || ' -> ' || d.destination AS route,
         CASE WHEN d.delay_hours > 0 THEN 1 ELSE 0 END AS delay_flag,
         CASE WHEN d.distance_km <> 0 THEN d.cost_usd / d.distance_km END AS cost_per_km,
         CASE WHEN v.capacity_ton <> 0 THEN greatest(d.volume_ton / v.capacity_ton, 0) END AS load_factor,
         CASE WHEN d.distance_km >= 0 AND d.distance_km <= 120 THEN 'short'
              WHEN d.distance_km > 120 AND d.distance_km <= 160 THEN 'medium'
              WHEN d.distance_km > 160 AND d.distance_km <= 200 THEN 'long'
              WHEN d.distance_km > 200 THEN 'very_long' END AS distance_bucket
  FROM deliveries d
  LEFT JOIN drivers dr ON d.driver_id = dr.driver_id
  LEFT JOIN vehicles v ON d.vehicle_id = v.vehicle_id)
"""
LOGI = W("deliveries", "drivers", "vehicles") + ENRICHED

ORACLE["enrich_deliveries"] = LOGI + "SELECT delivery_id, date, driver_id, vehicle_id, source, " \
    "destination, weather_conditions, driver_name, experience_years, driver_region, fuel_type, " \
    "route, delay_flag, distance_bucket, " + ", ".join(
        R(c, c) for c in ["volume_ton", "cost_usd", "delay_hours", "distance_km", "capacity_ton",
                          "cost_per_km", "load_factor"]) + " FROM enriched"

ORACLE["mart_delay_vs_weather"] = LOGI + f"""
SELECT weather_conditions, count(delivery_id) AS trips,
       {R(EXACT_AVG('delay_hours'), 'avg_delay_hours')},
       {R('avg(delay_flag) * 100', 'delay_rate_pct')},
       {R(EXACT_AVG('distance_km'), 'avg_distance_km')}
FROM enriched WHERE weather_conditions IS NOT NULL GROUP BY weather_conditions"""

ORACLE["mart_cost_vs_distance"] = LOGI + "SELECT delivery_id, date, route, source, destination, " \
    "driver_name, weather_conditions, " + ", ".join(
        R(c, c) for c in ["distance_km", "volume_ton", "cost_usd", "cost_per_km", "delay_hours"]) \
    + " FROM enriched"

ORACLE["mart_driver_kpi"] = LOGI + f"""
SELECT driver_id, driver_name, experience_years, driver_region, count(delivery_id) AS trips,
       {R(EXACT_SUM('volume_ton'), 'total_volume_ton')},
       {R(EXACT_SUM('cost_usd'), 'total_cost_usd')},
       {R(EXACT_AVG('delay_hours'), 'avg_delay_hours')},
       {R('avg(delay_flag) * 100', 'delay_rate_pct')},
       {R('avg(cost_per_km)', 'avg_cost_per_km')},
       {R(EXACT_AVG('distance_km'), 'avg_distance_km')},
       {R('avg(load_factor)', 'avg_load_factor')}
FROM enriched
WHERE driver_id IS NOT NULL AND driver_name IS NOT NULL AND experience_years IS NOT NULL
  AND driver_region IS NOT NULL
GROUP BY driver_id, driver_name, experience_years, driver_region"""

FACTOR_BUCKETS = f"""
SELECT b.factor_value, coalesce(a.trips, 0) AS trips, a.avg_delay_hours, 'distance_bucket' AS factor_type
FROM (VALUES ('short'), ('medium'), ('long'), ('very_long')) AS b(factor_value)
LEFT JOIN (SELECT distance_bucket, count(delivery_id) AS trips,
                  {R(EXACT_AVG('delay_hours'), 'avg_delay_hours')}
           FROM enriched_f WHERE distance_bucket IS NOT NULL GROUP BY distance_bucket) a
  ON a.distance_bucket = b.factor_value"""

ORACLE["agg_factor_long"] = LOGI + ", enriched_f AS (SELECT * FROM enriched)" + f"""
SELECT weather_conditions AS factor_value, count(delivery_id) AS trips,
       {R(EXACT_AVG('delay_hours'), 'avg_delay_hours')}, 'weather' AS factor_type
FROM enriched WHERE weather_conditions IS NOT NULL GROUP BY weather_conditions
UNION ALL {FACTOR_BUCKETS}
UNION ALL
SELECT driver_name AS factor_value, count(delivery_id) AS trips,
       {R(EXACT_AVG('delay_hours'), 'avg_delay_hours')}, 'driver' AS factor_type
FROM enriched WHERE driver_name IS NOT NULL GROUP BY driver_name"""

ORACLE["agg_full_domain"] = LOGI + ", enriched_f AS (SELECT * FROM enriched)" \
    + FACTOR_BUCKETS

# pandas rank(pct=True): (rows below + (ties + 1) / 2) / non-null count
ORACLE["mart_route_optimization"] = LOGI + f""",
routes AS (
  SELECT route, source, destination, count(delivery_id) AS trips,
         {EXACT_SUM('volume_ton')} AS total_volume_ton,
         {EXACT_AVG('distance_km')} AS avg_distance_km,
         {EXACT_AVG('delay_hours')} AS avg_delay_hours,
         avg(delay_flag) * 100 AS delay_rate_pct,
         {EXACT_AVG('cost_per_km')} AS avg_cost_per_km
  FROM enriched
  WHERE route IS NOT NULL AND source IS NOT NULL AND destination IS NOT NULL
  GROUP BY route, source, destination),
keyed AS (SELECT *, avg_delay_hours AS kd, avg_cost_per_km AS kc FROM routes),
ranked AS (
  SELECT *,
    CASE WHEN kd IS NOT NULL THEN
      ((rank() OVER (PARTITION BY kd IS NULL ORDER BY kd) - 1)
       + (count(*) OVER (PARTITION BY kd) + 1) / 2.0) / count(kd) OVER () END AS dn,
    CASE WHEN kc IS NOT NULL THEN
      ((rank() OVER (PARTITION BY kc IS NULL ORDER BY kc) - 1)
       + (count(*) OVER (PARTITION BY kc) + 1) / 2.0) / count(kc) OVER () END AS cn
  FROM keyed),
scored AS (SELECT *, round_even((0.6 * dn + 0.4 * cn) * 100.0 * 10, 0) / 10 AS route_risk_score FROM ranked),
prio AS (
  SELECT *, CASE WHEN route_risk_score > -0.1 AND route_risk_score <= 33 THEN 'low'
                 WHEN route_risk_score > 33 AND route_risk_score <= 66 THEN 'medium'
                 WHEN route_risk_score > 66 AND route_risk_score <= 100 THEN 'high' END AS priority
  FROM scored)
SELECT route, source, destination, trips, {R('total_volume_ton', 'total_volume_ton')},
       {R('avg_distance_km', 'avg_distance_km')}, {R('avg_delay_hours', 'avg_delay_hours')},
       {R('delay_rate_pct', 'delay_rate_pct')}, {R('avg_cost_per_km', 'avg_cost_per_km')},
       {R('route_risk_score', 'route_risk_score')}, priority,
       CASE WHEN priority = 'high' THEN 'replan immediately'
            WHEN priority = 'medium' THEN 'monitor and optimize' ELSE 'keep current' END
         AS recommended_action
FROM prio"""


# ----------------------------------------------------------------- equipment
PUMPS = W("pump_sensors", "pump_failures")
COERCED = """,
coerced AS (
  SELECT record_id, pump_id, timestamp,
         TRY_CAST(temperature AS DOUBLE) AS temperature, TRY_CAST(vibration AS DOUBLE) AS vibration,
         TRY_CAST(current AS DOUBLE) AS current, TRY_CAST(rpm AS DOUBLE) AS rpm,
         TRY_CAST(pressure AS DOUBLE) AS pressure
  FROM pump_sensors)
"""
# readings with all five features, hours to the next failure of the pump at
# or after the reading (infinity if none), and the 24 h label
LABELLED = COERCED + """,
complete AS (
  SELECT * FROM coerced
  WHERE temperature IS NOT NULL AND vibration IS NOT NULL AND current IS NOT NULL
    AND rpm IS NOT NULL AND pressure IS NOT NULL),
nxt AS (
  SELECT c.*, (SELECT min(f.failure_date) FROM pump_failures f
               WHERE f.pump_id = c.pump_id AND f.failure_date >= c.timestamp) AS next_failure
  FROM complete c),
labelled AS (
  SELECT *, coalesce((epoch_us(next_failure) - epoch_us(timestamp)) / 3.6e9,
                     'inf'::DOUBLE) AS hours_to_failure
  FROM nxt),
lab AS (SELECT *, CASE WHEN hours_to_failure <= 24 THEN 1 ELSE 0 END AS will_fail_24h FROM labelled),
latest AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY pump_id
                                 ORDER BY timestamp DESC NULLS FIRST, record_id DESC) AS rn
    FROM lab) WHERE rn = 1)
"""

ORACLE["zscore_global"] = PUMPS + COERCED + f""",
clean AS (SELECT * FROM coerced WHERE temperature IS NOT NULL AND vibration IS NOT NULL
          AND current IS NOT NULL AND rpm IS NOT NULL),
st AS (SELECT avg(temperature) AS mt, stddev_pop(temperature) AS st, avg(vibration) AS mv,
              stddev_pop(vibration) AS sv, avg(current) AS mc, stddev_pop(current) AS sc,
              avg(rpm) AS mr, stddev_pop(rpm) AS sr FROM clean),
z AS (
  SELECT record_id, pump_id, timestamp, greatest(
      abs(CASE WHEN st > 0 THEN (temperature - mt) / st ELSE 0 END),
      abs(CASE WHEN sv > 0 THEN (vibration - mv) / sv ELSE 0 END),
      abs(CASE WHEN sc > 0 THEN (current - mc) / sc ELSE 0 END),
      abs(CASE WHEN sr > 0 THEN (rpm - mr) / sr ELSE 0 END)) AS m
  FROM clean, st)
SELECT record_id, pump_id, timestamp, {R('m', 'max_abs_zscore')}, m > 3 AS is_anomaly_zscore FROM z"""

ORACLE["join_time_range"] = PUMPS + f"""
SELECT f.failure_id, s.pump_id, f.failure_type, s.timestamp,
       {R('(epoch_us(f.failure_date) - epoch_us(s.timestamp)) / 3.6e9', 'hours_before_failure')},
       s.temperature, s.vibration, s.current, s.rpm, s.pressure
FROM pump_failures f JOIN pump_sensors s
  ON s.pump_id = f.pump_id
 AND s.timestamp >= f.failure_date - INTERVAL 24 HOUR AND s.timestamp <= f.failure_date"""

ORACLE["join_next_event"] = PUMPS + LABELLED + f"""
SELECT record_id, pump_id, timestamp, {R('hours_to_failure', 'hours_to_failure')},
       will_fail_24h FROM lab"""

ORACLE["latest_per_key"] = PUMPS + LABELLED + """
SELECT pump_id, record_id, timestamp, will_fail_24h FROM latest"""

# pandas rank(pct=True) over the latest reading of each pump
PCT = ("((rank() OVER (ORDER BY {c}) - 1) + (count(*) OVER (PARTITION BY {c}) + 1) / 2.0)"
       " / count({c}) OVER ()")
ORACLE["risk_heuristic"] = PUMPS + LABELLED + f""",
ranked AS (
  SELECT *, ({PCT.format(c='vibration')} + {PCT.format(c='temperature')}
             + {PCT.format(c='current')}) / 3.0 AS risk_probability
  FROM latest),
scored AS (SELECT *, round_even(risk_probability * 100.0 * 10, 0) / 10 AS risk_score FROM ranked)
SELECT pump_id, timestamp, {R('temperature', 'temperature')}, {R('vibration', 'vibration')},
       {R('current', 'current')}, {R('rpm', 'rpm')}, {R('pressure', 'pressure')},
       {R('risk_probability', 'risk_probability')}, {R('risk_score', 'risk_score')},
       CASE WHEN risk_score > -0.1 AND risk_score <= 33 THEN 'low'
            WHEN risk_score > 33 AND risk_score <= 66 THEN 'medium'
            WHEN risk_score > 66 AND risk_score <= 100 THEN 'high' END AS risk_level
FROM scored"""


# ------------------------------------------------------------------ forecast
TELE_DAILY = """
SELECT well_id, CAST(timestamp AS DATE) AS date, {cols}
FROM telemetry WHERE well_id IS NOT NULL AND timestamp IS NOT NULL GROUP BY 1, 2"""

ORACLE["agg_telemetry_daily"] = W("telemetry") + TELE_DAILY.format(cols=", ".join([
    R("avg(pressure_out)", "avg_pressure"), R("avg(temperature)", "avg_temperature"),
    R("avg(vibration)", "avg_vibration"), R("avg(pump_speed_rpm)", "avg_rpm"),
    R("avg(pump_current)", "avg_current")]))

ORACLE["agg_telemetry_power"] = W("telemetry") + TELE_DAILY.format(cols=", ".join([
    R("avg(pressure_out)", "pressure"), R("avg(temperature)", "temperature"),
    R("avg(pump_current * pump_speed_rpm / 1000.0)", "pump_power_kw"),
    "CAST(count(timestamp) AS DOUBLE) AS pump_runtime_hours"]))

# targets <- daily telemetry <- raw production fallbacks; well median, then
# overall median (taken after the well step); rows without target dropped
TARGETS = """,
tp AS (
  SELECT well_id, CAST(timestamp AS DATE) AS date, avg(pressure_out) AS pressure,
         avg(temperature) AS temperature, avg(pump_current * pump_speed_rpm / 1000.0) AS pump_power_kw,
         CAST(count(timestamp) AS DOUBLE) AS pump_runtime_hours
  FROM telemetry WHERE well_id IS NOT NULL AND timestamp IS NOT NULL GROUP BY 1, 2),
pf AS (
  SELECT well_id, CAST(date AS DATE) AS date, pressure AS prod_pressure,
         temperature AS prod_temperature, energy_kwh / 24.0 AS prod_power_kw,
         CASE WHEN downtime_hours IS NOT NULL THEN least(greatest(24 - downtime_hours, 0), 24) END
           AS prod_runtime_hours
  FROM production),
ds0 AS (
  SELECT t.well_id, CAST(t.date AS DATE) AS date, t.daily_oil_ton AS target_oil_ton,
         coalesce(tp.pressure, pf.prod_pressure) AS pressure,
         coalesce(tp.temperature, pf.prod_temperature) AS temperature,
         coalesce(tp.pump_power_kw, pf.prod_power_kw) AS pump_power_kw,
         coalesce(tp.pump_runtime_hours, pf.prod_runtime_hours) AS pump_runtime_hours
  FROM well_targets t
  LEFT JOIN tp ON t.well_id = tp.well_id AND CAST(t.date AS DATE) = tp.date
  LEFT JOIN pf ON t.well_id IS NOT DISTINCT FROM pf.well_id
              AND CAST(t.date AS DATE) IS NOT DISTINCT FROM pf.date),
ds1 AS (
  SELECT well_id, date, target_oil_ton,
    CASE WHEN well_id IS NOT NULL THEN coalesce(pressure, median(pressure) OVER (PARTITION BY well_id)) END AS pressure,
    CASE WHEN well_id IS NOT NULL THEN coalesce(temperature, median(temperature) OVER (PARTITION BY well_id)) END AS temperature,
    CASE WHEN well_id IS NOT NULL THEN coalesce(pump_power_kw, median(pump_power_kw) OVER (PARTITION BY well_id)) END AS pump_power_kw,
    CASE WHEN well_id IS NOT NULL THEN coalesce(pump_runtime_hours, median(pump_runtime_hours) OVER (PARTITION BY well_id)) END AS pump_runtime_hours
  FROM ds0),
ds AS (
  SELECT well_id, date, target_oil_ton,
         coalesce(pressure, (SELECT median(pressure) FROM ds1)) AS pressure,
         coalesce(temperature, (SELECT median(temperature) FROM ds1)) AS temperature,
         coalesce(pump_power_kw, (SELECT median(pump_power_kw) FROM ds1)) AS pump_power_kw,
         coalesce(pump_runtime_hours, (SELECT median(pump_runtime_hours) FROM ds1)) AS pump_runtime_hours
  FROM ds1 WHERE target_oil_ton IS NOT NULL)
"""
TGT = W("well_targets", "telemetry", "production") + TARGETS

ORACLE["target_dataset"] = TGT + "SELECT well_id, date, " + ", ".join(
    R(c, c) for c in ["target_oil_ton", "pressure", "temperature", "pump_power_kw",
                      "pump_runtime_hours"]) + " FROM ds"

ORACLE["fit_linear"] = TGT + f"""
SELECT {R('regr_slope(target_oil_ton, pressure)', 'slope')},
       {R('regr_intercept(target_oil_ton, pressure)', 'intercept')},
       count(*) AS rows_used
FROM ds WHERE pressure IS NOT NULL"""

ORACLE["regression_metrics"] = W("well_targets", "production") + f""",
pairs AS (SELECT t.daily_oil_ton AS y, p.oil_ton AS yhat
          FROM well_targets t JOIN production p ON t.well_id = p.well_id AND t.date = p.date
          WHERE t.daily_oil_ton IS NOT NULL AND p.oil_ton IS NOT NULL)
SELECT {R('avg(abs(y - yhat))', 'mae')}, {R('sqrt(avg((y - yhat) * (y - yhat)))', 'rmse')},
       {R('1 - sum((y - yhat) * (y - yhat)) / (count(y) * var_pop(y))', 'r2')},
       count(*) AS rows_used
FROM pairs"""


ORACLE["split_train_test"] = TGT + f"""
SELECT {KEY_HASH('well_id', 'date')} < {int(0.25 * (1 << 60))} AS is_test, count(*) AS rows
FROM ds GROUP BY 1"""

# the rows of the floor(n / 4 + 1 / 2) smallest hashes of each class
ORACLE["split_stratified"] = PUMPS + LABELLED + f""",
h AS (SELECT will_fail_24h, {KEY_HASH('record_id')} AS h FROM lab),
r AS (SELECT *, row_number() OVER (PARTITION BY will_fail_24h ORDER BY h) AS place,
             count(*) OVER (PARTITION BY will_fail_24h) AS n FROM h)
SELECT will_fail_24h, place <= floor(n * 0.25 + 0.5) AS is_test, count(*) AS rows FROM r GROUP BY 1, 2"""

ORACLE["error_over_time"] = W("well_targets", "production") + f""",
t AS (SELECT well_id, date, daily_oil_ton AS y FROM well_targets
      WHERE well_id IS NOT NULL AND date IS NOT NULL AND daily_oil_ton IS NOT NULL),
e AS (SELECT 'reported' AS model, t.date, y - p.oil_ton AS e FROM t JOIN production p
        ON t.well_id = p.well_id AND t.date = p.date
      UNION ALL
      SELECT 'day_before', t.date, t.y - b.y FROM t JOIN t b ON t.well_id = b.well_id AND t.date = b.date + 1)
SELECT model, strftime(CAST(date AS DATE), '%Y-%m-%d') AS date, {R('avg(abs(e))', 'mae_day')},
       {R('sqrt(avg(e * e))', 'rmse_day')}
FROM e WHERE e IS NOT NULL GROUP BY model, date"""


# ------------------------------------------------------------------- changes
# Replay per id: an item exists from its first valid create up to the first
# delete after it; updates/deletes outside that span are "not found", any
# other create "id exists". Latest given field values win; a create sets
# completed to false.
CHANGES = W("item_changes") + """,
v AS (
  SELECT *, CASE
      WHEN op NOT IN ('create', 'update', 'delete') THEN 'unknown operation'
      WHEN op = 'create' AND title IS NULL THEN 'title required'
      WHEN op IN ('create', 'update') AND title IS NOT NULL
           AND (length(title) < 1 OR length(title) > 200) THEN 'title length'
      WHEN op IN ('create', 'update') AND description IS NOT NULL
           AND length(description) > 2000 THEN 'description length' END AS reason
  FROM item_changes),
v1 AS (SELECT *, min(CASE WHEN reason IS NULL AND op = 'create' THEN seq END)
                   OVER (PARTITION BY id) AS c0 FROM v),
v2 AS (SELECT *, min(CASE WHEN reason IS NULL AND op = 'delete' AND seq > c0 THEN seq END)
                   OVER (PARTITION BY id) AS d0 FROM v1),
decided AS (
  SELECT *, CASE
      WHEN reason IS NOT NULL THEN reason
      WHEN op = 'create' AND seq = c0 THEN NULL
      WHEN op IN ('update', 'delete') AND seq > c0 AND (d0 IS NULL OR seq <= d0) THEN NULL
      WHEN op = 'create' THEN 'id exists'
      ELSE 'not found' END AS outcome
  FROM v2),
snap AS (
  SELECT id,
         arg_max(title, seq) FILTER (WHERE title IS NOT NULL) AS title,
         arg_max(description, seq) FILTER (WHERE description IS NOT NULL) AS description,
         arg_max(CASE WHEN op = 'create' THEN false ELSE completed END, seq)
           FILTER (WHERE op = 'create' OR completed IS NOT NULL) AS completed,
         min(CASE WHEN op = 'create' THEN ts END) AS created_at
  FROM decided WHERE outcome IS NULL AND d0 IS NULL GROUP BY id)
"""

ORACLE["changes_validate"] = CHANGES + "SELECT seq, op, id, reason, reason IS NULL AS valid FROM v"
ORACLE["changes_apply"] = CHANGES + "SELECT * FROM snap"
ORACLE["changes_rejects"] = CHANGES + \
    "SELECT seq, op, id, outcome AS reason FROM decided WHERE outcome IS NOT NULL"
ORACLE["lookup_by_id"] = CHANGES + """
SELECT r.id, s.title, s.description, s.created_at, s.id IS NOT NULL AS found,
       CAST(CAST(CAST(s.completed AS BOOLEAN) AS INTEGER) AS VARCHAR) AS completed
FROM (SELECT DISTINCT id FROM item_changes WHERE op <> 'create') r
LEFT JOIN snap s ON r.id = s.id"""
ORACLE["snapshot_newest_first"] = CHANGES + """
SELECT id, title, description, CAST(completed AS BOOLEAN) AS completed, created_at
FROM snap ORDER BY id DESC"""
