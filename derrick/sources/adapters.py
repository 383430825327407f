"""Adapters: the driver's TPC-H-style tables reshaped into the operational
tables the marts consume (wells, production, telemetry, ...).

Each adapter is one SQL text that runs unchanged in Spark SQL and DuckDB.
Table references are written ``{name}``: Spark binds them to DataFrames
(``spark.sql(text, name=df)``), the DuckDB oracle to its pre-registered views.
Nulls, text measures, zero divisors and unmatched keys are put in by fixed
CASE rules on ids; no adapter drops rows, so every derived table reads its
whole source (failures are the error events).

Money and tonnage are summed as DECIMAL and turned back into DOUBLE once, so
both engines produce bit-identical inputs. Only stored fixed-scale values or
exact products are cast to DECIMAL, never quotients: a quotient can sit on a
rounding midpoint, where the two engines' double-to-decimal casts disagree.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: adapter definitions (inputs for every registered query) ---
ADAPTERS: dict[str, str] = {
    "wells": """
SELECT s_suppkey AS well_id, s_name AS name, n_name AS field_name, r_name AS region,
       CASE WHEN s_acctbal < 0 THEN 'idle' ELSE 'active' END AS status
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey""",
    "production": """
SELECT user_id AS well_id, CAST(ts AS DATE) AS date,
       CASE WHEN MIN(event_id) % 17 = 0 THEN NULL
            ELSE CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) END AS oil_ton,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) * 10 AS DOUBLE) AS gas_m3,
       CAST(COUNT(*) AS DOUBLE) AS water_m3,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) * 3 AS DOUBLE) AS energy_kwh,
       CASE WHEN MIN(event_id) % 11 = 0 THEN NULL
            ELSE CAST(MIN(event_id) % 30 AS DOUBLE) END AS downtime_hours,
       CASE WHEN MIN(event_id) % 7 = 0 THEN NULL ELSE MAX(value) END AS temperature,
       CASE WHEN MIN(event_id) % 13 = 0 THEN NULL ELSE MIN(value) END AS pressure
FROM {events}
GROUP BY user_id, CAST(ts AS DATE)""",
    "telemetry": """
SELECT user_id AS well_id, ts AS timestamp,
       CASE WHEN event_id % 19 = 0 THEN NULL ELSE value END AS pressure_out,
       value / 4 + 40 AS temperature,
       CAST(event_id % 9 AS DOUBLE) AS vibration,
       CAST(1000 + event_id % 500 AS DOUBLE) AS pump_speed_rpm,
       CAST(event_id % 60 AS DOUBLE) AS pump_current
FROM {events}""",
    "well_targets": """
SELECT user_id AS well_id, CAST(ts AS DATE) AS date,
       CASE WHEN MIN(event_id) % 23 = 0 THEN NULL
            ELSE CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) END AS daily_oil_ton
FROM {events}
GROUP BY user_id, CAST(ts AS DATE)""",
    "pump_sensors": """
SELECT event_id AS record_id, user_id AS pump_id, ts AS timestamp,
       CAST(value AS STRING) AS temperature,
       CASE WHEN event_id % 29 = 0 THEN 'bad' ELSE CAST(event_id % 9 AS STRING) END AS vibration,
       CAST(event_id % 60 AS STRING) AS current,
       CAST(1000 + event_id % 500 AS STRING) AS rpm,
       CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(event_id % 37 AS STRING) END AS pressure
FROM {events}""",
    "pump_failures": """
SELECT event_id AS failure_id, user_id AS pump_id, ts AS failure_date,
       CASE WHEN event_id % 3 = 0 THEN 'bearing' WHEN event_id % 3 = 1 THEN 'seal'
            ELSE 'motor' END AS failure_type
FROM {events}
WHERE event_type = 'error'""",
    "deliveries": """
SELECT l_orderkey * 10 + l_linenumber AS delivery_id, CAST(l_shipdate AS DATE) AS date,
       CASE WHEN l_orderkey % 53 = 0 THEN -l_suppkey ELSE l_suppkey END AS driver_id,
       CASE WHEN l_orderkey % 59 = 0 THEN -l_partkey ELSE l_partkey END AS vehicle_id,
       n_name AS source,
       CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_linestatus END AS destination,
       CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE l_returnflag END AS weather_conditions,
       l_quantity AS volume_ton,
       CAST(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS DOUBLE) AS cost_usd,
       CASE WHEN l_partkey % 43 = 0 THEN NULL
            ELSE CAST(CAST(l_tax * 100 - 4 AS DECIMAL(6,2)) AS DOUBLE) END AS delay_hours,
       CASE WHEN l_partkey % 50 = 0 THEN CAST(0 AS DOUBLE)
            ELSE CAST(CAST(l_extendedprice * 0.002 AS DECIMAL(14,5)) AS DOUBLE) END AS distance_km
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
JOIN {customer} ON o_custkey = c_custkey
JOIN {nation} ON c_nationkey = n_nationkey""",
    "drivers": """
SELECT s_suppkey AS driver_id, s_name AS name,
       CAST(s_suppkey % 30 AS INT) AS experience_years, r_name AS region
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey""",
    "vehicles": """
SELECT p_partkey AS vehicle_id,
       CASE WHEN p_size = 50 THEN CAST(0 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) END AS capacity_ton,
       p_type AS fuel_type
FROM {part}""",
    # the three tables of the city top-products mart
    "shop_users": """
SELECT c_custkey AS user_id, c_mktsegment AS city FROM {customer}""",
    "shop_orders": """
SELECT l_orderkey AS order_id, o_custkey AS user_id, l_partkey AS product_id,
       CAST(l_quantity AS BIGINT) AS qty,
       CAST(p_retailprice AS DECIMAL(12,2)) AS price
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
JOIN {part} ON l_partkey = p_partkey""",
    "shop_products": """
SELECT p_partkey AS product_id, p_name AS product_name FROM {part}""",
    # change log of the keyed item table: signups create, some errors delete,
    # the rest update; some titles empty or too long, some fields left out
    "item_changes": """
SELECT event_id AS seq,
       CASE WHEN event_type = 'signup' THEN 'create'
            WHEN event_type = 'error' AND event_id % 29 = 0 THEN 'delete'
            ELSE 'update' END AS op,
       user_id AS id,
       CASE WHEN event_type = 'error' AND event_id % 29 = 0 THEN NULL
            WHEN event_id % 13 = 0 THEN ''
            WHEN event_id % 17 = 0 THEN repeat('t', 201)
            WHEN event_id % 19 = 0 THEN repeat('t', 200)
            WHEN event_type <> 'signup' AND event_id % 3 = 0 THEN NULL
            ELSE concat('item ', CAST(event_id AS STRING)) END AS title,
       CASE WHEN (event_type = 'error' AND event_id % 29 = 0) OR event_id % 5 = 0 THEN NULL
            WHEN event_id % 101 = 0 THEN repeat(props, 250)
            ELSE props END AS description,
       CASE WHEN event_type = 'signup' OR (event_type = 'error' AND event_id % 29 = 0)
                 OR event_id % 4 = 0 THEN NULL
            ELSE value > 100 END AS completed,
       ts
FROM {events}""",
}
# --- end of fixed values ---

SOURCE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")


def referenced_tables(name: str) -> list[str]:
    """Driver tables an adapter reads."""
    fields = {f for _, f, _, _ in string.Formatter().parse(ADAPTERS[name]) if f}
    return sorted(fields)


def duckdb_text(name: str) -> str:
    """Adapter SQL with plain table names, for the DuckDB oracle."""
    return ADAPTERS[name].format(**{t: t for t in referenced_tables(name)})


def with_clause(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the oracle, adapters in given order."""
    parts = [f"{n} AS ({duckdb_text(n)}\n)" for n in names]
    return "WITH " + ",\n".join(parts) + "\n"


def read_source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One adapter as a DataFrame over the driver tables in ``sf_dir``."""
    frames = {t: read_source(spark, sf_dir, t) for t in referenced_tables(name)}
    return spark.sql(ADAPTERS[name], **frames)


def load_many(spark: SparkSession, sf_dir: str, *names: str) -> tuple[DataFrame, ...]:
    return tuple(load(spark, sf_dir, n) for n in names)
