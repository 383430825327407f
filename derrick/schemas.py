"""Explicit schemas of the operational input tables (enforced on read, so
empty inputs still carry their columns)."""

from __future__ import annotations

from pyspark.sql import types as T

D, L, S, I, B = T.DoubleType(), T.LongType(), T.StringType(), T.IntegerType(), T.BooleanType()
TS, DT = T.TimestampType(), T.DateType()


def _s(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


INPUTS: dict[str, T.StructType] = {
    "wells": _s(("well_id", L), ("name", S), ("field_name", S), ("region", S), ("status", S)),
    "production": _s(("well_id", L), ("date", DT), ("oil_ton", D), ("gas_m3", D), ("water_m3", D),
                     ("energy_kwh", D), ("downtime_hours", D), ("temperature", D), ("pressure", D)),
    "telemetry": _s(("well_id", L), ("timestamp", TS), ("pressure_out", D), ("temperature", D),
                    ("vibration", D), ("pump_speed_rpm", D), ("pump_current", D)),
    "well_targets": _s(("well_id", L), ("date", DT), ("daily_oil_ton", D)),
    "pump_sensors": _s(("record_id", L), ("pump_id", L), ("timestamp", TS), ("temperature", S),
                       ("vibration", S), ("current", S), ("rpm", S), ("pressure", S)),
    "pump_failures": _s(("failure_id", L), ("pump_id", L), ("failure_date", TS),
                        ("failure_type", S)),
    "deliveries": _s(("delivery_id", L), ("date", DT), ("driver_id", L), ("vehicle_id", L),
                     ("source", S), ("destination", S), ("weather_conditions", S),
                     ("volume_ton", D), ("cost_usd", D), ("delay_hours", D), ("distance_km", D)),
    "drivers": _s(("driver_id", L), ("name", S), ("experience_years", I), ("region", S)),
    "vehicles": _s(("vehicle_id", L), ("capacity_ton", D), ("fuel_type", S)),
    "users": _s(("user_id", S), ("city", S)),
    "orders": _s(("order_id", S), ("user_id", S), ("product_id", S), ("qty", L), ("price", D)),
    "products": _s(("product_id", S), ("product_name", S)),
    "items": _s(("id", L), ("title", S), ("description", S), ("completed", B), ("created_at", TS)),
    "item_changes": _s(("seq", L), ("op", S), ("id", L), ("title", S), ("description", S),
                       ("completed", B), ("ts", TS)),
}
