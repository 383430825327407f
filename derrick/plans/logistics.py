"""Logistics marts: enriched deliveries, delay vs weather, cost vs distance,
driver KPIs, delay factors and route priorities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.functions.exprs import (DISTANCE_LABELS, bin_distance, bin_risk, bool_flag,
                                     case_action, clip, coerce_numeric, concat_route,
                                     round_half_even, safe_div)
from derrick.operators.aggregates import exact_agg
from derrick.operators.joins import join_left_dim
from derrick.operators.windows import rank_pct
from derrick.session import cut_lineage

NUMERIC = ["volume_ton", "cost_usd", "delay_hours", "distance_km"]
COST_VS_DISTANCE = ["delivery_id", "date", "route", "source", "destination", "driver_name",
                    "weather_conditions", "distance_km", "volume_ton", "cost_usd",
                    "cost_per_km", "delay_hours"]
DRIVER_KEYS = ["driver_id", "driver_name", "experience_years", "driver_region"]
ROUTE_KEYS = ["route", "source", "destination"]


def enrich_deliveries(deliveries: DataFrame, drivers: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Coerce measures, attach driver and vehicle, derive route, delay flag,
    cost per km, load factor and distance bucket."""
    d = deliveries.withColumn("date", F.col("date").cast("date"))
    d = d.withColumns({c: coerce_numeric(c) for c in NUMERIC})
    v = vehicles.withColumn("capacity_ton", coerce_numeric("capacity_ton"))
    d = join_left_dim(d, drivers, "driver_id", ["name", "experience_years", "region"],
                      rename={"name": "driver_name", "region": "driver_region"})
    d = join_left_dim(d, v, "vehicle_id", ["capacity_ton", "fuel_type"])
    return d.withColumns({
        # float after the left join, as in pandas (missing drivers are NaN)
        "experience_years": F.col("experience_years").cast("double"),
        "route": concat_route("source", "destination"),
        "delay_flag": bool_flag(F.col("delay_hours") > 0),
        "cost_per_km": safe_div("cost_usd", "distance_km"),
        "load_factor": clip(safe_div("volume_ton", "capacity_ton"), lower=0.0),
        "distance_bucket": bin_distance("distance_km"),
    })


def delay_vs_weather(enriched: DataFrame) -> DataFrame:
    return _percent(exact_agg(enriched, ["weather_conditions"], {"trips": "delivery_id"}, means={
        "avg_delay_hours": "delay_hours", "delay_rate_pct": "delay_flag", "avg_distance_km": "distance_km"}))


def _percent(df: DataFrame) -> DataFrame:
    return df.withColumn("delay_rate_pct", F.col("delay_rate_pct") * 100.0)


def cost_vs_distance(enriched: DataFrame) -> DataFrame:
    return enriched.select(*COST_VS_DISTANCE)


def driver_kpi(enriched: DataFrame) -> DataFrame:
    """Per driver (deliveries without a known driver drop out)."""
    out = exact_agg(enriched, DRIVER_KEYS, {"trips": "delivery_id"},
                    sums={"total_volume_ton": "volume_ton", "total_cost_usd": "cost_usd"},
                    means={"avg_delay_hours": "delay_hours", "delay_rate_pct": "delay_flag",
                           "avg_cost_per_km": "cost_per_km", "avg_distance_km": "distance_km",
                           "avg_load_factor": "load_factor"}, many=True)
    return _percent(out)


def delay_factors(enriched: DataFrame) -> DataFrame:
    """Trips and mean delay by weather, by distance bucket (all four buckets,
    empty ones with 0 trips) and by driver name, stacked long.

    One scan: a delivery takes part once per factor that it has (pandas drops
    NULL keys).
    """
    factors = F.array(*[F.struct(F.lit(t).alias("factor_type"), F.col(c).alias("factor_value")) for t, c in (
        ("weather", "weather_conditions"), ("distance_bucket", "distance_bucket"), ("driver", "driver_name"))])
    keyed = enriched.select(F.explode(factors).alias("f"), "delivery_id", "delay_hours").select(
        "f.factor_type", "f.factor_value", "delivery_id", "delay_hours")
    long = exact_agg(keyed, ["factor_value", "factor_type"], {"trips": "delivery_id"},
                     means={"avg_delay_hours": "delay_hours"})
    # full bucket domain (observed=False): buckets without trips appear with
    # 0 trips; one outer join against the 4-row domain, so the aggregate above
    # is computed once
    spark = enriched.sparkSession
    domain = spark.createDataFrame([(b, "distance_bucket") for b in DISTANCE_LABELS],
                                   "factor_value string, factor_type string")
    return (long.join(domain, ["factor_value", "factor_type"], "full_outer")
            .select("factor_value", F.coalesce("trips", F.lit(0)).alias("trips"),
                    "avg_delay_hours", "factor_type"))


def route_optimization(enriched: DataFrame) -> DataFrame:
    """Per route: volume, distance, delay, delay rate, cost per km; risk score
    from percentile ranks of delay (60 %) and cost (40 %); priority and
    recommended action."""
    # one row per route, read by both rank passes; exact means, so ties are ties
    routes = cut_lineage(_percent(exact_agg(
        enriched, ROUTE_KEYS, {"trips": "delivery_id"}, sums={"total_volume_ton": "volume_ton"},
        means={"avg_distance_km": "distance_km", "avg_delay_hours": "delay_hours",
               "delay_rate_pct": "delay_flag", "avg_cost_per_km": "cost_per_km"})))
    ranked = rank_pct(routes, "avg_delay_hours", "__delay_norm")
    ranked = rank_pct(ranked, "avg_cost_per_km", "__cost_norm")
    score = round_half_even((F.lit(0.6) * F.col("__delay_norm")
                             + F.lit(0.4) * F.col("__cost_norm")) * F.lit(100.0), 1)
    return (ranked.withColumn("route_risk_score", score)
            .withColumn("priority", bin_risk("route_risk_score"))
            .withColumn("recommended_action", case_action("priority"))
            .drop("__delay_norm", "__cost_norm"))
