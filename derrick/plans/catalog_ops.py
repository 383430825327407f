"""Registered queries for single operators (scalar functions, filters, joins,
aggregates, windows, sort/limit/union, sources). Each runs over whole adapted
tables; see :mod:`derrick.plans.catalog` for the marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from derrick.functions import exprs as X
from derrick.operators import aggregates as AG
from derrick.operators import clean as CL
from derrick.operators import filters as FI
from derrick.operators import joins as J
from derrick.operators import windows as WN
from derrick.operators.stats import quantiles
from derrick.plans import equipment as EQ
from derrick.plans import forecast as FC
from derrick.plans import logistics as L
from derrick.plans import notebook as NB
from derrick.plans import production as P
from derrick.plans import products as PR
from derrick.plans.catalog import _enriched, _features, _pumps, _target_inputs, register
from derrick.schemas import INPUTS
from derrick.sources import adapters as A
from derrick.sources import tables as TB


# ------------------------------------------------------------- scans
@register("scan_table")
def q_scan_table(spark, sf):
    return TB.enforce_schema(A.load(spark, sf, "production"), INPUTS["production"])


@register("scan_ordered")
def q_scan_ordered(spark, sf):
    return TB.scan_ordered(A.load(spark, sf, "telemetry"), "timestamp", "well_id")


@register("scan_parquet")
def q_scan_parquet(spark, sf):
    return TB.scan_parquet(spark, f"{sf}/lineitem.parquet")


# ------------------------------------------------------------- scalar functions
@register("cast_datetime")
def q_cast_datetime(spark, sf):
    f = A.load(spark, sf, "pump_failures")
    return f.select("failure_id",
                    X.cast_datetime("failure_date", "date").alias("failure_day"),
                    X.cast_datetime(F.col("failure_date").cast("string"), "timestamp_ntz")
                    .alias("failure_ts"))


@register("cast_numeric_coerce")
def q_coerce(spark, sf):
    s = A.load(spark, sf, "pump_sensors")
    return (s.select("record_id", *[X.coerce_numeric(c).alias(c)
                                               for c in EQ.SENSOR_COLUMNS]))


@register("fill_const")
def q_fill_const(spark, sf):
    p = A.load(spark, sf, "production")
    return (p.select("well_id", "date", *[X.fill_const(c, 0.0).alias(c)
                                                     for c in P.FLOW_MEASURES]))


@register("fallback_coalesce")
def q_fallback(spark, sf):
    return FC.target_with_fallbacks(*_target_inputs(spark, sf))


@register("clip_range")
def q_clip(spark, sf):
    p = A.load(spark, sf, "production")
    return (p.select(
        "well_id", "date",
        X.clip(F.col("downtime_hours") / 24.0, 0.0, 1.0).alias("downtime_coef"),
        X.clip(F.lit(24.0) - F.col("downtime_hours"), 0.0, 24.0).alias("runtime_hours"),
        X.clip(F.col("pressure") - 100.0, lower=0.0).alias("excess_pressure")))


@register("safe_ratio")
def q_safe_ratio(spark, sf):
    d, v = A.load_many(spark, sf, "deliveries", "vehicles")
    j = J.join_left_dim(d, v, "vehicle_id", ["capacity_ton"])
    return (j.select("delivery_id", "vehicle_id",
                                X.safe_div("cost_usd", "distance_km").alias("cost_per_km"),
                                X.safe_div("volume_ton", "capacity_ton").alias("load_factor")))


@register("arith_derive")
def q_arith(spark, sf):
    t = A.load(spark, sf, "telemetry")
    return (t.select(
        "well_id", "timestamp",
        (F.col("pump_current") * F.col("pump_speed_rpm") / 1000.0).alias("power_kw"),
        (F.lit(24.0) - F.col("vibration")).alias("hours_left"),
        F.abs(F.col("temperature") - F.col("pressure_out")).alias("abs_gap"),
        F.pow(F.col("temperature") - 40.0, 2).alias("sq_gap")))


@register("concat_route")
def q_concat(spark, sf):
    d = A.load(spark, sf, "deliveries")
    return d.select("delivery_id", "source", "destination",
                    X.concat_route("source", "destination").alias("route"))


@register("bool_flag")
def q_bool_flag(spark, sf):
    d = A.load(spark, sf, "deliveries")
    return d.select("delivery_id", "delay_hours",
                    X.bool_flag(F.col("delay_hours") > 0).alias("delay_flag"))


@register("bin_distance")
def q_bin_distance(spark, sf):
    d = A.load(spark, sf, "deliveries")
    return (d.select("delivery_id", "distance_km",
                                X.bin_distance("distance_km").alias("distance_bucket")))


@register("bin_risk")
def q_bin_risk(spark, sf):
    e = A.read_source(spark, sf, "events")
    score = X.round_half_even(F.col("value") / 3.5, 1)
    return e.select("event_id", score.alias("score"), X.bin_risk(score).alias("level"))


@register("case_action")
def q_case_action(spark, sf):
    e = A.read_source(spark, sf, "events")
    level = X.bin_risk(X.round_half_even(F.col("value") / 3.5, 1))
    return e.select("event_id", level.alias("level"), X.case_action(level).alias("action"))


@register("date_truncate")
def q_date_truncate(spark, sf):
    t = A.load(spark, sf, "telemetry")
    return t.select("well_id", "timestamp", X.to_day("timestamp").alias("date"))


@register("date_parts")
def q_date_parts(spark, sf):
    p = A.load(spark, sf, "production")
    return p.select("well_id", "date", *[c.alias(n) for n, c in X.date_parts("date").items()])


@register("hours_between")
def q_hours_between(spark, sf):
    e = A.read_source(spark, sf, "events")
    midnight = X.to_day("ts").cast("timestamp_ntz")
    return e.select("event_id", X.hours_between(midnight, "ts").alias("hours"))


@register("round_half_even")
def q_round_half_even(spark, sf):
    e = A.read_source(spark, sf, "events")
    return (e.select("event_id", X.round_half_even(F.col("value") * 0.05, 1)
                                .alias("rounded")))


@register("sqrt_metric")
def q_sqrt(spark, sf):
    t = A.load(spark, sf, "telemetry")
    g = AG.group_by_dropna(t, ["well_id"]).agg(
        F.sqrt(F.avg(F.col("temperature") * F.col("temperature"))).alias("rms_temperature"))
    return g


@register("row_max_abs")
def q_row_max_abs(spark, sf):
    t = A.load(spark, sf, "telemetry")
    return (t.select("well_id", "timestamp", X.row_max_abs(
        [F.col("pressure_out") - 250.0, F.col("temperature") - 100.0,
         F.col("vibration") - 4.0]).alias("max_abs_dev")))


@register("bool_or")
def q_bool_or(spark, sf):
    z = EQ.pump_zscores(A.load(spark, sf, "pump_sensors"))
    hot = F.col("temperature") > 400
    return z.select("record_id", (F.col("is_anomaly_zscore") | hot).alias("is_flagged"))


@register("select_rename")
def q_select_rename(spark, sf):
    dr = A.load(spark, sf, "drivers")
    return dr.withColumnsRenamed({"name": "driver_name", "region": "driver_region"}) \
        .select("driver_id", "driver_name", "driver_region")


@register("tag_constant")
def q_tag(spark, sf):
    w = A.load(spark, sf, "wells")
    return w.select("well_id", "name").withColumn("segment", F.lit("all"))


# ------------------------------------------------------------- filters
@register("iqr_filter")
def q_iqr(spark, sf):
    d = A.load(spark, sf, "deliveries")
    return (CL.iqr_filter(d, ["cost_usd", "distance_km"]).select(
        "delivery_id", "cost_usd", "distance_km"))


@register("dropna_subset")
def q_dropna(spark, sf):
    s = EQ.coerce_sensors(A.load(spark, sf, "pump_sensors"), EQ.RISK_FEATURES)
    return CL.dropna_subset(s, EQ.RISK_FEATURES).select("record_id", "pump_id")


@register("filter_time_range")
def q_filter_time_range(spark, sf):
    t = A.load(spark, sf, "telemetry")
    return FI.last_hours_per_key(t, "well_id", "timestamp", 24.0).select("well_id", "timestamp")


@register("filter_topn")
def q_filter_topn(spark, sf):
    e = A.read_source(spark, sf, "events")
    return WN.topn_per_group(e, "user_id", [F.col("value").desc(), F.col("event_id").asc()], 2) \
        .select("user_id", "event_id", "value")


@register("filter_threshold")
def q_filter_threshold(spark, sf):
    t = A.load(spark, sf, "telemetry")
    return FI.filter_threshold(t, "pump_current", ">", 50.0).select("well_id", "timestamp",
                                                                    "pump_current")


# ------------------------------------------------------------- joins
@register("join_left_composite")
def q_join_composite(spark, sf):
    prod, tele = A.load_many(spark, sf, "production", "telemetry")
    j = J.join_left_composite(prod.select("well_id", "date", "oil_ton"), P.telemetry_daily(tele),
                              ["well_id", "date"])
    return j


@register("join_left_dim")
def q_join_dim(spark, sf):
    d, dr = A.load_many(spark, sf, "deliveries", "drivers")
    return J.join_left_dim(d.select("delivery_id", "driver_id"), dr, "driver_id",
                           ["name", "region"], rename={"name": "driver_name"})


@register("join_inner")
def q_join_inner(spark, sf):
    users, orders, prods = A.load_many(spark, sf, "shop_users", "shop_orders", "shop_products")
    e = PR.enrich_orders(orders, users).join(prods, "product_id", "inner")
    return (e.select("order_id", "product_id", "user_id", "city", "product_name",
                                "qty", "revenue"))


@register("join_using_limit")
def q_join_using_limit(spark, sf):
    kpi = P.well_kpi(_features(spark, sf), A.load(spark, sf, "wells"))
    return NB.kpi_with_production(kpi, A.load(spark, sf, "production"), 1000)


# ------------------------------------------------------------- aggregates
@register("rate_pct")
def q_rate_pct(spark, sf):
    e = _enriched(spark, sf)
    return (AG.group_by_dropna(e, ["source"]).agg(
        AG.rate_pct("delay_flag").alias("delay_rate_pct")))


@register("quantiles")
def q_quantiles(spark, sf):
    li = A.read_source(spark, sf, "lineitem")
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    qs = quantiles(li, "l_extendedprice", probs)
    return spark.createDataFrame(list(zip(probs, qs)), "p double, q double")


@register("group_median")
def q_group_median(spark, sf):
    p = A.load(spark, sf, "production")
    return CL.group_medians(p, "well_id", ["oil_ton", "pressure"], prefix="median_")


@register("count_distinct_class")
def q_count_distinct(spark, sf):
    lab = EQ.label_next_failure(*_pumps(spark, sf))
    return lab.agg(F.count_distinct("will_fail_24h").alias("classes"))


@register("row_count")
def q_row_count(spark, sf):
    frames = A.load_many(spark, sf, "production", "telemetry", "deliveries")
    out = None
    for name, df in zip(["production", "telemetry", "deliveries"], frames):
        c = df.agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(name))
        out = c if out is None else out.unionByName(c)
    return out


@register("agg_product_revenue")
def q_product_revenue(spark, sf):
    users, orders, prods = A.load_many(spark, sf, "shop_users", "shop_orders", "shop_products")
    return PR.city_product_totals(PR.enrich_orders(orders, users), prods)


@register("pivot_mean")
def q_pivot_mean(spark, sf):
    kpi = P.well_kpi(_features(spark, sf), A.load(spark, sf, "wells"))
    pairs = kpi.select("well_id", "avg_pressure", "avg_temperature").join(
        A.load(spark, sf, "production").select("well_id", "oil_ton"), "well_id")
    return NB.oil_pivot(pairs)


# ------------------------------------------------------------- windows
@register("impute_group_median")
def q_impute_group(spark, sf):
    p = A.load(spark, sf, "production")
    return (CL.impute_group_median(p, "well_id", ["temperature", "pressure"])
                       .select("well_id", "date", "temperature", "pressure"))


@register("impute_group_then_global")
def q_impute_global(spark, sf):
    ds = FC.target_with_fallbacks(*_target_inputs(spark, sf))
    return CL.impute_group_then_global(ds, "well_id", FC.TARGET_FEATURES)


@register("row_number_rank")
def q_row_number(spark, sf):
    kpi = L.driver_kpi(_enriched(spark, sf))
    r = WN.row_number_rank(kpi, "total_cost_usd", True, ["driver_id"], "cost_rank")
    return r.select("driver_id", "total_cost_usd", "cost_rank")


@register("rank_pct")
def q_rank_pct(spark, sf):
    kpi = L.driver_kpi(_enriched(spark, sf))
    r = WN.rank_pct(kpi, "avg_delay_hours", "delay_rank")
    return r.select("driver_id", "delay_rank")


@register("weighted_risk_score")
def q_weighted(spark, sf):
    r = L.route_optimization(_enriched(spark, sf))
    return r.select("route", "route_risk_score")


@register("topn_per_group")
def q_topn(spark, sf):
    e = A.read_source(spark, sf, "events")
    return WN.topn_per_group(e, "event_type", [F.col("value").desc(), F.col("event_id").asc()],
                             3).select("event_type", "event_id", "value")


# ------------------------------------------------------------- sort / limit / union
@register("sort_output")
def q_sort(spark, sf):
    kpi = L.driver_kpi(_enriched(spark, sf))
    return (kpi.orderBy(F.col("delay_rate_pct").asc_nulls_last(),
                                   F.col("avg_delay_hours").asc_nulls_last(), "driver_id"))


@register("head_tail_segments")
def q_head_tail(spark, sf):
    r = L.route_optimization(_enriched(spark, sf))
    seg = WN.head_tail_segments(r, [F.col("route_risk_score").desc(), F.col("route").asc()],
                                [F.col("route_risk_score").asc(), F.col("route").desc()], n=3)
    return seg.select("route", "route_risk_score", "segment")


@register("limit_n")
def q_limit(spark, sf):
    kpi = P.well_kpi(_features(spark, sf), A.load(spark, sf, "wells"))
    return NB.top_wells(kpi, 10).select("well_id", "name", "avg_oil_ton")


@register("union_all")
def q_union(spark, sf):
    prod, tg = A.load_many(spark, sf, "production", "well_targets")
    a = prod.select("well_id", "date", F.col("oil_ton").alias("value"),
                    F.lit("production").alias("kind"))
    b = tg.select("well_id", "date", F.col("daily_oil_ton").alias("value"),
                  F.lit("target").alias("kind"))
    return a.unionByName(b)

