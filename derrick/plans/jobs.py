"""The full batch: read the nine operational tables, build every mart, write
them to the lake (Parquet/CSV) and optionally to database tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from derrick.config import LakeConfig
from derrick.plans import equipment as EQ
from derrick.plans import forecast as FC
from derrick.plans import logistics as L
from derrick.plans import production as P
from derrick.session import cut_lineage
from derrick.sinks import writers as SK
from derrick.sources import adapters as A
from derrick.sources import tables as TB

INPUT_TABLES = ["wells", "production", "telemetry", "well_targets", "pump_sensors",
                "pump_failures", "deliveries", "drivers", "vehicles"]
PARTITIONED = {"daily_production": ["year", "month"]}


@dataclass
class JobSettings:
    forest_trees: int = 200
    target_forest_trees: int = 300
    classifier_trees: int = 300
    iforest_trees: int = 100
    seed: int = 42
    approx_quantiles: bool = False  # percentile_approx for IQR bounds and medians


def read_inputs(spark: SparkSession, cfg: LakeConfig | None = None,
                sf_dir: str | None = None) -> dict[str, DataFrame]:
    """The nine input tables from JDBC/Parquet (``cfg``) or, for tests and
    benchmarks, from the driver tables through the adapters (``sf_dir``)."""
    if sf_dir is not None:
        return {t: A.load(spark, sf_dir, t) for t in INPUT_TABLES}
    assert cfg is not None
    return {t: TB.scan_table(spark, cfg, t) for t in INPUT_TABLES}


def build_marts(inputs: dict[str, DataFrame], s: JobSettings | None = None) -> dict[str, DataFrame]:
    """All marts as lazy DataFrames (models are fitted while building)."""
    s = s or JobSettings()
    q = "approx" if s.approx_quantiles else "exact"
    # the feature table feeds five outputs: cut its lineage once
    features = cut_lineage(P.feature_table(
        P.clean_production(inputs["production"], quantile_method=q,
                           approx_medians=s.approx_quantiles),
        inputs["telemetry"], approx_medians=s.approx_quantiles))
    kpi = P.well_kpi(features, inputs["wells"])
    target = cut_lineage(FC.target_dataset(inputs["well_targets"], inputs["telemetry"],
                                           inputs["production"],
                                           approx_medians=s.approx_quantiles))
    t_metrics, preds, errors = FC.train_and_score(target, forest_trees=s.target_forest_trees,
                                                  seed=s.seed)
    enriched = cut_lineage(L.enrich_deliveries(inputs["deliveries"], inputs["drivers"],
                                               inputs["vehicles"]))
    risk, risk_metrics = EQ.pump_risk(inputs["pump_sensors"], inputs["pump_failures"],
                                      num_trees=s.classifier_trees, seed=s.seed)
    return {
        "features": features,
        "daily_production": P.daily_production(features),
        "well_kpi": kpi,
        "best_worst_wells": P.best_worst_wells(kpi),
        "influence_factors": P.influence_factors(features),
        "ml_metrics": FC.production_forest_metrics(features, num_trees=s.forest_trees,
                                                   seed=s.seed),
        "well_targets_features": target,
        "target_model_metrics": t_metrics,
        "actual_vs_predicted": preds,
        "model_error_over_time": errors,
        "pump_anomalies": EQ.pump_anomalies(inputs["pump_sensors"], n_trees=s.iforest_trees,
                                            seed=s.seed),
        "pre_failure_signals": EQ.pre_failure_signals(inputs["pump_sensors"],
                                                      inputs["pump_failures"]),
        "pump_risk_scores": risk,
        "pump_risk_model_metrics": risk_metrics,
        "delay_vs_weather": L.delay_vs_weather(enriched),
        "cost_vs_distance": L.cost_vs_distance(enriched),
        "driver_kpi": L.driver_kpi(enriched),
        "delay_factors": L.delay_factors(enriched),
        "route_optimization": L.route_optimization(enriched),
    }


def write_marts(marts: dict[str, DataFrame], lake_root: str, cfg: LakeConfig | None = None,
                tables: bool = False) -> None:
    """features and daily production as year/month Parquet, every mart as
    CSV, and (``tables=True``) every mart as a replaced ``mart.*`` table."""
    root = lake_root.rstrip("/")
    feats = marts["features"]
    from derrick.functions.exprs import date_parts
    SK.write_partitioned_parquet(feats.withColumns(date_parts("date")),
                                 f"{root}/processed/features", ["year", "month"])
    SK.write_partitioned_parquet(marts["daily_production"], f"{root}/marts/daily_production",
                                 PARTITIONED["daily_production"])
    for name, df in marts.items():
        if name == "features":
            continue
        folder = "ml" if "metric" in name or name in (
            "well_targets_features", "actual_vs_predicted", "model_error_over_time",
            "pump_anomalies", "pre_failure_signals", "pump_risk_scores") else "marts"
        SK.write_csv(df, f"{root}/{folder}/{name}.csv")
    if tables:
        spark = feats.sparkSession
        schema = cfg.mart_schema if cfg else "mart"
        SK.create_schema(spark, schema)
        for name, df in marts.items():
            if name != "features":
                SK.write_table_replace(df, name, cfg, schema)


def run_all(spark: SparkSession, lake_root: str, cfg: LakeConfig | None = None,
            sf_dir: str | None = None, settings: JobSettings | None = None,
            tables: bool = False) -> dict[str, DataFrame]:
    marts = build_marts(read_inputs(spark, cfg, sf_dir), settings)
    write_marts(marts, lake_root, cfg, tables)
    # intermediate frames were persisted for the marts that share them
    spark.catalog.clearCache()
    return marts
