"""Follow-up report queries over written marts: daily series, top wells,
KPI rows paired with production days, and the oil pivot by temperature and
pressure bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.operators.aggregates import pivot_mean


def top_wells(kpi: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` wells of highest mean oil (by their performance rank)."""
    return kpi.orderBy("performance_rank").limit(n)


def kpi_with_production(kpi: DataFrame, production: DataFrame, n: int = 1000) -> DataFrame:
    """Each well's mean pressure and temperature next to its daily oil,
    first ``n`` rows by (well, day). The pairing is on the well id only, as in
    the original report; the order makes the sample reproducible."""
    j = kpi.select("well_id", "avg_pressure", "avg_temperature").join(
        production.select("well_id", "date", "oil_ton"), "well_id")
    return j.orderBy("well_id", "date").limit(n)


def oil_pivot(pairs: DataFrame, temperature_step: float = 10.0, pressure_step: float = 50.0,
              pressure_bands: Sequence[int] = tuple(range(8))) -> DataFrame:
    """Mean oil per temperature band (rows) and pressure band (columns).

    The axes are continuous, so both are cut into fixed-width bands; the
    pressure bands are passed explicitly so no extra job looks for them, and
    the columns ``below`` and ``above`` take what lies outside them.
    """
    first, last = min(pressure_bands), max(pressure_bands)
    banded = (pairs
              .withColumn("temperature_band",
                          (F.floor(F.col("avg_temperature") / temperature_step)
                           * temperature_step).cast("int"))
              .withColumn("_band", F.floor(F.col("avg_pressure") / pressure_step).cast("long"))
              .withColumn("pressure_band", F.when(F.col("_band") < first, "below")
                          .when(F.col("_band") > last, "above").otherwise(F.col("_band").cast("string"))))
    return pivot_mean(banded, "temperature_band", "pressure_band", "oil_ton",
                      ["below", *map(str, pressure_bands), "above"])
