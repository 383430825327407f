"""Row filters: closed time ranges and thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derrick.functions.exprs import as_col


def filter_time_range(df: DataFrame, ts: str, start: str | Column, end: str | Column) -> DataFrame:
    """Rows with ``start <= ts <= end`` (both ends included; NULL fails)."""
    return df.where(F.col(ts).between(as_col(start), as_col(end)))


def last_hours_per_key(df: DataFrame, key: str, ts: str, hours: float) -> DataFrame:
    """Rows in the closed window of ``hours`` ending at the key's latest time.

    The per-key end is an aggregate (one row per key) joined back on the key,
    then the range test runs row by row.
    """
    ends = df.groupBy(key).agg(F.max(ts).alias("__end"))
    j = df.join(ends, key)
    start = F.col("__end") - F.make_dt_interval(secs=F.lit(hours * 3600.0))
    return filter_time_range(j, ts, start, "__end").drop("__end")


def filter_threshold(df: DataFrame, column: str | Column, op: str, value) -> DataFrame:
    """Keep rows where ``column op value``; NULL comparisons drop the row."""
    c = as_col(column)
    cond = {">": c > value, ">=": c >= value, "<": c < value, "<=": c <= value,
            "=": c == value, "<>": c != value}[op]
    return df.where(cond)
