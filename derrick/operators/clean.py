"""Cleaning operators: IQR outlier filter, group-median imputation, drops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.operators.group_stats import group_quantiles
from derrick.operators.stats import quantiles, quantiles_multi
from derrick.session import cut_lineage


def iqr_filter(df: DataFrame, columns: Sequence[str], k: float = 1.5,
               method: str = "exact") -> DataFrame:
    """Keep rows with Q1 - k*IQR <= x <= Q3 + k*IQR, column after column.

    The bounds of each column are computed on the rows left by the previous
    column, as in the sequential pandas filter. NULLs fail the test and are
    dropped. Bounds are two scalars per column (see :mod:`stats`); the input is
    materialised once in the shared folder, because every column reads it again.
    """
    out = cut_lineage(df)
    for c in columns:
        q1, q3 = quantiles(out, c, [0.25, 0.75], method=method)
        if q1 is None:
            return out.where(F.lit(False))
        iqr = q3 - q1
        out = out.where((F.col(c) >= F.lit(q1 - k * iqr)) & (F.col(c) <= F.lit(q3 + k * iqr)))
    return out


def group_medians(df: DataFrame, key: str | Sequence[str], columns: Sequence[str],
                  approx: bool = False, prefix: str = "__med_") -> DataFrame:
    """One row per non-null key with the median of each column. Exact medians come from
    :func:`group_stats.group_quantiles`, which never gathers a group; ``approx=True``
    uses ``percentile_approx`` (bounded sketch per group)."""
    keys = [key] if isinstance(key, str) else list(key)
    if not approx:
        return group_quantiles(df, keys, columns, 0.5, prefix)
    return df.dropna(subset=keys).groupBy(*keys).agg(
        *[F.percentile_approx(c, 0.5, 10_000).cast("double").alias(prefix + c) for c in columns])


def impute_group_median(df: DataFrame, key: str, columns: Sequence[str],
                        approx: bool = False) -> DataFrame:
    """NULL -> median of the row's own key group.

    All-null groups stay NULL; rows with a NULL key become NULL (pandas
    ``groupby().transform`` semantics). The medians are aggregated first and
    joined back on the key, so a hot key never lands whole in one window task;
    AQE broadcasts the per-key table when it is small at run time.
    """
    prefix = "__med_"
    # read by the passes of the medians and by the join back
    df = cut_lineage(df)
    meds = group_medians(df, key, columns, approx=approx, prefix=prefix)
    joined = df.join(meds, on=key, how="left")
    filled = {c: F.when(F.col(key).isNotNull(), F.coalesce(F.col(c), F.col(prefix + c)))
              for c in columns}
    return joined.withColumns(filled).select(*df.columns)


def impute_global_median(df: DataFrame, columns: Sequence[str],
                         method: str = "exact") -> DataFrame:
    """NULL -> median of the whole column (a scalar per column)."""
    # read by the median passes and again by the fill
    df = cut_lineage(df)
    if method == "approx":
        meds = {c: quantiles(df, c, [0.5], method="approx")[0] for c in columns}
    else:
        meds = {c: v[0] for c, v in quantiles_multi(df, {c: [0.5] for c in columns}).items()}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(meds[c]).cast("double"))
                           for c in columns})


def impute_group_then_global(df: DataFrame, key: str, columns: Sequence[str],
                             approx: bool = False) -> DataFrame:
    """Group median first, then the overall median of the group-filled column."""
    out = impute_group_median(df, key, columns, approx=approx)
    return impute_global_median(out, columns, method="approx" if approx else "exact")


def dropna_subset(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any of ``columns`` (all columns if None)."""
    return df.dropna(how="any", subset=list(columns) if columns else None)
