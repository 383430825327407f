"""Aggregation helpers with pandas-compatible semantics (NULL keys dropped,
sum of nothing is 0, ratios safe against zero spread)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derrick.functions.exprs import as_col, double_bin, double_of_parts, double_part, double_size


def group_by_dropna(df: DataFrame, keys: Sequence[str]):
    """``groupBy`` that drops NULL keys first (pandas ``groupby`` default)."""
    return df.dropna(subset=list(keys)).groupBy(*keys)


def exact_agg(df: DataFrame, keys: Sequence[str], counts: Mapping[str, str] | None = None,
              sums: Mapping[str, str | Column] | None = None,
              means: Mapping[str, str | Column] | None = None, many: bool = False) -> DataFrame:
    """Grouped counts of non-null values, sums and means ({name: column}) that do not
    depend on the order of the rows: doubles are added without any error and rounded
    once. Rows with a NULL key are dropped; the sum of no values is 0 and their mean
    NULL, as in pandas.

    Every value becomes a whole number in a bin of its size (:func:`double_part`);
    (keys, measure, bin) are added up in three limbs of 21 bits, combined on the map
    side and right for 4 * 10^12 rows a group, and a second aggregate of a few rows per
    group puts limbs and bins together. One scan.

    ``many``: a task holds few rows of each group, so cells would hardly be combined
    before they travel. The rows of a group are then brought together first, at one row
    each; a hot group may be split, as the aggregates don't rely on it.
    """
    counts, sums, means = counts or {}, sums or {}, means or {}
    measures = [("count", n, c) for n, c in counts.items()] + [("sum", n, c) for n, c in sums.items()] \
        + [("mean", n, c) for n, c in means.items()]
    cells = [F.struct(F.lit(i).alias("i"), (F.when(as_col(c).isNotNull(), F.lit(0.0)) if kind == "count"
                                            else as_col(c).cast("double")).alias("x"))
             for i, (kind, _, c) in enumerate(measures)]
    # a cell of its own keeps the group of rows that have no value
    cells.append(F.struct(F.lit(-1).alias("i"), F.lit(0.0).alias("x")))
    x, part = F.col("__x"), F.col("__part")
    rows = df.dropna(subset=list(keys))
    if many:
        rows = rows.select(*keys, F.array(*[c["x"] for c in cells]).alias("__x")).hint("rebalance", *[F.col(k) for k in keys])
        cells = [F.struct(F.lit(i).alias("i"), F.get("__x", F.lit(at)).alias("x"))
                 for at, i in enumerate([*range(len(measures)), -1])]
    stacked = (rows.select(*keys, F.explode(F.array(*cells)).alias("__e"))
               .select(*keys, F.col("__e.i").alias("__i"), F.col("__e.x").alias("__x"))
               .where(x.isNotNull() & ~F.isnan(x))
               .withColumn("__size", double_size(x)).withColumn("__bin", double_bin(x, F.col("__size")))
               .withColumn("__part", double_part(x, F.col("__bin"))))
    limb = F.lit((1 << 21) - 1).cast("long")
    binned = stacked.groupBy(*keys, "__i", "__bin").agg(
        F.sum(F.shiftright(part, 42)).alias("__a"), F.sum(F.shiftright(part, 21).bitwiseAND(limb)).alias("__b"),
        F.sum(part.bitwiseAND(limb)).alias("__c"), F.count(F.lit(1)).alias("__n"))

    def wide(c, bits):
        return F.col(c).cast("decimal(20,0)") * F.lit(1 << bits).cast("decimal(16,0)")
    total_ = (wide("__a", 42) + wide("__b", 21) + wide("__c", 0)).cast("decimal(38,0)")
    grouped = binned.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(
        F.col("__i").alias("i"), F.col("__bin").alias("bin"), total_.alias("s"), F.col("__n").alias("n"))))
        .alias("__p"))
    out = []
    for i, (kind, name, _) in enumerate(measures):
        own = _measure(i)
        n = F.aggregate(own, F.lit(0).cast("long"), lambda acc, e: acc + e["n"])
        if kind == "count":
            out.append(n.alias(name))
        elif kind == "sum":
            out.append(F.coalesce(double_of_parts(own), F.lit(0.0)).alias(name))
        else:
            out.append(F.try_divide(double_of_parts(own), n.cast("double")).alias(name))
    return grouped.select(*keys, *out)


def total(c: str | Column) -> Column:
    """Sum where the sum of no values is 0, as in pandas."""
    return F.coalesce(F.sum(as_col(c)), F.lit(0.0))


def _measure(i: int) -> Column:
    return F.filter("__p", lambda e: e["i"] == i)


def rate_pct(flag: str | Column) -> Column:
    """Share of 1s in a 0/1 column, in percent."""
    return F.avg(as_col(flag).cast("double")) * F.lit(100.0)


def corr_pairwise(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation over rows where both are present.

    NULL (not an error) when either side has zero spread or fewer than two
    rows.
    """
    x, y = as_col(x), as_col(y)
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


def regression_metrics(df: DataFrame, actual: str, predicted: str,
                       group: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and R^2 (1 - SSE / SST), optionally per group."""
    e = F.col(actual) - F.col(predicted)
    aggs = [F.avg(F.abs(e)).alias("mae"),
            F.sqrt(F.avg(e * e)).alias("rmse"),
            (F.lit(1.0) - F.try_divide(F.sum(e * e),
                                       F.count(F.col(actual)) * F.var_pop(F.col(actual)))).alias("r2"),
            F.count(F.lit(1)).alias("rows_used")]
    return df.groupBy(*group).agg(*aggs)


def agg_full_domain(df: DataFrame, key: str, domain: Sequence[str], *aggs: Column,
                    zero_cols: Sequence[str] = ()) -> DataFrame:
    """Aggregate by ``key`` showing every domain value, empty ones included
    (``observed=False``): counts in ``zero_cols`` become 0, others NULL."""
    agg = df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    spark = df.sparkSession
    dom = spark.createDataFrame([(v, i) for i, v in enumerate(domain)], f"{key} string, __ord int")
    out = F.broadcast(dom).join(agg, key, "left")
    return (out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero_cols})
            .drop("__ord"))


def pivot_mean(df: DataFrame, index: str, columns: str, values: str,
               pivot_values: Sequence | None = None) -> DataFrame:
    """Matrix of the mean of ``values`` by ``index`` x ``columns``.

    Pass ``pivot_values`` so Spark does not run an extra job to find them.
    """
    g = df.groupBy(index)
    g = g.pivot(columns, list(pivot_values)) if pivot_values is not None else g.pivot(columns)
    return g.agg(F.avg(values))
