"""Exact per-group quantiles that stay bounded for hot groups.

Spark's ``percentile``/``median`` aggregate merges, per group, a map of every
distinct value in one task. When a group's values are continuous and the
group holds a third of the data, that map is unbounded. Here every group of every
column is searched by the same passes, all together (as in :mod:`stats`, with one
row of state per group and column instead of numbers on the driver):

1. a mergeable KLL sketch per group brackets the wanted rank;
2. one aggregate counts the group's rows below, at and between the bracket's ends
   and finds the next values behind them;
3. a rank at an end is done; one strictly inside is read from a window over the
   (value, count) pairs of its bracket, once that has ``VALUES`` rows or fewer. Until
   then the bracket is the next round's range; rounds go on as long as a group needs
   them, and each leaves fewer rows.

The per-group tables have one row per group and column and are joined back on the
key; no step gathers a whole group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from derrick.session import cut_lineage

#: size parameter of a group's sketch and the rank error allowed for
KLL_K, ERROR = 256, 0.03
#: quantiles asked of a sketch (their number has to be fixed)
GRID = 64
#: rows of a group's bracket that one window orders
VALUES = 50_000


def _stacked(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(*keys, __c, v): every value that is neither NULL nor NaN, rows without a key
    left out."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    cells = F.array(*[F.struct(F.lit(i).alias("__c"), F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
                               .alias("v")) for i, c in enumerate(columns)])
    return (df.select(*keys, F.explode(F.filter(cells, lambda x: x["v"].isNotNull())).alias("__x"))
            .select(*keys, "__x.__c", "__x.v"))


def _within() -> Column:
    v = F.col("v")
    return ((F.col("low").isNull() | (v > F.col("low"))) & (F.col("high").isNull() | (v < F.col("high"))))


def _bracket(sketched: DataFrame) -> DataFrame:
    """``state`` with the ends of a bracket around the rank, from the sketch ``s``."""
    at = (F.col("r0") - F.col("below")) / F.greatest(F.col("inside") - 1, F.lit(1))
    grid = F.kll_sketch_get_quantile_double("s", F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))
    first = F.greatest(F.floor((at - ERROR) * GRID), F.lit(0)).cast("int")
    last = F.least(F.ceil((at + ERROR) * GRID), F.lit(GRID)).cast("int")
    return sketched.withColumn("g", grid).withColumns(
        {"lo": F.get("g", first), "hi": F.get("g", last)}).drop("s", "g")


def group_quantiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str], p: float,
                    prefix: str = "") -> DataFrame:
    """One row per non-null key with the exact ``p`` quantile (linear interpolation, as
    pandas/Spark/DuckDB) of each column's non-null values in the group (NULL if there
    is none), as ``prefix`` + column."""
    keys, columns = list(keys), list(columns)
    by = [*keys, "__c"]
    values = _stacked(df, keys, columns)
    pos = F.lit(p) * (F.col("n") - 1)
    none = F.lit(None).cast("double")
    state = cut_lineage(_bracket(
        values.groupBy(*by).agg(F.count("v").alias("n"), F.kll_sketch_agg_double("v", KLL_K).alias("s"))
        .select(*by, "s", F.floor(pos).cast("long").alias("r0"), F.ceil(pos).cast("long").alias("r1"),
                (pos - F.floor(pos)).alias("frac"), F.lit(0).cast("long").alias("below"),
                F.col("n").alias("inside"), none.alias("low"), none.alias("high"))))
    done = []
    while True:
        v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
        counted = values.join(state, by).groupBy(*by).agg(
            F.count_if(_within() & (v < lo)).alias("a"), F.count_if(v == lo).alias("b"),
            F.count_if((v > lo) & (v < hi)).alias("m"), F.count_if((v == hi) & (hi > lo)).alias("d"),
            F.min(F.when(v > lo, v)).alias("next_lo"), F.min(F.when(v > hi, v)).alias("next_hi"))
        at, b, m, d = F.col("below") + F.col("a"), F.col("b"), F.col("m"), F.col("d")
        r0, r1 = F.col("r0"), F.col("r1")
        place = (F.when(r0 < at, F.lit("under")).when(r0 < at + b, F.lit("lo"))
                 .when((r0 < at + b + m) & (m <= VALUES), F.lit("read")).when(r0 < at + b + m, F.lit("inner"))
                 .when(r0 < at + b + m + d, F.lit("hi")).otherwise(F.lit("over")))
        found = cut_lineage(state.join(counted, by).withColumn("place", place))
        ends = found.where("place in ('lo', 'hi')").select(
            *by, "frac", F.when(F.col("place") == "lo", lo).otherwise(hi).alias("v0"),
            F.when(F.col("place") == "lo", F.when(r1 < at + b, lo).otherwise(F.col("next_lo")))
            .otherwise(F.when(r1 < at + b + m + d, hi).otherwise(F.col("next_hi"))).alias("v1"))
        # values strictly inside a small bracket, and its upper end
        few = found.where("place = 'read'").select(*by, "frac", "r0", "r1", "lo", "hi", (at + b).alias("start"))
        pairs = (values.join(few.select(*by, "lo", "hi"), by).where((v > lo) & (v <= hi))
                 .groupBy(*by, "v").agg(F.count(F.lit(1)).alias("n")))
        running = Window.partitionBy(*by).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        read = (pairs.withColumn("upto", F.sum("n").over(running)).join(few, by).groupBy(*by, "frac").agg(
            F.min(F.when(F.col("start") + F.col("upto") > r0, v)).alias("v0"),
            F.min(F.when(F.col("start") + F.col("upto") > r1, v)).alias("v1")))
        done.append(ends.unionByName(read))
        left = found.where("place in ('under', 'inner', 'over')")
        if not left.limit(1).count():
            break
        under, inner = F.col("place") == "under", F.col("place") == "inner"
        after = F.when(inner, at + b).otherwise(at + b + m + d)
        left = left.select(
            *by, "r0", "r1", "frac",
            F.when(under, F.col("below")).otherwise(after).alias("below"),
            F.when(under, F.col("a")).when(inner, m).otherwise(F.col("inside") - (after - F.col("below"))).alias("inside"),
            F.when(under, F.col("low")).when(inner, lo).otherwise(hi).alias("low"),
            F.when(under, lo).when(inner, hi).otherwise(F.col("high")).alias("high"))
        sketch = (values.join(left.select(*by, "low", "high"), by).where(_within())
                  .groupBy(*by).agg(F.kll_sketch_agg_double("v", KLL_K).alias("s")))
        state = cut_lineage(_bracket(left.join(sketch, by)))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    value = F.col("v0") + (F.col("v1") - F.col("v0")) * F.col("frac")
    wide = out.groupBy(*keys).agg(*[F.max(F.when(F.col("__c") == i, value)).alias(prefix + c)
                                    for i, c in enumerate(columns)])
    # keys without any value keep a row
    every = df.dropna(subset=keys).select(*keys).distinct()
    return every.join(wide, keys, "left")
