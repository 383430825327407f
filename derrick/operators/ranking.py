"""Global ranks without a single-task window.

A global ``row_number`` or percentile rank needs, for every row, the number of
rows before it. Rows are range-partitioned and sorted on the whole order, so
every partition holds one stretch of it; a row's place is its place inside the
partition plus the rows of the partitions before. The numbered stretches are
checkpointed first, so partition numbers and totals always belong together, and
the totals (one row per partition) are joined back as a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derrick.session import cut_lineage


def stretches(df: DataFrame, order: Sequence[Column], partitions: int | None) -> DataFrame:
    """``df`` with ``__part`` (numbers of partitions follow the order) and ``__at``
    (0, 1, ... inside the partition), checkpointed. ``partitions`` is Spark's
    shuffle setting unless given."""
    ranged = (df.repartitionByRange(*order) if partitions is None
              else df.repartitionByRange(partitions, *order))
    # the id holds the partition in its upper bits and counts rows in the lower 33
    numbered = ranged.sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    return cut_lineage(numbered.withColumn("__part", F.shiftright("__id", 33))
                       .withColumn("__at", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)))
                       .drop("__id"))


def _before(stretches: DataFrame, weight: Column) -> DataFrame:
    """(__part, __before): weight of all partitions before each; one row per
    partition, so its window is small whatever the input."""
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return (stretches.groupBy("__part").agg(F.sum(weight).alias("__w"))
            .select("__part", F.coalesce(F.sum("__w").over(earlier), F.lit(0)).alias("__before")))


def global_row_number(df: DataFrame, column: str, descending: bool, tiebreak: Sequence[str],
                      out: str, partitions: int | None = None) -> DataFrame:
    """1..n (long) over the whole frame ordered by ``column`` (NULLs last), then by
    ``tiebreak`` ascending, of any orderable type. The tiebreak should make the
    order total: only rows equal in every column share a partition, so neither a
    heavy tie nor many NULLs land in one task."""
    lead = F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()
    rows = stretches(df, [lead, *[F.col(c).asc() for c in tiebreak]], partitions)
    before = F.broadcast(_before(rows, F.lit(1)))       # one row per shuffle partition
    return rows.join(before, "__part").select(
        *df.columns, (F.col("__before") + F.col("__at") + 1).alias(out))


def global_rank_pct(df: DataFrame, key: Column, out: str, partitions: int | None = None) -> DataFrame:
    """pandas ``rank(pct=True)`` of ``key``: (rows below + (ties + 1) / 2) / n.

    Rows are first reduced to (value, count) pairs, which are then spread by value.
    NULL keys get NULL.
    """
    keyed = df.withColumn("__rk", key)
    if isinstance(keyed.schema["__rk"].dataType, (T.DoubleType, T.FloatType)):
        # NaN is missing (pandas), not the largest value (Spark ordering)
        keyed = keyed.withColumn("__rk", F.nanvl("__rk", F.lit(None).cast("double")))
    keyed = cut_lineage(keyed)                          # read by the ranks and by the join back
    vals = (keyed.where(F.col("__rk").isNotNull()).groupBy("__rk")
            .agg(F.count(F.lit(1)).alias("__n")))
    vals = stretches(vals, [F.col("__rk").asc()], partitions)
    totals = _before(vals, F.col("__n"))
    n = vals.agg(F.sum("__n").alias("__total"))         # one row
    inside = F.coalesce(F.sum("__n").over(
        Window.partitionBy("__part").orderBy("__at")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = (vals.withColumn("__inside", inside).join(F.broadcast(totals), "__part")
              .join(F.broadcast(n))
              .select("__rk", ((F.col("__before") + F.col("__inside") + (F.col("__n") + 1) / 2.0)
                               / F.col("__total")).alias(out)))
    return keyed.join(ranked, "__rk", "left").drop("__rk")
