"""Window operators: percentile ranks, report ranks, latest row per key,
top-N per group, best/worst segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from derrick.functions.exprs import as_col
from derrick.operators.ranking import global_rank_pct, global_row_number


def rank_pct(df: DataFrame, column: str, out: str, sort_key: Column | None = None,
             partitions: int | None = None) -> DataFrame:
    """pandas ``rank(pct=True)``: average rank of ties / number of non-null.

    NULL values get a NULL rank. ``sort_key`` (e.g. a rounded copy of the
    column) decides ties and order. Spread by value, see
    :mod:`derrick.operators.ranking`.
    """
    key = sort_key if sort_key is not None else F.col(column)
    return global_rank_pct(df, key, out, partitions)


def row_number_rank(df: DataFrame, column: str, descending: bool, tiebreak: Sequence[str],
                    out: str, partitions: int | None = None) -> DataFrame:
    """1..n (long) over the whole frame by ``column`` (NULLs last), then ``tiebreak``."""
    return global_row_number(df, column, descending, tiebreak, out, partitions)


def latest_per_key(df: DataFrame, key: str | Sequence[str],
                   order: Sequence[str | Column]) -> DataFrame:
    """Last row per key when sorted by ``order`` ascending with NULLs last
    (plain columns, not sort orders); a NULL therefore wins.

    Expressed as ``row_number() = 1`` over the reversed order, which Spark
    plans with a partial WindowGroupLimit before the shuffle, so every task
    forwards at most one row per key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rev = [as_col(c).desc_nulls_first() for c in order]
    w = Window.partitionBy(*keys).orderBy(*rev)
    return (df.withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") == 1).drop("__rn"))


def topn_per_group(df: DataFrame, group: str | Sequence[str], order: Sequence[Column],
                   n: int) -> DataFrame:
    """Rows ranked 1..n per group by ``order`` (unique tie-break expected)."""
    keys = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("__rn", F.row_number().over(w))
            .where(F.col("__rn") <= n).drop("__rn"))


def head_tail_segments(df: DataFrame, order: Sequence[Column], reverse: Sequence[Column],
                       n: int = 3, segment: str = "segment",
                       labels: tuple[str, str] = ("best", "worst")) -> DataFrame:
    """First ``n`` and last ``n`` rows by ``order``, tagged; overlap is kept.

    Two distributed top-k (TakeOrderedAndProject) passes; ``reverse`` is the
    exact reverse of ``order``.
    """
    head = df.orderBy(*order).limit(n).withColumn(segment, F.lit(labels[0]))
    tail = df.orderBy(*reverse).limit(n).withColumn(segment, F.lit(labels[1]))
    return head.unionByName(tail)

