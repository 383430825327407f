"""Joins: size-checked dimension broadcast, composite left joins, the
time-range join and the as-of "next event" join.

The two temporal joins never pair all rows of a key with each other: the range
join splits a key's timeline into fixed buckets, the as-of join into range
partitions, so that a hot key (one pump with a third of all readings) is spread
over many tasks, and only rows that can match meet.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derrick.operators.ranking import stretches

DEFAULT_BROADCAST_ROWS = 2_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows, else ``df``.

    The check reads at most ``max_rows + 1`` rows (``limit`` stops early), so
    a table that grows with the data is never broadcast by accident; above the
    bound the join falls back to a shuffle join (AQE may still convert it).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def join_left_dim(fact: DataFrame, dim: DataFrame, on: str | Sequence[str],
                  columns: Sequence[str] | None = None,
                  rename: dict[str, str] | None = None,
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Left join a dimension: keys plus ``columns`` of ``dim``, renamed."""
    keys = [on] if isinstance(on, str) else list(on)
    cols = list(columns) if columns is not None else [c for c in dim.columns if c not in keys]
    right = dim.select(*keys, *[F.col(c).alias((rename or {}).get(c, c)) for c in cols])
    return fact.join(broadcast_if_small(right, max_broadcast_rows), on=keys, how="left")


def join_left_composite(left: DataFrame, right: DataFrame, keys: Sequence[str],
                        null_safe: bool = False) -> DataFrame:
    """Left equi-join on several keys; duplicates on the right fan out.

    ``null_safe=True`` matches NULL to NULL (pandas ``merge`` semantics).
    """
    if not null_safe:
        return left.join(right, on=list(keys), how="left")
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c)
                       for c in right.columns])
    cond = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = e if cond is None else cond & e
    return left.join(r, cond, "left").drop(*[f"__r_{k}" for k in keys])


def epoch_micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970-01-01 for timestamp or timestamp_ntz columns,
    independent of the session time zone."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.TimestampNTZType):
        epoch = F.lit(_dt.datetime(1970, 1, 1)).cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, F.col(column))
    return F.unix_micros(F.col(column).cast("timestamp"))


def join_time_range(left: DataFrame, right: DataFrame, key: str, left_ts: str,
                    right_ts: str, before_hours: float) -> DataFrame:
    """Inner join: left rows with ``right_ts - before_hours <= left_ts <= right_ts``
    and equal ``key``. A left row is repeated for every window it falls in.

    Plan: bucket time into ``before_hours``-wide slots; each right row is
    exploded to the (at most two) slots its window touches, each left row sits
    in one slot; equi-join on (key, slot), then the exact range test. A hot key
    spreads over its slots and no left row meets a right row more than one
    window away.
    """
    width = int(before_hours * 3.6e9)
    l_slot = F.floor(epoch_micros(left, left_ts) / F.lit(width))
    r_end = epoch_micros(right, right_ts)
    r_start = r_end - F.lit(width)
    lhs = left.withColumn("__slot", l_slot.cast("long"))
    rhs = (right.withColumnRenamed(key, "__rkey")
           .withColumn("__slot", F.explode(F.sequence(
               F.floor(r_start / F.lit(width)).cast("long"),
               F.floor(r_end / F.lit(width)).cast("long")))))
    lo = F.col(right_ts) - F.make_dt_interval(secs=F.lit(before_hours * 3600.0))
    joined = lhs.join(
        rhs,
        (lhs[key] == rhs["__rkey"]) & (lhs["__slot"] == rhs["__slot"])
        & (F.col(left_ts) >= lo) & (F.col(left_ts) <= F.col(right_ts)),
        "inner")
    return joined.drop("__slot", "__rkey")


def join_next_event(left: DataFrame, right: DataFrame, key: str, left_ts: str,
                    right_ts: str, out: str = "next_event_ts",
                    partitions: int | None = None) -> DataFrame:
    """As-of forward: for each left row, the earliest ``right_ts >= left_ts``
    of the same key (NULL when none, or without key or time). Left rows are kept
    one-to-one.

    Rows of both sides are range-partitioned and sorted on (key, time), so a hot key
    is cut along its time. Inside a partition a RANGE frame from the row's time onwards
    finds the next event (equal times count); beyond it, the first event of every later
    partition of the key: a table of one row per (partition, key), at most as many as
    there are keys and partitions, whatever the time span. Rows that can't match
    never move.
    """
    lt_type = left.schema[left_ts].dataType
    can = F.col(key).isNotNull() & F.col(left_ts).isNotNull()
    never = left.where(~can).withColumn(out, F.lit(None).cast(lt_type))
    lhs = left.where(can).select(*left.columns, F.col(left_ts).alias("__t"), F.lit(False).alias("__event"),
                                 F.lit(None).cast(lt_type).alias("__rts"))
    rts = F.col(right_ts).cast(lt_type)
    rhs = right.where(F.col(key).isNotNull() & F.col(right_ts).isNotNull()).select(
        *[F.col(c).cast(left.schema[c].dataType).alias(c) if c == key
          else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns],
        rts.alias("__t"), F.lit(True).alias("__event"), rts.alias("__rts"))
    rows = stretches(lhs.unionByName(rhs), [F.col(key).asc(), F.col("__t").asc(), F.col("__event").asc()],
                     partitions)
    onwards = (Window.partitionBy("__part", key).orderBy("__t")
               .rangeBetween(Window.currentRow, Window.unboundedFollowing))
    later = Window.partitionBy("__key").orderBy("__p").rowsBetween(1, Window.unboundedFollowing)
    carried = (rows.groupBy(F.col("__part").alias("__p"), F.col(key).alias("__key"))
               .agg(F.min("__rts").alias("__first"))
               .select("__p", "__key", F.min("__first").over(later).alias("__later")))
    found = rows.withColumn("__same", F.min("__rts").over(onwards)).where(~F.col("__event"))
    return (found.join(carried, (found["__part"] == carried["__p"]) & (found[key] == carried["__key"]), "left")
            .select(*[found[c] for c in left.columns], F.coalesce("__same", "__later").alias(out))
            .unionByName(never))
