"""Scalar column functions with pandas-compatible null semantics.

Every function returns a ``Column`` built from ``pyspark.sql.functions``, so
it stays inside whole-stage code generation. Arguments accept a column name
or a ``Column``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "as_col", "cast_datetime", "coerce_numeric", "nan_to_null", "fill_const",
    "fallback", "clip", "safe_div", "concat_route", "bool_flag", "cut_right_closed",
    "bin_distance", "bin_risk", "case_action", "to_day", "date_parts",
    "hours_between", "round_half_even", "row_max_abs", "double_size", "double_bin", "double_part", "double_of_parts",
    "DISTANCE_EDGES", "DISTANCE_LABELS", "RISK_EDGES", "RISK_LABELS", "ACTIONS",
]

# --- fixed values: bin edges, labels and action texts of the marts ---
DISTANCE_EDGES = (0.0, 120.0, 160.0, 200.0, math.inf)
DISTANCE_LABELS = ("short", "medium", "long", "very_long")
RISK_EDGES = (-0.1, 33.0, 66.0, 100.0)
RISK_LABELS = ("low", "medium", "high")
ACTIONS = {"high": "replan immediately", "medium": "monitor and optimize",
           "other": "keep current"}
ROUTE_SEPARATOR = " -> "
# --- end of fixed values ---


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cast_datetime(c: str | Column, to: str = "timestamp") -> Column:
    """Text or timestamp to ``timestamp``/``timestamp_ntz``/``date``."""
    return as_col(c).cast(to)


def nan_to_null(c: str | Column) -> Column:
    """NaN becomes NULL: one notion of missing, as in pandas."""
    c = as_col(c).cast("double")
    return F.nanvl(c, F.lit(None).cast("double"))


def coerce_numeric(c: str | Column) -> Column:
    """``pd.to_numeric(errors="coerce")``: unparsable text becomes NULL."""
    return nan_to_null(as_col(c).try_cast("double"))


def fill_const(c: str | Column, value) -> Column:
    return F.coalesce(as_col(c), F.lit(value))


def fallback(primary: str | Column, secondary: str | Column) -> Column:
    return F.coalesce(as_col(primary), as_col(secondary))


def clip(c: str | Column, lower=None, upper=None) -> Column:
    """Clip to [lower, upper]; NULL stays NULL (``greatest`` alone skips it)."""
    c = as_col(c)
    out = c
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(c.isNotNull(), out)


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Division where a zero or NULL denominator gives NULL."""
    return F.try_divide(as_col(num), as_col(den))


def concat_route(src: str | Column, dst: str | Column,
                 sep: str = ROUTE_SEPARATOR) -> Column:
    """``src + sep + dst``; NULL when either end is NULL."""
    return F.concat(as_col(src), F.lit(sep), as_col(dst))


def bool_flag(cond: Column) -> Column:
    """Condition as 0/1; a NULL comparison counts as false."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def cut_right_closed(c: str | Column, edges: Sequence[float], labels: Sequence[str],
                     include_lowest: bool = False) -> Column:
    """``pd.cut``: bins (e0, e1], (e1, e2], ...; outside and NULL give NULL."""
    c = as_col(c)
    expr = None
    for i, label in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        lower_ok = (c >= lo) if (include_lowest and i == 0) else (c > lo)
        cond = lower_ok & (c <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def bin_distance(c: str | Column) -> Column:
    return cut_right_closed(c, DISTANCE_EDGES, DISTANCE_LABELS, include_lowest=True)


def bin_risk(c: str | Column) -> Column:
    return cut_right_closed(c, RISK_EDGES, RISK_LABELS)


def case_action(priority: str | Column) -> Column:
    p = as_col(priority)
    return (F.when(p == "high", F.lit(ACTIONS["high"]))
            .when(p == "medium", F.lit(ACTIONS["medium"]))
            .otherwise(F.lit(ACTIONS["other"])))


def to_day(ts: str | Column) -> Column:
    return F.to_date(as_col(ts))


def date_parts(d: str | Column) -> dict[str, Column]:
    d = as_col(d)
    return {"year": F.year(d), "month": F.month(d)}


def hours_between(start: str | Column, end: str | Column) -> Column:
    """Fractional hours from ``start`` to ``end`` (microsecond exact).

    Works on ``timestamp_ntz`` and ``timestamp`` alike and never depends on
    the session time zone.
    """
    micros = F.timestamp_diff("MICROSECOND", as_col(start), as_col(end))
    return micros.cast("double") / F.lit(3.6e9)


def round_half_even(c: str | Column, digits: int = 1) -> Column:
    """numpy ``round``: half to even on the scaled value."""
    scale = float(10 ** digits)
    return F.rint(as_col(c) * F.lit(scale)) / F.lit(scale)


def row_max_abs(cols: Sequence[str | Column]) -> Column:
    return F.greatest(*[F.abs(as_col(c)) for c in cols])


#: width, in powers of two, of the bins of :func:`double_bin`
PART_BITS = 8
#: bin of infinite values
INFINITE = 999
#: bin of the smallest doubles
LOWEST = -142


def _powers(sign: int) -> tuple[Column, Column]:
    """2^(sign 8 bin) for every bin from LOWEST on, as two arrays whose product it is
    (the whole power may be beyond a double)."""
    all_ = range(LOWEST, LOWEST + 266)
    halves = [(sign * PART_BITS * b) // 2 for b in all_]
    return (F.array(*[F.lit(2.0 ** h) for h in halves]),
            F.array(*[F.lit(2.0 ** (sign * PART_BITS * b - h)) for b, h in zip(all_, halves)]))


def double_size(x: Column) -> Column:
    """The power of two a double lies next to, off by one at most; NULL for 0."""
    return F.floor(F.log2(F.abs(x)))


def double_bin(x: Column, size: Column) -> Column:
    """The bin of a double that is neither NULL nor NaN, from its :func:`double_size`."""
    return (F.when(x == 0, F.lit(0)).when(F.abs(x) < float("inf"), F.floor((size - 53) / PART_BITS).cast("int"))
            .otherwise(F.lit(INFINITE)))


def double_part(x: Column, bin_: Column) -> Column:
    """The double without loss as a whole number: x = part * 2^(8 bin). Parts of one
    bin add up exactly in any order."""
    first, second = _powers(-1)
    at = bin_ - F.lit(LOWEST)
    return (F.when(bin_ == INFINITE, F.signum(x)).otherwise(x * F.get(first, at) * F.get(second, at))).cast("long")


def double_of_parts(parts: Column) -> Column:
    """The double next to the sum of an array of struct(bin, s decimal(38,0)), sorted by
    bin: added as one whole number if the bins lie within 48 powers of two of each other,
    else from the smallest bin up. NULL for an empty array."""
    low = F.get(parts, F.lit(0))["bin"]

    def whole(acc, e):
        gap = e["bin"] - low
        scale = F.when(gap <= 6, F.pow(F.lit(2.0), F.least(gap, F.lit(6)) * PART_BITS).cast("long").cast("decimal(18,0)"))
        return F.try_add(acc, F.try_multiply(e["s"], scale).cast("decimal(38,0)")).cast("decimal(38,0)")

    def scaled(v, at):
        half = F.floor(at * PART_BITS / 2)
        return v * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), at * PART_BITS - half)
    one = F.aggregate(parts, F.lit(0).cast("decimal(38,0)"), whole)
    steps = F.aggregate(parts, F.lit(0.0), lambda acc, e: acc + scaled(e["s"].cast("double"), e["bin"]))
    return F.when(F.size(parts) > 0, F.coalesce(scaled(one.cast("double"), low), steps))
