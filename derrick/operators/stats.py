"""Exact quantiles over whole columns without gathering a column in one task.

``percentile``/``median`` aggregates keep a map of every distinct value of a
group in one task. For a global quantile over billions of high-cardinality
readings that map is unbounded, so the wanted ranks of all columns are selected
together, by the same three passes at every size:

1. one aggregate builds a mergeable KLL sketch per column (bounded size), whose
   rank error gives a bracket around every wanted rank;
2. one aggregate counts the rows below, at and between the ends of every bracket,
   so the place of the rank is known exactly: at an end, inside, or, if the
   sketch was off, beyond it;
3. ranks at an end are done; the values strictly inside the brackets that hold at
   most ``VALUES`` rows are read in one pass. A bracket with more rows, or one that
   missed, is the next round's range. A round keeps about 2 ``ERROR`` of the rows of
   the one before, and always fewer, as the ends themselves drop out: the search ends
   without a limit of rounds.

Interpolation is linear between the two neighbouring ranks (pandas
``quantile``, Spark ``percentile``, DuckDB ``quantile_cont``).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: size parameter of the sketches, and the rank error allowed for (about three times
#: the sketch's own at 99 %)
KLL_K, ERROR = 1024, 0.01
#: rows of a bracket that are read
VALUES = 20_000


@dataclass
class _Search:
    """A wanted rank (0-based, over the non-null rows of column ``c``): it lies strictly
    between ``low`` and ``high`` (None: open), below which ``below`` rows are, and among
    ``inside`` rows."""
    c: int
    rank: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    inside: int = 0
    value: float | None = None

    def within(self, v: Column) -> Column:
        cond = v.isNotNull()
        if self.low is not None:
            cond = cond & (v > F.lit(self.low))
        if self.high is not None:
            cond = cond & (v < F.lit(self.high))
        return cond


def _value(column: str) -> Column:
    return F.col(column).cast("double")


def _ranges(open_: list[_Search]) -> dict[tuple, list[_Search]]:
    out: dict[tuple, list[_Search]] = {}
    for s in open_:
        out.setdefault((s.c, s.low, s.high), []).append(s)
    return out


def _sketch_and_bracket(df: DataFrame, cols: list[str], open_: list[_Search]) -> list[tuple[float, float]]:
    """Ends of a bracket around every search, from one sketch per range."""
    ranges = _ranges(open_)
    aggs, wanted = [], []
    for i, own in enumerate(ranges.values()):
        v = _value(cols[own[0].c])
        aggs.append(F.kll_sketch_agg_double(F.when(own[0].within(v), v), KLL_K).alias(f"s{i}"))
        for s in own:
            at = (s.rank - s.below) / max(s.inside - 1, 1)
            wanted.append((s, i, max(at - ERROR, 0.0), min(at + ERROR, 1.0)))
    sketches = df.agg(*aggs)
    row = sketches.select(*[F.kll_sketch_get_quantile_double(f"s{i}", F.lit(p)).alias(f"q{k}_{side}")
                            for k, (_, i, a, b) in enumerate(wanted) for side, p in (("lo", a), ("hi", b))]).first()
    ends = {id(s): (row[f"q{k}_lo"], row[f"q{k}_hi"]) for k, (s, *_) in enumerate(wanted)}
    return [ends[id(s)] for s in open_]


def _count(df: DataFrame, cols: list[str], open_: list[_Search], ends: list[tuple[float, float]]) -> None:
    """Exact counts around the ends; settles or narrows every search."""
    aggs = []
    for k, (s, (lo, hi)) in enumerate(zip(open_, ends)):
        v = _value(cols[s.c])
        aggs += [F.count_if(s.within(v) & (v < F.lit(lo))).alias(f"a{k}"), F.count_if(v == F.lit(lo)).alias(f"b{k}"),
                 F.count_if((v > F.lit(lo)) & (v < F.lit(hi))).alias(f"c{k}"),
                 F.count_if(v == F.lit(hi)).alias(f"d{k}")]
    row = df.agg(*aggs).first()
    for k, (s, (lo, hi)) in enumerate(zip(open_, ends)):
        at = s.below + row[f"a{k}"]                      # rows below lo
        if s.rank < at:
            s.high, s.inside = lo, row[f"a{k}"]
            continue
        if s.rank < at + row[f"b{k}"]:
            s.value = lo
            continue
        inner = at + row[f"b{k}"]
        if s.rank < inner + row[f"c{k}"]:
            s.low, s.high, s.below, s.inside = lo, hi, inner, row[f"c{k}"]
            continue
        after = inner + row[f"c{k}"] + (row[f"d{k}"] if hi != lo else 0)
        if s.rank < after:
            s.value = hi
        else:
            s.inside -= after - s.below
            s.low, s.below = hi, after


def _read(df: DataFrame, cols: list[str], open_: list[_Search]) -> None:
    """Settle searches of few rows from the values inside their brackets."""
    ranges = list(_ranges(open_).values())
    held = F.array(*[F.struct(F.lit(i).alias("i"), F.when(own[0].within(_value(cols[own[0].c])),
                                                          _value(cols[own[0].c])).alias("v"))
                     for i, own in enumerate(ranges)])
    pairs: dict[int, list] = {}
    for r in (df.select(F.explode(F.filter(held, lambda x: x["v"].isNotNull())).alias("x")).select("x.i", "x.v")
              .groupBy("i", "v").count().collect()):
        pairs.setdefault(r["i"], []).append((r["v"], r["count"]))
    for i, own in enumerate(ranges):
        values = sorted(pairs[i])
        for s in own:
            seen = s.below
            for v, n in values:
                seen += n
                if s.rank < seen:
                    s.value = v
                    break


def select_ranks(df: DataFrame, wanted: Mapping[str, Sequence[int]], counts: Mapping[str, int]) -> dict[str, dict[int, float]]:
    """The values at 0-based ranks of several columns, NULLs and NaN aside."""
    cols = list(wanted)
    df = df.select(*[F.nanvl(_value(c), F.lit(None).cast("double")).alias(c) for c in cols])
    todo = [_Search(i, r, inside=counts[c]) for i, c in enumerate(cols) for r in wanted[c]]
    open_ = list(todo)
    while open_:
        _count(df, cols, open_, _sketch_and_bracket(df, cols, open_))
        open_ = [s for s in open_ if s.value is None]
        few = [s for s in open_ if s.inside <= VALUES]
        if few:
            _read(df, cols, few)
            open_ = [s for s in open_ if s.value is None]
    return {c: {s.rank: s.value for s in todo if s.c == i} for i, c in enumerate(cols)}


def quantiles_multi(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns: ``{column: [q1, q2, ...]}``; None without
    any value. ``df`` is read about four times, whatever the number of columns."""
    cols = list(wanted)
    if not cols:
        return {}
    row = df.agg(*[F.count(F.nanvl(_value(c), F.lit(None).cast("double"))).alias(f"n{i}")
                   for i, c in enumerate(cols)]).first()
    counts = {c: row[f"n{i}"] for i, c in enumerate(cols)}
    got = select_ranks(df, {c: _ranks(wanted[c], counts[c]) for c in cols if counts[c]}, counts)
    out = {}
    for c in cols:
        res = []
        for p in wanted[c] if counts[c] else ():
            pos = p * (counts[c] - 1)
            lo, hi = got[c][math.floor(pos)], got[c][math.ceil(pos)]
            res.append(lo + (hi - lo) * (pos - math.floor(pos)))
        out[c] = res if counts[c] else [None] * len(wanted[c])
    return out


def _ranks(probs: Sequence[float], n: int) -> list[int]:
    rs = set()
    for p in probs:
        pos = p * (n - 1)
        rs.update({math.floor(pos), math.ceil(pos)})
    return sorted(rs)


def quantiles(df: DataFrame, column: str, probs: Sequence[float], method: str = "exact",
              accuracy: int = 10_000) -> list[float | None]:
    """Quantiles of ``column`` (NULLs ignored) as Python floats.

    ``method="approx"`` is one ``percentile_approx`` pass (bounded memory,
    rank error about ``n / accuracy``).
    """
    if method == "approx":
        values = df.select(F.col(column).cast("double").alias("v"))
        row = values.agg(F.percentile_approx("v", F.array(*[F.lit(p) for p in probs]),
                                             accuracy)).first()[0]
        return list(row) if row is not None else [None] * len(probs)
    return quantiles_multi(df, {column: list(probs)})[column]


def median(df: DataFrame, column: str, **kw) -> float | None:
    return quantiles(df, column, [0.5], **kw)[0]
