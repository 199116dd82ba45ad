"""Exact, interpolated quantiles by rank selection.

pandas ``median``/``describe`` use the exact order statistics with linear
interpolation (the value at 0-based position (n-1)p). Spark's
``percentile`` aggregate keeps every distinct value of a group in one
buffer, and ordering a whole column to read two of its ranks shuffles the
column. Here a wanted rank is enclosed instead:

1. One aggregate over the input counts every column.
2. A sample of about ``SAMPLE`` rows gives two values around each wanted
   position. They only decide how narrow the next interval is, never the
   answer.
3. One aggregate counts the rows below and up to each of these values. The
   counts are exact, so they tell which side of a value a rank lies on, and
   a rank that falls on one of the values (a value that a third of the rows
   share) is found.
4. While an open interval between two values holds more than ``limit``
   rows, 2 and 3 are repeated inside it; each time it shrinks to about a
   hundredth.
5. Only the rows strictly inside the remaining intervals are ordered: their
   distinct values, at most ``limit`` per interval, with a running count.

Every pass is a scan with a partial aggregate, so the shuffle is one row per
task and no row is copied per column; the driver sees a few numbers per
column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACCURACY = 10_000  # of the percentiles of a sample
SAMPLE = 1 << 16
LIMIT = 1 << 16
GROUP = 48  # values counted at once: Spark generates code for under a hundred columns


def value_of(df: DataFrame, column: str) -> Column:
    """The column as a double; NaN is missing, as pandas' median/describe skip it."""
    c = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(c), c) if isinstance(df.schema[column].dataType, T.FractionalType) else c


@dataclass(frozen=True)
class _Interval:
    """The open interval (low, high) of a column, ``below`` rows left of it, ``inside`` rows in it, and the ranks it holds."""

    column: str
    ranks: tuple[int, ...]
    below: int
    inside: int
    low: float | None = None
    high: float | None = None

    def holds(self, value: Column) -> Column:
        cond = value.isNotNull()
        if self.low is not None:
            cond &= value > F.lit(self.low)
        if self.high is not None:
            cond &= value < F.lit(self.high)
        return cond


def _cuts(df: DataFrame, values: dict[str, Column], intervals: Sequence[_Interval], sample: int, turn: int) -> list[list[float]]:
    """For each interval some values around its ranks, from a sample of its rows."""
    out = []
    for group in _chunks(list(enumerate(intervals)), GROUP):
        share = min(1.0, sample / min(i.inside for _, i in group))
        asked = []
        for k, interval in group:
            v = values[interval.column]
            places: list[float] = []
            for m in ((r - interval.below - 0.5) / interval.inside for r in interval.ranks):
                spread = 2 / ACCURACY + (4 * math.sqrt(m * (1 - m) / sample) if share < 1 else 0)
                near = [p for p in places if abs(p - m) < 1.1 * spread]  # the other rank of the position is next to it
                places += [] if len(near) > 1 else [min(1.0, max(0.0, m + d)) for d in (-spread, spread)]
            asked.append(F.percentile_approx(F.when(interval.holds(v), v), sorted(places), ACCURACY).alias(f"q_{k}"))
        rows = df if share == 1 else df.sample(share, seed=turn)
        row = rows.agg(*asked).first()
        out += [sorted(set(row[f"q_{k}"] or [])) for k, _ in group]
    return out


def _chunks(items: list, size: int) -> list[list]:
    return [items[i : i + size] for i in range(0, len(items), size)]


def _counts(df: DataFrame, values: dict[str, Column], cuts: set[tuple[str, float]]) -> dict[tuple[str, float], tuple[int, int]]:
    """Rows below and rows up to each (column, value)."""
    out = {}
    for group in _chunks(sorted(cuts), GROUP):
        sums = [F.count_if(values[c] < F.lit(x)).alias(f"lt_{k}") for k, (c, x) in enumerate(group)]
        sums += [F.count_if(values[c] <= F.lit(x)).alias(f"le_{k}") for k, (c, x) in enumerate(group)]
        row = df.agg(*sums).first()
        out |= {cut: (row[f"lt_{k}"], row[f"le_{k}"]) for k, cut in enumerate(group)}
    return out


def _split(found: dict, interval: _Interval, cuts: list[float], counts: dict) -> list[_Interval]:
    """The parts of an interval that still hold ranks; ranks that fall on a cut are ``found``."""
    out, below, low = [], interval.below, interval.low
    for x in [*cuts, interval.high]:
        upto, through = counts[interval.column, x] if x in cuts else (interval.below + interval.inside,) * 2
        ranks = tuple(r for r in interval.ranks if below < r <= upto)
        if ranks:
            out.append(_Interval(interval.column, ranks, below, upto - below, low, x))
        found |= {(interval.column, r): x for r in interval.ranks if upto < r <= through}
        below, low = through, x
    return out


def select_ranks(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    extra: Sequence[Column] = (),
    sample: int = SAMPLE,
    limit: int = LIMIT,
) -> tuple[dict[str, int], dict[tuple[str, int], float], Row]:
    """Rows per column, the values of the ranks next to each position, and the row of ``extra`` aggregates.

    ``extra`` is computed in the first pass over the input."""
    values = {c: value_of(df, c) for c in columns}
    first = df.agg(*[F.count(values[c]).alias(f"n_{i}") for i, c in enumerate(columns)], *extra).first()
    counts = {c: first[f"n_{i}"] for i, c in enumerate(columns)}
    found: dict[tuple[str, int], float] = {}
    wide = [
        _Interval(c, tuple(sorted({r for p in probs for r in neighbours(n, p)[:2]})), 0, n) for c, n in counts.items() if n
    ]
    small: list[_Interval] = []
    turn = 0
    while wide:
        turn += 1  # another sample each time
        small += [i for i in wide if i.inside <= limit]
        wide = [i for i in wide if i.inside > limit]
        cuts = _cuts(df, values, wide, sample, turn)
        known = _counts(df, values, {(i.column, x) for i, at in zip(wide, cuts, strict=True) for x in at})
        wide = [part for i, at in zip(wide, cuts, strict=True) for part in _split(found, i, at, known)]
    if small:
        found |= _order(df, values, small)
    return counts, found, first


def _order(df: DataFrame, values: dict[str, Column], intervals: list[_Interval]) -> dict[tuple[str, int], float]:
    """The ranks inside small intervals: only the rows in them leave their tasks."""
    spark = df.sparkSession
    inside = [p.holds(values[p.column]) for p in intervals]
    marks = [F.struct(F.lit(k).alias("k"), F.when(i, values[p.column]).alias("v")) for k, (p, i) in enumerate(zip(intervals, inside, strict=True))]
    rows = df.filter(reduce(or_, inside)).select(F.inline(F.array(*marks))).filter("v IS NOT NULL")
    rows = rows.groupBy("k", "v").agg(F.count("*").alias("c"))
    upto = Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("upto", F.sum("c").over(upto))
    wanted = [(k, r, r - p.below) for k, p in enumerate(intervals) for r in p.ranks]  # two ranks per position
    wanted = F.broadcast(spark.createDataFrame(wanted, "k int, rank long, inner_rank long"))
    at = (F.col("inner_rank") <= F.col("upto")) & (F.col("inner_rank") > F.col("upto") - F.col("c"))
    hits = rows.join(wanted, "k").filter(at).select("k", "rank", "v").collect()
    return {(intervals[r["k"]].column, r["rank"]): r["v"] for r in hits}


def neighbours(n: int, p: float) -> tuple[int, int, float]:
    """The 1-based ranks beside the position (n-1)p and the fraction between them."""
    position = (n - 1) * p
    low = math.floor(position)
    return low + 1, min(low + 2, n), position - low


def interpolated(counts: dict[str, int], found: dict[tuple[str, int], float], column: str, p: float) -> float | None:
    if not counts[column]:
        return None
    low, high, fraction = neighbours(counts[column], p)
    a, b = found[column, low], found[column, high]
    return a if a == b else a + (b - a) * fraction


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], sample: int = SAMPLE, limit: int = LIMIT
) -> DataFrame:
    """(column_name, prob, value) with pandas/DuckDB linear interpolation; no row for a column without values."""
    counts, found, _ = select_ranks(df, columns, probs, (), sample, limit)
    rows = [(c, float(p), interpolated(counts, found, c, p)) for c in columns if counts[c] for p in probs]
    return df.sparkSession.createDataFrame(rows, "column_name string, prob double, value double")


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """The exact median of each column that has values."""
    if not columns:
        return {}
    counts, found, _ = select_ranks(df, columns, [0.5])
    return {c: interpolated(counts, found, c, 0.5) for c in columns if counts[c]}
