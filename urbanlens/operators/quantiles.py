"""Exact quantiles by narrowing ranks.

A quantile is one or two order statistics. For each wanted rank a pass finds
two values close around it (``percentile_approx`` with a fixed buffer), a second
one counts how many rows lie below and between them, and so on inside the
range, until few rows are left between or the two values are one. Each pass
leaves about a few ``1 / ACCURACY`` of the rows in the range, so 10^12 rows
need three or four; memory is ``ACCURACY`` values a task, and at most ``FEW``
values a rank reach the driver, whatever the number of distinct values.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000
FEW = 2_000


@dataclass
class Search:
    """Rank ``rank`` (from 0) lies among the ``inside`` rows from ``lo`` to ``hi``; ``below`` rows are smaller."""

    rank: int
    lo: float
    hi: float
    below: int
    inside: int

    def within(self, v: Column) -> Column:
        return (v >= F.lit(self.lo)) & (v <= F.lit(self.hi))

    def done(self) -> bool:
        return self.lo == self.hi


def order_statistics(df: DataFrame, x: str, ranks: list[int], accuracy: int = ACCURACY, few: int = FEW) -> dict[int, float]:
    """The values of the given ranks (from 0) among the non-null values of ``x``, as doubles; NaN sorts last."""
    v = F.col("_v")
    values = df.select(F.col(x).cast("double").alias("_v")).where(v.isNotNull() & ~F.isnan(v))
    total = values.agg(F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    n = total["n"]
    out = {r: math.nan for r in ranks if r >= n}
    todo = [Search(r, total["lo"], total["hi"], 0, n) for r in sorted(set(ranks)) if r < n]
    while todo:
        ready = [s for s in todo if s.done() or s.inside <= few]
        small = [s for s in ready if not s.done()]
        out |= {s.rank: s.lo for s in ready if s.done()}
        if small:
            # Bounded: at most ``few`` rows a rank.
            lists = values.where(_any(s.within(v) for s in small)).agg(*[F.array_sort(F.collect_list(F.when(s.within(v), v))) for s in small]).first()
            out |= {s.rank: got[s.rank - s.below] for s, got in zip(small, lists, strict=True)}
        todo = [s for s in todo if s not in ready]
        if todo:
            _narrow(values, v, todo, accuracy)
    return out


def _any(conditions) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _narrow(values: DataFrame, v: Column, todo: list[Search], accuracy: int) -> None:
    """Draws ``lo`` and ``hi`` of every search closer around its rank."""
    margin = 2.0 / accuracy
    asks = []
    for s in todo:
        at = (s.rank - s.below + 0.5) / s.inside
        points = [max(at - margin, 0.0), at, min(at + margin, 1.0)]
        asks.append(F.percentile_approx(F.when(s.within(v), v), F.array(*[F.lit(p) for p in points]), F.lit(accuracy)))
    near = values.where(_any(s.within(v) for s in todo)).agg(*asks).first()
    asks = []
    for s, (lo, mid, hi) in zip(todo, near, strict=True):
        here = s.within(v)
        # The middle value alone may hold the rank, however many rows share it.
        for a, b in ((lo, hi), (mid, mid)):
            asks += [F.count(F.when(here & (v < F.lit(a)), 1)), F.count(F.when((v >= F.lit(a)) & (v <= F.lit(b)), 1))]
        asks += [F.max(F.when(here & (v < F.lit(mid)), v)), F.min(F.when(here & (v > F.lit(mid)), v))]
    found = values.where(_any(s.within(v) for s in todo)).agg(*asks).first()
    for i, (s, (lo, mid, hi)) in enumerate(zip(todo, near, strict=True)):
        under, inside, under_mid, at_mid, before, after = found[6 * i: 6 * i + 6]
        k = s.rank - s.below
        if under_mid <= k < under_mid + at_mid:
            s.lo, s.hi, s.below, s.inside = mid, mid, s.below + under_mid, at_mid
        elif under <= k < under + inside and inside < s.inside:
            s.lo, s.hi, s.below, s.inside = lo, hi, s.below + under, inside
        elif k < under_mid:
            s.hi, s.inside = before, under_mid
        else:
            s.lo, s.below, s.inside = after, s.below + under_mid + at_mid, s.inside - under_mid - at_mid


def quantiles(df: DataFrame, x: str, probabilities: list[float], accuracy: int = ACCURACY, few: int = FEW) -> list[float | None]:
    """Exact quantiles with linear interpolation between order statistics; None without values."""
    v = F.col(x).cast("double")
    n = df.select(F.count(F.when(v.isNotNull() & ~F.isnan(v), 1)).alias("n")).first()["n"]
    if not n:
        return [None] * len(probabilities)
    at = [(n - 1) * p for p in probabilities]
    found = order_statistics(df, x, [r for h in at for r in (math.floor(h), math.ceil(h))], accuracy, few)
    out = []
    for h in at:
        lo, hi = found[math.floor(h)], found[math.ceil(h)]
        out.append(lo + (hi - lo) * (h - math.floor(h)))
    return out
