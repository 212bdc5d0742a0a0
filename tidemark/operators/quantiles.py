"""Exact quantiles without sorting the data.

``percentile`` keeps every distinct value of a group in one aggregation buffer.
Here mergeable sketches (``percentile_approx``) bracket the wanted ranks, exact
counts on the bracket's ends tell whether one of them is the value or how many
rows lie between, and the next pass looks only there. A bracket holds a few rows
in ten thousand of the one before, so two or three passes do for any table; what
then lies between is at most ``hold`` rows and is read value by value. Nothing but
sketches and counts is shuffled before.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import small_rows

ACCURACY = 10_000
HOLD = 4096


class _Range(NamedTuple):
    """The ``n`` values strictly between two bounds, ``before`` values below them; None is no bound."""

    lo: float | None
    hi: float | None
    before: int
    n: int
    ranks: tuple[int, ...]

    def holds(self, v: Column) -> Column:
        inside = F.lit(True)
        if self.lo is not None:
            inside = inside & (v > self.lo)
        return inside if self.hi is None else inside & (v < self.hi)


def quantile_values(
    df: DataFrame, column: str, probs: list[float], accuracy: int = ACCURACY, hold: int = HOLD
) -> dict[float, float | None]:
    """Quantiles by linear interpolation between the two neighbouring ranks.

    NULL and NaN are left out, infinities count; without any value every quantile
    is None. The passes run when this is called.
    """
    v = F.col(column).cast("double")
    values = df.select(v.alias("v")).where("v is not null and not isnan(v)")
    total = values.agg(F.count("v")).first()[0]
    if not total:
        return dict.fromkeys(probs)

    spots = {p: p * (total - 1) for p in probs}
    ranks = sorted({r for s in spots.values() for r in (math.floor(s), math.ceil(s))})
    at: dict[int, float] = {}
    ranges = [_Range(None, None, 0, total, tuple(ranks))]
    while ranges:
        small = [r for r in ranges if r.n <= hold]
        if small:
            _read(values, small, at)
        ranges = _narrowed(values, [r for r in ranges if r.n > hold], accuracy, at)

    return {p: _between(at[math.floor(s)], at[math.ceil(s)], s - math.floor(s)) for p, s in spots.items()}


def _between(low: float, high: float, part: float) -> float:
    if low == high or not part:
        return low
    return low * (1 - part) + high * part if math.isinf(high - low) else low + (high - low) * part


def _read(values: DataFrame, ranges: list[_Range], at: dict[int, float]) -> None:
    """Settle the ranks of ranges that hold few rows: those rows, one entry per value, come to the driver."""
    v = F.col("v")
    counts = values.where(reduce(or_, [r.holds(v) for r in ranges])).groupBy("v").agg(F.count("v").alias("n")).collect()
    bars = sorted((c["v"], c["n"]) for c in counts)
    for r in ranges:
        seen = r.before
        for value, n in bars:
            if (r.lo is None or value > r.lo) and (r.hi is None or value < r.hi):
                at.update({k: value for k in r.ranks if seen <= k < seen + n})
                seen += n


def _narrowed(values: DataFrame, ranges: list[_Range], accuracy: int, at: dict[int, float]) -> list[_Range]:
    """Two values around every wanted rank; ranks that one of them settles go to ``at``, the others get a new range."""
    if not ranges:
        return []
    v, wanted = F.col("v"), [(r, k) for r in ranges for k in r.ranks]
    width = 2 / accuracy
    spots = [
        [min(max((k - r.before) / max(r.n - 1, 1) + side * width, 0.0), 1.0) for k in r.ranks for side in (-1, 1)] for r in ranges
    ]
    ends = values.agg(*[F.percentile_approx(F.when(r.holds(v), v), p, accuracy) for r, p in zip(ranges, spots)]).first()
    pairs = [(e[i], e[i + 1]) for e in ends for i in range(0, len(e), 2)]
    # Also the rows of the range below each pair: a sketch may be off, and the counts say so.
    counts = values.agg(*[
        F.count_if(test) for lo, hi in pairs for test in (v < lo, v <= lo, v < hi, v <= hi)
    ]).first()
    found: dict[tuple, list[int]] = {}
    for i, ((r, k), (lo, hi)) in enumerate(zip(wanted, pairs)):
        below_lo, upto_lo, below_hi, upto_hi = counts[4 * i : 4 * i + 4]
        if below_lo <= k < upto_lo:
            at[k] = lo
        elif below_hi <= k < upto_hi:
            at[k] = hi
        elif k < below_lo:
            found.setdefault((r.lo, lo, r.before, below_lo - r.before), []).append(k)
        elif k >= upto_hi:
            found.setdefault((hi, r.hi, upto_hi, r.before + r.n - upto_hi), []).append(k)
        else:
            found.setdefault((lo, hi, upto_lo, below_hi - upto_lo), []).append(k)
    return [_Range(*bounds, tuple(ks)) for bounds, ks in found.items()]


def exact_quantiles(df: DataFrame, column: str, probs: list[float]) -> DataFrame:
    """``quantile_values`` as rows (prob, value)."""
    found = quantile_values(df, column, probs)
    return small_rows(
        df.sparkSession, [(p, found[p]) for p in probs], {"prob": pa.float64(), "value": pa.float64()}
    )
