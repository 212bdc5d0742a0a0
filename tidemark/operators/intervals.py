"""Joins of points with intervals and of intervals with each other, as equi-joins.

Every interval gets a level by its length: the bins of a level are at least as
wide as its intervals, so an interval lies in at most two of them. A point looks
into one bin of every level there is. Only every fourth level is used, from the
highest on, so bins are at most eight times as wide as need be, and whatever the
lengths, rows are copied at most twice on one side and sixteen times on the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Levels that share the bins of the highest of them.
TIER = 4


def _level(start: Column, end: Column) -> Column:
    """The least power of two above the length."""
    return F.when(end > start, F.floor(F.log2((end - start).cast("double"))) + 1).otherwise(0).cast("int")


def _bin(at: Column, level: Column) -> Column:
    """Floor division by the width of the level, also for negative numbers."""
    return F.call_function("shiftright", at, level)


def points_in_intervals(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, start: str, end: str) -> DataFrame:
    """Pairs (``p``, ``i``: the whole rows) of equal keys with ``start <= at <= end``; the three are whole numbers (longs).

    Null keys, points or ends match nothing, nor does an interval that ends before
    it starts. Repeated rows pair as often as they occur. The join is on keys,
    level and bin, so a hot key is spread over its bins, and those that are hot
    themselves are for Spark's skew join to split.
    """
    def flat(df: DataFrame, side: str) -> list[Column]:
        return [F.col(f"`{c}`").alias(f"__{side}{n}") for n, c in enumerate(df.columns)]

    def whole(df: DataFrame, side: str) -> Column:
        return F.struct(*[F.col(f"__{side}{n}").alias(c) for n, c in enumerate(df.columns)]).alias(side)

    # Keys and ends are columns of the rows and travel once.
    at_, start_, end_ = (F.col(f"__{side}{df.columns.index(c)}") for side, df, c in (("p", points, at), ("i", intervals, start), ("i", intervals, end)))
    kept = intervals.where(F.col(start) <= F.col(end)).select(*flat(intervals, "i")).withColumn("__level", _level(start_, end_))
    levels = sorted((r[0] for r in kept.select("__level").distinct().collect()), reverse=True)  # at most 64
    tiers: list[int] = []
    for level in levels:
        if not tiers or level <= tiers[-1] - TIER:
            tiers.append(level)
    tier = F.coalesce(*[F.when(F.col("__level") > t - TIER, t) for t in tiers or [0]])
    tiered = kept.withColumn("__level", tier.cast("int"))
    lo, hi = _bin(start_, F.col("__level")), _bin(end_, F.col("__level"))
    spread = tiered.select(*[c for c in tiered.columns], F.explode(F.array_distinct(F.array(lo, hi))).alias("__ibin")).withColumnRenamed("__level", "__ilevel")
    looked = points.where(F.col(at).isNotNull()).select(*flat(points, "p"), F.explode(F.lit(tiers or [0])).alias("__level")).withColumn(
        "__bin", _bin(at_, F.col("__level"))
    )
    on = (F.col("__level") == F.col("__ilevel")) & (F.col("__bin") == F.col("__ibin"))
    for k in keys:
        on = on & (F.col(f"__p{points.columns.index(k)}") == F.col(f"__i{intervals.columns.index(k)}"))
    return looked.join(spread, on & (start_ <= at_) & (at_ <= end_)).select(whole(points, "p"), whole(intervals, "i"))


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Pairs (``l``, ``r``: the whole rows) of equal keys whose closed intervals have a point in common, each once.

    Two intervals overlap when the later start lies in the other one. A pair with
    equal starts is found from the right side only. Bounds as in
    ``points_in_intervals``; intervals that end before they start overlap nothing.
    """
    sound = F.col(start) <= F.col(end)
    left, right = left.where(sound), right.where(sound)
    by_right = points_in_intervals(right, left, keys, start, start, end).select(F.col("i").alias("l"), F.col("p").alias("r"))
    by_left = points_in_intervals(left, right, keys, start, start, end).select(F.col("p").alias("l"), F.col("i").alias("r"))
    return by_right.unionAll(by_left.where(F.col(f"l.{start}") > F.col(f"r.{start}")))
