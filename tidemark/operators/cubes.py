"""Totals on many levels at once: grouping sets over the finest cells, with mergeable sketches for distinct counts.

Base rows are grouped once, by all dimensions. Every level is then made from
those cells, which are copied once per level, not the rows. Sums add up; a
distinct count does not, so a cell keeps a sketch of its values (HyperLogLog) that
merges upwards, or exactly, the distinct values of the cells are counted per level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Registers of a sketch are 2^14: 16 kB at most, a standard error near 0.7 %.
SKETCH_BITS = 14


def cells(rows: DataFrame, dims: dict[str, Column], sums: dict[str, Column], distinct: dict[str, Column]) -> DataFrame:
    """The finest cells: dims, n_rows, sums and a sketch ``<name>_sketch`` per distinct column; partial in each task first.

    Stored as a table they answer every coarser level later, and cells of new rows
    are joined to them by a union. Null dimensions are a value; null values count
    in no sketch.
    """
    return rows.groupBy(*[c.alias(n) for n, c in dims.items()]).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.sum(c).alias(n) for n, c in sums.items()],
        *[F.hll_sketch_agg(c, SKETCH_BITS).alias(f"{n}_sketch") for n, c in distinct.items()],
    )


def rollup_sets(*dims: str) -> list[list[str]]:
    """The grouping sets of ROLLUP: all dims, then one fewer from the right, down to none."""
    return [list(dims[:n]) for n in range(len(dims), -1, -1)]


def cube_sets(*dims: str) -> list[list[str]]:
    """The grouping sets of CUBE: every subset."""
    out = [[]]
    for d in dims:
        out = out + [s + [d] for s in out]
    return [[d for d in dims if d in s] for s in reversed(out)]


def crossed(*parts: list[list[str]]) -> list[list[str]]:
    """Grouping sets of several ROLLUPs and CUBEs side by side: each of one with each of the others."""
    out: list[list[str]] = [[]]
    for sets in parts:
        out = [a + b for a in out for b in sets]
    return out


def _levels(rows: DataFrame, dims: list[str], sets: list[list[str]], kept: list[str]) -> DataFrame:
    """Rows once per grouping set, the dims outside it null, with ``level``: its bits, first dim highest, 1 where left out."""
    options = [
        F.struct(
            F.lit(sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in s)).alias("level"),
            *[(F.col(d) if d in s else F.lit(None).cast(rows.schema[d].dataType)).alias(d) for d in dims],
        )
        for s in sets
    ]
    return rows.select(F.explode(F.array(*options)).alias("g"), *kept).select("g.level", *[f"g.{d}" for d in dims], *kept)


def levels(fine: DataFrame, dims: list[str], sets: list[list[str]]) -> DataFrame:
    """Totals of every grouping set from a ``cells`` table: level, dims, n_rows, sums and an estimate ``<name>_about`` per sketch.

    ``level`` tells a total from a group whose dimension is null, like GROUPING_ID.
    Cells of one group may come several times, as after a union of tables. Without
    cells there are no rows, not even a grand total.
    """
    kept = [c for c in fine.columns if c not in dims]
    sketches = [c for c in kept if c.endswith("_sketch")]
    return _levels(fine, dims, sets, kept).groupBy("level", *dims).agg(
        *[F.sum(c).alias(c) for c in kept if c not in sketches],
        *[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c.removesuffix("_sketch") + "_about") for c in sketches],
    )


def exact_distinct(rows: DataFrame, dims: dict[str, Column], value: Column, sets: list[list[str]], name: str) -> DataFrame:
    """(level, dims, ``name``): the exact number of distinct values, nulls not counted, in every grouping set.

    Distinct pairs of finest cell and value are made first and copied per level;
    a level's pairs are spread by value, so no group gathers its values in a task.
    Both go, before a task groups any of them, to as many times more partitions as
    there are levels, so that a task holds no more copies than it had rows, and none
    groups rows beside the joins that made them.
    """
    names = list(dims)
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) * max(1, len(sets))
    pairs = rows.select(*[c.alias(n) for n, c in dims.items()], value.alias("__value")).repartition(partitions, *names, "__value").distinct()
    met = _levels(pairs, names, sets, ["__value"]).repartition(partitions, "level", *names, "__value").distinct()
    return met.groupBy("level", *names).agg(F.count("__value").alias(name))
