"""Operators along a sort order that no single task holds: last known values, as-of joins, ranks, neighbours, sessions, funnels.

Rows are cut into ranges of the order, each of a bounded number of rows, so that
a key or a table that is too large for one task spans several. Windows run
inside the ranges; what a range needs from those before it, one row or one count
per range, is handed on.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.dates import micros
from tidemark.session import settled, small_rows

#: Most rows of one range on average, and the least for which a range of its own pays.
PER_RANGE, LEAST = 1_000_000, 1_000
_RANGE = "__range"


def ranged(rows: DataFrame, order: list[str], per_range: int = PER_RANGE) -> DataFrame:
    """The rows with ``__range``, a number that rises along ``order``, written once to the shared folder.

    Rows equal in all of ``order`` are in one range, so the order should end in
    columns that tell rows apart. Bounds come from a sample, so ranges differ in
    size, but not with the skew of the data. Nulls come first. There are as many
    ranges as the session has shuffle partitions, fewer for a small table and more
    where they would hold over ``per_range`` rows.
    """
    n = rows.count()
    usual = min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // LEAST)
    cut = rows.repartitionByRange(max(1, usual, -(-n // per_range)), *order).withColumn(_RANGE, F.spark_partition_id())
    return settled(cut)


def _struct(names: list[str]) -> Column:
    return F.struct(*[F.col(n).alias(f"_{i}") for i, n in enumerate(names)])


def last_known(parts: DataFrame, keys: list[str], order: list[str], value: Column, name: str, before: bool = False) -> DataFrame:
    """A ``ranged`` table (by keys, then order) with ``name``: the value of the latest row of the same keys whose value is not null.

    The row itself counts unless ``before``. Keys may be null, which is a key of
    its own. Inside a range this is a window over its rows of the key. Of each
    range, the last value of its greatest key goes on to the ranges after it that
    begin with that key; these are one row per range.
    """
    parts = parts.withColumn("__value", value)
    here = W.partitionBy(_RANGE, *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1 if before else 0)
    found = parts.withColumn("__here", F.last("__value", ignorenulls=True).over(here))

    # A struct of the value, so that a found value is told from none even where it holds nulls itself.
    filled = F.col("__value").isNotNull()
    ends = parts.select(_RANGE, _struct(keys).alias("k"), _struct(order).alias("o"), "__value", filled.alias("filled"))
    place = F.struct("k", "o")
    ends = ends.groupBy(_RANGE).agg(
        F.min("k").alias("first"), F.max("k").alias("top"),
        F.max_by(F.struct("k", F.col("__value").alias("v")), F.when(F.col("filled"), place)).alias("end"),
    )
    asks = ends.select(_RANGE, F.col("first").alias("k"), F.lit(0).alias("tells"), F.lit(None).cast(parts.schema["__value"].dataType).alias("v"))
    tells = ends.where(F.col("end.k").eqNullSafe(F.col("top"))).select(_RANGE, F.col("top").alias("k"), F.lit(1).alias("tells"), F.col("end.v").alias("v"))
    handed = W.partitionBy("k").orderBy(_RANGE, "tells").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        asks.unionByName(tells).withColumn("v", F.last("v", ignorenulls=True).over(handed)).where((F.col("tells") == 0) & F.col("v").isNotNull())
        .select(F.col(_RANGE).alias("__r"), F.col("k").alias("__k"), F.col("v").alias("__v"))
    )
    same = (F.col(_RANGE) == F.col("__r")) & _struct(keys).eqNullSafe(F.col("__k"))
    joined = found.join(carried, same, "left")
    kept = [c for c in parts.columns if c not in ("__value", name)]
    return joined.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col("__here"), F.col("__v")).alias(name))


def asof_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, values: dict[str, str],
    ties: list[str], strict: bool = False, per_range: int = PER_RANGE,
) -> DataFrame:
    """Every left row with ``values`` of the latest right row of its keys that is not later (``strict``: that is earlier).

    ``values`` maps new column names to right columns. Of right rows at the same
    time the one that is last by ``ties`` counts, then any of those equal in these
    too (by a hash, so always the same). Without such a row, and for left rows
    with a null key or time, the values are null; right rows with a null key or time
    match nothing. No keys make the whole table one. Left columns of the new names
    are replaced.
    """
    names = [f"__k{i}" for i in range(len(keys))] or ["__k0"]
    columns = [F.col(k) for k in keys] or [F.lit(0)]
    usable = F.col(right_time).isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    picked = F.struct(*[F.col(c).alias(n) for n, c in values.items()])
    whole = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    tie_types = [right.select(t).schema[0].dataType for t in ties]
    blank = [F.lit(None).cast(t).alias(f"__t{i}") for i, t in enumerate(tie_types)]
    row_type, value_type = left.select(whole.alias("l")).schema[0].dataType, right.select(picked.alias("r")).schema[0].dataType
    r = right.where(usable).select(
        *[c.alias(n) for c, n in zip(columns, names)], F.col(right_time).alias("__at"), F.lit(1 if strict else 0).alias("__side"),
        *[F.col(t).alias(f"__t{i}") for i, t in enumerate(ties)], F.xxhash64(picked).alias("__hash"),
        F.lit(None).cast(row_type).alias("__left"), picked.alias("__right"),
    )
    l = left.select(
        *[c.alias(n) for c, n in zip(columns, names)], F.col(left_time).alias("__at"), F.lit(0 if strict else 1).alias("__side"),
        *blank, F.xxhash64(*names, F.col(left_time)).alias("__hash"), whole.alias("__left"), F.lit(None).cast(value_type).alias("__right"),
    )
    order = ["__at", "__side", *[f"__t{i}" for i in range(len(ties))], "__hash"]
    parts = ranged(r.unionByName(l), [*names, *order], per_range)
    found = last_known(parts, names, order, F.col("__right"), "__match").where(F.col("__left").isNotNull())
    kept = [F.col("__left")[c].alias(c) for c in left.columns if c not in values]
    return found.select(*kept, *[F.col("__match")[n].alias(n) for n in values])


def _offsets(parts: DataFrame) -> tuple[int, list[tuple[int, int]]]:
    """All rows, and for every range with rows its number and the rows before it; one count per range reaches the driver."""
    counts = parts.groupBy(_RANGE).count().orderBy(_RANGE).collect()
    out, n = [], 0
    for number, rows in counts:
        out.append((number, n))
        n += rows
    return n, out


def ranks(rows: DataFrame, by: str, ties: list[str], buckets: int, per_range: int = PER_RANGE) -> DataFrame:
    """All rows of a table ranked by one column: ``row_number``, ``rank``, ``percent_rank``, ``ntile`` (1 to ``buckets``).

    The row number and ntile follow ``by``, then ``ties``; rows equal in both are
    numbered in any order, so ties should end in an id. Equal values of ``by`` share
    rank and percent rank, nulls are the smallest value. One row alone has percent
    rank 0. Columns of these four names are replaced.
    """
    new = ["row_number", "rank", "percent_rank", "ntile"]
    parts = ranged(rows.select(*[F.col(f"`{c}`") for c in rows.columns if c not in new]), [by, *ties], per_range)
    n, before = _offsets(parts)
    starts = small_rows(rows.sparkSession, before, {_RANGE: pa.int32(), "__before": pa.int64()})
    placed = parts.join(F.broadcast(starts), _RANGE)
    placed = placed.withColumn("row_number", F.col("__before") + F.row_number().over(W.partitionBy(_RANGE).orderBy(by, *ties)))
    # A value may begin in an earlier range: its least row number there is handed on with the value as the key.
    first = F.min("row_number").over(W.partitionBy(_RANGE, by))
    placed = placed.withColumn("__first", first)
    begun = placed.groupBy(by, _RANGE).agg(F.min("row_number").alias("__first"))
    ends = parts.groupBy(_RANGE).agg(F.min_by(F.struct(by), F.struct(by, *ties)).alias("lo"), F.max_by(F.struct(by), F.struct(by, *ties)).alias("hi"))
    border = ends.select(F.col(f"lo.{by}").alias("v")).unionAll(ends.select(F.col(f"hi.{by}").alias("v"))).distinct()
    began = begun.join(border, begun[by].eqNullSafe(border["v"]), "left_semi").groupBy(by).agg(F.min("__first").alias("__began"))
    began = began.select(F.col(by).alias("__v"), "__began")
    placed = placed.join(began, F.col(by).eqNullSafe(F.col("__v")), "left")
    rank = F.coalesce(F.col("__began"), F.col("__first"))
    size, rest = n // buckets, n % buckets
    large = rest * (size + 1)  # the first buckets hold one row more
    at = F.col("row_number") - 1
    ntile = F.when(at < large, F.floor(at / (size + 1))).otherwise(F.lit(rest) + F.floor((at - large) / max(size, 1))) + 1
    kept = [F.col(f"`{c}`") for c in parts.columns if c != _RANGE]
    return placed.select(
        *kept, "row_number", rank.alias("rank"), ((rank - 1) / F.lit(float(max(n - 1, 1)))).alias("percent_rank"), ntile.cast("int").alias("ntile")
    )


def neighbours(rows: DataFrame, order: list[str], value: str, per_range: int = PER_RANGE) -> DataFrame:
    """The rows of a whole table with ``lag`` and ``lead``: ``value`` of the row before and after in ``order``.

    The order should end in an id; nulls come first. The first row has no lag, the
    last no lead. Each range lends its first and last row to its neighbours.
    """
    parts = ranged(rows.select(*[F.col(f"`{c}`") for c in rows.columns if c not in ("lag", "lead")]), order, per_range)
    w = W.partitionBy(_RANGE).orderBy(*order)
    wrapped = F.struct(F.col(value).alias("v"))
    inside = parts.withColumn("__lag", F.lag(wrapped).over(w)).withColumn("__lead", F.lead(wrapped).over(w))
    numbers = [number for number, _ in _offsets(parts)[1]]
    links = small_rows(rows.sparkSession, list(zip(numbers, [None, *numbers], [*numbers[1:], None])), {"r": pa.int32(), "p": pa.int32(), "q": pa.int32()})
    ends = parts.groupBy(_RANGE).agg(F.min_by(wrapped, _struct(order)).alias("lo"), F.max_by(wrapped, _struct(order)).alias("hi"))
    lent = (
        links.join(ends.select(F.col(_RANGE).alias("p"), F.col("hi").alias("from_before")), "p", "left")
        .join(ends.select(F.col(_RANGE).alias("q"), F.col("lo").alias("from_after")), "q", "left").select("r", "from_before", "from_after")
    )
    joined = inside.join(lent, F.col(_RANGE) == F.col("r"))
    kept = [F.col(f"`{c}`") for c in parts.columns if c != _RANGE]
    lag, lead = F.coalesce("__lag", "from_before"), F.coalesce("__lead", "from_after")
    return joined.select(*kept, lag["v"].alias("lag"), lead["v"].alias("lead"))


def _elapsed(earlier: Column, later: Column) -> Column:
    return micros(later) - micros(earlier)


def session_starts(rows: DataFrame, key: str, time: str, ties: list[str], gap_us: int, per_range: int = PER_RANGE) -> DataFrame:
    """The rows with ``session_start``: the time of the first row of their session.

    A session of a key goes on while the next row is at most ``gap_us`` microseconds
    later. Rows without a time have no session.
    A key with any share of the rows spans several tasks.
    """
    order = [time, *ties]
    parts = ranged(rows.drop("session_start", "__previous"), [key, *order], per_range)
    with_lag = last_known(parts, [key], order, F.col(time), "__previous", before=True)
    starts = F.when(F.col(time).isNotNull() & (F.col("__previous").isNull() | (_elapsed(F.col("__previous"), F.col(time)) > gap_us)), F.col(time))
    found = last_known(with_lag, [key], order, starts, "session_start")
    begun = F.when(F.col(time).isNotNull(), F.col("session_start")).alias("session_start")
    return found.select(*[F.col(f"`{c}`") for c in found.columns if c not in ("session_start", _RANGE, "__previous")], begun)


def funnel(
    rows: DataFrame, key: str, time: str, ties: list[str], step: str, steps: list[str], within_us: int, per_range: int = PER_RANGE
) -> DataFrame:
    """Per key the furthest step reached: (key, ``reached``), 0 without the first step.

    A step is reached by a row of that step with rows of all earlier steps before
    it, in order, the first of them at most ``within_us`` microseconds earlier. For
    each row of a step the latest chain before it is the one that counts, as it
    begins latest. Rows without a time or key reach nothing and are left out.
    """
    order = [time, *ties]
    usable = rows.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(key, time, *ties, F.col(step).alias("__step"))
    parts = ranged(usable, [key, *order], per_range).withColumn("__begin0", F.when(F.col("__step") == steps[0], F.col(time)))
    for i, name in enumerate(steps[1:], 1):
        chained = last_known(parts, [key], order, F.col(f"__begin{i - 1}"), "__chain", before=True)
        in_time = (F.col("__step") == name) & F.col("__chain").isNotNull() & (_elapsed(F.col("__chain"), F.col(time)) <= within_us)
        parts = chained.withColumn(f"__begin{i}", F.when(in_time, F.col("__chain"))).drop("__chain")
    reached = F.greatest(*[F.when(F.col(f"__begin{i}").isNotNull(), i + 1).otherwise(0) for i in range(len(steps))])
    return parts.groupBy(key).agg(F.max(reached).alias("reached"))
