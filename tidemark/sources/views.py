"""Materialised views that are kept up to date from what has changed.

A view holds one row per group with counts, exact sums and extremes of a base
table. Files of a base version never change, so a refresh reads the files that
came since, with sign +1, and those that went, with sign -1, and merges the signed
sums into the view. The view's version names the base version it shows; two
refreshes at once therefore count a change once.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import settled
from tidemark.sources.changes import Clause, create_table, merge
from tidemark.sources.storage import (
    Version, current_version, live_files, read_files, read_table, read_version, retried, table_schema,
)

#: The merge key of a group: its key columns as one text, since a null is a group too.
GROUP = "group_key"


class View(NamedTuple):
    """Groups ``keys`` with the number of rows, sums, least and greatest values of SQL expressions over base rows.

    Sums must be of whole numbers or DECIMAL: a sum of floating point numbers
    would not come back to what it was when rows are taken out. ``rows`` prepares
    the base rows, row by row: filters, projections, joins with tables that do not
    change. Averages are a sum over its count; a distinct count is the number of
    groups of a view with the value as a further key.
    """

    keys: dict[str, str]
    sums: dict[str, str] = {}
    least: dict[str, str] = {}
    greatest: dict[str, str] = {}
    rows: Callable[[DataFrame], DataFrame] | None = None


class Refresh(NamedTuple):
    """What a refresh has read and changed."""

    base_version: int
    files_added: int
    files_removed: int
    groups_changed: int
    groups_recomputed: int


def _exact(t: T.DataType) -> bool:
    """Whether values of this type times a number of rows are exact in a DECIMAL of 38 digits."""
    return isinstance(t, T.IntegralType) or isinstance(t, T.DecimalType) and t.precision <= 27


def _picked(view: View, rows: DataFrame, sign: int) -> DataFrame:
    """One row per base row: group, keys, sign and the values of all expressions."""
    rows = view.rows(rows) if view.rows else rows
    named = [F.expr(e).alias(n) for part in (view.keys, view.sums, view.least, view.greatest) for n, e in part.items()]
    picked = rows.select(*named)
    wrong = [n for n in view.sums if not _exact(picked.schema[n].dataType)]
    if wrong:
        raise TypeError(f"sums of {wrong} would not be exact; cast them to DECIMAL of at most 27 digits")
    key = F.to_json(F.struct(*[F.col(n) for n in view.keys]), {"ignoreNullFields": "false"})
    return picked.select(key.alias(GROUP), "*", F.lit(sign).alias("sign"))


def _totals(view: View, rows: DataFrame) -> DataFrame:
    """Signed totals per group; extremes of the rows that came and of those that went apart."""
    came, times = F.col("sign") > 0, F.col("sign").cast("decimal(10,0)")
    scale = {n: getattr(rows.schema[n].dataType, "scale", 0) for n in view.sums}
    return rows.groupBy(GROUP).agg(
        *[F.first(n).alias(n) for n in view.keys],
        F.sum("sign").cast("long").alias("n_rows"),
        *[F.coalesce(F.sum(F.col(n) * times), F.lit(0)).cast(f"decimal(38,{scale[n]})").alias(n) for n in view.sums],
        *[F.coalesce(F.sum(F.when(F.col(n).isNotNull(), F.col("sign"))), F.lit(0)).cast("long").alias(f"n_{n}") for n in view.sums],
        *[F.min(F.when(came, F.col(n))).alias(n) for n in view.least], *[F.max(F.when(came, F.col(n))).alias(n) for n in view.greatest],
        *[F.min(F.when(~came, F.col(n))).alias(f"gone_{n}") for n in view.least],
        *[F.max(F.when(~came, F.col(n))).alias(f"gone_{n}") for n in view.greatest],
    )


def _columns(view: View) -> list[str]:
    return [GROUP, *view.keys, "n_rows", *view.sums, *[f"n_{n}" for n in view.sums], *view.least, *view.greatest]


def _delta(spark: SparkSession, base: str, view: View, old: Version, new: Version) -> tuple[DataFrame, int, int]:
    """Signed rows of the files by which two versions differ, and how many came and went."""
    before, after = set(live_files(spark, base, old)), set(live_files(spark, base, new))
    schema = table_schema(spark, base, new)
    came, went = sorted(after - before), sorted(before - after)
    rows = _picked(view, read_files(spark, base, came, schema), 1)
    if went:
        rows = rows.unionByName(_picked(view, read_files(spark, base, went, schema), -1))
        # Rows that a change only carried over to a new file cancel out.
        rows = rows.groupBy([c for c in rows.columns if c != "sign"]).agg(F.sum("sign").alias("sign")).where("sign <> 0")
    return rows, len(came), len(went)


def refresh(spark: SparkSession, dest: str, base: str, view: View) -> Refresh:
    """Bring the view at ``dest`` to the newest version of the table at ``base``; the first time it is made.

    Read are the files that differ and, for groups whose least or greatest value
    may have gone, the base once more, those groups only. A view whose old base
    version can no longer be read (its files were cleared) is built anew.
    """
    return retried(lambda: _refresh(spark, dest, base, view))


def _refresh(spark: SparkSession, dest: str, base: str, view: View) -> Refresh:
    state, new = current_version(spark, dest), current_version(spark, base)
    if not new.number:
        raise FileNotFoundError(f"no table at {base}")
    notes = {"base": base, "base_version": new.number}
    old = _shown(spark, base, state)
    if old is None:
        rows = _picked(view, read_table(spark, base, version=new), 1)
        totals = _totals(view, rows).select(*_columns(view))
        made = create_table(spark, dest, totals, [GROUP], notes, only_on=state.number)
        return Refresh(new.number, len(live_files(spark, base, new)), 0, read_table(spark, dest, version=made).count(), 0)
    if old.number == new.number:
        return Refresh(new.number, 0, 0, 0, 0)
    rows, came, went = _delta(spark, base, view, old, new)
    delta, stale = settled(_totals(view, rows)), 0
    if went and (view.least or view.greatest):
        delta, stale = _with_lost_extremes(spark, dest, base, view, state, new, delta)
    t, s = (lambda n: F.col(f"t.`{n}`")), (lambda n: F.col(f"s.`{n}`"))
    values = {n: t(n) + s(n) for n in ["n_rows", *view.sums, *[f"n_{n}" for n in view.sums]]}
    for names, pick in ((view.least, F.least), (view.greatest, F.greatest)):
        for n in names:
            values[n] = F.when(s("lost"), s(n)).otherwise(pick(t(n), s(n))) if "lost" in delta.columns else pick(t(n), s(n))
    done = merge(
        spark, dest, delta, [GROUP],
        matched=(Clause("delete", t("n_rows") + s("n_rows") == 0), Clause("update", None, values)),
        unmatched=(Clause("insert", s("n_rows") > 0),), notes=notes, only_on=state.number,
    )
    return Refresh(new.number, came, went, done.updated + done.deleted + done.inserted, stale)


def _shown(spark: SparkSession, base: str, state: Version) -> Version | None:
    """The base version that the view shows, if its log and all its files are still there."""
    if state.notes.get("base") != base:
        return None
    try:
        old = read_version(spark, base, state.notes["base_version"])
        live_files(spark, base, old)
        return old
    except Exception as error:
        if "FileNotFound" in str(error) or "does not exist" in str(error):
            return None
        raise


def _with_lost_extremes(
    spark: SparkSession, dest: str, base: str, view: View, state: Version, new: Version, delta: DataFrame
) -> tuple[DataFrame, int]:
    """``delta`` with ``lost`` and, for groups that a removed row may have given its extreme, the extremes of all their rows."""
    shown = read_table(spark, dest, version=state).select(GROUP, *[F.col(n).alias(f"was_{n}") for n in [*view.least, *view.greatest]])
    lost = F.lit(False)
    for n in view.least:
        lost = lost | (F.col(f"gone_{n}") <= F.col(f"was_{n}"))
    for n in view.greatest:
        lost = lost | (F.col(f"gone_{n}") >= F.col(f"was_{n}"))
    marked = settled(delta.join(shown, GROUP, "left").withColumn("lost", F.coalesce(lost, F.lit(False))).select(*delta.columns, "lost"))
    stale = marked.where("lost").select(GROUP)
    extremes = [*view.least, *view.greatest]
    again = _picked(view, read_table(spark, base, version=new), 1).join(stale, GROUP, "left_semi").groupBy(GROUP).agg(
        *[F.min(n).alias(f"now_{n}") for n in view.least], *[F.max(n).alias(f"now_{n}") for n in view.greatest]
    )
    kept = [c for c in marked.columns if c not in extremes]
    fixed = marked.join(again, GROUP, "left").select(*kept, *[F.when(F.col("lost"), F.col(f"now_{n}")).otherwise(F.col(n)).alias(n) for n in extremes])
    return fixed, stale.count()


def read_view(spark: SparkSession, dest: str) -> DataFrame:
    """The groups of a view with keys, ``n_rows``, sums, the ``n_`` of values that are not null, and extremes; a sum of none is null."""
    rows = read_table(spark, dest)
    sums = [c for c in rows.columns if f"n_{c}" in rows.columns]
    return rows.select(*[F.when(F.col(f"n_{c}") > 0, F.col(c)).alias(c) if c in sums else F.col(c) for c in rows.columns if c != GROUP])
