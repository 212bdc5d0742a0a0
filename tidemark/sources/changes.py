"""MERGE, UPDATE and DELETE on versioned tables, by writing anew only the files that hold a changed row.

Files never change: rows of a touched file are written to a new load with the
change applied, the version drops the old file, and readers of older versions
still find it. A change that meets another writer's version starts again on it,
so changes come one after the other.
"""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import settled, small_rows
from tidemark.sources.storage import (
    CommitConflict, Version, commit, current_version, discard, exists, live_files, new_load, read_files, retried, table_schema,
)

#: Keys or ranges of keys of a source that files are first tried against; more ranges only narrow the choice of files.
RANGES = 500
#: Inserted rows per new file.
_INSERTS = 2_000_000


class KeyViolation(ValueError):
    """The key column of a table holds a NULL or the same value twice."""


class Clause(NamedTuple):
    """What becomes of a row: ``update``, ``delete`` or ``insert``, for rows where ``where`` holds.

    Table columns are ``t.name`` and source columns ``s.name``. ``values`` names
    the columns that are set; without it an update or insert takes all source
    columns that the table has.
    """

    action: str
    where: Column | None = None
    values: dict[str, Column] | None = None


UPDATE, DELETE, INSERT = Clause("update"), Clause("delete"), Clause("insert")


class Changed(NamedTuple):
    """Rows and files a change has touched, and the version it made (the old one if nothing changed)."""

    updated: int
    deleted: int
    inserted: int
    files_rewritten: int
    files_kept: int
    version: int


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that are NULL or occur more than once, with their row count."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
        .where((F.col("n_rows") > 1) | missing)
    )


# --- which files ------------------------------------------------------------


def _file_name() -> Column:
    """``load/file`` of the row at hand."""
    return F.concat_ws("/", F.slice(F.split(F.col("_metadata.file_path"), "/"), -2, 2))


def write_key_ranges(spark: SparkSession, dest: str, load: str, keys: list[str], schema: T.StructType) -> None:
    """Least and greatest value of each key column per file of a load, kept beside its rows, for changes to choose files by."""
    rows = spark.read.schema(schema).parquet(load)
    ends = [e for k in keys for e in (F.min(k).alias(f"least_{k}"), F.max(k).alias(f"greatest_{k}"))]
    rows.groupBy(_file_name().alias("file")).agg(*ends).coalesce(1).write.parquet(f"{load}/_files")


def _candidates(spark: SparkSession, dest: str, version: Version, source: DataFrame, n_source: int, key: str) -> list[str]:
    """The files whose range of ``key`` meets one of the ranges into which the source keys are cut.

    Loads without ranges of that key count whole. The driver sees two values per
    file, as many as it lists anyway, and at most ``RANGES`` ranges of the source.
    """
    files = live_files(spark, dest, version)
    ranged = [load for load in version.loads if exists(spark, f"{dest}/{load}/_files")]
    if not ranged or not files:
        return files
    ends = spark.read.option("mergeSchema", True).parquet(*[f"{dest}/{load}/_files" for load in ranged])
    if f"least_{key}" not in ends.columns:
        return files
    cut = source.select(F.col(key).alias("a"), F.col(key).alias("b"))
    if n_source > RANGES:
        cut = cut.repartitionByRange(RANGES, "a").groupBy(F.spark_partition_id().alias("part")).agg(F.min("a").alias("a"), F.max("b").alias("b"))
    known = ends.where(F.col(f"least_{key}").isNotNull())
    met = known.join(F.broadcast(cut.select("a", "b")), (F.col(f"least_{key}") <= F.col("b")) & (F.col(f"greatest_{key}") >= F.col("a")), "left_semi")
    hit, sure = ({r.file for r in df.select("file").collect()} for df in (met, known))
    return [f for f in files if f in hit or f not in sure]


# --- what becomes of the rows -----------------------------------------------


def _first_action(clauses: list[Clause]) -> Column:
    """The number of the first clause that holds, null if none does."""
    number = F.lit(None).cast("int")
    for i, clause in reversed(list(enumerate(clauses))):
        number = F.when(F.lit(True) if clause.where is None else clause.where, F.lit(i)).otherwise(number)
    return number


def _values(clause: Clause, schema: T.StructType, source: list[str], update: bool) -> list[Column]:
    """The columns of the table after an update or insert, in its types; a value that does not fit is an error."""
    unknown = set(clause.values or {}) - set(schema.names)
    if unknown:
        raise ValueError(f"no columns {sorted(unknown)} in the table")
    out = []
    for f in schema:
        if clause.values is not None and f.name in clause.values:
            value = clause.values[f.name]
        elif clause.values is None and f.name in source:
            value = F.col(f"s.`{f.name}`")
        else:
            value = F.col(f"t.`{f.name}`") if update else F.lit(None)
        out.append(value.cast(f.dataType).alias(f.name))
    return out


def _row(columns: list[Column]) -> Column:
    return F.struct(*columns)


def _rewritten(rows: DataFrame, action: Column, clauses: list[Clause], schema: T.StructType, source: list[str]) -> DataFrame:
    """Rows ``t`` after the clause of their ``action``: deleted, updated or as they were."""
    after = F.col("t")
    for i, clause in enumerate(clauses):
        if clause.action == "update":
            after = F.when(action == i, _row(_values(clause, schema, source, True))).otherwise(after)
        elif clause.action != "delete":
            raise ValueError(f"no {clause.action} of a row that is there")
    gone = [i for i, clause in enumerate(clauses) if clause.action == "delete"]
    stays = ~F.coalesce(action.isin(gone), F.lit(False)) if gone else F.lit(True)
    return rows.where(stays).select("origin", after.alias("t"))


def _with_origin(spark: SparkSession, dest: str, files: list[str], schema: T.StructType) -> DataFrame:
    """(origin, t): the rows of some files with the name of their file."""
    rows, row = read_files(spark, dest, files, schema), _row([F.col(f"`{n}`") for n in schema.names]).alias("t")
    return rows.select(_file_name().alias("origin") if files else F.lit(None).cast("string").alias("origin"), row)


def _write(rows: DataFrame, files: list[str], n_new: int, schema: T.StructType, staged: str) -> None:
    """One new file for every touched one, so that key ranges stay as narrow as they were, and ``n_new`` files of inserted rows.

    Origins are numbered by a table of the touched files, which the driver has listed.
    """
    numbers = small_rows(rows.sparkSession, [(f, i) for i, f in enumerate(files)], {"origin": pa.string(), "number": pa.int32()})
    spread = F.lit(len(files)) + F.pmod(F.xxhash64("t"), F.lit(max(n_new, 1))).cast("int")
    placed = rows.join(F.broadcast(numbers), "origin", "left").withColumn("place", F.coalesce(F.col("number"), spread))
    placed.repartitionById(len(files) + n_new, F.col("place")).select("t.*").write.parquet(staged)


def _finish(
    spark: SparkSession, dest: str, base: Version, schema: T.StructType, staged: str | None, touched: list[str], notes: dict | None
) -> Version:
    """The next version: the touched files dropped, the staged load added."""
    dropped = base.dropped | set(touched)
    left = {f.split("/")[0] for f in live_files(spark, dest, base._replace(dropped=dropped))}
    loads = [load for load in base.loads if load in left] + ([staged] if staged else [])
    notes = dict(base.notes if notes is None else notes)
    notes["schema"] = schema.jsonValue()
    return commit(spark, dest, base, loads, dropped, notes)


# --- changes ----------------------------------------------------------------


def merge(
    spark: SparkSession, dest: str, source: DataFrame, keys: list[str], matched: tuple[Clause, ...] = (UPDATE,),
    unmatched: tuple[Clause, ...] = (INSERT,), notes: dict | None = None, only_on: int | None = None,
) -> Changed:
    """MERGE: rows of the table whose keys are in the source, and source rows whose keys are not in the table.

    For a matched row the first of ``matched`` whose condition holds decides, for
    an unmatched source row the first of ``unmatched``; without one it stays, or
    is left out. Source keys must be there and distinct, else ``KeyViolation`` and
    the table stays as it is; rows of the table with a null key match nothing, rows
    that repeat a key all match. An empty source changes nothing.

    Files are chosen by key range, then by a join on the key columns alone, and
    only those that hold a row to be changed are read whole. Table rows are on the
    outer side of that join, which can split a key that many of them share.
    ``notes`` become those of the new version. A source that is only right for one
    version names it in ``only_on``; on any other there is ``CommitConflict``.
    """
    rows = settled(source.select(_row([F.col(f"`{c}`") for c in source.columns]).alias("s")))
    flat = rows.select("s.*")
    bad = key_violations(flat.select(*keys), keys).limit(1).collect()
    if bad:
        raise KeyViolation(f"{keys}={list(bad[0][:-1])} occurs {bad[0]['n_rows']} times in the source")
    n_source = rows.count()
    same = F.lit(True)
    for key in keys:
        same = same & (F.col(f"t.`{key}`") == F.col(f"s.`{key}`"))

    def change() -> Changed:
        base = current_version(spark, dest)
        if only_on is not None and base.number != only_on:
            raise CommitConflict(f"{dest} is at version {base.number}, not {only_on}")
        schema = table_schema(spark, dest, base)
        if schema is None:
            raise FileNotFoundError(f"no table at {dest}")
        if not n_source and notes is None:
            return Changed(0, 0, 0, 0, len(live_files(spark, dest, base)), base.number)
        every = live_files(spark, dest, base)
        candidates = _candidates(spark, dest, base, flat, n_source, keys[0])
        action = _first_action(list(matched))
        pairs = _with_origin(spark, dest, candidates, schema).join(rows, same)
        hits = pairs.select("origin", action.alias("action")).where("action IS NOT NULL").groupBy("origin", "action").count().collect()
        touched = sorted({r.origin for r in hits})
        tally = {kind: sum(r["count"] for r in hits if matched[r.action].action == kind) for kind in ("update", "delete")}

        target = _with_origin(spark, dest, touched, schema).join(rows, same, "left")
        acted = target.withColumn("action", F.when(F.col("s").isNotNull(), action))
        new = _rewritten(acted, F.col("action"), list(matched), schema, flat.columns)
        known = _with_origin(spark, dest, candidates, schema)
        inserted = rows.join(known, same, "left_anti").withColumn("action", _first_action(list(unmatched))).where("action IS NOT NULL")
        after = F.lit(None).cast(schema)
        for i, clause in enumerate(unmatched):
            if clause.action != "insert":
                raise ValueError(f"no {clause.action} of a row that is not there")
            after = F.when(F.col("action") == i, _row(_values(clause, schema, flat.columns, False))).otherwise(after)
        n_new = max(1, -(-n_source // _INSERTS))
        if unmatched:
            new = new.unionByName(inserted.select(F.lit(None).cast("string").alias("origin"), after.alias("t")))
        staged = new_load(dest)
        try:
            _write(new, touched, n_new, schema, staged)
            written = spark.read.schema(schema).parquet(staged).count()
            kept = read_files(spark, dest, touched, schema).count() - tally["delete"]
            if not touched and not written and notes is None:
                discard(spark, staged)
                return Changed(0, 0, 0, 0, len(every), base.number)
            if written:
                write_key_ranges(spark, dest, staged, keys, schema)
            else:
                discard(spark, staged)
            version = _finish(spark, dest, base, schema, staged if written else None, touched, notes)
        except BaseException:
            discard(spark, staged)
            raise
        return Changed(tally["update"], tally["delete"], written - kept, len(touched), len(every) - len(touched), version.number)

    return retried(change) if only_on is None else change()


def _change_where(spark: SparkSession, dest: str, clause: Clause, keys: list[str] | None) -> Changed:
    def change() -> Changed:
        base = current_version(spark, dest)
        schema = table_schema(spark, dest, base)
        if schema is None:
            raise FileNotFoundError(f"no table at {dest}")
        every = live_files(spark, dest, base)
        hits = (
            read_files(spark, dest, every, schema).where(clause.where if clause.where is not None else F.lit(True))
            .groupBy(_file_name().alias("origin")).count().collect()
        ) if every else []
        touched, n = sorted(r.origin for r in hits), sum(r["count"] for r in hits)
        if not touched:
            return Changed(0, 0, 0, 0, len(every), base.number)
        rows = read_files(spark, dest, touched, schema)
        hit = F.coalesce(clause.where, F.lit(False)) if clause.where is not None else F.lit(True)
        named = rows.select(
            _file_name().alias("origin"), _row([F.col(f"`{c}`") for c in schema.names]).alias("t"), F.when(hit, F.lit(0)).alias("action"),
            _row([(clause.values or {}).get(c, F.col(f"`{c}`")).cast(schema[c].dataType).alias(c) for c in schema.names]).alias("u"),
        )
        if clause.action == "delete":
            new = named.where("action IS NULL").select("origin", "t")
        else:
            new = named.select("origin", F.when(F.col("action") == 0, F.col("u")).otherwise(F.col("t")).alias("t"))
        staged = new_load(dest)
        try:
            _write(new, touched, 1, schema, staged)
            written = spark.read.schema(schema).parquet(staged).count()
            if written and keys:
                write_key_ranges(spark, dest, staged, keys, schema)
            if not written:
                discard(spark, staged)
            version = _finish(spark, dest, base, schema, staged if written else None, touched, None)
        except BaseException:
            discard(spark, staged)
            raise
        counts = (n, 0) if clause.action == "update" else (0, n)
        return Changed(*counts, 0, len(touched), len(every) - len(touched), version.number)

    return retried(change)


def update(spark: SparkSession, dest: str, where: Column | None, values: dict[str, Column], keys: list[str] | None = None) -> Changed:
    """UPDATE: set columns of the rows where the condition is true; plain column names mean the old row.

    Rows for which it is null stay. ``keys`` names the columns whose ranges are
    kept for later merges; a change of a key column does not check it for repeats.
    """
    unknown = set(values) - set(table_schema(spark, dest).names)
    if unknown:
        raise ValueError(f"no columns {sorted(unknown)} in the table")
    return _change_where(spark, dest, Clause("update", where, values), keys)


def delete(spark: SparkSession, dest: str, where: Column | None, keys: list[str] | None = None) -> Changed:
    """DELETE: the rows where the condition is true; without a condition all of them. The table keeps its types."""
    return _change_where(spark, dest, Clause("delete", where), keys)


def create_table(
    spark: SparkSession, dest: str, rows: DataFrame, keys: list[str] | None = None, notes: dict | None = None,
    only_on: int | None = None,
) -> Version:
    """Write rows as a new table, or as all rows of one that is there; ``KeyViolation`` for null or repeated keys.

    With ``only_on`` the table must still be at that version (0: not there).
    """
    staged = new_load(dest)
    try:
        rows.write.parquet(staged)
        schema = rows.schema
        if keys:
            bad = key_violations(spark.read.schema(schema).parquet(staged).select(*keys), keys).limit(1).collect()
            if bad:
                raise KeyViolation(f"{keys}={list(bad[0][:-1])} occurs {bad[0]['n_rows']} times")
            write_key_ranges(spark, dest, staged, keys, schema)
        kept = dict(notes or {})
        kept["schema"] = schema.jsonValue()
        if only_on is not None:
            return commit(spark, dest, Version(only_on), [staged], notes=kept)
        return retried(lambda: commit(spark, dest, current_version(spark, dest), [staged], notes=kept))
    except BaseException:
        discard(spark, staged)
        raise


def append_rows(spark: SparkSession, dest: str, rows: DataFrame, notes: dict | None = None) -> Version:
    """Add rows to a keyless table; appends at the same time all stay. The columns must be those of the table."""
    schema = table_schema(spark, dest)
    if schema is not None:
        rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in schema])
    staged = new_load(dest)
    try:
        rows.write.parquet(staged)

        def switch() -> Version:
            base = current_version(spark, dest)
            return commit(spark, dest, base, [*base.loads, staged], base.dropped, {**base.notes, **(notes or {})})

        return retried(switch)
    except BaseException:
        discard(spark, staged)
        raise
