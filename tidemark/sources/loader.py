"""Typed load of CSV extracts into parquet tables, one table at a time."""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text_values as tv
from tidemark.operators.inference import infer_column_types, spark_schema
from tidemark.session import small_rows
from tidemark.sources.csv_tables import has_broken_lines, read_raw_csv
from tidemark.sources.changes import KeyViolation, key_violations, write_key_ranges
from tidemark.sources.storage import (
    Version, commit, current_version, discard, list_csv, new_load, read_table, retried, table_schema,
)


class LoadResult(NamedTuple):
    table: str
    rows: int | None
    status: str
    error: str | None


def typed_column(name: str, data_type: T.DataType) -> Column:
    """Raw cell to its type. An empty cell is NULL; a cell that does not fit fails the job.

    Blanks and underscores are only taken out of cells that are numbers with them.
    """
    v = F.nullif(F.col(f"`{name}`"), F.lit(""))
    if isinstance(data_type, T.StringType):
        return v.alias(name)
    if isinstance(data_type, T.TimestampNTZType):
        parsed = tv.to_timestamp(v)
    elif isinstance(data_type, T.IntegralType):
        parsed = F.when(tv.is_integer(v), tv.without_marks(v).try_cast(data_type))
    elif isinstance(data_type, T.NumericType):
        parsed = F.when(tv.is_number(v), tv.without_marks(v).try_cast(data_type))
    else:
        parsed = v.try_cast(data_type)
    # Said outright, so that a session without ANSI casts does not load NULL instead.
    misfit = F.concat(F.lit(f"{name}: not {data_type.simpleString()}: "), v)
    if isinstance(data_type, T.DecimalType):
        # A number with more places than the column would be rounded without a word.
        exact = tv.without_marks(v).try_cast(f"decimal(38,{min(38, data_type.scale + 6)})")
        parsed = F.when(exact.isNull() | (exact == parsed), parsed)
    typed = F.when(v.isNotNull() & parsed.isNull(), F.raise_error(misfit).cast(data_type)).otherwise(parsed)
    return typed.alias(name)


def apply_schema(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The raw table with the types of ``schema``, which must name the same columns."""
    if sorted(raw.columns) != sorted(schema.names):
        raise ValueError(f"columns {sorted(raw.columns)} are not those of the table {sorted(schema.names)}")
    return raw.select(*[typed_column(f.name, f.dataType) for f in schema.fields])


def load_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    dest: str,
    mode: str = "overwrite",
    key: str | None = "id",
    multi_line: bool | None = None,
) -> int:
    """Load one extract and return its row count.

    ``overwrite`` replaces the rows, so a repeated load changes nothing;
    ``append`` adds them, for a table with a key only those whose key is new.
    The rows are first written to a folder of their own, which is the only parse
    of the CSV; the key check reads one column of it, and on append one column of
    the table. Only then does the table switch to them: on any failure, and
    wherever the load is cut off, the table stays as it was. Loads that run at the
    same time come one after the other: the later one checks its types and keys
    against what the earlier one has added, and of two overwrites it replaces
    the earlier one's rows.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unknown mode {mode}")
    staged = new_load(dest)
    base = _checked_version(spark, dest, schema)
    try:
        raw = read_raw_csv(spark, path, multi_line, strict=True)
        apply_schema(raw, schema).write.parquet(staged)
        loaded = spark.read.schema(schema).parquet(staged)
        keyed = key if key in loaded.columns else None
        if keyed:
            _refuse_repeated(key_violations(loaded, [keyed]), keyed)
            write_key_ranges(spark, dest, staged, [keyed], schema)
        rows, checked = loaded.count(), Version()

        def switch() -> None:
            nonlocal base, checked
            base = _checked_version(spark, dest, schema)
            if mode == "append" and keyed:
                _refuse_known(spark, dest, base, checked, loaded, keyed, schema)
                checked = base
            commit(spark, dest, base, [*base.loads, staged] if mode == "append" else [staged], base.dropped)

        retried(switch)
    except Exception:
        discard(spark, staged)
        raise
    return rows


def _checked_version(spark: SparkSession, dest: str, schema: T.StructType) -> Version:
    """The newest version, an error if it has other columns or types."""
    base = current_version(spark, dest)
    fixed = table_schema(spark, dest, base)
    if fixed is not None and _kinds(fixed) != _kinds(schema):
        raise ValueError(f"the table has {fixed.simpleString()}, the load {schema.simpleString()}")
    return base


def _refuse_repeated(bad: DataFrame, key: str) -> None:
    found = bad.limit(1).collect()
    if found:
        raise KeyViolation(f"{key}={found[0][0]} occurs {found[0]['n_rows']} times")


def _refuse_known(
    spark: SparkSession, dest: str, base: Version, checked: Version, loaded: DataFrame, key: str, schema: T.StructType
) -> None:
    """An error if a loaded key is in the table; loads already in the version ``checked`` are not looked at again."""
    fresh = [load for load in base.loads if load not in checked.loads]
    if not fresh:
        return
    known = read_table(spark, dest, schema, base._replace(loads=tuple(fresh)))
    again = known.select(key).join(loaded.select(key), key, "left_semi").limit(1).collect()
    if again:
        raise KeyViolation(f"{key}={again[0][0]} is already in the table")


def _kinds(schema: T.StructType) -> list[tuple[str, T.DataType]]:
    return [(f.name, f.dataType) for f in schema.fields]


def load_folder(
    spark: SparkSession,
    folder: str,
    dest_root: str,
    schemas: dict[str, T.StructType] | None = None,
    mode: str = "overwrite",
    tables: list[str] | None = None,
) -> list[LoadResult]:
    """Load every CSV of a folder in name order; a table that fails is named and passed over.

    A table that exists keeps its types, and a cell that does not fit fails the
    load. ``schemas`` names the tables that may be loaded and their types; an
    extract of any other table then fails. Without it a new table gets inferred
    types. ``tables`` restricts the load to some tables. Columns whose numbers no
    DECIMAL holds load as text, which the result says.
    """
    results = []
    for table, path in list_csv(spark, folder):
        if tables is not None and table not in tables:
            continue
        dest, note = f"{dest_root}/{table}", None
        try:
            if schemas is not None and table not in schemas:
                raise LookupError(f"unknown table {table}")
            broken = has_broken_lines(spark, path)
            schema = schemas[table] if schemas is not None else table_schema(spark, dest)
            if schema is None:
                types = infer_column_types(read_raw_csv(spark, path, broken))
                schema = spark_schema(types)
                wide = sorted(
                    r["column"] for r in types.where("type = 'NUMERIC' AND spark_type = 'string'").select("column").collect()
                )
                if wide:
                    note = f"kept as text, more than 38 digits: {', '.join(wide)}"
            rows = load_table(spark, path, schema, dest, mode, multi_line=broken)
            results.append(LoadResult(table, rows, "loaded", note))
        except Exception as error:  # whatever went wrong, the other tables still load
            results.append(LoadResult(table, None, "failed", (str(error).splitlines() or [repr(error)])[0]))
    return results


def load_audit(spark: SparkSession, results: list[LoadResult]) -> DataFrame:
    """One row per table, in load order: rows loaded, status and error text."""
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string()]
    return small_rows(spark, results, dict(zip(LoadResult._fields, kinds)))


def load_summary(audit: DataFrame) -> DataFrame:
    """Total rows, number of failed tables and their names."""
    failed = F.col("status") == "failed"
    return audit.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.count_if(failed).alias("n_failed"),
        F.array_join(F.array_sort(F.collect_list(F.when(failed, F.col("table")))), ", ").alias(
            "failed_tables"
        ),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, for the reconciliation of a load."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        for name, df in tables.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionAll(c)
    return out


def reconciliation_total(tables: dict[str, DataFrame]) -> DataFrame:
    return row_counts(tables).agg(F.sum("n_rows").alias("total_rows"))
