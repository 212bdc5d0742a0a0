"""Column types of a raw (all-string) table, and the DDL text for them."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text_values as tv
from tidemark.session import small_rows

INT_MAX = 2_147_483_647


def _cells(table: str, raw: DataFrame) -> DataFrame:
    """(table, pos, v) for every filled cell. An empty cell says nothing about a type."""
    text = raw.select(*[
        F.col(f"`{c}`").cast("string").alias(str(i)) for i, c in enumerate(raw.columns)
    ])
    return text.unpivot([], [F.col(f"`{c}`") for c in text.columns], "pos", "v").select(
        F.lit(table).alias("table"), F.col("pos").cast("int").alias("pos"), "v"
    ).where("v <> ''")


def _classed_cells(tables: dict[str, DataFrame]) -> DataFrame:
    cells = reduce(DataFrame.unionAll, [_cells(t, raw) for t, raw in tables.items()])
    return cells.withColumn("kind", tv.value_class(F.col("v")))


def _column_names(tables: dict[str, DataFrame]) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession
    return small_rows(
        spark,
        [(t, i, c) for t, raw in tables.items() for i, c in enumerate(raw.columns)],
        {"table": pa.string(), "pos": pa.int32(), "column": pa.string()},
    )


def infer_folder_types(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table and column: its type and the figures the type rests on.

    Every cell is classified once in the scan stage. All tables share one
    group-by, whose shuffle carries one partial row per column and task.
    """
    kind_is = lambda name: F.col("kind") == name
    # Step by step, so that nothing is worked out twice; whole numbers need no more than their length.
    classed = _classed_cells(tables).withColumn(
        "digits", F.when(F.col("kind").isin("integer", "number"), tv.bare_digits(F.col("v")))
    )
    special = kind_is("number") & F.substring("digits", 1, 1).isin(*"nNiI")  # nan and inf
    power_sign = kind_is("number") & ~special & (F.contains("digits", F.lit("e")) | F.contains("digits", F.lit("E")))
    classed = classed.withColumns({"special": special, "scaled": power_sign})
    # Signs are gone from "digits"; the exponent's is read from the cell. An absurd exponent counts as 99 places.
    classed = classed.withColumns({
        "mantissa": F.when(F.col("scaled"), F.regexp_replace("digits", "[eE].*$", "")).otherwise(F.col("digits")),
        "power": F.when(F.col("scaled"), F.coalesce(
            F.regexp_replace(F.regexp_extract("v", r"[eE]([+-]?[0-9_]+)", 1), "[+_]", "").try_cast("int"), F.lit(99)
        )).otherwise(0),
    })
    classed = classed.withColumns({
        "point": F.when(kind_is("number"), F.instr("mantissa", ".")).otherwise(0), "length": F.length("mantissa"),
    })
    point, length, power = F.col("point"), F.col("length"), F.col("power")
    plain = F.col("digits").isNotNull() & ~F.col("special")
    whole = F.greatest(F.when(point > 0, point - 1).otherwise(length) + power, F.lit(1))
    fraction = F.greatest(F.when(point > 0, length - point).otherwise(0) - power, F.lit(0))

    def n(kind: str):
        return F.count_if(F.col("kind") == kind).alias(f"n_{kind}")

    # Numbers only: a text result (such as a sample cell) would turn this into a sort of all cells.
    found = classed.groupBy("table", "pos").agg(
        F.count("v").alias("n_filled"),
        n("code"), n("boolean"), n("integer"), n("number"), n("date"),
        F.count_if("special").alias("n_special"),
        F.max(F.when(F.col("kind") == "integer", F.col("digits").cast("bigint"))).alias("max_int"),
        F.max(F.when(plain, whole)).alias("whole_digits"),
        F.max(F.when(plain, fraction)).alias("fraction_digits"),
    )
    names = _column_names(tables)
    filled = F.coalesce("n_filled", F.lit(0))
    kind = (
        F.when(filled == 0, "TEXT")
        .when(F.col("n_code") > 0, "TEXT")
        .when(F.col("n_boolean") == filled, "BOOLEAN")
        .when(
            F.col("n_integer") == filled,
            F.when(F.col("max_int") <= INT_MAX, "INTEGER").otherwise("BIGINT"),
        )
        .when(F.col("n_integer") + F.col("n_number") == filled, "NUMERIC")
        .when(F.col("n_date") == filled, "TIMESTAMP")
        .otherwise("TEXT")
    )
    # NUMERIC is unbounded in SQL. Up to 16 + 2 digits are money; more are sized from the
    # data, exponents included. Only nan and inf ask for a DOUBLE. What has more than
    # 38 digits stays text, since neither type holds it.
    digits = F.col("whole_digits") + F.col("fraction_digits")
    decimal = (
        F.when(digits > 38, "string")
        .when(F.col("n_special") > 0, "double")
        .when((F.col("whole_digits") <= 16) & (F.col("fraction_digits") <= 2), "decimal(18,2)")
        .otherwise(F.format_string("decimal(%d,%d)", F.greatest(digits, F.lit(18)), "fraction_digits"))
    )
    spark_type = (
        F.when(F.col("type") == "NUMERIC", decimal)
        .when(F.col("type") == "TEXT", "string")
        .when(F.col("type") == "INTEGER", "int")
        .when(F.col("type") == "TIMESTAMP", "timestamp_ntz")
        .otherwise(F.lower("type"))
    )
    return (
        names.join(found, ["table", "pos"], "left")
        .withColumn("type", kind)
        .select(
            "table", "pos", "column", "type", spark_type.alias("spark_type"),
            filled.alias("n_filled"), F.coalesce("n_code", F.lit(0)).alias("n_code"),
            "max_int",
        )
    )


def infer_column_types(raw: DataFrame) -> DataFrame:
    """``infer_folder_types`` of one raw table."""
    return infer_folder_types({"": raw}).drop("table")


def code_examples(tables: dict[str, DataFrame]) -> DataFrame:
    """The smallest code-like cell of every column that has one, to show why it is TEXT."""
    codes = _classed_cells(tables).where(F.col("kind") == "code")
    return (
        codes.groupBy("table", "pos").agg(F.min("v").alias("sample_code"))
        .join(_column_names(tables), ["table", "pos"])
        .select("table", "column", "sample_code")
    )


def spark_schema(types: DataFrame) -> T.StructType:
    """Schema for the typed load. Only the one row per column comes to the driver."""
    rows = types.orderBy("pos").select("column", "spark_type").collect()
    return T.StructType([T.StructField(r[0], T.DataType.fromDDL(r[1])) for r in rows])


def ddl_for(types: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """CREATE TABLE text per table from (table, pos, column, type); ``id`` is the primary key.

    ``counts`` (table, n_rows) adds the number of rows the types rest on.
    """
    key = F.when(F.lower("column") == "id", " PRIMARY KEY").otherwise("")
    line = F.concat(F.lit("    "), F.col("column"), F.lit(" "), F.col("type"), key)
    lines = F.array_sort(F.collect_list(F.struct("pos", line.alias("line"))))
    ddl = types.groupBy("table").agg(
        F.concat(
            F.lit("CREATE TABLE "), F.col("table"), F.lit(" (\n"),
            F.array_join(F.transform(lines, lambda s: s["line"]), ",\n"), F.lit("\n);"),
        ).alias("ddl"),
        F.count(F.lit(1)).alias("n_columns"),
    )
    return ddl if counts is None else ddl.join(counts, "table", "left")


def write_ddl(ddl: DataFrame, path: str) -> None:
    """All statements as one text file in table order (one row per table, so one task)."""
    script = ddl.agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("table", "ddl"))), lambda s: s["ddl"]),
            "\n\n",
        ).alias("value")
    )
    script.coalesce(1).write.mode("overwrite").text(path)
