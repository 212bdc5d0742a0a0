"""JSON cells: the paths and types found in a column, and its cells as typed columns.

Cells are parsed into VARIANT values. Types of one path meet in a lattice (null
below whole numbers below decimals below doubles; any other mix is text), which
counts and maxima merge, so that each task sends one row per path and type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longest path with a column of its own; objects at its end stay JSON text.
DEEPEST = 8
MOST_COLUMNS = 1000

_NUMBERS = ["BIGINT", "DECIMAL", "DOUBLE", "FLOAT"]


def _kind(schema: Column) -> Column:
    return F.regexp_extract(schema, "^([A-Z]+)", 1)


def type_counts(rows: DataFrame, column: str, deepest: int = DEEPEST) -> DataFrame:
    """(path, kind, n, whole, scale): how often each path holds each kind of value, and its decimals' digits.

    ``path`` is the list of member names. Members of objects are followed,
    elements of arrays are not. The empty path is the cell itself: its kinds are
    OBJECT, ARRAY and so on, ``BROKEN`` for text that is not JSON (repeated
    members included), and ``MISSING`` for a null cell.
    """
    parsed = rows.select(F.try_parse_json(column).alias("v"), F.col(column).isNull().alias("missing"))
    schema = F.schema_of_variant("v")
    kind = F.when(F.col("missing"), "MISSING").when(F.col("v").isNull(), "BROKEN").otherwise(_kind(schema))
    level = parsed.select(F.array().cast("array<string>").alias("path"), kind.alias("kind"), schema.alias("schema"), "v")
    found = None
    for _ in range(deepest + 1):
        scale = F.when(F.col("kind") == "DECIMAL", F.regexp_extract("schema", r"(\d+)\)", 1).cast("int")).when(F.col("kind") == "BIGINT", 0)
        digits = F.when(F.col("kind") == "DECIMAL", F.regexp_extract("schema", r"\((\d+)", 1).cast("int")).when(F.col("kind") == "BIGINT", 19)
        counted = level.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("n"), F.max(digits - scale).alias("whole"), F.max(scale).alias("scale"))
        found = counted if found is None else found.unionAll(counted)
        objects = level.where("kind = 'OBJECT'").select("path", F.col("v").alias("o"))
        if objects.isEmpty():
            break
        members = objects.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("o").outer()))
        schema = F.schema_of_variant("value")
        level = members.select(F.array_append("path", F.col("key")).alias("path"), _kind(schema).alias("kind"), schema.alias("schema"), F.col("value").alias("v"))
    return found


def infer_json(rows: DataFrame, column: str, deepest: int = DEEPEST) -> DataFrame:
    """(path, type, n_filled, n_null, mixed): one row per member path, with the type that holds all its values.

    ``type`` is bigint, a decimal of as many digits as seen, double (also where a
    decimal would need over 38 digits), boolean, string, ``object`` where all
    values are objects, and string for arrays, other kinds and mixes; ``mixed``
    tells that values of unlike kinds have met. Paths seen only with null are string.
    """
    kinds = type_counts(rows, column, deepest).where(F.size("path") > 0)

    def n(*names: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind").isin(*names), F.col("n"))), F.lit(0))

    found = kinds.groupBy("path").agg(
        n("VOID").alias("n_null"), n("BIGINT").alias("n_int"), n("BIGINT", "DECIMAL").alias("n_exact"), n(*_NUMBERS).alias("n_number"),
        n("BOOLEAN").alias("n_bool"), n("OBJECT").alias("n_object"), n("STRING").alias("n_string"),
        (F.sum("n") - n("VOID")).alias("n_filled"), F.max("whole").alias("whole"), F.max("scale").alias("scale"), F.collect_set("kind").alias("kinds"),
    )
    filled = F.col("n_filled")
    digits = F.col("whole") + F.col("scale")
    kind = (
        F.when(filled == 0, "string").when(F.col("n_int") == filled, "bigint")
        .when((F.col("n_exact") == filled) & (digits <= 38), F.format_string("decimal(%d,%d)", digits, F.col("scale")))
        .when(F.col("n_number") == filled, "double").when(F.col("n_bool") == filled, "boolean")
        .when((F.col("n_object") == filled) & (F.size("path") < deepest), "object").otherwise("string")
    )
    plain = F.size(F.array_except("kinds", F.array(F.lit("VOID")))) <= 1
    return found.select("path", kind.alias("type"), "n_filled", "n_null", (~(plain | (F.col("n_number") == filled))).alias("mixed"))


def _json_path(path: list[str]) -> str:
    out = "$"
    for name in path:
        if "'" in name and '"' in name:
            raise ValueError(f"a member name with both quotes cannot be addressed: {name}")
        out += f'["{name}"]' if "'" in name else f"['{name}']"
    return out


def shredded(rows: DataFrame, column: str, types: DataFrame, broken: str = "is_broken") -> DataFrame:
    """The other columns, a typed column per leaf path of ``infer_json`` (members joined by dots), and whether the cell is broken.

    A null, a missing member and a cell that is null, broken or no object give
    null; arrays and mixed members are their JSON text, strings in them bare.
    Paths that clash with another column, or with each other in their joined
    names, and more than ``MOST_COLUMNS`` of them are an error.
    """
    leaves = sorted((r["path"], r["type"]) for r in types.where("type <> 'object'").limit(MOST_COLUMNS + 1).collect())
    if len(leaves) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} paths; keys may be data")
    names = [".".join(path) for path, _ in leaves]
    kept = [c for c in rows.columns if c != column]
    twice = {n for n in [*names, *kept, broken] if [*names, *kept, broken].count(n) > 1}
    if twice:
        raise ValueError(f"columns {sorted(twice)} occur twice")
    parsed = rows.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.try_parse_json(column).alias("v"), F.col(column).alias("text"))
    cells = [F.try_variant_get("v", _json_path(path), kind).alias(name) for (path, kind), name in zip(leaves, names)]
    return parsed.select(*[F.col("row")[c].alias(c) for c in kept], *cells, (F.col("v").isNull() & F.col("text").isNotNull()).alias(broken))
