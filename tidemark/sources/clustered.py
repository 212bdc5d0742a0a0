"""Tables sorted along a space-filling curve of several columns, and reads that choose files by their ranges.

Rows close in all columns lie in the same files, so a condition on any of the
columns, or on several at once, leaves out most files by their least and greatest
values, which are kept beside the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.changes import write_key_ranges
from tidemark.sources.storage import (
    Version, commit, current_version, discard, exists, live_files, new_load, read_files, retried, table_schema,
)

#: Bits of a column in the curve: so many halvings of its values by rank.
BITS = 8
#: Rows of one file on average, and the fewest files.
PER_FILE, LEAST_FILES = 2_000_000, 32


def curve(rows: DataFrame, columns: list[str], bits: int = BITS) -> Column:
    """The place of a row on the curve: the bits of its columns' rank buckets in turn, the highest first.

    Buckets are cut at approximate quantiles, 255 values per column, so skewed
    columns are cut where their rows are; nulls are in the first one. Columns need
    an order and a type with quantiles: numbers, dates, timestamps.
    """
    cuts = [(i + 1) / 2**bits for i in range(2**bits - 1)]
    number = {c: _number(rows, c) for c in columns}
    found = rows.agg(*[F.percentile_approx(number[c], cuts, 10_000).alias(str(i)) for i, c in enumerate(columns)]).first()
    place = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        ends = sorted(set(found[i] or []))
        bucket = _below(ends, number[c]) if ends else F.lit(0)
        # Equal values make fewer buckets; they are spread over the bits all the same.
        bucket = F.floor(bucket * (2**bits - 1) / max(len(ends), 1)).cast("long")
        for bit in range(bits):
            taken = F.shiftright(bucket, bit).bitwiseAND(F.lit(1).cast("long"))
            place = place + F.shiftleft(taken, bit * len(columns) + len(columns) - 1 - i)
    return place


def _below(ends: list[float], value: Column) -> Column:
    """How many of the sorted ends are below a value; 0 for null. A binary search, one comparison per bit of the number of ends."""
    bits = len(ends).bit_length()
    # Ends that are null are below nothing.
    padded = F.array(*[F.lit(e) for e in ends], *[F.lit(None).cast("double")] * (2**bits - 1 - len(ends)))
    steps = F.lit([2**bit for bit in reversed(range(bits))])
    found = F.aggregate(steps, F.lit(0), lambda below, step: below + F.when(F.get(padded, below + step - 1) < value, step).otherwise(0))
    return F.when(value.isNotNull(), found).otherwise(0)


def _number(rows: DataFrame, column: str) -> Column:
    """A column as a number in its own order."""
    kind = rows.schema[column].dataType.typeName()
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        within = F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)
        return F.unix_date(F.col(column).cast("date")).cast("double") * 86_400 + within
    return F.col(column).cast("double")


def write_clustered(spark: SparkSession, dest: str, rows: DataFrame, columns: list[str], files: int | None = None) -> Version:
    """Write rows as the whole table, sorted along the curve of the columns, with the ranges of each in every file."""
    n = rows.count()
    files = files or max(LEAST_FILES if n >= LEAST_FILES else 1, -(-n // PER_FILE))
    staged = new_load(dest)
    try:
        placed = rows.withColumn("__place", curve(rows, columns))
        placed.repartitionByRange(files, "__place").sortWithinPartitions("__place").drop("__place").write.parquet(staged)
        if n:
            write_key_ranges(spark, dest, staged, columns, rows.schema)
        notes = {"schema": rows.schema.jsonValue(), "clustered_by": columns}
        return retried(lambda: commit(spark, dest, current_version(spark, dest), [staged], notes=notes))
    except BaseException:
        discard(spark, staged)
        raise


def files_in_ranges(spark: SparkSession, dest: str, ranges: dict[str, tuple], version: Version | None = None) -> tuple[list[str], int]:
    """The files that may hold a row with every column in its closed range, and how many the table has.

    An open end is None. Files without ranges of a column, as of later appends,
    count for any condition on it. A range excludes nulls, as a comparison does.
    """
    version = version or current_version(spark, dest)
    files = live_files(spark, dest, version)
    ranged = [load for load in version.loads if exists(spark, f"{dest}/{load}/_files")]
    if not ranged:
        return files, len(files)
    ends = spark.read.option("mergeSchema", True).parquet(*[f"{dest}/{load}/_files" for load in ranged])
    out = F.lit(False)
    for c, (lo, hi) in ranges.items():
        if f"least_{c}" not in ends.columns:
            continue
        if lo is not None:
            out = out | (F.col(f"greatest_{c}") < F.lit(lo))
        if hi is not None:
            out = out | (F.col(f"least_{c}") > F.lit(hi))
    left_out = {r.file for r in ends.where(out).select("file").collect()}
    return [f for f in files if f not in left_out], len(files)


def read_ranges(spark: SparkSession, dest: str, ranges: dict[str, tuple]) -> DataFrame:
    """The rows with every column in its closed range, from the files that may hold one; Parquet skips row groups in these too."""
    version = current_version(spark, dest)
    if not version.number:
        raise FileNotFoundError(f"no table at {dest}")
    files, _ = files_in_ranges(spark, dest, ranges, version)
    rows = read_files(spark, dest, files, table_schema(spark, dest, version))
    for c, (lo, hi) in ranges.items():
        if lo is not None:
            rows = rows.where(F.col(c) >= F.lit(lo))
        if hi is not None:
            rows = rows.where(F.col(c) <= F.lit(hi))
    return rows
