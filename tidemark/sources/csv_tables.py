"""Reading CSV extracts as raw strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _single(text: str) -> Column:
    """The text with one quote for an odd run of quotes and none for an even one: no cell opens or ends otherwise."""
    return F.replace(F.col(text), F.lit('""'), F.lit(""))


def _left_open(single: Column) -> Column:
    """Whether a text that starts outside of quotes ends inside; a quote opens only at its start or after a delimiter."""
    return F.rlike(F.regexp_replace(single, '(^|,)"[^"]*"', "$1x"), F.lit('(^|,)"'))


def has_broken_lines(spark: SparkSession, path: str) -> bool:
    """Whether a quoted cell holds a line break.

    A cell that runs on to the next line is open where its first line ends; if
    no line opens one, all start outside of quotes. The search is a split text
    scan that stops at one hit.
    """
    opened = spark.read.text(path).where(_left_open(_single("value")))
    return bool(opened.limit(1).count())


def read_raw_csv(
    spark: SparkSession, path: str, multi_line: bool | None = None, strict: bool = False
) -> DataFrame:
    """Every column as string, first row as names, quotes doubled inside quotes.

    With ``multi_line`` cells may hold line breaks; by default the file is
    checked for that. Either way files are split among tasks. ``strict`` fails on
    rows shorter or longer than the header, else they are padded or cut.
    """
    if multi_line is None:
        multi_line = has_broken_lines(spark, path)
    mode = "FAILFAST" if strict else "PERMISSIVE"
    if not multi_line:
        return spark.read.csv(
            path, header=True, inferSchema=False, quote='"', escape='"', encoding="UTF-8", mode=mode
        )
    # Only the head of a file is read for its names.
    names = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"', multiLine=True).columns
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    options = {"quote": '"', "escape": '"', "mode": mode}
    rows = _records(spark, path).select(F.from_csv("record", schema, options).alias("row"))
    return rows.select("row.*")


def _records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the rows of all files as text, headers and blank lines left out.

    A line starts a row if no quoted cell is open before it. What a line does is
    known for both cases: it ends open or closed whatever came before (fixed),
    or it keeps or turns that (turns). The state after some lines is that of the
    last fixed one, turned as often as lines after it turn. Each split does this
    for its own lines; a list of one entry per split then tells the state before
    it, and to which row of an earlier split its first lines belong. A file that
    ends in an open cell fails the read.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), _single("value").alias("single"),
    )
    rest = F.expr("concat('x', substr(single, instr(single, '\"') + 1))")
    outside = _left_open(F.col("single")).cast("int")
    inside = F.when(F.instr("single", '"') == 0, 1).otherwise(_left_open(rest).cast("int"))
    lines = lines.select("value", "file", "split", "at", outside.alias("outside"), inside.alias("inside")).select(
        "value", "file", "split", "at", F.when(F.col("outside") == F.col("inside"), F.col("outside")).alias("fixed"),
        (F.col("outside") > F.col("inside")).cast("int").alias("turns"),
    )
    in_file = W.partitionBy("file").orderBy("split")
    in_split = W.partitionBy("file", "split").orderBy("at")
    until, earlier = (W.unboundedPreceding, W.currentRow), in_file.rowsBetween(W.unboundedPreceding, -1)
    lines = lines.withColumn("turned", F.sum("turns").over(in_split.rowsBetween(*until))).withColumn(
        "base", (F.col("fixed") + F.col("turned")) % 2
    )
    splits = lines.groupBy("file", "split").agg(F.max_by("base", F.when(F.col("base").isNotNull(), F.col("at"))).alias("last"), F.sum("turns").alias("turns"))
    splits = splits.withColumn("turned", F.sum("turns").over(in_file.rowsBetween(*until))).withColumn(
        "base", (F.col("last") + F.col("turns") + F.col("turned")) % 2
    )
    # Lines before the first of a file: closed.
    before = F.coalesce(F.last("base", ignorenulls=True).over(earlier), F.lit(0)) + F.col("turned") - F.col("turns")
    entry = splits.select("file", "split", (before % 2).alias("open"))
    base = F.coalesce(F.last("base", ignorenulls=True).over(in_split.rowsBetween(W.unboundedPreceding, -1)), F.col("open"))
    starts = ((base + F.col("turned") - F.col("turns")) % 2 == 0).cast("int")
    numbered = lines.join(entry, ["file", "split"]).withColumn("starts", starts).withColumn(
        "row", F.sum("starts").over(in_split.rowsBetween(W.unboundedPreceding, W.currentRow))
    )
    last = F.when(F.col("rows") > 0, F.struct("split", F.col("rows").alias("row")))
    owners = numbered.groupBy("file", "split").agg(F.max("row").alias("rows")).select(
        "file", "split", F.last(last, ignorenulls=True).over(earlier).alias("owner")
    )
    own = F.when(F.col("row") > 0, F.struct("split", "row")).otherwise(F.col("owner"))
    owned = numbered.join(owners, ["file", "split"]).select("file", own.alias("own"), "split", "at", "value")
    # One row of the table, however many lines it has.
    parts = F.array_sort(F.collect_list(F.struct("split", "at", "value")))
    whole = owned.groupBy("file", "own").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("text"))
    first = (F.col("own.split") == 0) & (F.col("own.row") == 1)
    closed = F.when(_left_open(_single("text")), F.raise_error(F.concat(F.lit("a quoted cell is never closed in "), "file"))).otherwise(F.col("text"))
    return whole.where(~first).select(F.regexp_replace(closed, "\r$", "").alias("record")).where("record != ''")
