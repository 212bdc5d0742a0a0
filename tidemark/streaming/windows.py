"""Event-time windows over a stream of files: tumbling, sliding and session windows, late rows, restarts.

The same function builds the windows of a stream and of a finished table, so a
stream can be held against its batch. Timestamps without zone are read as UTC.
A window is written once, when the watermark has passed its end, by the file
sink, whose log makes every batch count once, also after a restart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import instant, wall_time

#: The hidden column that carries the event time as an instant.
_AT = "__at"


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 1) -> DataFrame:
    """New Parquet files of a folder, oldest first; the schema is fixed, so a file of another one fails the batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def windowed(
    rows: DataFrame, time_col: str, keys: list[str], totals: list[Column], size: str, slide: str | None = None,
    delay: str = "0 seconds",
) -> DataFrame:
    """Totals per key and window: (keys, window_start, window_end, totals).

    Windows begin at multiples of ``slide`` (of ``size`` if there is none, so that
    they do not overlap) since 1970. In a stream a row counts in a window unless
    the window was over by the watermark, the greatest time of earlier batches
    less ``delay``. Rows without a time are in no window. Null keys are a key.
    Totals are partial sums in each task first; a hot key is one row per task.
    """
    timed = rows.withColumn(_AT, instant(F.col(time_col))).where(F.col(_AT).isNotNull())
    spans = F.window(_AT, size, slide) if slide else F.window(_AT, size)
    return _ends(timed.withWatermark(_AT, delay).groupBy(*keys, spans.alias("window")).agg(*totals), keys, "window")


def sessions(rows: DataFrame, time_col: str, keys: list[str], totals: list[Column], gap: str, delay: str = "0 seconds") -> DataFrame:
    """Totals per key and session: (keys, window_start, window_end, totals), a session ending ``gap`` after its last row.

    Rows of a key less than ``gap`` apart are in one session. In a stream the
    state of a key are its open sessions; a session is split if a row that would
    join two parts comes after the first part is written.
    """
    timed = rows.withColumn(_AT, instant(F.col(time_col))).where(F.col(_AT).isNotNull())
    spans = F.session_window(_AT, gap)
    return _ends(timed.withWatermark(_AT, delay).groupBy(*keys, spans.alias("window")).agg(*totals), keys, "window")


def _ends(found: DataFrame, keys: list[str], window: str) -> DataFrame:
    totals = [c for c in found.columns if c not in keys and c != window]
    ends = [wall_time(F.col(f"{window}.{end}")).alias(f"window_{end}") for end in ("start", "end")]
    return found.select(*keys, *ends, *totals)


def drain(found: DataFrame, sink: str, checkpoint: str) -> int:
    """Work through all files that are there, write the windows that are over to ``sink``, and return the number of batches.

    Started again with the same checkpoint it goes on where it stopped, wherever
    that was; open windows wait in the checkpoint's state. Both folders must be
    shared by the cluster.
    """
    job = (
        found.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
        .option("path", sink).option("checkpointLocation", checkpoint).start()
    )
    job.awaitTermination()
    return len([p for p in job.recentProgress if p.numInputRows])


def read_sink(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    """The windows written so far; files of batches that did not finish are left out by the sink's log."""
    return spark.read.schema(schema).parquet(sink)


def late_rows(feed: DataFrame, written: DataFrame, keys: list[str], count: str = "n_rows") -> DataFrame:
    """Windows of the whole feed (a batch of ``windowed``) with the rows that came too late: (keys, window_start, window_end, n_rows, n_late).

    A window of which every row was late is listed with ``n_rows`` of all its
    rows and as many late ones. Both sides hold one row per window.
    """
    on = [*keys, "window_start", "window_end"]
    a, b = feed.select(*on, F.col(count).alias("all")).alias("a"), written.select(*on, F.col(count).alias("in_time")).alias("b")
    same = F.lit(True)
    for c in on:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    late = F.col("all") - F.coalesce(F.col("in_time"), F.lit(0))
    return a.join(b, same, "left").select(*[F.col(f"a.{c}").alias(c) for c in on], F.col("all").alias("n_rows"), late.alias("n_late"))


def deliver(spark: SparkSession, parts: list[str], folder: str) -> None:
    """Move files into the folder that a stream watches; their times, and so their order, stay."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    for part in parts:
        fs.rename(path(part), path(f"{folder}/{part.rsplit('/', 1)[-1]}"))


def write_feed(rows: DataFrame, folder: str, slices: int, number: Column, time_col: str) -> list[str]:
    """Rows as ``slices`` files of a feed, in the order of ``number`` (0 on), and a last one that closes all windows.

    The closing file holds one row with a time far ahead and nothing else, so that
    the watermark passes every real window. Files carry rising times, which is the
    order in which a stream takes them up. Returns their paths.
    """
    spark = rows.sparkSession
    rows.withColumn("__slice", number.cast("int")).repartitionById(slices, F.col("__slice")).drop("__slice").write.parquet(folder)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(conf)
    parts = sorted(s.getPath().toString() for s in fs.listStatus(path) if s.getPath().getName().startswith("part-"))
    closing = spark.range(1).select(*[
        (F.to_timestamp_ntz(F.lit("9000-01-01 00:00:00")) if f.name == time_col else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in rows.schema
    ])
    closing.coalesce(1).write.mode("append").parquet(folder)
    every = {s.getPath().toString() for s in fs.listStatus(path) if s.getPath().getName().startswith("part-")}
    parts += sorted(every - set(parts))
    for i, part in enumerate(parts):
        fs.setTimes(jvm.org.apache.hadoop.fs.Path(part), 1_700_000_000_000 + 1000 * i, -1)
    return parts
