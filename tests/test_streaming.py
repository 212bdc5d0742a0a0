"""Streams of files written by hand: late rows by the watermark, restarts, sessions, null keys and times."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.streaming import windows

DAY = datetime(2024, 5, 1)
SCHEMA = "k string, ts timestamp_ntz, v int"


def at(hours):
    return DAY + timedelta(hours=hours)


def feed(spark, tmp_path, slices):
    """One file per slice, whose number travels in the hundreds of v, then the closing file."""
    rows = spark.createDataFrame([(k, t if t is None else at(t), v + 100 * i) for i, part in enumerate(slices) for k, t, v in part], SCHEMA)
    return windows.write_feed(rows, str(tmp_path / "arriving"), len(slices), F.floor(F.col("v") / 100), "ts")


def hourly(rows, delay="2 hours"):
    return windows.windowed(rows, "ts", ["k"], [F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("v") % 100).alias("total")], "1 hour", delay=delay)


def stream(spark, tmp_path, build):
    source = windows.file_stream(spark, str(tmp_path / "feed"), spark.createDataFrame([], SCHEMA).schema)
    return build(source)


def run(spark, tmp_path, files, build):
    windows.deliver(spark, files, str(tmp_path / "feed"))
    windows.drain(stream(spark, tmp_path, build), str(tmp_path / "sink"), str(tmp_path / "checkpoint"))
    schema = build(spark.createDataFrame([], SCHEMA)).schema
    found = windows.read_sink(spark, str(tmp_path / "sink"), schema)
    return sorted(((r["k"], (r["window_start"] - DAY).total_seconds() / 3600, r["n_rows"], r["total"]) for r in found.collect()), key=repr)


SLICES = [
    [("a", 0.5, 1), ("b", 0.5, 1), (None, 0.6, 1), ("a", None, 9)],
    [("a", 5.5, 2)],
    [("a", 6.5, 3), ("a", 0.7, 4)],   # 0.7: the window ended at 1, the watermark is not yet known to this batch
    [("a", 0.8, 5), ("a", 4.9, 6)],   # the watermark is 5.5 - 2: 0.8 is late, 4.9 is not
]
WANT = [("a", 0.0, 2, 5), ("a", 4.0, 1, 6), ("a", 5.0, 1, 2), ("a", 6.0, 1, 3), ("b", 0.0, 1, 1), (None, 0.0, 1, 1)]


def test_late_rows_null_keys_and_times(spark, tmp_path):
    assert run(spark, tmp_path, feed(spark, tmp_path, SLICES), hourly) == sorted(WANT, key=repr)
    batch = hourly(spark.createDataFrame([(k, t if t is None else at(t), v) for s in SLICES for k, t, v in s], SCHEMA))
    written = windows.read_sink(spark, str(tmp_path / "sink"), batch.schema)
    late = {(r["k"], r["window_start"].hour): (r["n_rows"], r["n_late"]) for r in windows.late_rows(batch, written, ["k"]).collect()}
    assert late[("a", 0)] == (3, 1) and late[(None, 0)] == (1, 0) and sum(n for _, n in late.values()) == 1


def test_restarts_and_failed_batches_count_once(spark, tmp_path):
    files = feed(spark, tmp_path, [[("a", h + 0.5, h % 7)] for h in range(8)])
    run(spark, tmp_path, files[:3], hourly)

    def broken(rows):
        return hourly(rows.withColumn("v", F.when(F.hour("ts") == 4, F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col("v"))))

    with pytest.raises(Exception, match="stop"):
        run(spark, tmp_path, files[3:6], broken)
    got = run(spark, tmp_path, files[6:], hourly)
    assert got == [("a", float(h), 1, h % 7) for h in range(8)]
    assert run(spark, tmp_path, [], hourly) == got  # nothing new


def test_sessions_equal_their_batch(spark, tmp_path):
    def build(rows):
        return windows.sessions(rows, "ts", ["k"], [F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("v") % 100).alias("total")], "2 hours", "30 days")

    slices = [[("a", 0.0, 1), ("b", 1.0, 1)], [("a", 6.0, 2), ("a", 1.5, 3)], [("a", 3.5, 4), (None, 3.0, 5), ("b", 30.0, 1)]]
    got = run(spark, tmp_path, feed(spark, tmp_path, slices), build)
    # 1.5 and 3.5 are just the gap apart and in one session.
    assert got == sorted([("a", 0.0, 3, 8), ("a", 6.0, 1, 2), ("b", 1.0, 1, 1), ("b", 30.0, 1, 1), (None, 3.0, 1, 5)], key=repr)


def test_times_do_not_depend_on_the_session_zone(spark):
    stamps = ["1969-12-31 23:59:59.5", "1970-01-01 00:00:00", "2018-11-04 00:30:00.123456", "2024-02-29 23:59:59.999999", "0001-01-01 00:00:00"]
    rows = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.to_timestamp_ntz("s").alias("t"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Sao_Paulo", "Asia/Kathmandu"):  # the second had a missing hour in 2018
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert rows.where(dates.wall_time(dates.instant(F.col("t"))) != F.col("t")).count() == 0
            first = rows.select(dates.micros(F.col("t"))).collect()
            assert [r[0] for r in first][:2] == [-500_000, 0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
