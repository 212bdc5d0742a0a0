"""Clustered tables: the same rows from few files."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.sources import changes, clustered
from tidemark.sources.storage import read_table

SCHEMA = "id int, a double, t timestamp_ntz, s string"
T0 = datetime(2024, 1, 1)


def make(spark, n, seed=1):
    rng = random.Random(seed)
    rows = [(i, None if rng.random() < 0.03 else rng.gauss(0, 1) ** 3, T0 + timedelta(seconds=rng.randrange(10**7)), "x") for i in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_two_ranges_read_few_files_and_all_rows(spark, tmp_path):
    dest = str(tmp_path / "t")
    rows, df = make(spark, 8000)
    clustered.write_clustered(spark, dest, df, ["a", "t"], files=64)
    late = T0 + timedelta(days=80)
    ranges = {"a": (0.1, 0.6), "t": (late, late + timedelta(days=12))}
    files, every = clustered.files_in_ranges(spark, dest, ranges)
    assert every == 64 and len(files) < every / 5
    got = sorted(r["id"] for r in clustered.read_ranges(spark, dest, ranges).collect())
    want = [i for i, a, t, _ in rows if a is not None and 0.1 <= a <= 0.6 and late <= t <= ranges["t"][1]]
    assert got == want and len(want) > 50
    assert len(clustered.read_ranges(spark, dest, ranges).inputFiles()) == len(files)
    # One column alone leaves files out too, which a plain sort by the other would not.
    assert all(len(clustered.files_in_ranges(spark, dest, {c: r})[0]) < every / 2 for c, r in ranges.items())


def test_open_ends_nulls_appends_and_changes(spark, tmp_path):
    dest = str(tmp_path / "t")
    rows, df = make(spark, 500)
    clustered.write_clustered(spark, dest, df, ["a", "t"], files=9)
    assert read_table(spark, dest).count() == 500
    assert clustered.read_ranges(spark, dest, {"a": (None, None)}).count() == 500
    count = lambda lo: clustered.read_ranges(spark, dest, {"a": (lo, None)}).count()
    plain = sum(a is not None and a >= 0.5 for _, a, _, _ in rows)
    assert count(0.5) == plain
    changes.append_rows(spark, dest, spark.createDataFrame([(1000, 0.7, T0, "new"), (1001, None, T0, "new")], SCHEMA))
    assert count(0.5) == plain + 1
    changes.delete(spark, dest, F.col("a") > 0.6, ["a", "t"])
    assert count(0.5) == sum(a is not None and 0.5 <= a <= 0.6 for _, a, _, _ in rows)
    assert clustered.read_ranges(spark, dest, {"s": (None, "x")}).count() == read_table(spark, dest).where("s <= 'x'").count()


def test_empty_and_constant_columns(spark, tmp_path):
    nothing, same = str(tmp_path / "e"), str(tmp_path / "c")
    clustered.write_clustered(spark, nothing, spark.createDataFrame([], SCHEMA), ["a", "t"])
    assert clustered.read_ranges(spark, nothing, {"a": (0.0, 1.0)}).count() == 0
    clustered.write_clustered(spark, same, spark.createDataFrame([(i, 1.0, T0, None) for i in range(50)], SCHEMA), ["a", "t"])
    assert clustered.read_ranges(spark, same, {"a": (1.0, 1.0), "t": (T0, None)}).count() == 50


def test_buckets_take_few_comparisons(spark):
    """Values below, on, between and above the ends, NaN and null; the plan compares once per bit, not once per end."""
    rng = random.Random(3)
    for n in (1, 2, 5, 255):
        ends = sorted({float(rng.randrange(-50, 400)) for _ in range(4 * n)})[:n]
        values = [e + d for e in ends for d in (-0.5, 0.0, 0.5)] + [float("-inf"), float("inf"), float("nan"), None]
        column = clustered._below(ends, F.col("v"))
        got = spark.createDataFrame([(v,) for v in values], "v double").select("v", column.alias("n")).collect()
        assert len(got) == len(values)
        for v, found in got:
            assert found == (0 if v is None else len(ends) if v != v else sum(e < v for e in ends))
    assert "filter(" not in str(column)
