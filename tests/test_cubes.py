"""Grouping sets from finest cells on rows written by hand."""

from itertools import product

from pyspark.sql import functions as F

from tidemark.operators import cubes

SCHEMA = "a string, b int, v int, who long"


def dims():
    return {"a": F.col("a"), "b": F.col("b")}


def test_sets():
    assert cubes.rollup_sets("x", "y") == [["x", "y"], ["x"], []]
    assert sorted(map(tuple, cubes.cube_sets("x", "y"))) == [(), ("x",), ("x", "y"), ("y",)]
    assert cubes.crossed([["x"], []], [["y"], []]) == [["x", "y"], ["x"], ["y"], []]


def test_levels_with_nulls_and_unions(spark):
    data = [("x", 1, 5, 1), ("x", None, 7, 1), (None, 1, None, 2), (None, None, 2, None), ("x", 1, 5, 1), ("y", 2, 1, 3)]
    sets = cubes.cube_sets("a", "b")
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    fine = lambda rows: cubes.cells(frame(rows), dims(), {"v": F.col("v")}, {"who": F.col("who")})
    whole = cubes.levels(fine(data), ["a", "b"], sets).collect()
    parts = cubes.levels(fine(data[:2]).unionByName(fine(data[2:])), ["a", "b"], sets).collect()
    want = {}
    for a, b, v, who in data:
        for no_a, no_b in product((0, 1), repeat=2):
            n, total, seen = want.get((2 * no_a + no_b, None if no_a else a, None if no_b else b), (0, None, frozenset()))
            total = total if v is None else (total or 0) + v
            want[2 * no_a + no_b, None if no_a else a, None if no_b else b] = (n + 1, total, seen | ({who} - {None}))
    for got in (whole, parts):
        assert {(r["level"], r["a"], r["b"]): (r["n_rows"], r["v"], r["who_about"]) for r in got} == {
            k: (n, t, len(s)) for k, (n, t, s) in want.items()}
    exact = cubes.exact_distinct(frame(data), dims(), F.col("who"), sets, "n").collect()
    assert {(r["level"], r["a"], r["b"]): r["n"] for r in exact} == {k: len(s) for k, (_, _, s) in want.items()}
    assert cubes.levels(fine([]), ["a", "b"], sets).count() == 0


def test_sketches_stay_close_after_merging(spark):
    rows = spark.range(60_000).select((F.col("id") % 300).cast("string").alias("a"), (F.col("id") % 7).cast("int").alias("b"), F.lit(1).alias("v"),
                                      (F.col("id") % 50_000).alias("who"))
    fine = cubes.cells(rows, dims(), {}, {"who": F.col("who")})
    about = cubes.levels(fine, ["a", "b"], [[]]).first()["who_about"]
    assert abs(about - 50_000) < 1_500


def test_copies_per_level_have_partitions_per_level(spark):
    """The copies are dealt out before they are grouped: no aggregate between the explode and the exchange."""
    sets = cubes.cube_sets("a", "b")
    rows = spark.range(500).selectExpr("CAST(id % 5 AS string) AS a", "CAST(id % 3 AS int) AS b", "1 AS v", "id % 50 AS who")
    exact = cubes.exact_distinct(rows, dims(), F.col("who"), sets, "n")
    lines = [x.lstrip("+-: *()0123456789") for x in exact._jdf.queryExecution().sparkPlan().toString().splitlines()]
    kinds = [x.split()[0].split("(")[0] for x in lines if x.strip()]
    up = kinds[: kinds.index("Generate")]
    assert up[-1] in ("Project", "Exchange") and "Exchange" in up and up.index("Exchange") > up.index("HashAggregate")
    assert "HashAggregate" not in up[up.index("Exchange"):]
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert f", {n}), REPARTITION_BY_NUM" in exact._jdf.queryExecution().sparkPlan().toString()
    assert {r["n"] for r in exact.where("level = 3").collect()} == {50}
