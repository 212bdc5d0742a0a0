"""Operators along a sort order with ranges of a few rows, and interval joins, against plain Python."""

import random
import re
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import intervals, ordered

T0 = datetime(2024, 3, 1)


@pytest.fixture(autouse=True)
def small_ranges(monkeypatch):
    """Ranges of about five rows, so that keys and ties reach over many of them."""
    real = ordered.ranged
    monkeypatch.setattr(ordered, "ranged", lambda rows, order, per_range=None: real(rows, order, 5))


def events(rng, n, keys="aab", span=40):
    return [(i, rng.choice([*keys, None]) if rng.random() < 0.1 else rng.choice(keys),
             None if rng.random() < 0.05 else T0 + timedelta(hours=rng.randrange(span))) for i in range(n)]


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("keyed", [False, True])
def test_asof_join(spark, strict, keyed):
    rng = random.Random(3 + strict)
    left, right = events(rng, 70), events(rng, 60)
    frames = [spark.createDataFrame(rows, "id int, k string, t timestamp_ntz") for rows in (left, right)]
    got = ordered.asof_join(*frames, ["k"] if keyed else [], "t", "t", {"rid": "id", "rt": "t"}, ["id"], strict).collect()
    assert len(got) == len(left)
    found = {r["id"]: (r["rid"], r["rt"]) for r in got}
    for i, k, t in left:
        fits = [(rt, rid) for rid, rk, rt in right if t is not None and rt is not None and (not keyed or k is not None and rk == k) and (rt < t or rt == t and not strict)]
        want = max(fits, default=(None, None))
        assert found[i] == (want[1], want[0])


def test_asof_edges(spark):
    schema = "id int, k string, t timestamp_ntz, __right int, rid string"
    left = spark.createDataFrame([(1, "a", T0, 5, "old"), (1, "a", T0, 5, "old"), (2, None, T0, 5, "x")], schema)
    none = spark.createDataFrame([], schema)
    got = ordered.asof_join(left, none, ["k"], "t", "t", {"rid": "id"}, ["id"]).collect()
    assert sorted((r["id"], r["rid"], r["__right"]) for r in got) == [(1, None, 5), (1, None, 5), (2, None, 5)]
    assert ordered.asof_join(none, left, ["k"], "t", "t", {"x": "id"}, ["id"]).count() == 0
    # A value that is null itself is a match, not a reason to look further back.
    right = spark.createDataFrame([(7, "a", T0 - timedelta(1), 1, "old"), (None, "a", T0, 1, "new")], schema)
    both = ordered.asof_join(left, right, ["k"], "t", "t", {"who": "id", "what": "rid"}, ["rid"]).where("id = 1").first()
    assert (both["who"], both["what"], both["rid"]) == (None, "new", "old")


@pytest.mark.parametrize("values", [[None, 1, 2], [5], list(range(200)), [1, 1, 1, 2]])
def test_ranks(spark, values):
    rng = random.Random(len(values))
    rows = [(i, rng.choice(values)) for i in range(57)]
    got = {r["id"]: r for r in ordered.ranks(spark.createDataFrame(rows, "id int, v int"), "v", ["id"], 5).collect()}
    key = lambda r: (r[1] is not None, r[1] or 0, r[0])
    for number, (i, v) in enumerate(sorted(rows, key=key), 1):
        rank = 1 + sum((w is not None, w or 0) < (v is not None, v or 0) for _, w in rows)
        bucket = (number - 1) // 12 + 1 if number <= 24 else 2 + (number - 25) // 11 + 1  # 57 rows: 12, 12, 11, 11, 11
        r = got[i]
        assert (r["row_number"], r["rank"], r["percent_rank"], r["ntile"]) == (number, rank, (rank - 1) / 56, bucket)


def test_ranks_of_few_rows(spark):
    frame = lambda n: spark.createDataFrame([(i, i) for i in range(n)], "id int, v int")
    assert ordered.ranks(frame(0), "v", ["id"], 5).count() == 0
    only = ordered.ranks(frame(1), "v", ["id"], 5).first()
    assert (only["row_number"], only["rank"], only["percent_rank"], only["ntile"]) == (1, 1, 0.0, 1)
    assert sorted(r["ntile"] for r in ordered.ranks(frame(3), "v", ["id"], 5).collect()) == [1, 2, 3]


def test_neighbours(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice([None, *range(10)]), rng.choice([None, "x", "y"])) for i in range(64)]
    got = {r["id"]: (r["lag"], r["lead"]) for r in ordered.neighbours(spark.createDataFrame(rows, "id int, v int, s string"), ["v", "id"], "s").collect()}
    line = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    for at, (i, _, _) in enumerate(line):
        assert got[i] == (line[at - 1][2] if at else None, line[at + 1][2] if at + 1 < len(line) else None)
    assert ordered.neighbours(spark.createDataFrame([], "id int, v int, s string"), ["v", "id"], "s").count() == 0


def test_sessions_of_a_hot_key(spark):
    rng = random.Random(12)
    rows = [(i, k, t and t + timedelta(minutes=rng.randrange(60))) for i, k, t in events(rng, 150, "aaab", 90)]
    gap = timedelta(hours=1)
    got = ordered.session_starts(spark.createDataFrame(rows, "id int, k string, t timestamp_ntz"), "k", "t", ["id"], 3_600_000_000).collect()
    found = {r["id"]: r["session_start"] for r in got}
    assert len(got) == len(rows)
    for key in ("a", "b", None):
        start = last = None
        for t, i in sorted((t, i) for i, k, t in rows if k == key and t is not None):
            start = t if last is None or t - last > gap else start
            last = t
            assert found[i] == start
    assert all(found[i] is None for i, _, t in rows if t is None)


def test_funnel(spark):
    rng = random.Random(2)
    steps = ["view", "click", "buy"]
    rows = [(i, k, t, rng.choice([*steps, "other", None])) for i, k, t in events(rng, 160, "aaabcdef", 60)]
    got = ordered.funnel(spark.createDataFrame(rows, "id int, k string, t timestamp_ntz, s string"), "k", "t", ["id"], "s", steps, 5 * 3_600_000_000)
    found = {r["k"]: r["reached"] for r in got.collect()}
    want = {}
    for key in {k for _, k, t, _ in rows if k is not None and t is not None}:
        line = sorted((t, i, s) for i, k, t, s in rows if k == key and t is not None)
        best = 0
        for a, (t0, _, s0) in enumerate(line):  # every chain that begins here, greedily
            reached = 0
            for t, _, s in line[a:]:
                if reached < 3 and s == steps[reached] and (reached or t == t0) and t - t0 <= timedelta(hours=5):
                    reached += 1
            best = max(best, reached if s0 == "view" else 0)
        want[key] = best
    assert found == want and set(want.values()) >= {3}


def test_interval_overlaps(spark):
    rng = random.Random(1)

    def spans(n):
        out = []
        for i in range(n):
            start = rng.randrange(-60, 60)
            out.append((i, rng.choice(["a", "b", None]), rng.choice([start, start, start, None]), start + rng.choice([0, 0, 1, 3, 17, 64, 500, -2])))
        return out

    left, right = spans(80), spans(70)
    frames = [spark.createDataFrame(s, "id int, k string, s long, e long") for s in (left, right)]
    pairs = intervals.overlapping(*frames, ["k"], "s", "e")
    got = Counter((r["l"]["id"], r["r"]["id"]) for r in pairs.collect())
    want = Counter(
        (a, b) for a, k, s, e in left for b, q, u, v in right
        if k is not None and k == q and s is not None and u is not None and s <= e and u <= v and s <= v and u <= e)
    assert got == want and len(want) > 150
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    nothing = spark.createDataFrame([], "id int, k string, s long, e long")
    assert intervals.overlapping(frames[0], nothing, ["k"], "s", "e").count() == 0
    twice = frames[0].where("id < 9").unionAll(frames[0].where("id < 9"))
    assert intervals.overlapping(twice, twice, ["k"], "s", "e").count() == 4 * intervals.overlapping(frames[0].where("id < 9"), frames[0].where("id < 9"), ["k"], "s", "e").count()


def test_points_in_wide_intervals(spark):
    wide = spark.createDataFrame([(1, -(2**60), 2**60), (2, 5, 5), (3, 2**40, 2**40 + 1)], "i int, s long, e long")
    points = spark.createDataFrame([(p,) for p in (0, 5, 2**40 + 1, 2**60, 2**60 + 1, -(2**60))], "p long")
    pairs = intervals.points_in_intervals(points.withColumn("k", F.lit(1)), wide.withColumn("k", F.lit(1)), ["k"], "p", "s", "e")
    got = sorted((r["i"]["i"], r["p"]["p"]) for r in pairs.collect())
    assert got == sorted([(1, 0), (1, 5), (2, 5), (1, 2**40 + 1), (3, 2**40 + 1), (1, 2**60), (1, -(2**60))])


def test_points_are_copied_once_for_four_levels(spark):
    """Lengths of every level up to 2^11: points look into three tiers of bins, not into twelve levels, and find the same."""
    rng = random.Random(11)
    spans = [(i, s, s + rng.randrange(2 ** (i % 12))) for i, s in ((i, rng.randrange(-3000, 3000)) for i in range(240))]
    points = [(rng.randrange(-3500, 5500),) for _ in range(100)]
    frames = spark.createDataFrame(points, "p long").withColumn("k", F.lit(1)), spark.createDataFrame(spans, "i int, s long, e long").withColumn("k", F.lit(1))
    pairs = intervals.points_in_intervals(*frames, ["k"], "p", "s", "e")
    got = Counter((r["p"]["p"], r["i"]["i"]) for r in pairs.collect())
    assert got == Counter((p, i) for (p,) in points for i, s, e in spans if s <= p <= e) and len(got) > 300
    copies = [len(x.split(",")) for x in re.findall(r"explode\(\[([\d, ]+)\]", pairs._jdf.queryExecution().optimizedPlan().toString())]
    assert copies and max(copies) <= 3
