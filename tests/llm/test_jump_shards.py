import hashlib
import zlib
from collections import Counter

import pytest

from tidemark.llm import jump_shards


def plain_jump(key, n):
    """The published loop, on Python integers."""
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def plain_key(doc_id):
    return int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:16], 16)


ROWS = [(i, f"text {i}") for i in range(-50, 400)] + [(None, "no id"), (3, None), (4, ""), (5, "ü" * 70_000), (2**62, "far")]


@pytest.mark.parametrize("n", [1, 2, 40, 41, 1000])
def test_shards_are_those_of_the_loop(make, n):
    got = jump_shards.assign(make(ROWS), n).select("doc_id", "shard", "grown_shard").collect()
    assert len(got) == len(ROWS)
    for doc_id, shard, grown in got:
        assert (shard, grown) == (plain_jump(plain_key(doc_id), n), plain_jump(plain_key(doc_id), n + 1))
        assert grown in (shard, n)


def test_manifest_sizes_checksums_and_slots(make):
    got = jump_shards.manifest(make(ROWS), 40).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in ROWS)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_repeated_rows_get_their_own_slots(make):
    rows = [(1, "a")] * 2500 + [(1, "b")] * 3 + [(None, None)] * 4 + [(i, "c") for i in range(2000)]
    got = jump_shards.manifest(make(rows), 3).collect()
    assert len(got) == len(rows) and len({(r["shard"], r["slot"]) for r in got}) == len(rows)
    for shard, n in Counter(r["shard"] for r in got).items():
        assert max(r["slot"] for r in got if r["shard"] == shard) == n - 1
    assert len({r["shard"] for r in got if r["doc_id"] == 1}) == 1


def test_slots_do_not_depend_on_the_layout(make):
    one, other = (
        {(r["doc_id"], r["size"], r["slot"]) for r in jump_shards.manifest(make(ROWS).repartition(n), 5).collect()} for n in (1, 7))
    assert one == other


def test_more_shards_take_rows_only_into_the_new_ones(make):
    moved = {(r["from_shard"], r["to_shard"]): r["n_rows"] for r in jump_shards.moves(make([(i, "") for i in range(5000)]), 10, 12).collect()}
    assert sum(moved.values()) == 5000 and all(a == b or b >= 10 for a, b in moved)
    assert abs(sum(n for (a, b), n in moved.items() if a != b) / 5000 - 2 / 12) < 0.03


def test_edges_and_clashing_names(make, spark):
    assert jump_shards.manifest(make([]), 4).count() == 0 and jump_shards.assign(make([]), 4).count() == 0
    named = make(ROWS[:5]).selectExpr("doc_id", "text", "1 AS shard", "2 AS slot", "3 AS `__row`", "4 AS `__jump`", "5 AS copies", "6 AS `a.b`")
    got = jump_shards.assign(named, 4)
    assert got.columns == ["doc_id", "text", "slot", "__row", "__jump", "copies", "a.b", "shard", "grown_shard"]
    assert {r["__jump"] for r in got.collect()} == {4} and jump_shards.manifest(named, 4).count() == 5
    with pytest.raises(ValueError):
        jump_shards.assign(named, 0)


def test_written_shards(make, spark, tmp_path):
    path = str(tmp_path / "shards")
    jump_shards.write_shards(make(ROWS), path, 4, 2)
    back = spark.read.parquet(path)
    assert back.count() == len(ROWS)
    assert all(r["shard"] == plain_jump(plain_key(r["doc_id"]), 4) for r in back.select("doc_id", "shard").collect())
    assert len(list((tmp_path / "shards" / "shard=1").glob("*.parquet"))) <= 2


def test_no_python_on_the_path(make):
    for df in (jump_shards.assign(make(ROWS), 40), jump_shards.manifest(make(ROWS), 40)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan.replace("PythonRDD", "") and "MapInArrow" not in plan
