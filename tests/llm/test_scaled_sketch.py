import hashlib
import random

from tidemark.llm import scaled_sketch

ROWS = [(5, "e " * 30), (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (3, None), (2, ""), (9, "été 你好 \U0001f600x"), (7, "one"),
        (11, "w%d " * 3), (20, " ".join(f"t{i}" for i in range(20_000))), (21, " ".join(f"t{i}" for i in range(20_000)))]


def brute(rows):
    rows = sorted(rows, key=lambda r: r[0])
    out = {}
    for k, (i, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        tail = len(t) // 4
        new = t[: len(t) - tail] + following[:tail]
        a, b, c = scaled_sketch.text_sketches([t, new, following])
        out[i] = (len(t), hashlib.sha256(new.encode()).hexdigest(), scaled_sketch.fingerprint(a), scaled_sketch.fingerprint(b),
                  scaled_sketch.likeness(a, b), scaled_sketch.likeness(a, c))
    return out


def test_equals_brute_force_in_one_and_many_ranges(make):
    rows = ROWS + [(100 + i, " ".join(random.Random(i).choices("abcdefghij", k=30))) for i in range(60)]
    for per_range in (4096, 4):
        got = scaled_sketch.neighbours_compared(make(rows), per_range=per_range).collect()
        assert {r[0]: tuple(r)[1:] for r in got} == brute(rows) and len(got) == len(rows)


def test_edges(make):
    assert scaled_sketch.neighbours_compared(make([])).count() == 0
    assert [r["near_next"] for r in scaled_sketch.neighbours_compared(make([(1, "a b c d e f g")])).collect()] == [1.0]
    got = scaled_sketch.neighbours_compared(make([(1, "x y"), (1, "x y"), (None, "z"), (2, None)]), per_range=1).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "1", "2", "None"]
    same = {r["fingerprint"] for r in got if r["doc_id"] == 1}
    assert len(same) == 1


def test_sketches_merge_and_estimate_containment(spark, make):
    words = [f"t{i}" for i in range(4000)]
    whole, part = " ".join(words), " ".join(words[1000:1800])
    a, b = scaled_sketch.sketch_table(make([(1, whole)])), scaled_sketch.sketch_table(make([(2, part), (3, None)]))
    r = scaled_sketch.containment(a, b).collect()
    assert len(r) == 1 and r[0]["share_of_b"] == 1.0 and abs(r[0]["share_of_a"] - 0.2) < 0.05
    kept = a.count() / (len(words) - 4)
    assert abs(kept - 1 / scaled_sketch.SCALE) < 0.05


def test_every_range_is_a_partition_of_its_own(make, monkeypatch):
    rows = [(i * 3 - 100, f"text {i}") for i in range(300)]
    for block in (1, 7, 128):
        monkeypatch.setattr(scaled_sketch, "_BLOCK", block)
        docs = make(rows).selectExpr("doc_id as id", "text")
        got = scaled_sketch._ranged(docs, 10, 20_000).selectExpr("id", "part", "guest", "spark_partition_id() as p").collect()
        own = sorted((r["id"], r["part"]) for r in got if not r["guest"])
        assert [i for i, _ in own] == [i for i, _ in rows] and all(a[1] <= b[1] for a, b in zip(own, own[1:]))
        assert all(r["p"] == r["part"] for r in got) and len({r["part"] for r in got}) > 20
        assert max(sum(part == k for _, part in own) for k in {r["part"] for r in got}) <= 20
