import hashlib
import random
import zlib

from tidemark.llm import periodic_runs
from tidemark.llm.queries import QUERIES


def brute(words):
    """All runs by comparing every word with the one p further on, smallest p of a stretch first."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i + p - start >= max(12, 2 * p):
                found.setdefault((start, i + p), p)
    return sorted((s, e - s, p) for (s, e), p in found.items())


def collapsed(words, runs):
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_text(rng):
    n = rng.choice([0, 1, 11, 12, 13, 24, 60, 150])
    words = [rng.choice("abcde"[: rng.choice([1, 2, 3, 5])]) for _ in range(n)]
    kind = rng.random()
    if kind < 0.4 and n > 4:
        a = rng.randrange(n)
        p = 1 + rng.randrange(max(1, (n - a) // 2))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    elif kind < 0.6:  # Fibonacci words hold many runs of many periods
        x, y = "a", "ab"
        while len(y) < n:
            x, y = y, y + x
        words = list(y[:n])
        if n and rng.random() < 0.5:
            words[rng.randrange(n)] = "z"
    return words


def test_runs_equal_brute_force(make):
    rng = random.Random(5)
    texts = [random_text(rng) for _ in range(600)]
    rows = [(i, rng.choice([" ", "\n", " \t "]).join(w)) for i, w in enumerate(texts)]
    got = {r["doc_id"]: r for r in periodic_runs.find_runs(make(rows)).collect()}
    total = 0
    for i, words in enumerate(texts):
        want = brute(words)
        total += len(want)
        assert [tuple(r) for r in got[i]["runs"]] == want, words
        assert got[i]["collapsed"] == collapsed(words, want)
    assert total > 500


def test_edges_and_columns(make):
    long = " ".join(f"w{i % 777}" for i in range(200_000))
    same = "x " * 100_000
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "ab " * 11), (5, "ab " * 12), (5, "ab " * 12), (None, "ä ö " * 6), (7, long), (8, same),
            (9, "a b " * 12 + "a　b"), (10, " ".join(map(str, range(3000))))]
    docs = make(rows).selectExpr("*", "1 AS runs", "2 AS row", "3 AS collapsed")
    got = periodic_runs.find_runs(docs)
    assert got.columns == [*[c for c in docs.columns if c not in ("runs", "collapsed")], "runs", "collapsed"]
    found = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got.collect()]
    assert len(found) == len(rows)
    by_id = {i: (runs, text) for i, runs, text in found}
    assert by_id[1] == by_id[2] == by_id[3] == ([], "") and by_id[4] == ([], " ".join(["ab"] * 11))
    assert by_id[5] == ([(0, 12, 1)], "ab") and by_id[None] == ([(0, 12, 2)], "ä ö")
    assert by_id[7] == ([(0, 200_000, 777)], " ".join(f"w{i}" for i in range(777))) and by_id[8] == ([(0, 100_000, 1)], "x")
    assert by_id[9] == ([(0, 12, 1)], "a b a　b") and by_id[10][0] == []
    assert periodic_runs.find_runs(make([])).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in QUERIES["op12_basic_factor_runs"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    planted = 0
    assert len(got) == len(docs)
    for doc_id, text in docs:
        words = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode())
        n, g = len(words), h // 10
        if n > 4000:
            continue  # too long to compare every word with every other; the next test holds long texts
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += n > 40
        runs, r = brute(words), got[doc_id]
        best = min(((-length, s, p) for s, length, p in runs), default=None)
        assert r["n_runs"] == len(runs)
        want = (best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == want
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{length},{p}\n" for s, length, p in runs).encode()).hexdigest()
        gone = {i for s, length, p in runs for i in range(s + p, s + length)}
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()
    assert planted > 3


def test_long_texts_against_shifts():
    rng = random.Random(9)
    words = [b"%d" % rng.randrange(50) for _ in range(30_000)]
    for at, p, length in ((100, 37, 500), (4_000, 1_500, 3_000), (12_000, 1, 4_000), (20_000, 3, 13)):
        for i in range(at + p, at + length):
            words[i] = words[i - p]
    found = list(zip(*(a.tolist() for a in periodic_runs.text_runs([words])[0])))
    for start, length, p in found:
        assert all(words[i] == words[i + p] for i in range(start, start + length - p)) and length >= max(12, 2 * p)
        assert start == 0 or words[start - 1] != words[start - 1 + p]
        assert start + length == len(words) or words[start + length] != words[start + length - p]
    assert {p for _, _, p in found} >= {37, 1_500, 1, 3}
