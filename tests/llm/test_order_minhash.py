import random

import numpy as np

from tidemark.llm import order_minhash
from tidemark.llm.components import components


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_alignment_is_exact():
    rng = random.Random(1)
    for _ in range(800):
        a = [rng.randint(0, 3) for _ in range(rng.randint(0, 12))]
        b = [x if rng.random() < 0.8 else rng.randint(0, 3) for x in a if rng.random() < 0.9]
        d = edit_distance(a, b)
        for k in range(10):
            assert order_minhash.aligned(np.array(a, "<u4"), np.array(b, "<u4"), k) == (d <= k)


def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    docs = {i: [word() for _ in range(rng.randint(20, 80))] for i in range(30)}
    for k in range(12):  # near copies of 3, one with every edit
        copy = list(docs[3])
        copy[(k * 4) % len(copy)] = word()
        docs[100 + k] = copy
    docs[200] = docs[5] + docs[6]  # shares half with each
    docs[201], docs[202] = list(docs[7]), list(docs[7])
    return {i: " ".join(w) for i, w in docs.items()}


def test_groups_equal_brute_force(make):
    texts = corpus()
    ids = sorted(texts)
    shingles = {i: [tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))] for i, w in ((i, t.split()) for i, t in texts.items())}
    label = {i: i for i in ids}
    links = [(a, b) for a in ids for b in ids if a < b and
             edit_distance(shingles[a], shingles[b]) <= 0.2 * max(len(shingles[a]), len(shingles[b]))]
    for _ in ids:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = order_minhash.near_duplicates(make(list(texts.items()))).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == label
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in got)


def test_parities_bound_the_distance():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = rng.integers(0, 30, rng.integers(0, 40)).astype(np.uint64) << np.uint64(20), rng.integers(0, 30, rng.integers(0, 40)).astype(np.uint64) << np.uint64(20)
        odd = order_minhash.parities(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        classes = sum(int(x ^ y).bit_count() for x, y in zip(odd[0].view(np.uint64), odd[1].view(np.uint64)))
        assert classes + abs(len(a) - len(b)) <= 2 * edit_distance(a.tolist(), b.tolist())


def test_edges(make):
    long = "word and another one here " * 4000
    rows = [(1, None), (2, ""), (3, "  "), (4, "a b"), (5, "a b"), (6, "A b"), (7, long), (8, long + "end"), (9, "a c"), (9, "a c"), (None, "a b")]
    got = {r["doc_id"]: (r["class_id"], r["kept"]) for r in order_minhash.near_duplicates(make(rows)).collect()}
    assert got == {1: (1, True), 2: (2, True), 3: (3, True), 4: (4, True), 5: (4, False), 6: (4, False), 7: (7, True), 8: (7, False),
                   9: (9, True), None: (None, True)}
    assert order_minhash.near_duplicates(make([])).count() == 0
    docs = make(rows)
    kept = order_minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == sorted("1 2 3 4 7 9 9 None".split())


def test_one_text_without_words_stays(make):
    docs = make([(5, ""), (3, " \n"), (4, "\t"), (8, None), (None, ""), (9, "some words here"), (6, "")])
    kept = [(r["doc_id"], r["text"]) for r in order_minhash.drop_wordless_copies(docs).collect()]
    assert sorted(kept, key=str) == sorted([(3, " \n"), (8, None), (None, ""), (9, "some words here")], key=str)


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(50, 51), (51, 50), (60, 60), (None, 3)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(links).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {50: 50, 51: 50}
    assert components(links.where("a = 60")).count() == 0
