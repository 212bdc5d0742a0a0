import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import ppm

ROWS = [(1, "the cat sat on the mat"), (2, "The cat"), (3, None), (4, ""), (5, "the the the\tdog\n"), (6, "é ünïcode"), (7, "cat " * 20_000),
        (1, "the cat sat on the mat"), (None, "dog")]


def training(rows):
    return [t for i, t in rows if i is not None and i % 2 == 1]


def slow_score(texts, text):
    """PPM with exclusion, walked symbol by symbol over a dictionary of contexts."""
    counts = {}
    wrap = lambda t: b"\xff" * ppm.ORDER + (t or "").encode().lower() + b"\xff"
    for t in texts:
        b = wrap(t)
        for i in range(ppm.ORDER, len(b)):
            for k in range(ppm.ORDER + 1):
                counts.setdefault(b[i - k : i], Counter())[b[i]] += 1
    total, b = 0.0, wrap(text)
    for i in range(ppm.ORDER, len(b)):
        out, p = set(), 1.0
        for k in range(ppm.ORDER, -1, -1):
            known = counts.get(b[i - k : i], {})
            if not known:
                continue
            mass = sum(counts[b[i - k : i]].values()) - sum(counts[b[i - k : i]][s] for s in out)
            escape = mass - sum(n - ppm.DISCOUNT for s, n in known.items() if s not in out)
            if mass <= 0 or escape <= 0:
                out |= set(known)
                if b[i] in known:
                    raise AssertionError("an excluded symbol")
                continue
            if b[i] in known:
                p *= (known[b[i]] - ppm.DISCOUNT) / mass
                break
            p *= escape / mass
            out |= set(known)
        else:
            p /= 256 - len(counts.get(b"", {}))
        total += math.log10(p)
    return total


def scored(make, rows):
    return ppm.score(make(rows), F.coalesce(F.col("doc_id") % 2 == 1, F.lit(False))).collect()


def test_base_and_model_equal_plain_python(make):
    texts = training(ROWS)
    counts = Counter(w for t in texts for w in (t or "").encode().lower().split() + [b" "])
    n, v = sum(counts.values()), len(counts)
    got = scored(make, ROWS)
    assert len(got) == len(ROWS)
    by_id = {i: t for i, t in ROWS}
    for r in got:
        words = (by_id[r["doc_id"]] or "").encode().lower().split() + [b" "]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        if r["doc_id"] != 7:
            assert math.isclose(r["score"], slow_score(texts, by_id[r["doc_id"]]), rel_tol=1e-5, abs_tol=1e-9)


def test_probabilities_add_up(make):
    model = ppm.train(make([(i, t) for i, t in ROWS if i != 7]).select("text"))
    for context in (b"\xff" * 6, b"the ca", b"zzzzzz", b"on the", b"\xff\xff\xff\xff\xffe"):
        head = int.from_bytes(context[-ppm.ORDER :], "big") << 8
        p = 10 ** ppm.symbol_scores(model, np.array([head | s for s in range(256)], dtype=np.uint64))
        assert math.isclose(p.sum(), 1, rel_tol=1e-5)


def test_rare_words_are_joined(make):
    few = ppm.score(make(ROWS), F.lit(True), common_rate=0.2).collect()
    every = ppm.score(make(ROWS), F.lit(True), common_rate=0).collect()
    key = lambda r: (str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6))
    assert sorted(map(key, few)) == sorted(map(key, every))


def test_nothing_to_learn_and_empty_table(make):
    r = ppm.score(make([(2, "ab")]), F.lit(False)).first()
    assert (r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0.0) and math.isclose(r["score"], -3 * math.log10(256))
    assert ppm.score(make([]), F.lit(True)).count() == 0


def test_lookup_table():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**60, 5000).astype(np.uint64))
    table = ppm.Table.of(keys)
    assert (table.find(keys) == np.arange(len(keys))).all() and (table.find(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)] == -1).all()


def test_codes_hold_the_bytes_before():
    codes, symbols = ppm._codes(pa.array(["aB", None, "c"]))
    assert symbols.tolist() == [3, 1, 2]
    assert [int(c).to_bytes(8, "big")[-(ppm.ORDER + 1):] for c in codes] == [
        b"\xff" * 6 + b"a", b"\xff" * 5 + b"ab", b"\xff" * 4 + b"ab\xff", b"\xff" * 7, b"\xff" * 6 + b"c", b"\xff" * 5 + b"c\xff"]


def test_rare_pairs_stay_in_a_larger_corpus(make):
    # 2.4 million symbols: a millionth of them is more than two, which once cut the pairs of the rare text.
    rows = [(1, "cat " * 300_000), (3, "cat " * 300_000), (5, "zyxwvu tsrq"), (7, "zyxwvu tsrq"), (2, "zyxwvu tsrq")]
    got = {r["doc_id"]: r["score"] for r in scored(make, rows)}
    # Whatever the filler counts: after their six bytes these symbols were seen twice of two times.
    sure = math.log10((2 - ppm.DISCOUNT) / 2)
    start = math.log10((2 - ppm.DISCOUNT) / 4)
    assert math.isclose(got[2], start + 11 * sure, rel_tol=1e-5) and got[2] == got[5] == got[7]


def test_many_slices_and_buckets_give_the_same(make, monkeypatch):
    rows = [(i, f"{'ab' * (i % 7)} text {i * 7919 % 31} é") for i in range(300)]
    whole = {r["doc_id"]: r["score"] for r in scored(make, rows)}
    monkeypatch.setattr(ppm, "SLICE_BYTES", 100)
    monkeypatch.setattr(ppm, "BUCKET_BYTES", 200)
    monkeypatch.setattr(ppm, "PIECE", 3)
    parts = {r["doc_id"]: r["score"] for r in scored(make, rows)}
    assert parts.keys() == whole.keys() and all(math.isclose(parts[i], whole[i], rel_tol=1e-6) for i in whole)
    texts = training(rows)
    assert all(math.isclose(whole[i], slow_score(texts, t), rel_tol=1e-5) for i, t in rows[:20])


def test_a_pair_seen_once_is_known(make):
    got = {r["doc_id"]: r["score"] for r in scored(make, [(1, "qwertz uiop"), (2, "qwertz uiop"), (4, "mnbvcx ylkj")])}
    # Each context was seen once: half of its mass is the symbol's, half the escape's.
    assert math.isclose(got[2], 12 * math.log10(DISCOUNTED), rel_tol=1e-5) and got[4] < 2 * got[2]


DISCOUNTED = 1 - ppm.DISCOUNT


def test_stored_texts_come_back():
    column = pa.array(["a", None, "", "é\n" * 1000])
    assert ppm._restored(ppm._stored(column)).to_pylist() == ["a", "", "", "é\n" * 1000]
    assert ppm._restored(ppm._stored(pa.array([], pa.string()))).to_pylist() == []


def test_scores_travel_exactly_and_packed():
    rng = np.random.default_rng(1)
    scores = -rng.choice(rng.random(300), 20_000)
    data = ppm._scores_packed(scores)
    assert (ppm._scores_unpacked(data) == scores).all() and len(data) < 2.5 * len(scores)
    assert ppm._scores_unpacked(ppm._scores_packed(np.zeros(0))).tolist() == []


def test_a_symbol_in_context_and_a_token_travel_once_per_slice(make):
    rows = make([(i, "qwertz uiop " * 50) for i in range(40)]).select("text", F.lit(True).alias("teach")).coalesce(1)
    plan = ppm.sent_rows(rows, rows.sparkSession.sparkContext.broadcast({}), 8).collect()
    kinds = Counter(r["kind"] for r in plan)
    codes = [c for r in plan if r["kind"] == ppm._CODES for c in ppm._unpacked(bytes(r["data"]))[0].tolist()]
    assert len(codes) == len(set(codes)) and kinds[ppm._TEXTS] == 1
    # 24 000 symbols: 12 contexts go round, besides those of the start and the end. Counts of the training texts travel along.
    assert len(codes) < 40 and sum(int(ppm._unpacked(bytes(r["data"]))[1].sum()) for r in plan if r["kind"] == ppm._CODES) == 40 * 601
    asked = [t for r in plan if r["kind"] == ppm._TOKENS for t in ppm._unzipped(bytes(r["data"])).split(b"\n")]
    assert sorted(asked) == [b" ", b"qwertz", b"uiop"]


def test_symbols_and_words_of_many_texts_are_told_apart():
    texts = [None, "", " aB\x0b\x1cc\x85 ", "é aB", *[f"x{i % 7} y\t" * (i % 5) for i in range(ppm._TOGETHER - 4)]]
    codes, times, text, n = ppm._by_code(pa.array(texts, pa.large_string()))
    assert n == len(texts) and (np.diff(codes.astype(np.int64)) > 0).all()
    every = [ppm._codes(pa.array([t], pa.string()))[0] for t in texts]
    found = np.repeat(codes, times)
    for i, own in enumerate(every):
        assert found[text == i].tolist() == sorted(own.tolist())
    words, places = ppm._tokens(pa.array(texts, pa.string()))
    split = [(t or "").encode().lower().split() for t in texts]
    assert ppm._bytes(words) == [w for t in split for w in t] and places.tolist() == [i for i, t in enumerate(split) for _ in t]
    # Sums of many logs are not rounded more than the plain sum.
    base = ppm._assessed([b"a", b"b"], np.tile([0, 1], 100_000), np.zeros(200_000, np.int64), 1, {b"a": 4.3010321}, {b"b": -0.7, ppm.END: -1.0}, {b"b"})
    assert math.isclose(base["base"][0].as_py(), math.fsum([4.3010321, -0.7] * 100_000 + [-1.0]), rel_tol=1e-13)
    assert (base["n_tokens"][0].as_py(), base["known"][0].as_py()) == (200_001, 100_001)
