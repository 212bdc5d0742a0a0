import numpy as np

from tidemark.llm import language_id

ROWS = [(i, "the cat and the dog sat on the mat there") for i in range(6)] + [
    (10 + i, "der hund und die katze liegen auf der matte") for i in range(6)]
LANG = {i: "en" for i in range(6)} | {10 + i: "de" for i in range(6)}


def model(make):
    return language_id.train(make(ROWS, lang=LANG).select("text", "lang"))


def test_predicts_and_marks_edges(make):
    rows = [(1, "the dog and the cat"), (2, "die katze und der hund"), (3, None), (4, ""), (5, "123 %%"), (6, "жук"), (7, "the " * 50_000),
            (1, "the dog and the cat"), (None, "und der")]
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language_id.predict(make(rows), model(make)).collect()]
    found = {i: (p, s) for i, p, s in got}
    assert [found[i][0] for i in (1, 2, 3, 4, 5, 7)] == ["en", "de", "und", "und", "und", "en"]
    assert found[3][1] == found[5][1] == 0 and found[6] == ("en" if found[6][0] == "en" else "de", 0.0)
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, _, s in got) and found[None][0] == "de"


def test_no_training_rows_and_empty_table(make):
    empty = language_id.train(make([(1, None), (2, "x")]).select("text", "lang"))
    assert [r["lang_pred"] for r in language_id.predict(make([(1, "abc")]), empty).collect()] == ["und"]
    assert language_id.predict(make([]), model(make)).count() == 0


def test_filter_keeps_columns_and_clean_documents(make):
    docs = make([(1, "the dog and the cat"), (2, None), (3, "???"), (4, "qqqq zzzz xxxx"), (1, "the dog and the cat")])
    kept = language_id.keep_identified(docs, model(make))
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 1]


def test_bloom_hits_are_exact_but_for_false_ones(make):
    m = model(make)
    hashes, _, _ = language_id._grams(["the cat and the dog sat"], m.gram)  # n-grams of the English training text only
    masks = np.full(len(hashes), ~np.uint64(0))
    for at in language_id._slots(hashes, m.n_hashes, len(m.filters)):
        masks &= m.filters[at][:, 0]
    english = np.uint64(1) << np.uint64(m.languages.index("en"))
    assert (masks & english).all()  # a Bloom filter forgets nothing
    assert m.false_rate.max() < 0.05


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language_id.held_out("doc_id", 4, 2)
    m = language_id.train(docs.where(~out).select("text", "lang"))
    pairs = language_id.predict(docs.where(out), m).join(docs, "doc_id").select("lang", "lang_pred").collect()
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.97


def test_held_out_rule(make):
    import zlib

    got = {r[0]: r[1] for r in make([(i, "") for i in range(40)]).select("doc_id", language_id.held_out("doc_id", 4, 2)).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(40)}
