import public_tokenizers
import pytest

from tidemark.llm import lattice

ROWS = [(1, "Hello  wörld\nx\ty 你好 ﬁ, isn't it? (a.b)  "), (2, None), (3, ""), (4, " "), (4, "a" * 700 + " b"), (5, "a\x00b \r\n é\U0001f600|x"),
        (6, "the the"), (6, "the the"), (None, "▁ word"), (7, "long words here " * 500)]


@pytest.fixture(scope="module")
def vocabulary():
    return lattice.load(public_tokenizers.path("piece_bpe_32k.model"))


def test_round_trip(make, vocabulary):
    docs = make(ROWS)
    got = lattice.decode(lattice.encode(docs, vocabulary), vocabulary).collect()
    texts = sorted((str(r["doc_id"]), r["text"]) for r in got)
    # A null comes back empty, a mark for a space as a space.
    assert texts == sorted((str(i), (t or "").replace("▁", " ")) for i, t in ROWS)
    assert lattice.encode(make([]), vocabulary).count() == 0


def test_round_trip_of_the_test_data(spark, vocabulary):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    back = lattice.decode(lattice.encode(docs, vocabulary), vocabulary).select("doc_id", "text")
    assert back.exceptAll(docs.select("doc_id", "text")).count() == 0 and back.count() == docs.count()


def best(word, table, vocabulary):
    top = [(0.0, [])] + [None] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - vocabulary.longest), end):
            found = table.get(word[start:end])
            if found is None and end - start == 1:
                found = ([vocabulary.first_byte + b for b in word[start:end].encode()], vocabulary.unknown_weight)
            if found and (top[end] is None or top[start][0] + found[1] > top[end][0] + 1e-12):
                top[end] = (top[start][0] + found[1], top[start][1] + found[0])
    return top[-1]


def test_paths_are_the_best_ones(spark, vocabulary):
    words = ["▁hello", "▁▁▁x", "thinor", "▁unbelievable", "é你好", "▁", "▁wörldwide", "ﬁx"]
    table = {p: ([i], w) for p, i, w in vocabulary.pieces}
    weight = {i: w for _, i, w in vocabulary.pieces}
    got = lattice.word_pieces(spark.createDataFrame([(w,) for w in words], "word string"), vocabulary).collect()
    assert len(got) == len(words)
    for r in got:
        bytes_in = [i for i in r["ids"] if i not in weight]
        chars = len(bytes(i - vocabulary.first_byte for i in bytes_in).decode()) if bytes_in else 0
        total = sum(weight.get(i, 0) for i in r["ids"]) + chars * vocabulary.unknown_weight
        assert abs(total - best(r["word"], table, vocabulary)[0]) < 1e-9


def test_words_cut_only_where_no_piece_reaches_across(spark, vocabulary):
    import regex as re

    pieces = [p for p, _, _ in vocabulary.pieces]
    text = "▁it's▁(a.b),▁end..▁naïve!x"
    words = re.findall(vocabulary.pattern, text)
    assert "".join(words) == text
    for a, b in zip(words, words[1:]):
        assert not any(a[-1] + b[0] in p for p in pieces if b[0] != "▁")


def test_long_words_are_not_cut(make, vocabulary):
    table = {p: ([i], w) for p, i, w in vocabulary.pieces}
    texts = ["internationalization" * 50, "你好世界" * 250, "x\U0001f600international" * 70, "a" * 1000]
    got = {r["doc_id"]: r["ids"] for r in lattice.encode(make(list(enumerate(texts))), vocabulary).collect()}
    weights = {i: w for _, i, w in vocabulary.pieces}
    for i, text in enumerate(texts):
        word = lattice.SPACE + text
        total, _ = best(word, table, vocabulary)
        known = sum(weights[x] for x in got[i] if x in weights)
        unknown = sum(1 for c in word if c not in table)
        assert abs(known + unknown * vocabulary.unknown_weight - total) < 1e-6
    # The relational lattice and the loop find the same paths.
    words = make([]).sparkSession.createDataFrame([(lattice.SPACE + t[:k],) for t in texts for k in (7, 100, 255)], "word string")
    short = {r["word"]: r["ids"] for r in lattice.word_pieces(words, vocabulary).collect()}
    long = {r["word"]: r["ids"] for r in lattice._long_word_pieces(words, vocabulary).collect()}
    assert short == long and len(short) == 12


def test_words_travel_once_per_slice(make, vocabulary, capsys):
    rows = ROWS + [(i, f"word{i % 5} other{i} été x\ny" * (i % 7)) for i in range(100, 160)]
    docs = make(rows)
    got = lattice.encode(docs, vocabulary)
    got.explain()
    plan = capsys.readouterr().out
    # No row per word of a text and no edges grouped as rows: both took more disk than the budget.
    assert "Generate" not in plan and "ObjectHashAggregate" not in plan
    small = lattice.encode(docs, vocabulary, slice_words=7, bucket_bytes=200)
    assert got.columns == ["doc_id", "ids"]
    found = sorted((str(r["doc_id"]), r["ids"]) for r in got.collect())
    assert len(found) == len(rows) and found == sorted((str(r["doc_id"]), r["ids"]) for r in small.collect())
    table = {p: ([i], w) for p, i, w in vocabulary.pieces}
    assert dict(found)["106"] == [i for w in ["▁word1", "▁other106", "▁été", "▁x", "\n", "y"] for i in best(w, table, vocabulary)[1]]
