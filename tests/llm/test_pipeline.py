import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_line_join import brute as brute_lines
from tidemark.llm import secret_scan


@pytest.fixture()
def folder(make, tmp_path):
    english = "the quick brown fox number {} jumps over the lazy dog and runs {} miles through the quiet green forest near town {}"
    german = "der schnelle braune fuchs nummer {} springt über den faulen hund und läuft {} meilen durch den stillen wald bei {}"
    rows = [(i, english.format(f"alpha{i}", f"beta{i * 3}", f"gamma{i * 7}") + f"\nonly{i} line{i} of{i} its{i} own{i}") for i in range(12)]
    rows += [(20 + i, german.format(f"eins{i}", f"zwei{i}", f"drei{i}")) for i in range(12)]
    rows += [(40, rows[3][1]), (41, None), (42, "%%% 123"), (43, "the secret is token = abcdef123456 and more words to the end of it")]
    lang = {i: "en" for i in range(12)} | {20 + i: "de" for i in range(12)}
    make(rows, lang=lang).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path), rows


def test_stages(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "secret_scan", "packing"]
    texts = lambda df: sorted((r["doc_id"], r["text"]) for r in df.collect())
    columns = docs.columns
    stage = dict(corpus_pipeline.STAGES)
    known = stage["language_id"](spark, docs, path)
    assert known.columns == columns and [i for i, _ in texts(known)] == [i for i, _ in rows if i not in (41, 42)]
    lines = stage["line_dedup"](spark, known, path)
    assert lines.columns == columns and texts(lines) == brute_lines(texts(known))
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())
    near = stage["near_dedup"](spark, known, path)
    assert near.columns == columns and 40 not in [i for i, _ in texts(near)] and len(texts(near)) == len(texts(known)) - 1
    masked = stage["secret_scan"](spark, near, path)
    assert texts(masked) == [(i, secret_scan.masked(t)) for i, t in texts(near)]
    assert "[SECRET:assign]" in dict(texts(masked))[43]


def test_run(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, f in corpus_pipeline.STAGES[:-1]:
        docs = f(spark, docs, path)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted((r["doc_id"], len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1) for r in docs.collect())
    got = corpus_pipeline.run(spark, path).collect()
    assert sorted((r["doc_id"], r["length"]) for r in got) == want


def test_emptied_copies_leave_one_document(spark, make):
    docs = make([(i, "one and the same line of text in many documents") for i in range(5)] + [(9, "another text of quite other words")])
    stage = dict(corpus_pipeline.STAGES)
    left = stage["near_dedup"](spark, stage["line_dedup"](spark, docs, ""), "")
    assert sorted((r["doc_id"], r["text"]) for r in left.collect()) == [(0, docs.first()["text"]), (1, ""), (9, "another text of quite other words")]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_table(spark, make, name):
    out = dict(corpus_pipeline.STAGES)[name](spark, make([]), "")
    assert out.count() == 0
