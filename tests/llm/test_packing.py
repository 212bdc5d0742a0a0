import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["İstanbul’s don't  ΣΑΣ ſ ŉ x²½ naïve áb \x1ca 你好 <|endoftext|>x it'Ll we've that's\u0085é", "", "  ", "ẞ ÀÉ×÷ª º µ 'S 's's' 123,4.5!!", " a　b"]


@pytest.mark.parametrize("text", ODD)
def test_ids_are_those_of_the_tokenizer(text):
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.ChunkEncoder(PATH).encode(text), "<u4").tolist() == want


def test_pieces_and_places(make):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(20, None), (21, "word " * 5000), (21, "word " * 5000), (None, "x")] + [
        (100 + i, "some words here " * (i * 7 % 90)) for i in range(60)]
    got = packing.pack_documents(make(rows).select("doc_id", "text"), PATH, size=256).collect()
    tokenizer = Tokenizer.from_file(PATH)
    want = defaultdict(int)
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 256):
            part = ids[k : k + 256]
            want[i, k // 256, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    have = defaultdict(int)
    for r in got:
        have[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
    assert have == want
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spots in places.values():
        end = 0
        for offset, length in sorted(spots):
            assert offset == end
            end += length
        assert end <= 256
    total = sum(k[3] * n for k, n in want.items())
    assert len(places) <= 1.06 * -(-total // 256) + 1
    assert packing.pack_documents(make([]).select("doc_id", "text"), PATH).count() == 0


def test_rule_takes_the_smallest_sum_of_squares():
    rng = np.random.default_rng(3)
    size, lengths = 20, rng.integers(1, 21, 60)
    sequence, offset = packing.sum_of_squares(lengths, size)
    fill = defaultdict(int)
    squares = lambda f: sum(n * n for g, n in zip(*np.unique([size - x for x in f.values()], return_counts=True)) if g)
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        choices = [squares({**fill, b: f + s}) for b, f in fill.items() if f + s <= size] + [squares({**fill, -1: s})]
        assert offset[i] == fill[sequence[i]]
        fill[sequence[i]] += s
        assert squares(fill) == min(choices)


def test_groups_are_packed_again_together(make, spark):
    pieces = spark.createDataFrame([(i, 3 + i % 5, i * 7919) for i in range(300)], "doc_id long, length long, deal long")
    got = packing.pack(pieces, size=16, group=40).collect()
    fill = defaultdict(int)
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert fill[r["sequence_id"]] == r["offset"]
        fill[r["sequence_id"]] += r["length"]
    assert len(got) == 300 and max(fill.values()) <= 16 and len(fill) <= 1.08 * sum(fill.values()) / 16
