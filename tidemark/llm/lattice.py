"""SentencePiece encoding and decoding by a lattice of pieces over the distinct words.

Slices of documents send their distinct words to buckets. A bucket segments every
word once: its substrings are joined with the table of pieces, the matches are the
edges of the word's lattice, and a Viterbi fold over the edges, grouped by where
they end, finds the best path; words of more than 256 characters get theirs from a
plain loop. The pieces go back to the slices, which join them with their documents.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import sliced, text_bytes
from tidemark.llm.ppm import Table

#: What a piece table writes for a space.
SPACE = "▁"
#: Longer words get their path from a loop over their characters: the fold takes as many steps as the longest word has.
LONGEST_WORD = 256
#: Words whose distinct ones are sent together, text per bucket, and characters whose lattice is held at once.
SLICE_WORDS, BUCKET_BYTES, LATTICE_CHARS = 4_000_000, 32_000_000, 100_000


class Vocabulary(NamedTuple):
    """Pieces with id and weight (log), first byte piece, bounds, and the boundaries no piece spans."""

    pieces: list[tuple[str, int, float]]
    texts: list[str]
    first_byte: int
    unknown: int
    longest: int
    unknown_weight: float
    pattern: str


def load(path: str) -> Vocabulary:
    """The vocabulary of a SentencePiece model file with byte fallback.

    Unigram models bring log probabilities. The scores of a BPE model are only
    ranks; a Zipf-Mandelbrot law turns rank r of v into the probability
    proportional to 1 / (r + v / 100), flat among the first pieces, which keeps
    words in few pieces. What follows assumes that text is not normalised but
    for one space put in front.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    scores = {i: model.get_score(i) for i in plain}
    ranks = all(s <= 0 and s == int(s) for s in scores.values())
    shift, total = len(plain) / 100, math.log(101)
    weight = (lambda s: -math.log((shift - s) * total)) if ranks else (lambda s: s)
    pieces = [(model.id_to_piece(i), i, weight(scores[i])) for i in plain]
    first_byte = next(i for i in ids if model.is_byte(i))
    # Letters end before these marks in every text if no piece holds a letter and then one of them.
    marks = "".join(c for c in ".,;:!?%$#*&|\"')(]" if not any(re.search(r"[^\W\d_]" + re.escape(c), p) for p, _, _ in pieces))
    safe = "".join("\\" + c for c in marks)
    free = [c for c in "\n\t\r" if not any(c in p for p, _, _ in pieces)]
    breaks = "".join({"\n": "\\n", "\t": "\\t", "\r": "\\r"}[c] for c in free)
    # A mark starts a word only after a letter; after anything else it goes on with the word.
    inside = rf"[^{SPACE}{breaks}{safe}]|(?<!\p{{L}})[{safe}]" if safe else rf"[^{SPACE}{breaks}]"
    word = rf"{SPACE}*[^{SPACE}{breaks}](?:{inside})*"
    pattern = rf"{word}|{SPACE}+" + (f"|[{breaks}]" if breaks else "")
    return Vocabulary(
        pieces, [model.id_to_piece(i) for i in ids], first_byte, model.unk_id(), max(len(p) for p, _, _ in pieces),
        min(w for _, _, w in pieces) - 10, pattern,
    )


def _prepared(text: str) -> Column:
    spaced = F.concat(F.lit(SPACE), F.replace(text, F.lit(" "), F.lit(SPACE)))
    return F.when(F.length(text) > 0, spaced).otherwise(F.lit(""))


def words_of(text: str, vocabulary: Vocabulary) -> Column:
    """The words of a text in order; together they are the prepared text. Empty for a null or empty text."""
    found = F.regexp_extract_all(_prepared(text), F.lit(vocabulary.pattern), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


class Pieces(NamedTuple):
    """The piece table as a trie: ``steps`` finds the node that a node and a character lead to, less one; nodes have pieces or -1."""

    steps: Table
    ids: np.ndarray
    weights: np.ndarray
    by_text: dict[str, tuple[float, int]]
    vocabulary: Vocabulary


def _pieces(vocabulary: Vocabulary) -> Pieces:
    steps: dict[int, int] = {}
    ends = []
    for piece, _, _ in vocabulary.pieces:
        node = 0
        for c in piece:
            node = steps.setdefault(node << 21 | ord(c), len(steps) + 1)
        ends.append(node)
    ids, weights = np.full(len(steps) + 1, -1, dtype=np.int32), np.full(len(steps) + 1, -np.inf)
    ids[ends], weights[ends] = [i for _, i, _ in vocabulary.pieces], [w for _, _, w in vocabulary.pieces]
    table = Table.of(np.fromiter(steps, dtype=np.uint64, count=len(steps)))
    return Pieces(table, ids, weights, {p: (w, i) for p, i, w in vocabulary.pieces}, vocabulary)


def _long_path(word: str, pieces: Pieces) -> list[int]:
    """The ids of one word, with work linear in its length."""
    longest, first_byte, unknown_weight = pieces.vocabulary.longest, pieces.vocabulary.first_byte, pieces.vocabulary.unknown_weight
    weights, starts = [0.0], [-1]
    for end in range(1, len(word) + 1):
        top = None
        for start in range(max(0, end - longest), end):
            found = pieces.by_text.get(word[start:end])
            if found is None and start < end - 1:
                continue
            edge = (weights[start] + (unknown_weight if found is None else found[0]), start)
            top = edge if top is None or edge > top else top
        weights.append(top[0])
        starts.append(top[1])
    parts, end = [], len(word)
    while end:
        piece = word[starts[end] : end]
        found = pieces.by_text.get(piece)
        parts.append([first_byte + b for b in piece.encode()] if found is None else [found[1]])
        end = starts[end]
    return [i for part in reversed(parts) for i in part]


def _lattice(chars: np.ndarray, lengths: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """The ids of words, longest first, and how many each has; ``chars`` has all their characters.

    A word has one more state than characters; edges lie with the state they end at, by their length.
    """
    n, longest = len(lengths), int(min(pieces.vocabulary.longest, lengths[0]))
    owner = np.repeat(np.arange(n), lengths)
    begins = np.cumsum(lengths + 1) - lengths - 1
    room = np.repeat(np.cumsum(lengths), lengths)
    weight = np.full((len(chars) + n, longest), -np.inf)
    ids = np.full((len(chars) + n, longest), -1, dtype=np.int32)
    weight[np.arange(len(chars)) + owner + 1, 0] = pieces.vocabulary.unknown_weight  # of a character that is no piece
    at, node = np.arange(len(chars)), np.zeros(len(chars), dtype=np.int64)
    for k in range(longest):  # the substrings from every character, as far as a piece goes on with them
        inside = at + k < room[at]
        at, node = at[inside], node[inside]
        node = pieces.steps.find(node.astype(np.uint64) << np.uint64(21) | chars[at + k]).astype(np.int64) + 1
        at, node = at[node > 0], node[node > 0]
        known = pieces.ids[node] >= 0
        end = at[known] + owner[at[known]] + k + 1
        weight[end, k], ids[end, k] = pieces.weights[node[known]], pieces.ids[node[known]]
    best, cut = np.zeros(len(chars) + n), np.zeros(len(chars) + n, dtype=np.int64)
    back = np.arange(1, longest + 1)
    for end in range(1, int(lengths[0]) + 1):
        states = begins[: np.searchsorted(-lengths, -end, side="right")] + end
        sums = best[states[:, None] - back] + weight[states]  # no edge reaches into another word
        cut[states] = sums.argmax(axis=1)  # the first of equal ones, that of the latest start
        best[states] = sums[np.arange(len(states)), cut[states]]
    on_path = np.zeros(len(cut), dtype=bool)
    states, first = begins + lengths, begins
    while len(states):
        on_path[states] = True
        states = states - cut[states] - 1
        states, first = states[states > first], first[states > first]
    states = np.flatnonzero(on_path)
    found, word = ids[states, cut[states]], np.repeat(np.arange(n), lengths + 1)[states]
    unknown = chars[(states - word - 1)[found < 0]]
    counts = np.ones(len(found), dtype=np.int64)
    counts[found < 0] = 1 + (unknown >= 0x80) + (unknown >= 0x800) + (unknown >= 0x10000)
    out = np.repeat(found, counts)
    out[out < 0] = pieces.vocabulary.first_byte + np.frombuffer("".join(map(chr, unknown.tolist())).encode(), dtype=np.uint8).astype(np.int32)
    return out, np.bincount(word, weights=counts, minlength=n).astype(np.int64)


def _paths(words: pa.Array, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, none of them empty, one after the other, and how many each has."""
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(-lengths, kind="stable")
    words, lengths = words.take(pa.array(order)), lengths[order]
    done = int(np.searchsorted(-lengths, -LONGEST_WORD, side="left"))
    long = [_long_path(w, pieces) for w in words.slice(0, done).to_pylist()]
    ids = [np.array([i for w in long for i in w], dtype=np.int32)]
    counts = [np.array([len(w) for w in long], dtype=np.int64)]
    ends = np.cumsum(lengths)
    while done < len(words):
        stop = max(done + 1, int(np.searchsorted(ends, ends[done] - lengths[done] + LATTICE_CHARS, side="right")))
        text = text_bytes(words.slice(done, stop - done))[0].tobytes().decode()
        out, n = _lattice(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64), lengths[done:stop], pieces)
        ids.append(out)
        counts.append(n)
        done = stop
    counts, back = np.concatenate(counts), np.empty(len(order), dtype=np.int64)
    back[order] = np.arange(len(order))
    return _picked(np.concatenate(ids), counts, back), counts[back]


def _picked(values: np.ndarray, counts: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The values of the groups at ``places``, where the groups have ``counts`` values each."""
    n = counts[places]
    starts = (np.cumsum(counts) - counts)[places]
    return values[np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _long_word_pieces(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(word, ids) as ``word_pieces`` has them, one word at a time with work linear in its length."""
    shared = words.sparkSession.sparkContext.broadcast(_pieces(vocabulary))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "word", 1_000_000):
            ids = [_long_path(w, shared.value) for w in batch.column(0).to_pylist()]
            yield pa.record_batch({"word": batch.column(0), "ids": pa.array(ids, pa.list_(pa.int32()))})

    return words.select("word").mapInArrow(fold, "word string, ids array<int>")


def word_pieces(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(word, ids) for a table of distinct words: the path of largest total weight through each word's lattice.

    A character that is no piece is an edge of its UTF-8 byte pieces. Among
    equally good paths the one with the later start of its last piece wins.
    """
    shared = words.sparkSession.sparkContext.broadcast(_pieces(vocabulary))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "word", 1_000_000):
            yield pa.record_batch({"word": batch.column(0), "ids": _lists(*_paths(batch.column(0), shared.value))})

    return words.select("word").where("word != ''").mapInArrow(fold, "word string, ids array<int>")


def _packed(numbers: list[np.ndarray], body: bytes = b"") -> bytes:
    """Arrays of numbers below 2^32, as compressed byte planes, and other bytes after them."""
    planes = [np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for x in numbers]
    head = np.array([len(numbers), *map(len, numbers), len(body)], dtype="<i8").tobytes()
    return head + pa.Codec("zstd", compression_level=9).compress(b"".join([*planes, body]), asbytes=True)


def _unpacked(data: bytes) -> tuple[list[np.ndarray], bytes]:
    n = int(np.frombuffer(data, dtype="<i8", count=1)[0])
    sizes = np.frombuffer(data, dtype="<i8", count=n + 1, offset=8).tolist()
    body = pa.decompress(data[8 * (n + 2) :], 4 * sum(sizes[:-1]) + sizes[-1], "zstd", asbytes=True)
    out, at = [], 0
    for size in sizes[:-1]:
        planes = np.frombuffer(body, dtype=np.uint8, count=4 * size, offset=at).reshape(4, size)
        out.append(np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64))
        at += 4 * size
    return out, body[at:]


def _words_packed(words: pa.Array) -> bytes:
    flat, offsets = text_bytes(words)
    return _packed([np.diff(offsets)], flat.tobytes())


def _words_unpacked(data: bytes) -> pa.Array:
    (lengths,), flat = _unpacked(data)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def _table_packed(column: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.record_batch({"id": column})
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


#: What the rows of the exchanges hold: the documents of a slice, words for a bucket or their pieces.
_DOCS, _WORDS = range(2)
_SENT = "bucket long, slice long, kind int, data binary"


def _rows(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    types = {"bucket": pa.int64(), "slice": pa.int64(), "kind": pa.int32(), "data": pa.binary()}
    return pa.record_batch({c: pa.array(v, t) for (c, t), v in zip(types.items(), zip(*rows), strict=True)})


def _sent(ids: pa.Array, words: pa.Array, number: int, n_buckets: int) -> pa.RecordBatch:
    """A slice of documents with their words by number, and its distinct words as one row per bucket.

    Frequent words have small numbers, which pack well; ``place`` is where the buckets have each.
    """
    met = words.flatten().dictionary_encode()
    distinct, met = met.dictionary, met.indices.to_numpy(zero_copy_only=False)
    frequent = np.argsort(-np.bincount(met, minlength=len(distinct)), kind="stable")
    rank, place = np.empty_like(frequent), np.empty_like(frequent)
    rank[frequent] = np.arange(len(frequent))
    order = pc.sort_indices(distinct).to_numpy()  # neighbours compress each other
    bucket = np.fromiter(map(zlib.crc32, distinct.take(pa.array(order)).cast(pa.binary()).to_pylist()), dtype=np.int64) % n_buckets
    dealt = np.argsort(bucket, kind="stable")
    order, bucket = order[dealt], bucket[dealt]
    place[rank[order]] = np.arange(len(order))
    sizes = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    numbers = [sizes, rank[met], place]
    rows = [((number ^ number >> 32) % n_buckets, number, _DOCS, _packed(numbers, _table_packed(ids)))]
    cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else [], len(bucket)).astype(np.int64).tolist()
    distinct = distinct.take(pa.array(order))
    rows += [(int(bucket[a]), number, _WORDS, _words_packed(distinct.slice(a, b - a))) for a, b in zip(cuts, cuts[1:])]
    return _rows(rows)


def encode(
    docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text",
    slice_words: int = SLICE_WORDS, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """(id, ids) for every row of ``docs``: the piece ids of its whole text.

    A null or empty text has no ids. Repeated rows are encoded each. The distinct
    words of a slice of documents go to buckets by hash, where each word that any
    slice has is segmented once; no task holds more than a slice or a bucket, both of bounded size.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n_buckets = max(8, -(-size // bucket_bytes))
    shared = spark.sparkContext.broadcast(_pieces(vocabulary))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, ids, words = TaskContext.get().partitionId() << 32, 0, [], []
        for batch in batches:
            ends, start = np.cumsum(pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)), 0
            while start < batch.num_rows:
                before = int(ends[start - 1]) if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + slice_words - held, side="right")))
                ids.append(batch.column(0).slice(start, stop - start))
                words.append(batch.column(1).slice(start, stop - start))
                held += int(ends[stop - 1]) - before
                start = stop
                if held >= slice_words or start < batch.num_rows:
                    yield _sent(pa.concat_arrays(ids), pa.concat_arrays(words), number, n_buckets)
                    number, held, ids, words = number + 1, 0, [], []
        if ids:
            yield _sent(pa.concat_arrays(ids), pa.concat_arrays(words), number, n_buckets)

    def segmented(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, slices, asked = None, [], []

        def answers():
            met = pa.chunked_array(asked).combine_chunks().dictionary_encode()
            ids, counts = _paths(met.dictionary, shared.value)
            places, done = met.indices.to_numpy(zero_copy_only=False), 0
            for number, words in zip(slices, asked):
                own = places[done : done + len(words)]
                done += len(words)
                yield _rows([(at, number, _WORDS, _packed([counts[own], _picked(ids, counts, own)]))])

        for batch in batches:
            for bucket, number, kind, data in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == _DOCS:
                    yield _rows([(bucket, number, kind, data)])
                    continue
                if bucket != at and asked:
                    yield from answers()
                    slices, asked = [], []
                at = bucket
                slices.append(number)
                asked.append(_words_unpacked(data))
        if asked:
            yield from answers()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, found = None, None, []

        def out():
            (sizes, places, place), ids = _unpacked(rows)
            counts = np.concatenate([np.zeros(0, dtype=np.int64), *[f[0] for f in found]])
            values = np.concatenate([np.zeros(0, dtype=np.int64), *[f[1] for f in found]])
            places = place[places]
            done = np.concatenate([[0], np.cumsum(counts[places])])[np.concatenate([[0], np.cumsum(sizes)])]
            with pa.ipc.open_stream(ids) as reader:
                column = reader.read_all().column("id").combine_chunks()
            return pa.record_batch({id_col: column, "ids": _lists(_picked(values, counts, places), np.diff(done))})

        for batch in batches:
            for _, number, kind, data in zip(*(c.to_pylist() for c in batch.columns)):
                if number != at:
                    if at is not None:
                        yield out()
                    at, found = number, []
                if kind == _DOCS:
                    rows = data
                else:
                    found.append(_unpacked(data)[0])
        if at is not None:
            yield out()

    rows = docs.select(F.col(id_col).alias("id"), words_of(text_col, vocabulary).alias("words")).mapInArrow(sent, _SENT)
    parts = rows.repartition(n_buckets, "bucket").sortWithinPartitions("bucket", "kind", "slice").mapInArrow(segmented, _SENT)
    result = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return parts.repartition("slice").sortWithinPartitions("slice", "kind", "bucket").mapInArrow(joined, result)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids; null ids give a null text, an id outside the table the unknown mark's text.

    Bytes that are not UTF-8 become replacement characters.
    """
    table = [
        f"{i - vocabulary.first_byte:02X}" if 0 <= i - vocabulary.first_byte < 256 else t.replace(SPACE, " ").encode().hex().upper()
        for i, t in enumerate(vocabulary.texts)
    ]
    pieces = f"split('{','.join(table)}', ',')"
    hexed = f"array_join(transform({ids_col}, i -> coalesce(try_element_at({pieces}, i + 1), '{table[vocabulary.unknown]}')), '')"
    # The first space was put there by the encoder.
    text = F.expr(f"substr(decode(unhex({hexed}), 'UTF-8'), 2)")
    return encoded.withColumn(text_col, F.when(F.size(ids_col) > 0, text).when(F.col(ids_col).isNotNull(), ""))
