"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A sketch of a text takes the few occurrence-labelled word shingles that are
smallest under one hash function and keeps them in text order; texts that agree
in a sketch share the same shingles in the same order. Candidates are verified by
aligning their shingle sequences. The candidates of a sketch are compared with
the smallest document of its bucket first, which settles large groups of copies
in linear work; whatever that leaves open is compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import mix, shingle_hashes, sliced, text_bytes, word_hashes
from tidemark.llm.components import components
from tidemark.session import settled

_NONE = np.uint64(2**64 - 1)
PARITY_BITS = 2048


def labelled(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hashes told apart by how often the same shingle has come before in the text."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    key = mix(hashes + mix(text.astype(np.uint64), 3))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    at = np.arange(len(key))
    nth = np.zeros(len(key), dtype=np.uint64)
    nth[order] = (at - np.maximum.accumulate(np.where(fresh, at, 0))).astype(np.uint64)
    return mix(hashes + nth * np.uint64(0xA24BAED4963EE407), 7)


def sketches(labels: np.ndarray, offsets: np.ndarray, count: int, take: int) -> np.ndarray:
    """``count`` sketch keys of every text from its labelled shingles; texts without shingles have zeros."""
    n = len(offsets) - 1
    out = np.zeros((n, count), dtype=np.uint64)
    filled = np.flatnonzero(offsets[1:] > offsets[:-1])
    if not len(filled):
        return out
    starts = offsets[filled]
    sizes = np.diff(np.append(starts, offsets[-1]))
    for f in range(count):
        ranks = labels * np.uint64((0x9FB21C651E98DF25 + 0x2545F4914F6CDD1E * f) % 2**64 | 1)  # odd, so distinct stay distinct
        ranks ^= ranks >> np.uint64(32)
        ranks[ranks == _NONE] -= np.uint64(1)
        places = np.full((len(filled), take), len(labels), dtype=np.int64)
        for t in range(min(take, int(sizes.max()))):
            least = np.minimum.reduceat(ranks, starts)
            at = np.flatnonzero((ranks == np.repeat(least, sizes)) & (ranks != _NONE))
            owner = np.searchsorted(starts, at, side="right") - 1
            owner, first = np.unique(owner, return_index=True)
            places[owner, t] = at[first]
            ranks[at[first]] = _NONE
        places.sort(axis=1)
        padded = np.append(labels, np.uint64(f))
        key = np.full(len(filled), f + 1, dtype=np.uint64)
        for t in range(take):
            key = mix(key * np.uint64(0xC2B2AE3D27D4EB4F) + padded[places[:, t]], 11)
        out[filled, f] = key
    return out


def aligned(a: np.ndarray, b: np.ndarray, most: int) -> bool:
    """Whether at most ``most`` items must be put in, taken out or replaced to turn one sequence into the other.

    A column of the alignment is one integer whose bits are the 2 * most + 1
    diagonals of the band, so a step costs a few operations on such integers.
    """
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[::-1][:short] != b[::-1][:short])
    tail = int(differ[0]) if len(differ) else short
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if len(a) < len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if m <= most:
        return True
    if m - n > most:
        return False
    at: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        at[w] = at.get(w, 0) | 1 << i
    ones = (1 << (2 * most + 1)) - 1
    corner = 1 << (2 * most)
    up, down, distance = ones ^ ((1 << most) - 1), 0, most
    for j, w in enumerate(b.tolist()):
        same = at.get(w, 0)
        same = (same >> (j - most) if j >= most else same << (most - j)) & ones
        zero = ((((same & up) + up) ^ up) | same | down) & ones
        right = down | (ones ^ (ones & (zero | up)))
        left = zero & up
        if j < m - most:
            distance += not zero & corner
            if distance > 2 * most + n - m:
                return False
        else:
            row = 1 << (m - 1 - j + most)
            distance += bool(right & row) - bool(left & row)
        shifted = zero >> 1
        up = left | (ones ^ (ones & (shifted | right)))
        down = shifted & right
    return distance <= most


def parities(labels: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every text, which of PARITY_BITS classes of labelled shingles it holds an odd number of, as 64-bit numbers.

    Texts of m and n shingles that differ in c classes have at least
    (c + |m - n|) / 2 shingles to put in, take out or replace.
    """
    n = len(offsets) - 1
    text = np.repeat(np.arange(n), np.diff(offsets))
    place = text * PARITY_BITS + (labels >> np.uint64(20)).astype(np.int64) % PARITY_BITS
    odd = (np.bincount(place, minlength=n * PARITY_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(n, PARITY_BITS // 64)


def document_sketches(
    docs: DataFrame, shingle: int = 5, count: int = 24, take: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, words, same_a, same_b, keys, odd): two hashes of the whole text's words, its sketch keys and parities."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 1_000_000):
            words, at = word_hashes(*text_bytes(batch.column(1)))
            hashes, offsets = shingle_hashes(words, at, shingle)
            labels = labelled(hashes, offsets)
            place = (np.arange(len(words)) - np.repeat(at[:-1], np.diff(at))).astype(np.uint64)
            sums = np.zeros((2, len(words) + 1), dtype=np.uint64)
            for k in range(2):
                np.cumsum(mix(words + mix(place, 21 + k), 23 + k), out=sums[k, 1:])
            whole = sums[:, at[1:]] - sums[:, at[:-1]]
            keys = sketches(labels, offsets, count, take)
            lists = [
                pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.int64()))
                for x in (keys.view(np.int64), parities(labels, offsets))
            ]
            yield pa.record_batch({
                "id": batch.column(0), "words": np.diff(at), "same_a": whole[0].view(np.int64),
                "same_b": whole[1].view(np.int64), "keys": lists[0], "odd": lists[1],
            })

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(sketch, "id long, words long, same_a long, same_b long, keys array<long>, odd array<long>")


def _sequences(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(id, seq): the hashes of a text's shingles in order, 32 bits each, as bytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            hashes, at = shingle_hashes(*word_hashes(*text_bytes(batch.column(1))), shingle)
            short = (hashes >> np.uint64(32)).astype("<u4")
            yield pa.record_batch({
                "id": batch.column(0), "seq": pa.array([short[s:e].tobytes() for s, e in zip(at[:-1], at[1:])], pa.binary())
            })

    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(rows, "id long, seq binary")


def _verified(pairs: DataFrame, sequences: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sequences have an edit similarity of at least ``similarity``."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                s, t = np.frombuffer(x.as_buffer(), dtype="<u4"), np.frombuffer(y.as_buffer(), dtype="<u4")
                longest = max(len(s), len(t))
                good.append(longest > 0 and aligned(s, t, int(longest * (1 - similarity) + 1e-9)))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    with_b = pairs.join(sequences.select(F.col("id").alias("b"), F.col("seq").alias("seq_b")), "b")
    with_both = with_b.join(sequences.select(F.col("id").alias("a"), F.col("seq").alias("seq_a")), "a")
    return with_both.select("a", "b", "seq_a", "seq_b").mapInArrow(verify, "a long, b long")


def near_duplicates(
    docs: DataFrame, similarity: float = 0.8, shingle: int = 5, count: int = 24, take: int = 3,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, class_id, kept) for every document id; the class is the smallest id reachable by links, which is kept.

    Two documents are linked if they agree in one of ``count`` sketches (or in
    all words) and at most 1 - ``similarity`` of the longer one's shingles must
    be put in, taken out or replaced. At 0.8 these are texts with about two
    thirds of all their shingles in common, in the same order; the Jaccard
    similarity of 0.8 lies well inside. Words are what lies between ASCII white
    space, A-Z made small. Texts with a Jaccard similarity of J agree in a sketch
    with a chance near J^take: 0.8 is missed once in 10^7 times, 0.67 once in
    5 000.

    A null or empty text is in a class of its own. Rows that repeat an id are one
    document with one result row, linked if any of its texts is. Ids are
    integers; rows with a null id give one row with a null class that is kept.
    """
    all_ids = docs.select(F.col(id_col).cast("long").alias("id"))
    one_each = document_sketches(docs, shingle, count, take, id_col, text_col)
    signed = settled(one_each.where("id IS NOT NULL AND words > 0"))
    groups = signed.groupBy("same_a", "same_b", "words").agg(F.min("id").alias("rep"))
    grouped = settled(signed.join(groups, ["same_a", "same_b", "words"]).select("id", "rep", "words", "odd", "keys"))
    member = grouped.where("id != rep").select("id", "rep")
    rows = grouped.where("id = rep").select("id", F.explode("keys").alias("key")).distinct()
    buckets = rows.groupBy("key").agg(F.min("id").alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = settled(rows.join(buckets, "key").where("id != pivot").select("key", "pivot", "id"))
    sequences = _sequences(docs, shingle, id_col, text_col)
    first = shared.select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    links = settled(_verified(first, sequences, similarity))
    # Members of a bucket that differ from its smallest document are compared with the other members, unless a common
    # pivot links them already, or length or parities rule the pair out.
    failed = shared.join(
        links.select(F.col("a").alias("pivot"), F.col("b").alias("id")), ["pivot", "id"], "left_anti"
    ).select("key", "id")
    label = links.groupBy("b").agg(F.min("a").alias("label")).withColumnRenamed("b", "id")
    length = F.greatest(F.col("words") - (shingle - 1), F.lit(1)).alias("n")
    traits = grouped.where("id = rep").select("id", length, "odd", "keys").join(label, "id", "left")
    open_keys = failed.select("key").distinct()
    x = failed.join(traits, "id").alias("x")
    y = shared.join(open_keys, "key", "left_semi").select("key", "id").join(traits, "id").alias("y")
    most = f"floor({1 - similarity} * greatest(x.n, y.n) + 1e-9)"
    differ = " + ".join(f"bit_count(x.odd[{i}] ^ y.odd[{i}])" for i in range(PARITY_BITS // 64))
    rest = (
        x.join(y, F.col("x.key") == F.col("y.key"))
        .where(f"x.id != y.id AND abs(x.n - y.n) <= {most} AND {differ} + abs(x.n - y.n) <= 2 * {most}")
        .where("coalesce(x.label, x.id) != coalesce(y.label, y.id)")
        .where("x.key = array_min(array_intersect(x.keys, y.keys))")  # once, however many keys they share
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    )
    more = _verified(rest, sequences, similarity)
    whole = components(
        links.unionAll(more).unionAll(member.select(F.col("rep").alias("a"), F.col("id").alias("b")))
    )
    joined = all_ids.distinct().join(whole, "id", "left")
    class_id = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias(id_col), class_id.alias("class_id"), F.coalesce(F.col("id") == class_id, F.lit(True)).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, but those of documents in the class of a smaller id."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    gone = found.where(~F.col("kept")).select(F.col(id_col).alias("__gone"))
    return docs.join(gone, F.col(id_col).cast("long") == F.col("__gone"), "left_anti")


def drop_wordless_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns; of the texts without a word only those with the smallest id stay.

    For stages after one that empties texts. Null texts and rows with a null id stay.
    """
    number, wordless = F.col(id_col).cast("long"), ~F.col(text_col).rlike(r"[^\x20\x09-\x0D]")
    least = docs.where(wordless).agg(F.min(number)).first()[0]
    return docs if least is None else docs.where(F.coalesce(~(wordless & (number > least)), F.lit(True)))
