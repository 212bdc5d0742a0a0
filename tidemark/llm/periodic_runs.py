"""Periodic runs of words, found with a dictionary of basic factors.

For every power of two L the factors of L words get names, so that equal
factors of a document have equal names. Occurrences of a factor between L and
2L words further on propose periods; a run of period p with at least two periods
has such a pair at its first word for the L with L <= p < 2L. Proposals that are
squares are extended with the names of all levels, and several for one stretch
leave the smallest period.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import sliced

#: A run has at least so many words, and at least two periods.
SHORTEST = 12

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class _Level:
    """Names of the factors that start at each word: equal for equal factors, -1 where the factor occurs once or leaves the text."""

    def __init__(self, size: int, at: np.ndarray, names: np.ndarray):
        self.at, self.names = at, names
        self.dense = None
        if 4 * len(at) > size:  # few starts are kept as a sorted list
            self.dense = np.full(size, -1, dtype=np.int32)
            self.dense[at] = names

    def __getitem__(self, places: np.ndarray) -> np.ndarray:
        if self.dense is not None:
            inside = places < len(self.dense)
            return np.where(inside, self.dense[np.where(inside, places, 0)], -1)
        found = np.minimum(np.searchsorted(self.at, places), max(len(self.at) - 1, 0))
        return np.where(self.at[found] == places, self.names[found], -1) if len(self.at) else np.full(len(places), -1)

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = self[a]
        return (x >= 0) & (x == self[b])


def _named(size: int, at: np.ndarray, keys: np.ndarray) -> tuple[_Level, np.ndarray, np.ndarray]:
    """The level whose factors at ``at`` are told apart by ``keys``, with its starts and names in the order of names, then places."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    fresh = np.ones(len(ranked) + 1, dtype=bool)
    fresh[1:-1] = ranked[1:] != ranked[:-1]
    again = ~(fresh[:-1] & fresh[1:])  # the factor occurs more than once
    starts, names = at[order][again], np.cumsum(fresh[:-1])[again].astype(np.int32)
    level = np.argsort(starts, kind="stable")
    return _Level(size, starts[level], names[level]), starts, names


def _pairs(starts: np.ndarray, names: np.ndarray, length: int, size: int, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of equal factors with L <= j - i < 2L whose words before i and j differ, and perhaps some where they do not.

    The occurrences for one i lie less than L apart. From the second on they all
    have the same word before them, as the factor reaches over each gap, so one
    comparison drops them or shows that a run of a shorter period starts at i.
    Over a text such runs have fewer than three periods a word, which bounds the
    pairs that are left.
    """
    near = np.flatnonzero((names[1:] == names[:-1]) & (starts[1:] - starts[:-1] < 2 * length))
    place = names.astype(np.int64) * (size + 1) + starts
    i, base = starts[near], place[near]
    first = np.searchsorted(place, base + length)
    # Beyond the last place of the same name lies the next name.
    bound = np.minimum(base + 2 * length, (names[near].astype(np.int64) + 1) * (size + 1))
    count = np.searchsorted(place, bound) - first
    some = count > 0
    i, first, count = i[some], first[some], count[some]
    many = np.flatnonzero(count > 1)
    later = starts[first[many] + 1]
    count[many[words[i[many] - 1] == words[later - 1]]] = 1
    left = np.repeat(i, count)
    right = starts[np.repeat(first, count) + np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)]
    return left, right


def _found(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the runs, ascending, in numbers of ``words``.

    Texts lie one after the other with a number that occurs nowhere else before,
    between and after them, so no factor that occurs twice reaches over a border.
    """
    size = len(words)
    level, starts, names = _named(size, np.arange(size), words)
    levels, proposed, length = [], [], 1
    while len(starts):
        levels.append(level)
        i, j = _pairs(starts, names, length, size, words)
        p = j - i
        square = (words[i - 1] != words[j - 1]) & level.equal(i + p - length, j + p - length)
        proposed.append((i[square], p[square]))
        both = level[level.at + length]
        on = both >= 0
        keys = level.names[on].astype(np.int64) << 32 | both[on]
        level, starts, names = _named(size, level.at[on], keys)
        length *= 2
    i = np.concatenate([np.zeros(0, dtype=np.int64), *[a for a, _ in proposed]])
    p = np.concatenate([np.zeros(0, dtype=np.int64), *[b for _, b in proposed]])
    reach = np.zeros(len(i), dtype=np.int64)
    for k in reversed(range(len(levels))):  # every power of two is part of the common length at most once
        reach += levels[k].equal(i + reach, i + p + reach).astype(np.int64) << k
    end = i + p + reach
    long = end - i >= np.maximum(SHORTEST, 2 * p)
    i, end, p = i[long], end[long], p[long]
    order = np.lexsort((p, end, i))
    i, end, p = i[order], end[order], p[order]
    own = np.ones(len(i), dtype=bool)
    own[1:] = (i[1:] != i[:-1]) | (end[1:] != end[:-1])
    i, end, p = i[own], end[own], p[own]
    order = np.lexsort((p, i))
    return i[order], end[order], p[order]


def _split(text: str | None) -> list[bytes]:
    """The words: what lies between spaces and the ASCII controls 9 to 13."""
    return (text or "").encode().split()


def text_runs(texts: list[list[bytes]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each list of words its runs: starts, lengths and periods, ascending by start, then period."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    flat = pa.array([w for t in texts for w in t], pa.binary()).dictionary_encode()
    number = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # One border before every text and one after the last; names differ between texts, so copies of a text do not meet.
    at = np.cumsum(lengths + 1) - lengths
    owner = np.repeat(np.arange(len(texts)), lengths)
    words = -1 - np.arange(int(lengths.sum()) + len(texts) + 1, dtype=np.int64)
    place = np.arange(len(number)) + owner + 1
    words[place] = owner * (len(flat.dictionary) + 1) + number
    start, end, period = _found(words)
    cuts = np.searchsorted(start, np.append(at, len(words)))
    return [
        (start[a:b] - base, (end - start)[a:b], period[a:b]) for base, a, b in zip(at, cuts[:-1], cuts[1:])
    ]


def kept_words(n: int, runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Which of n words stay when every run keeps only its first period."""
    start, length, period = runs
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:n]) == 0


def find_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with ``runs``, an array of (start, length, period) by start, then period, and ``collapsed``.

    A run is a stretch of consecutive words with smallest period q, at least 12
    words and 2q long, that cannot be longer; starts count words from 0.
    ``collapsed`` is the text without the words that any run holds after its first
    q, joined by single spaces. Null and empty texts and those without words have
    no runs and collapse to the empty text. Documents are handled by themselves,
    so repeated rows and hot keys need nothing; a task holds a few megabytes of
    text at a time, of a longer text all. Columns of these two names are
    replaced, all others are kept.
    """
    names = [c for c in docs.columns if c not in ("runs", "collapsed")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            texts = [_split(t) for t in batch.column(1).to_pylist()]
            found = text_runs(texts)
            offsets = np.concatenate([[0], np.cumsum([len(r[0]) for r in found])]).astype(np.int32)
            parts = [pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *[r[k] for r in found]])) for k in range(3)]
            collapsed = []
            for words, run in zip(texts, found):
                if len(run[0]):
                    words = [words[w] for w in np.flatnonzero(kept_words(len(words), run))]
                collapsed.append(b" ".join(words).decode())
            yield pa.record_batch({
                "row": batch.column(0), "runs": pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(parts, fields=list(_RUN))),
                "collapsed": pa.array(collapsed),
            })

    picked = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(text_col).cast("string").alias("text"))
    out = T.StructType([picked.schema["row"]]).add("runs", T._parse_datatype_string(RUNS)).add("collapsed", T.StringType())
    found = picked.mapInArrow(rows, out)
    return found.select(*[F.col("row")[c].alias(c) for c in names], "runs", "collapsed")


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text): one text in ten, told by the checksum of the id, ends in a periodic stretch of its own words.

    Words of all texts are joined by single spaces. A null id plants nothing.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            texts = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = _split(text)
                h = zlib.crc32(str(key).encode())
                n, g = len(words), h // 10
                if key is not None and h % 10 == 0 and n:
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    words = words[:a] + [words[a + i % p] for i in range(n - a)]
                texts.append(b" ".join(words).decode())
            yield pa.record_batch({id_col: batch.column(0), "text": pa.array(texts, pa.string())})

    picked = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return picked.mapInArrow(rows, f"`{id_col}` {id_type}, text string")
