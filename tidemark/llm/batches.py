"""Texts of an Arrow batch as flat numpy arrays: whole-batch work without a Python loop per character."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that part words: space and the ASCII controls 9 to 13.
WORD_BREAKS = (32, 9, 10, 11, 12, 13)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers that spreads every input bit (finaliser of splitmix64)."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text; one text alone may be longer."""
    for batch in batches:
        sizes = np.asarray(
            pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ).astype(np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and the n + 1 offsets; a null text is empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(flat: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, and the n + 1 word offsets of the texts.

    Words are what lies between white space (ASCII); ``lower`` makes A-Z small
    first. The hash is a polynomial of the bytes, taken from prefix sums.
    """
    n = len(offsets) - 1
    if not len(flat):
        return np.zeros(0, dtype=np.uint64), np.zeros(n + 1, dtype=np.int64)
    gap = np.zeros(len(flat), dtype=bool)
    for code in WORD_BREAKS:
        gap |= flat == code
    first = ~gap
    first[1:] &= gap[:-1]
    text_starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[text_starts] = ~gap[text_starts]
    starts = np.flatnonzero(first)
    last = ~gap
    last[:-1] &= gap[1:]
    text_ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[text_ends] = ~gap[text_ends]
    ends = np.flatnonzero(last) + 1
    values = flat.astype(np.uint64)
    if lower:
        values += np.uint64(32) * ((flat >= 65) & (flat <= 90))
    lengths = ends - starts
    values += np.uint64(1)
    hashes = np.zeros(len(starts), dtype=np.uint64)
    powers = np.cumprod(np.full(min(len(flat), 1 << 16), _BASE, dtype=np.uint64))
    # Prefix sums modulo 2^64, restarted every 65536 bytes so that few powers are kept; longer words span blocks.
    size = len(powers)
    if len(starts):
        local = values * powers[np.arange(len(flat)) % size]
        sums = np.zeros(len(flat) + 1, dtype=np.uint64)
        np.cumsum(local, out=sums[1:])
        inside = starts // size == (ends - 1) // size
        inverse = np.cumprod(np.full(size, _INVERSE, dtype=np.uint64))
        s, e = starts[inside], ends[inside]
        hashes[inside] = (sums[e] - sums[s]) * inverse[s % size]
        for i in np.flatnonzero(~inside):  # a word across a block border: its bytes alone
            part = values[starts[i] : ends[i]]
            own = powers if len(part) <= size else np.cumprod(np.full(len(part), _BASE, dtype=np.uint64))
            hashes[i] = int((part * own[: len(part)]).sum()) * int(_INVERSE) % 2**64
    hashes = mix(hashes ^ (lengths.astype(np.uint64) << np.uint64(1)))
    return hashes, np.searchsorted(starts, offsets).astype(np.int64)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """A hash for every run of ``size`` words of a text, and the n + 1 shingle offsets.

    A text of fewer words, but at least one, has one shingle: all its words.
    """
    n_words = np.diff(offsets)
    counts = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    out_offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    total = int(out_offsets[-1])
    text = np.repeat(np.arange(len(n_words)), counts)
    at = np.arange(total) - out_offsets[text] + offsets[text]
    hashes = np.zeros(total, dtype=np.uint64)
    padded = np.concatenate([words, np.zeros(size, dtype=np.uint64)])
    left = offsets[text + 1] - at if total else at
    for i in range(size):
        hashes = hashes * _STEP + np.where(left > i, padded[at + i], np.uint64(1))
    return mix(hashes, 5), out_offsets
