"""Scoring documents with prediction by partial matching over bytes, beside a word unigram base score.

The byte-context trie of orders 0 to 6 is counted over all training texts by
Spark. A symbol not seen after a context escapes to the next shorter one, where
all symbols the longer context knows are excluded. Every symbol of a context, also
one seen once, gives up half a count to the escape (method D). The trained model is static and stays in Spark, in buckets that the
symbols of the documents are sent to; a document's score is its log10 probability.
"""

from __future__ import annotations

import hashlib
import tempfile
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import mix, sliced, text_bytes
from tidemark.session import settled

ORDER = 6
#: What a symbol gives up to the escape.
DISCOUNT = 0.5
#: A byte that UTF-8 never has: stands before the first and after the last byte of a text.
EDGE = 0xFF
#: The token after the last word; no word holds a space.
END = b" "
_EMPTY = np.uint64(2**64 - 1)
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32


def _mask(n_bytes: int) -> np.uint64:
    return np.uint64(2 ** (8 * n_bytes) - 1)


class Table(NamedTuple):
    """Open-addressed lookup of unsigned 64-bit keys."""

    keys: np.ndarray
    rows: np.ndarray

    @staticmethod
    def of(keys: np.ndarray) -> Table:
        size = 1 << max(4, int(2 * len(keys)).bit_length())
        slots, rows = np.full(size, _EMPTY), np.full(size, -1, dtype=np.int32)
        todo = np.arange(len(keys))
        at = (mix(keys) & np.uint64(size - 1)).astype(np.int64)
        while len(todo):
            free = slots[at] == _EMPTY
            slots[at[free]] = keys[todo[free]]  # of several for one slot the last stays, the others go on
            won = slots[at] == keys[todo]
            rows[at[won]] = todo[won]
            todo, at = todo[~won], (at[~won] + 1) % size
        return Table(slots, rows)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where there is none."""
        at = (mix(keys) & np.uint64(len(self.keys) - 1)).astype(np.int64)
        there = self.keys[at]
        out = np.where(there == keys, self.rows[at], -1)
        todo = np.flatnonzero((there != keys) & (there != _EMPTY))
        while len(todo):
            at[todo] = (at[todo] + 1) % len(self.keys)
            there = self.keys[at[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = self.rows[at[todo[hit]]]
            todo = todo[~hit & (there != _EMPTY)]
        return out


class Level(NamedTuple):
    """Contexts of one order: their symbols' counts, and log10 weights of escaping and of the whole.

    ``whole`` and ``escape`` hold when the context is the longest known one;
    ``below_whole`` and ``below_escape`` are those of its suffix after escaping
    from it, the context's own symbols excluded.
    """

    pairs: Table
    log_count: np.ndarray
    nodes: Table
    whole: np.ndarray
    escape: np.ndarray
    below_whole: np.ndarray
    below_escape: np.ndarray


class Model(NamedTuple):
    levels: list[Level]
    log_rest: float


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For every symbol, end included, the ORDER bytes before it and itself as one number; symbols per text."""
    flat, offsets = text_bytes(column)
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    # ORDER edges, the text and one edge more for each text; all but the first ORDER are symbols.
    starts = offsets[:-1] + np.arange(n) * (ORDER + 1)
    symbol = np.ones(len(flat) + n * (ORDER + 1), dtype=bool)
    for i in range(ORDER):
        symbol[starts + i] = False
    inside = symbol.copy()
    inside[starts + ORDER + lengths] = False
    wide = np.full(len(symbol), EDGE, dtype=np.uint8)
    wide[inside] = _SMALL[flat]
    # Two, four, then seven bytes as one number.
    two = wide[:-1].astype(np.uint16) << np.uint16(8) | wide[1:]
    four = two[:-2].astype(np.uint32) << np.uint32(16) | two[2:]
    code = four[:-3].astype(np.uint64) << np.uint64(24) | four[3:] & np.uint32(0xFFFFFF)
    return code[symbol[ORDER:]], lengths + 1


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys; numpy's own unique hashes, which takes many times longer than this sort."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])[: len(keys)]]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes with the sum of their counts."""
    if not parts:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    keys = np.concatenate([p[0] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], np.concatenate([p[1] for p in parts])[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return (keys[first], np.add.reduceat(n, first)) if len(keys) else (keys, n)


def _task_counts(batches: Iterator[pa.RecordBatch], n_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Counts of the last ``n_bytes`` of every code of a task, in parts that are summed first."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for batch in sliced(batches, "text", 2_000_000):
        if batch.num_rows:
            codes = _codes(batch.column(0))[0] & _mask(n_bytes)
            keys, n = np.unique(codes.astype(np.uint32) if n_bytes <= 4 else codes, return_counts=True)
            parts.append((keys.astype(np.uint64), n))
            held += len(parts[-1][0])
        if held > 4_000_000:
            parts = [_merged(parts)]
            held = len(parts[0][0])
            if held > 2_000_000:
                yield parts[0]
                parts, held = [], 0
    if parts:
        yield _merged(parts)


def gram_counts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """(code, n) of every symbol with ``order`` bytes of context over all rows; summed in each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n in _task_counts(batches, order + 1):
            yield pa.record_batch({"code": keys.view(np.int64), "n": n})

    return texts.select("text").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


class Counts(NamedTuple):
    """What an order leaves to the next longer one."""

    nodes: Table
    totals: np.ndarray
    distinct: np.ndarray
    pairs: Table
    counts: np.ndarray


def _grown(keys: np.ndarray, n: np.ndarray, orders: range, below: Counts | None) -> tuple[list[Level], Counts | None]:
    """The levels of ``orders``, from all codes that end in the same contexts (sorted, distinct) and their counts.

    Every pair of context and symbol that was seen is in the trie.
    """
    levels: list[Level] = []
    for k in orders:
        codes, n_seen = _merged([(keys & _mask(k + 1), n)])
        context = codes >> np.uint64(8)
        first = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(codes) else np.zeros(0, dtype=np.int64)
        contexts, counts = context[first], n_seen.astype(np.float64)
        totals = np.add.reduceat(counts, first) if len(codes) else counts
        distinct = np.diff(np.append(first, len(codes))).astype(np.float64)
        nodes, table = Table.of(contexts), Table.of(codes)
        whole, escape = totals, DISCOUNT * distinct
        below_whole, below_escape = np.ones(len(contexts)), np.ones(len(contexts))
        if below is not None:
            down = below.nodes.find(contexts & _mask(k - 1))
            shared = below.counts[below.pairs.find(codes & _mask(k))]  # the same symbols in the shorter context
            below_escape = DISCOUNT * (below.distinct[down] - distinct)
            below_whole = below.totals[down] - (np.add.reduceat(shared, first) if len(codes) else shared)
            nothing = (below_whole <= 0) | (below_escape <= 0)  # the shorter context knows nothing more: pass through
            below_whole[nothing], below_escape[nothing] = 1, 1
        logs = [np.log10(x).astype(np.float32) for x in (counts - DISCOUNT, whole, escape, below_whole, below_escape)]
        levels.append(Level(table, logs[0], nodes, *logs[1:]))
        below = Counts(nodes, totals, distinct, table, counts)
    return levels, below


def _low(texts: DataFrame, order: int) -> tuple[Model, Counts]:
    """The levels up to ``order``, grown on the driver."""
    grams = gram_counts(texts, order).toArrow()
    keys = grams.column("code").combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    n = grams.column("n").combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)
    levels, counts = _grown(*_merged([(keys, n)]), range(order + 1), None)
    return Model(levels, -float(np.log10(max(1, 256 - len(levels[0].log_count))))), counts


def train(texts: DataFrame) -> Model:
    """The trie over all rows of ``texts`` (text; null is empty) in one process, for texts that fit there."""
    return _low(texts, ORDER)[0]


def symbol_scores(model: Model, codes: np.ndarray) -> np.ndarray:
    """log10 probability of every symbol after its context."""
    out = np.zeros(len(codes))
    todo, came = np.arange(len(codes)), np.full(len(codes), -1, dtype=np.int64)
    for k in range(ORDER, -1, -1):
        level = model.levels[k]
        now = codes[todo]
        pair = level.pairs.find(now & _mask(k + 1))
        node = np.full(len(now), -1, dtype=np.int64)
        context = (now >> np.uint64(8)) & _mask(k) if k else np.zeros(len(now), dtype=np.uint64)
        node[:] = level.nodes.find(context)
        known = node >= 0
        straight, after = known & (came < 0), known & (came >= 0)
        whole, escape = np.zeros(len(now)), np.zeros(len(now))
        whole[straight], escape[straight] = level.whole[node[straight]], level.escape[node[straight]]
        if after.any():
            longer = model.levels[k + 1]
            whole[after], escape[after] = longer.below_whole[came[after]], longer.below_escape[came[after]]
        found = pair >= 0
        out[todo[found]] += level.log_count[pair[found]] - whole[found]
        out[todo[~found]] += escape[~found] - whole[~found]
        todo, came = todo[~found], node[~found]
    out[todo] += model.log_rest
    return out


#: Contexts up to this length are sent to the tasks: at most 2^24 pairs of bytes and symbol, whatever the corpus.
NEAR = 2
#: Training text per bucket, symbols per row of the shuffle, and text whose symbols are looked up together.
BUCKET_BYTES, PIECE, SLICE_BYTES = 8_000_000, 16384, 8_000_000


def _buckets(codes: np.ndarray, n: int) -> np.ndarray:
    """Where the contexts of more than NEAR bytes of a code are counted: by the NEAR + 1 bytes before the symbol."""
    return (mix((codes >> np.uint64(8)) & _mask(NEAR + 1)) % np.uint64(n)).astype(np.int64)


def _packed(codes: np.ndarray, more: np.ndarray) -> bytes:
    """Sorted codes and a small number beside each, as compressed byte planes of the differences."""
    steps = np.diff(codes, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    planes = np.concatenate([steps, more.astype(np.uint32).view(np.uint8).reshape(-1, 4).T])
    return len(codes).to_bytes(4, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    planes = np.frombuffer(pa.decompress(data[4:], 12 * n, "zstd", asbytes=True), dtype=np.uint8).reshape(12, n)
    steps = np.ascontiguousarray(planes[:8].T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64), np.ascontiguousarray(planes[8:].T).view(np.uint32).ravel()


_SENT = "bucket long, kind int, slice long, part int, data binary"


def _sent(codes: np.ndarray, more: np.ndarray, n_buckets: int, kind: int, first: int) -> pa.RecordBatch:
    """Sorted codes as rows of at most PIECE symbols by bucket."""
    bucket, order = _dealt(codes, n_buckets)
    codes, more = codes[order], more[order]
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    ends = np.append(cuts[1:], len(codes))
    pieces = [(a, min(a + PIECE, e), (a - c) // PIECE) for c, e in zip(cuts.tolist(), ends.tolist()) for a in range(c, e, PIECE)]
    data = [_packed(codes[a:b], more[a:b]) for a, b, _ in pieces]
    m = len(pieces)
    return pa.record_batch({
        "bucket": pa.array([int(bucket[a]) for a, _, _ in pieces], pa.int64()), "kind": pa.array([kind] * m, pa.int32()),
        "slice": pa.array([first] * m, pa.int64()), "part": pa.array([i for _, _, i in pieces], pa.int32()), "data": pa.array(data, pa.binary()),
    })


def _dealt(codes: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of sorted codes, ascending, and the order of the codes by them."""
    bucket = _buckets(codes, n_buckets)
    order = np.argsort(bucket.astype(np.min_scalar_type(n_buckets)), kind="stable")  # of 16 bits, a radix sort
    return bucket[order], order


#: Texts whose symbols are sorted together: a code has seven bytes, the number of its text is the eighth.
_TOGETHER = 256


def _by_code(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The distinct codes of a few texts, how often each occurs, the text of every occurrence by code, and the number of texts."""
    codes, symbols = _codes(column)
    keys = np.sort(codes << np.uint64(8) | np.repeat(np.arange(len(column), dtype=np.uint64), symbols))
    codes = keys >> np.uint64(8)
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])[: len(codes)])
    return codes[first], np.diff(np.append(first, len(codes))).astype(np.int32), keys.astype(np.uint8), len(column)


def _stored(column: pa.Array) -> bytes:
    """Texts as compressed bytes; a null text is empty."""
    flat, offsets = text_bytes(column)
    body = offsets.tobytes() + flat.tobytes()
    return len(column).to_bytes(8, "little") + len(body).to_bytes(8, "little") + pa.compress(body, "zstd", asbytes=True)


def _restored(data: bytes) -> pa.Array:
    n, size = int.from_bytes(data[:8], "little"), int.from_bytes(data[8:16], "little")
    body = pa.py_buffer(pa.decompress(data[16:], size, "zstd", asbytes=True))
    return pa.Array.from_buffers(pa.large_string(), n, [None, body.slice(0, 8 * (n + 1)), body.slice(8 * (n + 1))])


def _zipped(body: bytes) -> bytes:
    return len(body).to_bytes(8, "little") + pa.compress(body, "zstd", asbytes=True)


def _unzipped(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _scores_packed(scores: np.ndarray) -> bytes:
    """Scores, of which many are equal, as the distinct ones and compressed byte planes of their numbers."""
    values, places = np.unique(scores, return_inverse=True)
    planes = places.astype(np.uint32).view(np.uint8).reshape(-1, 4).T
    return len(values).to_bytes(4, "little") + _zipped(values.tobytes() + planes.tobytes())


def _scores_unpacked(data: bytes) -> np.ndarray:
    n, body = int.from_bytes(data[:4], "little"), _unzipped(data[4:])
    planes = np.frombuffer(body, dtype=np.uint8, offset=8 * n).reshape(4, -1)
    return np.frombuffer(body, dtype=np.float64, count=n)[np.ascontiguousarray(planes.T).view(np.uint32).ravel()]


def _tokens(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, A-Z made small, and the text each is of; a null text has none."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(column))
    text = np.repeat(np.arange(len(column)), pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False))
    words = found.flatten()
    filled = pc.not_equal(pc.binary_length(words), 0)  # white space at an end leaves an empty one
    return words.filter(filled), text[filled.to_numpy(zero_copy_only=False)]


def _bytes(words: pa.Array) -> list[bytes]:
    return words.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()


def _by_bucket(tokens: set[bytes], n_buckets: int) -> list[tuple[int, list[bytes]]]:
    """Tokens by the bucket that has their counts, ascending."""
    buckets: dict[int, list[bytes]] = {}
    for token in sorted(tokens):
        buckets.setdefault(zlib.crc32(token) % n_buckets, []).append(token)
    return sorted(buckets.items())


def _text_key(text: str) -> Column:
    """16 bytes that stand for a text; a null text is empty."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)), 1, 16)


def _assessed(
    distinct: list[bytes], places: np.ndarray, text: np.ndarray, n: int, common: dict[bytes, float], rare: dict[bytes, float], unseen: set[bytes]
) -> dict[str, pa.Array]:
    """n_tokens, how many of them are known, and the sum of their logs, for ``n`` texts; each word has its place among the distinct ones and its text."""
    n_tokens = np.bincount(text, minlength=n) + 1
    unknown = np.fromiter(map(unseen.__contains__, distinct), dtype=bool, count=len(distinct))
    known = n_tokens - np.bincount(text[unknown[places]], minlength=n) - (END in unseen)
    logs = np.array([rare[w] if log is None else log for w, log in zip([*distinct, END], map(common.get, [*distinct, END]))])
    high = np.round(logs * 2**20) / 2**20  # these add up without rounding, the small rest nearly so
    sums = sum(np.bincount(text, weights=part[places], minlength=n) + part[-1] for part in (logs - high, high))
    return {"n_tokens": pa.array(n_tokens, pa.int64()), "known": pa.array(known, pa.int64()), "base": pa.array(sums, pa.float64())}


#: What the rows sent to a bucket hold.
_CODES, _COUNTS, _TOKENS, _TEXTS = range(4)
#: Codes that wait for a bucket's trie are kept in memory up to this size, beyond it in a temporary file.
WAITING_BYTES = 32_000_000


def sent_rows(rows: DataFrame, shared: Broadcast, n_buckets: int) -> DataFrame:
    """What slices of texts (text, teach) send to the buckets: symbols in context with their counts, tokens not in ``shared``, texts."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        held, part, seen, tokens = 0, 0, [], set()
        for batch in sliced(batches, "text", 1_000_000):
            if not batch.num_rows:
                continue
            column, teach = batch.column(0), batch.column(1)
            yield pa.record_batch({
                "bucket": pa.array([first % n_buckets], pa.int64()), "kind": pa.array([_TEXTS], pa.int32()), "slice": pa.array([first], pa.int64()),
                "part": pa.array([part], pa.int32()), "data": pa.array([_stored(column)], pa.binary()),
            })
            part += 1
            for some, teaches in ((column.filter(teach), True), (column.filter(pc.invert(teach)), False)):
                codes, n = np.unique(_codes(some)[0], return_counts=True) if len(some) else _merged([])
                held += int(n.sum())
                seen.append((codes, n if teaches else np.zeros_like(n)))
            tokens |= {END, *_bytes(_tokens(column)[0].unique())}.difference(shared.value)
            if held >= SLICE_BYTES:
                yield _sent(*_merged(seen), n_buckets, _CODES, first)
                yield from _tokens_sent(tokens, n_buckets, _TOKENS, first)
                first, held, part, seen, tokens = first + 1, 0, 0, [], set()
        if seen:
            yield _sent(*_merged(seen), n_buckets, _CODES, first)
            yield from _tokens_sent(tokens, n_buckets, _TOKENS, first)

    return rows.select("text", "teach").mapInArrow(sent, _SENT)


def text_scores(rows: DataFrame, counts: DataFrame, common: dict[bytes, float], add: float) -> DataFrame:
    """(key, n_tokens, known, base, score) of every distinct text of ``rows`` (text, teach).

    ``base`` sums log10(c + add) over the tokens, of which ``common`` has some and
    ``counts`` all others; ``score`` is that of the model of the rows that teach.

    Contexts and symbols go to buckets by the three bytes before the symbol, so
    that a bucket has every longer context of its symbols whole. Every slice of
    texts sends its distinct symbols in context once, with their counts among the
    texts that teach. The bucket adds the counts of all slices up to its part of
    the trie; then the same symbols are looked up there, and their scores go back to
    the slice, whose texts wait beside. Tokens that are not common are looked up likewise.
    No task holds more than one bucket's contexts or one slice, the driver none
    beyond those of NEAR bytes.
    """
    spark = rows.sparkSession
    taught = rows.where("teach").select("text")
    size = taught.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(8, -(-size // BUCKET_BYTES))
    near = spark.sparkContext.broadcast(_low(taught, NEAR))
    shared = spark.sparkContext.broadcast(common)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            yield from _tokens_sent({t for t in times if t not in shared.value}, n_buckets, _COUNTS, -1, times)

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, below = near.value
        at, grams, n_held, times = None, [], 0, {}
        waiting: list[tuple[int, int, int]] = []  # slice, part and size of what the file holds

        def rows_of(kind, slices, bucket, parts, data):
            m = len(data)
            return pa.record_batch({
                "slice": pa.array(slices, pa.int64()), "kind": pa.array([kind] * m, pa.int32()), "bucket": pa.array([bucket] * m, pa.int64()),
                "part": pa.array(parts, pa.int32()), "data": pa.array(data, pa.binary()),
            })

        def answers():
            model = Model(low.levels + _grown(*_merged(grams), range(NEAR + 1, ORDER + 1), below)[0], low.log_rest)
            file.seek(0)
            asked, n = [], 0
            for first, part, length in waiting:
                asked.append((first, part, _unpacked(file.read(length))[0]))
                n += len(asked[-1][2])
                if n > 1_000_000:
                    yield answered(model, asked)
                    asked, n = [], 0
            if asked:
                yield answered(model, asked)

        def answered(model, asked):
            codes, back = np.unique(np.concatenate([a[2] for a in asked]), return_inverse=True)
            scores = symbol_scores(model, codes)[back]
            ends = np.cumsum([len(a[2]) for a in asked])
            data = [_scores_packed(scores[e - len(a[2]) : e]) for a, e in zip(asked, ends)]
            return rows_of(_CODES, [a[0] for a in asked], at, [a[1] for a in asked], data)

        with tempfile.SpooledTemporaryFile(max_size=WAITING_BYTES) as file:
            for batch in batches:
                columns = [batch.column(i).to_pylist() for i in range(4)]
                for i, (bucket, kind, first, part) in enumerate(zip(*columns)):
                    data = batch.column(4)[i].as_py()
                    if waiting and (bucket != at or kind != _CODES):
                        yield from answers()
                        file.seek(0)
                        file.truncate()
                        grams, n_held = [], 0
                        waiting.clear()
                    if bucket != at:
                        at, times = bucket, {}
                    if kind == _CODES:
                        keys, n = _unpacked(data)
                        grams.append((keys[n > 0], n[n > 0].astype(np.int64)))
                        n_held += len(grams[-1][0])
                        if n_held > 4_000_000:
                            grams, n_held = [_merged(grams)], 0
                        waiting.append((first, part, len(data)))
                        file.write(data)
                    elif kind == _COUNTS:
                        body = _unzipped(data)
                        size = int.from_bytes(body[:8], "little")
                        n = np.frombuffer(body[8 : 8 + 8 * size], dtype=np.int64).tolist()
                        times.update(zip(body[8 + 8 * size :].split(b"\n"), n))
                    elif kind == _TOKENS:
                        found = np.array([times.get(t, 0) for t in _unzipped(data).split(b"\n")], dtype=np.int64)
                        yield rows_of(_TOKENS, [first], at, [part], [_zipped(found.tobytes())])
                    else:
                        yield rows_of(_TEXTS, [first], -1, [part], [data])
            if waiting:
                yield from answers()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        texts: list[pa.Array] = []
        found: list[np.ndarray] = []
        times: list[np.ndarray] = []

        def out():
            parts = [_by_code(column.slice(i, _TOGETHER)) for column in texts for i in range(0, len(column), _TOGETHER)]
            codes = _distinct(np.concatenate([p[0] for p in parts]))
            scores = np.empty(len(codes))
            scores[_dealt(codes, n_buckets)[1]] = np.concatenate(found)
            totals = [np.bincount(text, np.repeat(scores[np.searchsorted(codes, own)], times), n) for own, times, text, n in parts]
            del parts, codes, scores
            words, text, n_texts = [], [], 0
            for column in texts:  # the words of a part at a time: those of a slice take several times its bytes
                own, of = _tokens(column)
                words.append(own.dictionary_encode())
                text.append((of + n_texts).astype(np.int32))
                n_texts += len(column)
            words = pa.chunked_array(words).unify_dictionaries().combine_chunks()
            text, distinct = np.concatenate(text), _bytes(words.dictionary)
            n = np.concatenate([np.zeros(0, dtype=np.int64), *times])
            tokens = {END, *distinct}.difference(shared.value)
            rare = dict(zip([t for _, own in _by_bucket(tokens, n_buckets) for t in own], np.log10(n + add).tolist(), strict=True))
            unseen = {t for t, c in zip(rare, n.tolist()) if not c}
            base = _assessed(distinct, words.indices.to_numpy(zero_copy_only=False), text, n_texts, shared.value, rare, unseen)
            keys = [hashlib.sha256(t or b"").digest()[:16] for column in texts for t in _bytes(column)]
            return pa.record_batch({"key": pa.array(keys, pa.binary()), **base, "score": pa.array(np.concatenate(totals), pa.float64())})

        for batch in batches:
            for first, kind, data in zip(*(batch.column(i).to_pylist() for i in (0, 1, 4))):
                if first != at:
                    if at is not None:
                        yield out()
                    at, texts, found, times = first, [], [], []
                if kind == _TEXTS:
                    texts.append(_restored(data))
                elif kind == _CODES:
                    found.append(_scores_unpacked(data))
                else:
                    times.append(np.frombuffer(_unzipped(data), dtype=np.int64))
        if at is not None:
            yield out()

    asked = sent_rows(rows, shared, n_buckets).unionAll(counts.select("token", "c").mapInArrow(counted, _SENT))
    parts = asked.repartition(n_buckets, "bucket").sortWithinPartitions("bucket", "kind", "slice", "part").mapInArrow(
        looked_up, "slice long, kind int, bucket long, part int, data binary"
    )
    result = "key binary, n_tokens long, known long, base double, score double"
    slices = parts.repartition("slice").sortWithinPartitions("slice", "kind", "bucket", "part").mapInArrow(summed, result)
    return slices.groupBy("key").agg(*[F.max(c).alias(c) for c in ("n_tokens", "known", "base", "score")])


def _tokens_sent(tokens: set[bytes], n_buckets: int, kind: int, first: int, times: dict[bytes, int] | None = None) -> Iterator[pa.RecordBatch]:
    """Tokens, with their counts if there are any, as one row per bucket."""
    for bucket, own in _by_bucket(tokens, n_buckets):
        body = b"\n".join(own)
        if times is not None:
            body = len(own).to_bytes(8, "little") + np.array([times[t] for t in own], dtype=np.int64).tobytes() + body
        yield pa.record_batch({
            "bucket": pa.array([bucket], pa.int64()), "kind": pa.array([kind], pa.int32()), "slice": pa.array([first], pa.int64()),
            "part": pa.array([0], pa.int32()), "data": pa.array([_zipped(body)], pa.binary()),
        })


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, c) over all rows: A-Z made small, words between ASCII white space, and one END per row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows():
            return pa.record_batch({"token": pa.array(counts.keys(), pa.binary()), "c": pa.array(counts.values(), pa.int64())})

        for batch in sliced(batches, "text", 1_000_000):
            met = _tokens(batch.column(0))[0].value_counts()
            for token, n in zip(_bytes(met.field("values")), met.field("counts").to_pylist()):
                counts[token] += n
            counts[END] += batch.num_rows
            if len(counts) > 500_000:
                yield rows()
                counts.clear()
        yield rows()

    return texts.select("text").mapInArrow(count, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def score(
    docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text",
    common_rate: float = 1e-6, add: float = 0.1,
) -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, n_known, train_tokens, base_score, score.

    ``training`` tells which rows teach. ``base_score`` sums
    log10((c + add) / (N + add (V + 1))) over the tokens, exact for every token:
    those in more than ``common_rate`` of all places (at most 1 / common_rate of
    them) are sent to the tasks, the counts of all others are looked up in buckets. ``score`` is
    the log10 probability of the text, A-Z made small, under the byte model, its
    end included. A null text is empty: one token, the end. Repeated rows are
    scored each, rows with a null id too; without training rows all counts are 0.
    """
    teach = F.coalesce(training, F.lit(False)).alias("teach")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), teach)
    counts = settled(token_counts(rows.where("teach")))
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    common = counts.where(F.col("c") >= n * common_rate).toPandas()
    weights = dict(zip(map(bytes, common["token"]), np.log10(common["c"].to_numpy(np.float64) + add).tolist()))
    per_token = float(np.log10(n + add * (v + 1)))
    return (
        rows.select("id", _text_key("text").alias("key")).join(text_scores(rows, counts, weights, add), "key", "left")
        .select(
            F.col("id").alias(id_col), "n_tokens", F.col("known").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
            (F.col("base") - F.col("n_tokens") * F.lit(per_token)).alias("base_score"), "score",
        )
    )
