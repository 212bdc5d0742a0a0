"""Secrets in whole texts, also inside nested URL, Unicode, base64 and compressed layers.

Each document has its own worklist. A layer is a text with, for every
character, the span of the document it came from. It is searched for secrets,
then every way of unwrapping it puts further layers on the list, until nothing
new appears. A layer whose content was already seen for the same span is left
out, so payloads that decode to themselves end.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import sliced

# The kinds in order of report, their patterns, and the least lengths that count.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE, LEAST_ACCESS = 8, 16

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}"
    r"|%u[0-9A-Fa-f]{4}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+"
)
_ONE_ESCAPE = re.compile(r"(?:\\u\{|\\[uUx]|%u|&#[xX])([0-9A-Fa-f]+)[};]?|&#([0-9]+);")
# Bytes written as text, the printable ones mostly as they are: in URLs, and in string literals.
_URL_BYTES, _ONE_URL_BYTE = re.compile(r"[!-~]*%[0-9A-Fa-f]{2}[!-~]*"), re.compile(r"%([0-9A-Fa-f]{2})|.")
_LITERAL_BYTES = re.compile(r"[ -~]*\\(?:x|u00)[0-9A-Fa-f]{2}[ -~]*")
_ONE_LITERAL_BYTE = re.compile(r"\\(?:x|u00)([0-9A-Fa-f]{2})|\\[abfnrtv0'\"\\/]|.")
_LITERALS = dict(zip("abfnrtv0'\"\\/", b"\a\b\f\n\r\t\v\0'\"\\/"))
# The shortest secret, token=12345678, has 14 bytes and so 19 base64 digits.
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{19,}={0,2}")
# Lines of a wrapped run; the last may be short.
_WRAPPED = re.compile(r"(?:[A-Za-z0-9+/_-]{16,}\r?\n[ \t]*)+[A-Za-z0-9+/_-]+={0,2}")
# How streams begin: gzip, bzip2, and zlib with any window and no preset dictionary.
_ZLIB = frozenset(bytes((c, f)) for c in range(0x08, 0x80, 0x10) for f in range(256) if (c * 256 + f) % 31 == 0 and not f & 0x20)
_HEAD = re.compile(b"(?=\x1f\x8b\x08[\x00-\x1f]|BZh[1-9]1AY&SY|" + b"|".join(re.escape(z) for z in sorted(_ZLIB)) + b")", re.DOTALL)
_BROKEN = (zlib.error, OSError, EOFError)
# ASCII in UTF-16 of either byte order.
_WIDE = re.compile(rb"(?:[\x01-\x7f]\x00){7,}[\x01-\x7f]?")
_URL_SAFE = bytes.maketrans(b"-_", b"+/")
#: Inflated layers are searched in windows of so many bytes, with an overlap.
WINDOW, OVERLAP = 1 << 22, 1 << 16

Span = tuple[int, int, int]  # kind, start, end


def base_spans(text: str) -> list[Span]:
    """Spans of a text itself: leftmost, not overlapping within a kind."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return found


class _Layer:
    """A decoded text; character i came from [starts[i], ends[i]) of the document. No arrays: the document itself."""

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None):
        self.text, self.starts, self.ends = text, starts, ends

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())

    def origin(self) -> tuple[np.ndarray, np.ndarray]:
        if self.starts is None:
            at = np.arange(len(self.text), dtype=np.int64)
            return at, at + 1
        return self.starts, self.ends


def _stream(data: bytes):
    """A decompressor for the stream that the bytes begin with; None if they begin with none."""
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    return zlib.decompressobj(15) if data[:2] in _ZLIB else None


def _starts(data: bytes) -> Iterator[int]:
    """The places where a stream may start: its first bytes can be read."""
    for m in _HEAD.finditer(data):
        head = data[m.start() : m.start() + 400]
        try:
            _stream(head).decompress(head, 1 << 16)
        except _BROKEN:
            continue
        yield m.start()


def _pieces(data: bytes) -> Iterator[tuple[bytes, int]]:
    """(piece, bytes of ``data`` behind the end of the last whole stream) of the streams that follow each other; pieces are at most a window."""
    stream, left, behind = _stream(data), data, len(data)
    while stream is not None:
        try:
            piece = stream.decompress(left, WINDOW)
        except _BROKEN:
            return
        if stream.eof:
            left = stream.unused_data
            behind, stream = len(left), _stream(left)
        else:
            left = getattr(stream, "unconsumed_tail", b"")
            if not piece:  # cut off
                return
        yield piece, behind


def _inflated(data: bytes) -> Iterator[bytes]:
    """The windows of a stream and of what follows it; nothing if it is none."""
    held, behind = b"", len(data)
    for piece, behind in _pieces(data):
        if piece:
            yield held + piece
            held = (held + piece)[-OVERLAP:]
    if 0 < behind < len(data):
        yield held + data[-behind:]


def _stream_length(data: bytes) -> int:
    """How many bytes belong to the streams at the start; all if the first is cut off, 0 if it cannot be read."""
    behind = None
    for _, behind in _pieces(data):
        pass
    return 0 if behind is None else len(data) - behind % len(data)


def _replaced(layer: _Layer, pattern: re.Pattern, decode) -> _Layer | None:
    """The layer with every run of the pattern decoded; ``decode`` gives (character, characters of the run it takes)."""
    starts, ends = layer.origin()
    text, new_starts, new_ends, at = [], [], [], 0
    for m in pattern.finditer(layer.text):
        decoded = decode(m[0])
        if not decoded:
            continue
        text.append(layer.text[at : m.start()])
        new_starts.append(starts[at : m.start()])
        new_ends.append(ends[at : m.start()])
        widths = np.cumsum([0] + [w for _, w in decoded])
        text.append("".join([c for c, _ in decoded]))
        new_starts.append(starts[m.start() + widths[:-1]])
        new_ends.append(ends[m.start() + widths[1:] - 1])
        at = m.end()
    if not at:
        return None
    text.append(layer.text[at:])
    return _Layer("".join(text), np.concatenate([*new_starts, starts[at:]]), np.concatenate([*new_ends, ends[at:]]))


def _percent(run: str) -> list[tuple[str, int]]:
    text = bytes.fromhex(run.replace("%", "")).decode("utf-8", "replace")
    sizes = [len(c.encode("utf-8")) * 3 for c in text]
    if "\ufffd" in text:  # not UTF-8: byte by byte
        return [(chr(b), 3) for b in bytes.fromhex(run.replace("%", ""))]
    return list(zip(text, sizes))


def _escapes(run: str) -> list[tuple[str, int]]:
    out: list[tuple[str, int]] = []
    for m in _ONE_ESCAPE.finditer(run):
        code, width = int(m[1], 16) if m[1] else int(m[2]), len(m[0])
        if out and 0xDC00 <= code <= 0xDFFF and 0xD800 <= ord(out[-1][0]) <= 0xDBFF:
            high, before = out.pop()
            out.append((chr(0x10000 + ((ord(high) - 0xD800) << 10) + code - 0xDC00), before + width))
        else:
            out.append((chr(code) if code < 0x110000 else "\ufffd", width))
    return out


def _opened(data: bytes) -> Iterator[bytes]:
    """What compressed bytes hold, through any number of compressed layers; nothing if they are none."""
    todo, seen = [data], set()
    while todo:
        now = todo.pop()
        digest = hashlib.sha256(now).digest()
        if digest in seen:
            continue
        seen.add(digest)
        for window in list(_inflated(now)) if len(now) < WINDOW else _inflated(now):
            todo += [window[i:] for i in _starts(window)]
            yield window


def _written(layer: _Layer, run: re.Match, one: re.Pattern) -> Iterator[_Layer]:
    """What the streams hold whose bytes a run of text spells out; each has the span of its stream."""
    data, at = bytearray(), []
    for m in one.finditer(run[0]):
        code = int(m[1], 16) if m[1] else _LITERALS[m[0][1]] if len(m[0]) == 2 else ord(m[0])
        data.append(code)
        at.append(run.start() + m.start())
    data, done = bytes(data), 0
    for i in _starts(data):
        if i < done or not (size := _stream_length(data[i:])):
            continue
        done = i + size
        start, end = layer.span(at[i], at[done] if done < len(at) else run.end())
        for window in _opened(data[i:done]):
            for text, _, _ in _readings(window):
                yield _Layer(text, np.full(len(text), start, dtype=np.int64), np.full(len(text), end, dtype=np.int64))


def _layers(layer: _Layer) -> Iterator[_Layer]:
    if "%" in layer.text and (new := _replaced(layer, _PERCENT, _percent)):
        yield new
    if ("\\" in layer.text or "%u" in layer.text or "&#" in layer.text) and (new := _replaced(layer, _ESCAPE, _escapes)):
        yield new
    for m in _URL_BYTES.finditer(layer.text) if "%" in layer.text else ():
        yield from _written(layer, m, _ONE_URL_BYTE)
    for m in _LITERAL_BYTES.finditer(layer.text) if "\\" in layer.text else ():
        yield from _written(layer, m, _ONE_LITERAL_BYTE)
    for m in _BASE64.finditer(layer.text):
        digits = m[0].rstrip("=")
        yield from _decoded(layer, digits, np.arange(m.start(), m.start() + len(digits)), m.end())
    for m in _WRAPPED.finditer(layer.text) if "\n" in layer.text else ():
        at = np.array([i for i, c in enumerate(m[0], m.start()) if c not in "\r\n\t ="], dtype=np.int64)
        yield from _decoded(layer, re.sub(r"[\r\n\t =]", "", m[0]), at, m.end())


def _decoded(layer: _Layer, digits: str, at: np.ndarray, end: int) -> Iterator[_Layer]:
    """Layers of a run of base64 digits at the places ``at``, which ends with its padding at ``end``.

    The run may start with characters that are not of the payload: all four
    alignments are read as text, and streams are tried at every byte of each.
    """

    def made(text: str, first: np.ndarray, last: np.ndarray) -> _Layer:
        if layer.starts is None:
            return _Layer(text, first, last + 1)
        return _Layer(text, layer.starts[first], layer.ends[last])

    for skip in range(4):
        data = _bytes_of(digits[skip:])
        for text, stop, size in _readings(data):  # byte b needs the digits floor(4b/3) to ceil(4(b+1)/3)
            first = at[skip + (stop - size) * 4 // 3]
            last = at[np.minimum(skip - (-stop * 4 // 3), len(digits)) - 1]
            last[stop == len(data)] = end - 1  # with the padding
            yield made(text, first, last)
        for i in _starts(data):
            if not (length := _stream_length(data[i:])):
                continue
            stop = i + length  # what follows is in the reading above
            first, last = int(at[skip + i * 4 // 3]), int(at[min(skip - (-stop * 4 // 3), len(digits)) - 1])
            if stop == len(data):
                last = end - 1
            for window in _opened(data[i:stop]):
                for text, _, _ in _readings(window):
                    yield made(text, np.full(len(text), first, dtype=np.int64), np.full(len(text), last, dtype=np.int64))


def _bytes_of(digits: str) -> bytes:
    if len(digits) % 4 == 1:
        digits = digits[:-1]
    raw = digits.encode().translate(_URL_SAFE)
    return base64.b64decode(raw + b"=" * (-len(raw) % 4))


def _readings(data: bytes) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(text, end of each character among the bytes, its bytes): as UTF-8, other bytes kept as such, and runs of UTF-16."""
    text = data.decode("utf-8", "surrogateescape")
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    size[(points >= 0xDC80) & (points <= 0xDCFF)] = 1
    yield text, np.cumsum(size), size
    if b"\0" in data:
        for m in _WIDE.finditer(data):
            text = m[0][::2].decode("ascii")
            stop = np.minimum(m.start() + 2 * np.arange(1, len(text) + 1), m.end())
            yield text, stop, stop - m.start() - 2 * np.arange(len(text))


def text_spans(text: str | None) -> tuple[list[Span], list[Span]]:
    """(spans of the text itself, all spans with those of its layers), each sorted by start, kind, end."""
    if not text:
        return [], []
    order = lambda s: (s[1], s[0], s[2])
    base = base_spans(text)
    every, seen, todo = set(base), set(), list(_layers(_Layer(text)))
    while todo:
        layer = todo.pop()
        if not layer.text:
            continue
        key = (hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest(), layer.span(0, len(layer.text)))
        if key in seen:
            continue
        seen.add(key)
        every.update((kind, *layer.span(s, e)) for kind, s, e in base_spans(layer.text))
        todo.extend(_layers(layer))
    base.sort(key=order)
    return base, sorted(every, key=order) if len(every) > len(base) else base


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) for every row; spans: array of (kind, start, end, base), by start, kind and end.

    Positions are code points of the document, the end exclusive; ``base`` tells
    a secret in the plain text from one only found in a decoded layer, whose span
    is that of the encoded characters. A null or empty text has no spans;
    repeated rows are searched each.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            found = []
            for text in batch.column(1).to_pylist():
                base, every = text_spans(text)
                own = set(base)
                found.append([{"kind": KINDS[k], "start": s, "end": e, "base": (k, s, e) in own} for k, s, e in every])
            yield pa.record_batch({id_col: batch.column(0), "spans": pa.array(found, pa.list_(_SPAN))})

    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    spans = "spans array<struct<kind: string, start: bigint, end: bigint, base: boolean>>"
    return rows.mapInArrow(search, f"`{id_col}` {id_type}, {spans}")


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: str | None) -> str | None:
    """The text with every secret, plain or encoded, replaced by ``[SECRET:kind]``; overlapping ones become one."""
    _, spans = text_spans(text)
    out, at, until = [], 0, -1
    for kind, start, end in spans:
        if start < until:
            until = max(until, end)
            continue
        if until >= 0:
            at = until
        out += [text[at:start], f"[SECRET:{KINDS[kind]}]"]
        until = end
    return "".join([*out, text[until:]]) if spans else text


def mask_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, the secrets in the text masked; null and empty texts stay as they are."""
    at = docs.columns.index(text_col)

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_col):
            texts = pa.array([masked(t) for t in batch.column(at).to_pylist()], batch.column(at).type)
            yield batch.set_column(at, batch.schema.field(at), texts)

    return docs.mapInArrow(mask, docs.schema)
