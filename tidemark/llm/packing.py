"""Tokenising documents and packing them into training sequences with the sum-of-squares rule.

A sequence holds ``size`` tokens; its gap is what is still free. N(g) counts
the open sequences of gap g, and every piece goes where the sum of N(g)^2 over
all gaps becomes smallest, a new sequence being one of the choices. Pieces are
taken from long to short. Tasks pack groups of pieces by themselves; the pieces
of the sequences that stay open are then packed anew across groups.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import mix, sliced
from tidemark.session import settled

#: Python and the tokenizer differ about these being white space, so such texts are encoded in one go.
_ODD_BREAKS = ("\x1c", "\x1d", "\x1e", "\x1f")
#: The pipeline for which chunks between white space are independent; its pattern is fixed by the tokenizer file.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LATIN = "a-z\xdf-\xf6\xf8-\xff\u0101-\u012f\u0131-\u0148\u014a-\u017e"
_PLAIN = re.compile(f"[!-~\xc0-\xd6\xd8-\xde{_LATIN}\u0100]*")
_PLAIN_TEXT = re.compile(f"[\t-\r -~\xc0-\xd6\xd8-\xde{_LATIN}\u0100]*")
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[0-9]|[^\\s0-9{_LATIN}]+")
_ENCODERS: dict[str, ChunkEncoder] = {}


class ChunkEncoder:
    """Token ids of a text as little-endian 32-bit numbers.

    Where the tokenizer composes, makes small, drops white space and splits as
    ``_SPLIT`` says, a chunk between white space has the same ids in any text.
    Words of plain Latin texts, and such chunks of others, are encoded by the
    tokenizer once and remembered, up to ``remember``; beyond that they are
    encoded anew. Texts for any other tokenizer are encoded as they are.
    """

    def __init__(self, path: str, remember: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        steps = [n.get("type") for n in (parts["normalizer"] or {}).get("normalizers", [])]
        splits = (parts["pre_tokenizer"] or {}).get("pretokenizers", [])
        self.by_chunk = (
            steps == ["NFC", "Replace", "Lowercase"]
            and [x.get("type") for x in splits] == ["Split", "ByteLevel"]
            and splits[0]["pattern"] == {"Regex": _SPLIT}
            and (splits[0]["behavior"], splits[0]["invert"]) == ("Removed", True)
            and not splits[1]["add_prefix_space"]
            and not splits[1]["use_regex"]
            and all(t["special"] and t["content"].startswith("<|") for t in parts["added_tokens"])
        )
        self.letters = _byte_letters()
        self.remember = remember
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.tokenizer.model.tokenize(shown)]
            found = struct.pack(f"<{len(ids)}I", *ids)
            if len(self.words) < self.remember:
                self.words[word] = found
        return found

    def _chunk(self, chunk: str) -> bytes:
        found = self.chunks.get(chunk)
        if found is None:
            if _PLAIN.fullmatch(chunk) and "<|" not in chunk:
                found = b"".join([self._word(w) for w in _WORDS.findall(chunk.lower())])
            else:
                found = self._whole(chunk)
            if len(self.chunks) < self.remember // 4:
                self.chunks[chunk] = found
        return found

    def encode(self, text: str) -> bytes:
        if not self.by_chunk or any(c in text for c in _ODD_BREAKS):
            return self._whole(text)
        if _PLAIN_TEXT.fullmatch(text) and "<|" not in text:
            words = _WORDS.findall(text.lower())
            found = list(map(self.words.get, words))
            if None in found:
                found = [self._word(w) if f is None else f for w, f in zip(words, found)]
            return b"".join(found)
        chunks = text.split()
        found = list(map(self.chunks.get, chunks))
        if None in found:
            found = [self._chunk(c) if f is None else f for c, f in zip(chunks, found)]
        return b"".join(found)


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE shows a printable Latin-1 byte as itself and the others, in order, as U+0100 and on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def token_pieces(
    docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, id_col: str = "doc_id",
    text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, deal[, ids]): each document's ids, then ``end_id``, cut at ``size``.

    Only documents of more than ``size`` ids have several pieces. A null text is
    empty and yields the end id alone; repeated rows yield their pieces again.
    ``deal`` spreads pieces evenly whatever their ids; ``ids`` are the piece's
    ids as little-endian unsigned 32-bit numbers.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = ChunkEncoder(tokenizer)
        encoder = _ENCODERS[tokenizer]
        done = 0
        for batch in sliced(batches, "text"):
            rows, piece, start, ids = [], [], [], []
            for row, found in enumerate(map(encoder.encode, [t or "" for t in batch.column(1).to_pylist()])):
                found += end
                for k, at in enumerate(range(0, len(found), 4 * size)):
                    rows.append(row)
                    piece.append(k)
                    start.append(at // 4)
                    ids.append(found[at : at + 4 * size])
            crc = [zlib.crc32(x) for x in ids]
            deal = mix(np.array(crc, dtype=np.uint64) + (np.arange(len(crc)) + done).astype(np.uint64) * np.uint64(2**32))
            done += len(crc)
            out = {
                id_col: batch.column(0).take(pa.array(rows)), "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()), "length": pa.array([len(x) // 4 for x in ids], pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()), "deal": deal.view(np.int64),
            }
            yield pa.record_batch(out | ({"ids": pa.array(ids, pa.binary())} if with_ids else {}))

    fields = f"`{id_col}` {id_type}, piece int, start long, length long, ids_crc32 long, deal long"
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, fields + (", ids binary" if with_ids else ""))


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number (from 0) and offset of each piece; every length is 1 to ``size``.

    Pieces go from long to short, equal ones in the given order. Among equally
    good places the smallest gap wins, then the latest sequence opened with it.
    """
    n = len(lengths)
    sequence, offset = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    twice = np.zeros(size + 1, dtype=np.int64)  # 2 N(g)
    open_at: list[list[int]] = [[] for _ in range(size + 1)]
    opened = 0
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        gaps = np.flatnonzero(twice[s:size])
        change, gap = (int(twice[size - s]) + 1 if s < size else 0), size
        if len(gaps):
            gaps += s
            after = twice[gaps - s] + 1
            if gaps[0] == s:
                after[0] = 0  # a full sequence is closed and counts no more
            delta = after - twice[gaps] + 1
            k = int(delta.argmin())
            if delta[k] <= change:
                gap = int(gaps[k])
        if gap == size:
            at = opened
            opened += 1
        else:
            at = open_at[gap].pop()
            twice[gap] -= 2
        sequence[i], offset[i] = at, size - gap
        if gap > s:
            open_at[gap - s].append(at)
            twice[gap - s] += 2
    return sequence, offset


def _packed(pieces: DataFrame, parts: int, size: int) -> DataFrame:
    """``pieces`` with the part each was dealt to, its sequence in the part, its offset, and how full that sequence is."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop(columns="__part").sort_values(["length", "deal"], ascending=False, kind="stable")
        sequence, offset = sum_of_squares(rows["length"].to_numpy(), size)
        filled = np.bincount(sequence, weights=rows["length"].to_numpy()).astype(np.int64)
        return rows.assign(part=key[0], seq=sequence, offset=offset, filled=filled[sequence])

    dealt = pieces.withColumn("__part", F.pmod("deal", F.lit(parts)))
    return dealt.groupBy("__part").applyInPandas(place, fields + ", part long, seq long, offset long, filled long")


def pack(pieces: DataFrame, size: int = 2048, group: int = 20_000) -> DataFrame:
    """All columns of ``pieces`` but ``deal``, with ``sequence_id`` and ``offset``.

    ``pieces`` has ``length`` (1 to ``size``) and ``deal`` (evenly spread
    numbers). About ``group`` pieces are packed by one task; then the pieces of
    the sequences that are not full, a small part, are packed anew in groups of
    that size. So the work of a task does not grow with the table, and nearly all
    waste is in the few sequences left open by the second round. Every sequence
    is gapless from offset 0. An empty table stays empty.
    """
    columns = [c for c in pieces.columns if c != "deal"]
    parts = max(1, -(-pieces.count() // group))
    first = settled(_packed(pieces, parts, size))
    still_open = first.where(F.col("filled") < size).select(*pieces.columns)
    again = max(1, -(-still_open.count() // group))
    # Other bits of deal than before, so that pieces of many parts meet.
    second = _packed(still_open.withColumn("deal", F.xxhash64("deal")), again, size)
    step = 2 * max(parts, again)
    done = first.where(F.col("filled") == size).select(
        *columns, (F.col("seq") * step + 2 * F.col("part")).alias("sequence_id"), "offset"
    )
    return done.unionAll(
        second.select(*columns, (F.col("seq") * step + 2 * F.col("part") + 1).alias("sequence_id"), "offset")
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Tokenise, cut and pack: one row per piece with its place. The tokenised pieces are written once."""
    return pack(settled(token_pieces(docs, tokenizer, size, end_id, id_col, text_col, with_ids)), size)
