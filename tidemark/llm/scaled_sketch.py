"""Document fingerprints: every word-shingle hash below a fixed share of the hash range.

The share does not depend on the text, so a long text keeps proportionally more
hashes, the union of two sketches is the sketch of both texts together, and the
part of a small sketch found in a large one estimates how much of the small text
the large one contains.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import shingle_hashes, sliced, text_bytes, word_hashes
from tidemark.session import small_rows

#: One of so many hashes is kept.
SCALE = 4
SHINGLE = 5
_BLOCK = 128


def _joined(texts: list[str]) -> pa.Array:
    return pa.array(texts, pa.large_string())


def text_sketches(texts: list[str], scale: int = SCALE, shingle: int = SHINGLE) -> list[tuple[np.ndarray, bool]]:
    """For each text its kept hashes, ascending and distinct, and whether they are a real sketch.

    A text with shingles of which none is kept is shown by its smallest hash
    alone; that stands for the text only to tell it from others.
    """
    words, at = word_hashes(*text_bytes(_joined(texts)), lower=False)
    hashes, offsets = shingle_hashes(words, at, shingle)
    limit = np.uint64(2**64 // scale - 1)
    low = hashes <= limit
    text = np.repeat(np.arange(len(texts)), np.diff(offsets))
    kept, owner = hashes[low], text[low]
    order = np.lexsort((kept, owner))
    kept, owner = kept[order], owner[order]
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        own = kept[ends[i] : ends[i + 1]]
        if len(own):
            fresh = np.append(True, own[1:] != own[:-1])
            out.append((own[fresh], True))
        elif offsets[i + 1] > offsets[i]:
            out.append((hashes[offsets[i] : offsets[i + 1]].min(keepdims=True), False))
        else:
            out.append((np.zeros(0, dtype=np.uint64), True))
    return out


def fingerprint(sketch: tuple[np.ndarray, bool]) -> str:
    """The kept hashes as 16 hex digits each, ascending; ``~`` and one hash where none is kept; empty without words."""
    hashes, real = sketch
    return ("" if real else "~") + hashes.astype(">u8").tobytes().hex()


def likeness(a: tuple[np.ndarray, bool], b: tuple[np.ndarray, bool]) -> float:
    """Estimated containment of the smaller text's shingles in the larger's, 0 to 1.

    Without a real sketch on both sides it is 1 for equal fingerprints, else 0;
    two texts without words are alike.
    """
    small, large = (a, b) if len(a[0]) <= len(b[0]) else (b, a)
    if not (small[1] and large[1]) or not len(small[0]):
        return float(small[1] == large[1] and np.array_equal(small[0], large[0]))
    return float(np.isin(small[0], large[0], assume_unique=True).mean())


def sketch_table(
    docs: DataFrame, scale: int = SCALE, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, hash) rows of every document's sketch, to be merged by union and compared by joins on the hash.

    A null text or one without words has no rows; rows that repeat an id merge.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            found = text_sketches([t or "" for t in batch.column(1).to_pylist()], scale, shingle)
            kept = [s[0] if s[1] else s[0][:0] for s in found]
            at = np.repeat(np.arange(len(kept)), [len(k) for k in kept])
            hashes = np.concatenate([np.zeros(0, dtype=np.uint64), *kept])
            yield pa.record_batch({id_col: batch.column(0).take(pa.array(at)), "hash": hashes.view(np.int64)})

    picked = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return picked.mapInArrow(rows, f"`{id_col}` {id_type}, hash long")


def containment(a: DataFrame, b: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(a, b, shared, share_of_a, share_of_b) for the documents of two sketch tables with a hash in common."""
    sizes = [t.distinct().groupBy(id_col).agg(F.count(F.lit(1)).alias("n")) for t in (a, b)]
    shared = (
        a.distinct().select(F.col(id_col).alias("a"), "hash").join(b.distinct().select(F.col(id_col).alias("b"), "hash"), "hash")
        .groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    )
    return (
        shared.join(sizes[0].select(F.col(id_col).alias("a"), F.col("n").alias("n_a")), "a")
        .join(sizes[1].select(F.col(id_col).alias("b"), F.col("n").alias("n_b")), "b")
        .select("a", "b", "shared", (F.col("shared") / F.col("n_a")).alias("share_of_a"), (F.col("shared") / F.col("n_b")).alias("share_of_b"))
    )


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many first ones of the next text, or all it has."""
    tail = len(text) // 4
    return text[: len(text) - tail] + following[:tail]


def _ranged(rows: DataFrame, per_range: int, most_ranges: int) -> DataFrame:
    """(id, text, part, guest): rows in ranges of ids, each range also holding the first rows of the next as guests.

    The last range is followed by the first, and every range is one partition.
    Range bounds and first ids are lists of at most ``most_ranges`` entries;
    beyond that many times ``per_range`` rows the ranges, which are sorted on
    disk and streamed, get longer.
    """
    ranges = max(1, min(most_ranges, -(-rows.count() // per_range)))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = sorted({int(c) for c in rows.approxQuantile("id", shares, 0.25 / ranges)}) if shares else []
    part = F.lit(0)
    if cuts:
        numbers = lambda some: f"cast(split('{','.join(map(str, some))}', ',') as array<bigint>)"
        # Bounds at or below the id: first among every _BLOCK-th, then within the block.
        block = f"greatest(array_size(filter({numbers(cuts[::_BLOCK])}, c -> c <= id)) - 1, 0) * {_BLOCK}"
        inside = f"transform(array({block}), b -> b + array_size(filter(slice({numbers(cuts)}, b + 1, {_BLOCK}), c -> c <= id)))[0]"
        part = F.when(F.col("id").isNull(), 0).otherwise(F.expr(inside)).cast("int")
    placed = rows.withColumn("part", part)
    least = F.min(F.struct(F.col("id").isNotNull().alias("known"), "id")).alias("first")
    firsts = placed.groupBy("part").agg(least).orderBy("part").collect()
    before = [(r["part"], r["first"]["id"], firsts[i - 1]["part"]) for i, r in enumerate(firsts)]
    lent = small_rows(rows.sparkSession, before, {"p": pa.int32(), "first": pa.int64(), "lent_to": pa.int32()})
    marked = placed.join(F.broadcast(lent), (F.col("part") == F.col("p")) & F.col("id").eqNullSafe(F.col("first")), "left")
    places = F.filter(
        F.array(
            F.struct(F.col("part").alias("part"), F.lit(0).alias("guest")),
            F.struct(F.col("lent_to").alias("part"), F.lit(1).alias("guest")),
        ),
        lambda place: place["part"].isNotNull(),
    )
    dealt = marked.select("id", "text", F.explode(places).alias("at")).select("id", "text", "at.part", "at.guest")
    return dealt.repartitionById(ranges, F.col("part")).sortWithinPartitions("part", "guest", F.col("id").asc_nulls_first(), "text")


def neighbours_compared(
    docs: DataFrame, scale: int = SCALE, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text",
    per_range: int = 4096, most_ranges: int = 20_000,
) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; the next document is that of the next id.

    Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. The texts are moved once, in ranges of ids that the
    tasks read as streams. The last document is followed by the first. Ids are
    integers; rows with the same id follow each other by text, null ids come
    first. A null text is empty. A single row is its own next document; an empty
    table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in sliced(batches, "text", 2_000_000):
            run = held + batch.to_pylist()
            held = run[-1:]
            # A guest ends its range: it is only a next document, and only the first guest is.
            at = [i for i in range(len(run) - 1) if run[i]["part"] == run[i + 1]["part"] and not run[i]["guest"]]
            if not at:
                continue
            texts = [r["text"] for r in run]
            changed = [edited(texts[i], texts[i + 1]) for i in at]
            own, new = text_sketches(texts, scale, shingle), text_sketches(changed, scale, shingle)
            yield pa.record_batch({
                id_col: pa.array([run[i]["id"] for i in at], pa.int64()),
                "n_chars": pa.array([len(texts[i]) for i in at], pa.int64()),
                "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                "fingerprint": pa.array([fingerprint(own[i]) for i in at]),
                "edited_fingerprint": pa.array([fingerprint(s) for s in new]),
                "near_edited": pa.array([likeness(own[i], s) for i, s in zip(at, new)], pa.float64()),
                "near_next": pa.array([likeness(own[i], own[i + 1]) for i in at], pa.float64()),
            })

    fields = (
        "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
    return _ranged(rows, per_range, most_ranges).mapInArrow(compare, f"`{id_col}` long, {fields}")
