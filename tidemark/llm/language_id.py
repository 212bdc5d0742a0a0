"""Language identification with bit-sliced Bloom filters over character n-grams.

One filter of ``slots`` positions serves all languages: a slot holds a bitmask
with one bit per language, and the AND of a gram's slots names every language
whose profile (perhaps falsely) contains the gram. Per text, the hits of each
language are counted, the expected number of false ones is taken off, and the
language with most corrected hits wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import mix, sliced
from tidemark.session import settled

UNDETERMINED = "und"
_LETTERS: np.ndarray | None = None


class LanguageModel(NamedTuple):
    """``filters``: slots x words of 64 language bits; ``false_rate``: of one gram, by language."""

    languages: list[str]
    filters: np.ndarray
    n_hashes: int
    gram: int
    false_rate: np.ndarray
    fallback: int


def _letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTERS


def _grams(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all grams, the text each belongs to, and the number of letters per text.

    Letters are made small, everything else is a gap; a gram lies within one
    text, holds a letter, and no two gaps next to each other.
    """
    points = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32) if t else
              np.zeros(0, dtype=np.uint32) for t in texts]
    lengths = np.array([len(p) for p in points], dtype=np.int64)
    flat = np.concatenate(points) if points else np.zeros(0, dtype=np.uint32)
    text = np.repeat(np.arange(len(points)), lengths)
    letter = _letters()[flat]
    n_letters = np.bincount(text[letter], minlength=len(points))
    flat = np.where(letter, flat, 0).astype(np.uint64)
    keep = np.ones(len(flat), dtype=bool)
    keep[1:] = letter[1:] | letter[:-1] | (text[1:] != text[:-1])  # runs of gaps count as one
    flat, text = flat[keep], text[keep]
    n = max(0, len(flat) - size + 1)
    code = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        code = code * np.uint64(0x110000 if size <= 3 else 0x9E3779B97F4A7C15) + flat[i : i + n]
    inside = text[:n] == text[size - 1 :] if n else np.zeros(0, dtype=bool)
    return mix(code[inside]), text[:n][inside], n_letters


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(where, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)


def gram_counts(labelled: DataFrame, size: int) -> DataFrame:
    """(lang, gram, n) over whole texts, summed within each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list] = {}
        held = 0

        def flush():
            for lang, found in parts.items():
                keys, n = _merged(found)
                yield pa.record_batch({"lang": pa.array([lang] * len(keys)), "gram": keys.view(np.int64), "n": n})
            parts.clear()

        for batch in sliced(batches, "text"):
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            hashes, text, _ = _grams(batch.column(0).to_pylist(), size)
            owner = langs[text] if len(text) else np.zeros(0, dtype=object)
            for lang in set(langs):
                keys, n = np.unique(hashes[owner == lang], return_counts=True)
                if len(keys):
                    parts.setdefault(lang, []).append((keys, n))
                    held += len(keys)
            if held > 2_000_000:
                parts.update({lang: [_merged(found)] for lang, found in parts.items()})
                held = sum(len(found[0][0]) for found in parts.values())
                if held > 1_000_000:
                    yield from flush()
                    held = 0
        yield from flush()

    rows = labelled.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    return (
        rows.mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )


def train(
    labelled: DataFrame, gram: int = 3, share: float = 0.25, min_rate: float = 2e-5,
    n_hashes: int = 4, bits_per_gram: int = 24,
) -> LanguageModel:
    """Learn from all rows of ``labelled`` (text, lang); rows with a null in either teach nothing.

    A gram enters a language's filter if its rate there is at least ``min_rate``
    and at least ``share`` of its highest rate in any language. As rates add up
    to 1, a language has at most 1 / min_rate grams however large the corpus;
    that bounds what reaches the driver and what each task is sent.
    """
    counts = settled(gram_counts(labelled, gram))  # written once: the totals and the rates both need it
    totals = {r["lang"]: r["total"] for r in counts.groupBy("lang").agg(F.sum("n").alias("total")).collect()}
    languages = sorted(totals)
    if not languages:
        return LanguageModel([], np.zeros((1, 1), dtype=np.uint64), n_hashes, gram, np.zeros(0), 0)
    total = F.lit(0)
    index = F.lit(0)
    for i, lang in enumerate(languages):
        total = F.when(F.col("lang") == lang, F.lit(totals[lang])).otherwise(total)
        index = F.when(F.col("lang") == lang, F.lit(i)).otherwise(index)
    rates = (
        counts.select("gram", index.alias("lang"), (F.col("n") / total).alias("rate")).where(F.col("rate") >= min_rate)
        .groupBy("gram").agg(F.collect_list(F.struct("lang", "rate")).alias("by"), F.max("rate").alias("top"))
        .select("gram", F.expr(f"transform(filter(by, x -> x.rate >= {share} * top), x -> x.lang)").alias("langs"))
    )
    admitted = rates.toPandas()
    grams = admitted["gram"].to_numpy().astype(np.int64).view(np.uint64)
    slots = 1 << max(10, int(np.ceil(np.log2(max(1, len(grams)) * bits_per_gram))))
    words = (len(languages) + 63) // 64
    filters = np.zeros((slots, words), dtype=np.uint64)
    sizes = admitted["langs"].map(len).to_numpy().astype(np.int64)
    lang = np.concatenate([np.zeros(0, dtype=np.int64), *admitted["langs"].to_list()]).astype(np.int64)
    for at in _slots(np.repeat(grams, sizes), n_hashes, slots):
        np.bitwise_or.at(filters, (at, lang // 64), np.uint64(1) << (lang % 64).astype(np.uint64))
    fill = np.array([((filters[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))])
    fallback = max(range(len(languages)), key=lambda i: (totals[languages[i]], -i))
    return LanguageModel(languages, filters, n_hashes, gram, fill**n_hashes, fallback)


def _slots(grams: np.ndarray, n_hashes: int, slots: int) -> Iterator[np.ndarray]:
    step = mix(grams, 17) | np.uint64(1)
    for i in range(n_hashes):
        yield ((grams + np.uint64(i) * step) >> np.uint64(20)) & np.uint64(slots - 1)


def predict_texts(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; see :func:`predict`."""
    hashes, text, n_letters = _grams(texts, model.gram)
    n_langs = len(model.languages)
    if not n_langs:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    masks = np.full((len(hashes), model.filters.shape[1]), ~np.uint64(0))
    for at in _slots(hashes, model.n_hashes, len(model.filters)):
        masks &= model.filters[at]
    n = np.bincount(text, minlength=len(texts))
    hits = np.zeros((n_langs, len(texts)))
    for i in range(n_langs):
        found = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
        hits[i] = np.bincount(text, weights=found, minlength=len(texts))
    rate = model.false_rate[:, None]
    real = np.maximum(0, (hits - n * rate) / np.maximum(1e-9, 1 - rate))
    best = real.argmax(axis=0)
    top = real.max(axis=0)
    best = np.where(top > 0, best, model.fallback)
    score = np.clip(np.divide(top, n, out=np.zeros(len(texts)), where=n > 0), 0, 1)
    names = [model.languages[b] if k else UNDETERMINED for b, k in zip(best, n_letters)]
    return names, np.where(n_letters > 0, score, 0.0)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row of ``docs``, repeated rows included.

    ``score`` is the share of the text's grams that the language accounts for.
    A null text, or one without a letter, is ``und`` with score 0. A text with
    letters gets a learned language even if none of its grams is known: the one
    with most training text, with score 0. Ties go to the first name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            names, scores = predict_texts(shared.value, batch.column(1).to_pylist())
            yield pa.record_batch({id_col: batch.column(0), "lang_pred": pa.array(names, pa.string()), "score": scores})

    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    return rows.mapInArrow(label, f"`{id_col}` {id_type}, lang_pred string, score double")


def keep_identified(
    docs: DataFrame, model: LanguageModel, min_score: float = 0.2, text_col: str = "text"
) -> DataFrame:
    """All columns of the documents whose language is found with at least ``min_score``.

    Null texts, texts without letters and letter salad go; repeated rows are
    judged each on its own text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_col):
            names, scores = predict_texts(shared.value, batch.column(at).to_pylist())
            good = np.array([n != UNDETERMINED for n in names], dtype=bool) & (scores >= min_score)
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)


def held_out(id_col: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == remainder, F.lit(False))
