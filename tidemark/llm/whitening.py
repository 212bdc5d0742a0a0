"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance is never built. Each pass sends a thin block Q to the tasks and
sums X'(XQ) of the centred vectors. A polynomial recurrence over such passes
damps the unwanted end of the spectrum, QR and Rayleigh-Ritz turn the block to
the eigenvectors, and rounds go on until their residuals certify them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settled

#: Vectors of the block beside the wanted ones, passes of one filter, and passes that find the ends of the spectrum.
GUARD, DEGREE, BOUND_PASSES = 16, 10, 10
#: A component is certified when its residual is at most this share of the largest eigenvalue.
CERTIFIED = 2e-14
#: Residuals that no longer shrink are those of rounding and accepted up to this share.
ROUNDING = 1e-12
MOST_ROUNDS = 100
#: Entries of a block of vectors that numpy holds at a time.
_CELLS = 2_000_000


class Whitening(NamedTuple):
    """n vectors with exact sums per dimension, and their components by falling eigenvalue (columns of ``axes``)."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    axes: np.ndarray
    passes: int


def fixed_point(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, x) with whole numbers ``x = floor(1024 c) + 100000``, written once to the shared folder.

    Vectors that are null or hold a null or non-finite entry are left out, and of
    several lengths only the commonest stays (of equally common ones the longest;
    vectors without entries have no dimension and go). An entry beyond the range
    of a long is an error.
    """
    v = F.col(vec_col)
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * 1024) + 100_000)
    kept = settled(vectors.where(v.isNotNull() & (F.size(v) > 0)).where(~odd).select(F.col(id_col).alias("id"), x.alias("x")))
    common = kept.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return kept.where(F.size("x") == (common["d"] if common else 0))


def _blocks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows and their vectors as one matrix of whole numbers, in bounded parts."""
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            width = max(1, len(batch.column(column)[start]))
            part = batch.slice(start, max(1, _CELLS // width))
            start += part.num_rows
            yield part, np.asarray(part.column(column).flatten()).reshape(part.num_rows, -1)


def _summed(table: DataFrame, f: Callable[[np.ndarray], np.ndarray], rows: int, columns: int) -> np.ndarray:
    """The sum over all vectors of the matrices ``f(x)``: one per task, added up row by row in the shuffle."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rows, columns))
        for _, x in _blocks(batches, 0):
            total += f(x)
        flat = pa.array(total.ravel())
        yield pa.record_batch({
            "at": pa.array(np.arange(rows, dtype=np.int32)),
            "y": pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * columns), flat),
        })

    parts = table.select("x").mapInArrow(partial, "at int, y array<double>")
    found = parts.groupBy("at").agg(F.array(*[F.sum(F.col("y")[i]) for i in range(columns)]).alias("y")).collect()
    out = np.zeros((rows, columns))
    for at, y in found:
        out[at] = y
    return out


def _exact_sums(table: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of every dimension."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, 0):
            yield pa.record_batch({
                "at": pa.array(np.arange(x.shape[1], dtype=np.int32)),
                "n": pa.array(np.full(x.shape[1], part.num_rows)), "s": pa.array(x.sum(axis=0)),
            })

    parts = table.select("x").mapInArrow(partial, "at int, n long, s long")
    found = parts.groupBy("at").agg(F.sum("n"), F.sum(F.col("s").cast("decimal(38,0)"))).orderBy("at").collect()
    return (int(found[0][1]), [int(s) for _, _, s in found]) if found else (0, [])


def _centred(n: int, sums: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """Whole numbers less the mean, subtracted from the whole numbers so that nothing cancels."""
    base = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n for s in sums], dtype=np.float64) / n
    return lambda x: (x - base) - rest


def _low_end(times: Callable[[np.ndarray], np.ndarray], d: int, rng: np.random.Generator) -> float:
    """A lower estimate of the smallest eigenvalue from a few Lanczos steps."""
    q = rng.standard_normal(d)
    basis, diagonal, side = [q / np.linalg.norm(q)], [], []
    for _ in range(min(BOUND_PASSES, d)):
        w = times(basis[-1][:, None])[:, 0]
        diagonal.append(float(basis[-1] @ w))
        for _ in range(2):
            w = w - np.array(basis).T @ (np.array(basis) @ w)
        side.append(float(np.linalg.norm(w)))
        if side[-1] <= 1e-12 * max(map(abs, diagonal)):
            break
        basis.append(w / side[-1])
    inner = side[: len(diagonal) - 1]
    values, turns = np.linalg.eigh(np.diag(diagonal) + np.diag(inner, 1) + np.diag(inner, -1))
    return max(0.0, float(values[0] - abs(side[len(diagonal) - 1] * turns[-1, 0])))


def fit(table: DataFrame, k: int = 8, seed: int = 1) -> Whitening | None:
    """The first ``k`` components of the covariance (divisor n) of a ``fixed_point`` table; None without rows.

    Components whose eigenvalue is zero up to rounding are left out, as they
    cannot be whitened, so equal vectors have none. The driver holds a few blocks
    of (dimensions x (k + 16)) numbers, whatever the number of vectors.
    """
    n, sums = _exact_sums(table)
    if not n:
        return None
    d, centred, passes = len(sums), _centred(n, sums), 0
    trace = float(_summed(table, lambda x: np.square(centred(x)).sum().reshape(1, 1), 1, 1)[0, 0]) / n
    if trace <= 0:
        return Whitening(n, sums, 0.0, np.zeros(0), np.zeros((d, 0)), 1)

    def times(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def product(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            return c.T @ (c @ q)

        return _summed(table, product, d, q.shape[1]) / n

    rng = np.random.default_rng(seed)
    width, wanted = min(d, k + GUARD), min(d, k)
    low = _low_end(times, d, rng)
    block = np.linalg.qr(rng.standard_normal((d, width)))[0]
    image, best = times(block), np.inf
    for _ in range(MOST_ROUNDS):
        inner = block.T @ image
        values, turns = np.linalg.eigh((inner + inner.T) / 2)
        values, turns = values[::-1], turns[:, ::-1]
        block, image = block @ turns, image @ turns
        residual = float(np.linalg.norm(image - block * values, axis=0)[:wanted].max() / values[0])
        if residual <= CERTIFIED or (residual <= ROUNDING and residual > best / 2):
            real = values[:wanted] > 1e-12 * trace
            return Whitening(n, sums, trace, values[:wanted][real], block[:, :wanted][:, real], passes)
        best = min(best, residual)
        block = np.linalg.qr(_filtered(times, block, image, values, low))[0]
        image = times(block)
    raise ArithmeticError(f"components not certified after {MOST_ROUNDS} rounds, residual {residual:.1e}")


def _filtered(
    times: Callable[[np.ndarray], np.ndarray], block: np.ndarray, image: np.ndarray, values: np.ndarray, low: float
) -> np.ndarray:
    """The Chebyshev polynomial that is small between ``low`` and the block's smallest value and grows above, applied to the block.

    Scaled so that it is one at the largest value, which keeps numbers in range.
    """
    low = min(low, 0.999 * values[-1])
    centre, half = (values[-1] + low) / 2, max((values[-1] - low) / 2, 1e-9 * values[0])
    first = half / (values[0] - centre)
    before, now, scale = block, (image - centre * block) * (first / half), first
    for _ in range(DEGREE - 1):
        following = 1 / (2 / first - scale)
        before, now, scale = now, 2 * (following / half) * (times(now) - centre * now) - scale * following * before, following
    return now


def identity_error(table: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened vectors less the identity, over all rows."""
    k = len(model.values)
    if not k:
        return 0.0
    centred, axes = _centred(model.n, model.sums), model.axes / np.sqrt(model.values)

    def moments(x: np.ndarray) -> np.ndarray:
        z = centred(x) @ axes
        return np.vstack([z.T @ z, z.sum(axis=0)])

    found = _summed(table, moments, k + 1, k) / model.n
    return float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())


def transform(table: DataFrame, model: Whitening, id_col: str = "vec_id") -> DataFrame:
    """One row per vector and component: id, component (from 1), n, deviation, whitened, explained.

    ``deviation`` is the exact sum of ``(n x - S)^2`` over the dimensions, a
    DECIMAL(38,0), as it outgrows a long with some millions of vectors.
    """
    n, k, d = model.n, len(model.values), len(model.sums)
    centred, axes = _centred(n, model.sums), model.axes / np.sqrt(model.values)
    sums = np.array(model.sums, dtype=object)
    explained = model.values / model.trace

    def deviations(x: np.ndarray) -> pa.Array:
        if n * float(np.abs(x).max()) < 2**62 and max(map(abs, model.sums)) < 2**62:
            apart = n * x - sums.astype(np.int64)
            if float(np.abs(apart).max()) ** 2 * d < 2**62:
                return pa.array(np.square(apart).sum(axis=1)).cast(pa.decimal128(38, 0))
        apart = n * x.astype(object) - sums
        return pa.array([int(v) for v in (apart * apart).sum(axis=1)], pa.decimal128(38, 0))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, 1):
            at = pa.array(np.repeat(np.arange(part.num_rows), k))
            yield pa.record_batch({
                id_col: part.column(0).take(at), "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows)),
                "n": pa.array(np.full(part.num_rows * k, n)), "deviation": deviations(x).take(at),
                "whitened": pa.array((centred(x) @ axes).ravel()), "explained": pa.array(np.tile(explained, part.num_rows)),
            })

    id_type = table.schema["id"].dataType.simpleString()
    return table.select("id", "x").mapInArrow(
        rows, f"`{id_col}` {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double"
    )


def whiten(vectors: DataFrame, k: int = 8, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Fit on all usable vectors and whiten them: the rows of ``transform`` with ``identity_error``, one value for all.

    Repeated ids and vectors count as often as they occur; null ids stay. Without
    a usable vector, or when all are equal, there are no rows.
    """
    table = fixed_point(vectors, id_col, vec_col)
    model = fit(table, k) or Whitening(0, [], 0.0, np.zeros(0), np.zeros((0, 0)), 0)
    if not len(model.values):
        table = table.where("false")
        model = Whitening(1, [0], 1.0, np.ones(1), np.ones((1, 1)), model.passes)
        return transform(table, model, id_col).withColumn("identity_error", F.lit(0.0))
    return transform(table, model, id_col).withColumn("identity_error", F.lit(identity_error(table, model)))
