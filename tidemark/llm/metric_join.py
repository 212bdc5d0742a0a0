"""Near-duplicate embeddings by an exact metric range join over pivots.

On unit vectors a cosine of at least c is a distance of at most
r = sqrt(2 - 2 c). Every vector belongs to the cell of its nearest pivot. By the
triangle inequality a vector can have a partner in another cell only if it lies
within r of the border between the two and within r of the cell's farthest
member; it is sent there as a guest. Each cell is then joined by itself, in
blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components
from tidemark.session import settled, small_rows

#: Beyond any rounding of the single-precision products that pick candidates.
_MARGIN = 1e-4


def _usable(vector: str) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    return F.expr(
        f"coalesce(size({vector}) > 0 AND forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) "
        f"AND exists({vector}, x -> x != 0), false)"
    )


def _matrix(column: pa.Array | pd.Series, kind: str, dim: int) -> np.ndarray:
    parts = column.to_pylist() if isinstance(column, pa.Array) else column.tolist()
    return np.frombuffer(b"".join(parts), dtype=kind).reshape(-1, dim)


def _unit(rows: np.ndarray) -> np.ndarray:
    wide = rows.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)  # no overflow in the squares
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


def _spread(sample: np.ndarray, count: int) -> np.ndarray:
    """``count`` rows of the sample, each the farthest from those before it."""
    chosen = [0]
    nearest = 2 - 2 * sample @ sample[0]
    while len(chosen) < min(count, len(sample)):
        at = int(nearest.argmax())
        if nearest[at] <= 1e-12:
            break
        chosen.append(at)
        nearest = np.minimum(nearest, 2 - 2 * sample @ sample[at])
    return sample[chosen]


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * points @ pivots.T))


class _Forest:
    """Connected sets of block-local numbers; the smallest number stands for its set."""

    def __init__(self, size: int):
        self.up = np.arange(size)

    def _flatten(self) -> None:
        while True:
            over = self.up[self.up]
            if np.array_equal(over, self.up):
                return
            self.up = over

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            a, b = self.up[a], self.up[b]
            low, high = np.minimum(a, b), np.maximum(a, b)
            apart = low != high
            if not apart.any():
                return
            a, b = low[apart], high[apart]
            np.minimum.at(self.up, b, a)
            self._flatten()


def _linked(queries: np.ndarray, data: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, data) of unit vectors with a cosine of at least ``least``, a strip of queries at a time."""
    narrow_q, narrow_d = queries.astype(np.float32), data.astype(np.float32)
    for at in range(0, len(queries), 256):
        near = narrow_q[at : at + 256] @ narrow_d.T
        q, d = np.nonzero(near >= least - _MARGIN)
        unsure = near[q, d] < least + _MARGIN
        if unsure.any():
            exact = np.einsum("ij,ij->i", queries[at + q[unsure]], data[d[unsure]])
            keep = np.ones(len(q), dtype=bool)
            keep[np.flatnonzero(unsure)[exact < least]] = False
            q, d = q[keep], d[keep]
        if len(q):
            yield q + at, d


def near_vectors(
    vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding",
    per_cell: int = 8192, block: int = 8192, sample: int = 16_384, most_pivots: int = 1024,
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``.

    ``n_links``: other rows with a cosine of at least ``cosine`` (0 < cosine < 1);
    ``component_id``: smallest id reachable by such links; ``kept``: it is the own
    id. The join is exact in double precision. Equal vectors are joined once and
    counted as often as they occur. Pivots are spread over ``sample`` vectors
    picked by a hash of the id; they only steer the work.

    Vectors that are null, empty, all zero or hold a null or non-finite component
    link with nothing, nor do vectors of different lengths with each other or
    rows with a null id (whose component is null; they are kept). Rows that
    repeat an id count as further rows.
    """
    element = vectors.schema[vec_col].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    if kind == "<f8":
        rows = rows.withColumn("vec", F.col("vec").cast("array<double>"))
    good = rows.where(_usable("vec") & F.col("id").isNotNull())
    classes = settled(good.groupBy("vec").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")))
    sizes = [r[0] for r in classes.select(F.size("vec")).distinct().collect()]  # one length per kind of embedding
    parts = [
        _joined(settled(classes.where(F.size("vec") == dim)) if len(sizes) > 1 else classes, dim, kind, cosine, per_cell, block, sample, most_pivots)
        for dim in sizes
    ]
    found = small_rows(vectors.sparkSession, [], {"id": pa.int64(), "n": pa.int64(), "root": pa.int64()})
    for part in parts:
        found = found.unionAll(part)
    found = settled(found)
    counts = found.groupBy("id").agg(F.sum("n").alias("links"))
    label = components(found.where("root IS NOT NULL").select(F.col("id").alias("a"), F.col("root").alias("b")))
    per_class = (
        classes.join(counts, F.col("rep") == F.col("id"), "left").drop("id")
        .join(label, F.col("rep") == F.col("id"), "left")
        .select(
            "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    marked = rows.withColumn("key", F.when(_usable("vec") & F.col("id").isNotNull(), F.col("vec")))
    joined = marked.join(per_class.withColumnRenamed("vec", "key"), "key", "left")
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _joined(
    classes: DataFrame, dim: int, kind: str, cosine: float, per_cell: int, block: int, sample: int, most_pivots: int
) -> DataFrame:
    """(id, n, root): links of distinct vectors of one length, summed per block, and a spanning forest of them."""
    spark = classes.sparkSession
    total = classes.count()
    cells = max(1, min(most_pivots, -(-total // per_cell)))
    picked = classes.orderBy(F.xxhash64("rep"), "rep").limit(min(sample, 16 * cells)).select("vec").collect()
    pivots = spark.sparkContext.broadcast(_spread(_unit(np.array([r[0] for r in picked], dtype=kind)), cells))
    radius = float(np.sqrt(2 - 2 * cosine)) + 1e-6

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.asarray(batch.column(2).flatten()).astype(kind).reshape(-1, dim)
            away = _distances(_unit(flat), pivots.value)
            cell = away.argmin(axis=1)
            yield pa.record_batch({
                "id": batch.column(0), "n": batch.column(1), "vec": pa.array([v.tobytes() for v in flat], pa.binary()),
                "cell": cell, "away": away[np.arange(len(cell)), cell],
            })

    homes = settled(classes.select("rep", "n", "vec").mapInArrow(home, "id long, n long, vec binary, cell long, away double"))
    reach = {r["cell"]: (r["far"], r["n"]) for r in homes.groupBy("cell").agg(F.max("away").alias("far"), F.count(F.lit(1)).alias("n")).collect()}
    shape = spark.sparkContext.broadcast(reach)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = pivots.value
        between = np.maximum(_distances(points, points), 1e-9)
        far = np.array([shape.value.get(c, (-np.inf, 0))[0] for c in range(len(points))])
        for batch in batches:
            away = _distances(_unit(_matrix(batch.column(2), kind, dim)), points)
            cell = np.asarray(batch.column(3))
            nearest = away[np.arange(len(cell)), cell]
            border = (away**2 - nearest[:, None] ** 2) / (2 * between[cell])
            there = (border <= radius) & (away <= far + radius)
            there[np.arange(len(cell)), cell] = True
            row, into = np.nonzero(there)
            yield pa.record_batch({
                "cell": into, "guest": into != cell[row], "id": batch.column(0).take(pa.array(row)),
                "n": batch.column(1).take(pa.array(row)), "vec": batch.column(2).take(pa.array(row)),
            })

    dealt = settled(homes.mapInArrow(deal, "cell long, guest boolean, id long, n long, vec binary"))
    held = {r["cell"]: r["n"] for r in dealt.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    # A cell of h own and t rows in all is joined as ceil(h / block) x ceil(t / block) blocks, each a bounded group.
    ways = [(c, -(-reach[c][1] // block), -(-held[c] // block)) for c in reach]
    table = small_rows(spark, ways, {"cell": pa.int64(), "across": pa.int64(), "down": pa.int64()})
    spots = dealt.join(F.broadcast(table), "cell")  # a row per pivot, at most most_pivots
    i, j = F.pmod(F.xxhash64("id"), F.col("across")), F.pmod(F.xxhash64("id", F.lit(1)), F.col("down"))
    as_query = spots.where("NOT guest").select(
        "cell", i.alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("down") - 1)).alias("j"), F.lit(True).alias("query"), "id", "n", "vec"
    )
    as_data = spots.select(
        "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("across") - 1)).alias("i"), j.alias("j"), F.lit(False).alias("query"), "id", "n", "vec"
    )

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        asks = rows["query"].to_numpy()
        ids, weights = rows["id"].to_numpy(), rows["n"].to_numpy()
        q, d = np.flatnonzero(asks), np.flatnonzero(~asks)
        links = np.zeros(len(q), dtype=np.int64)
        order = np.unique(ids)
        forest = _Forest(len(order))
        local = np.searchsorted(order, ids)
        if len(q) and len(d):
            unit = _unit(_matrix(rows["vec"], kind, dim))
            for a, b in _linked(unit[q], unit[d], cosine):
                other = ids[q[a]] != ids[d[b]]
                a, b = a[other], b[other]
                links += np.bincount(a, weights=weights[d[b]], minlength=len(q)).astype(np.int64)
                forest.join(local[q[a]], local[d[b]])
        linked = np.flatnonzero(forest.up != np.arange(len(order)))
        some = links > 0
        return pd.concat([
            pd.DataFrame({"id": ids[q[some]], "n": links[some], "root": None}),
            pd.DataFrame({"id": order[linked], "n": 0, "root": order[forest.up[linked]]}),
        ]).astype({"id": "int64", "n": "int64", "root": "Int64"})

    blocks = as_query.unionAll(as_data).groupBy("cell", "i", "j")
    return blocks.applyInPandas(join, "id long, n long, root long")
