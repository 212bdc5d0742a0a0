import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import whitening
from tidemark.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, n int, x int, row int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in vectors], SCHEMA)


def reference(x, k):
    """Eigenvectors of the covariance by numpy, from exactly centred whole numbers."""
    centred = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(x))
    return centred, values[::-1][:k], axes[:, ::-1][:, :k]


def test_query_equals_numpy(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op13_chebyshev_whitening"](spark, sf).toPandas()
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for _, v in vectors])
    centred, values, axes = reference(x, 8)
    want = centred @ axes / np.sqrt(values)
    at = {i: row for row, (i, _) in enumerate(vectors)}
    assert len(rows) == 8 * len(vectors) and set(rows["n"]) == {len(vectors)}
    n, total = len(x), x.sum(axis=0)
    for k in range(8):
        own = rows[rows["component"] == k + 1]
        place = own["vec_id"].map(at).to_numpy()
        got = own["whitened"].to_numpy()
        sign = np.sign(got @ want[place, k])
        assert np.abs(got * sign - want[place, k]).max() < 1e-9
        assert np.allclose(own["explained"], values[k] / np.square(centred).sum(axis=1).mean(), rtol=1e-10)
        assert (own["deviation"].to_numpy() == np.square(n * x - total).sum(axis=1)[place]).all()
    assert rows["identity_error"].nunique() == 1 and rows["identity_error"].max() < 1e-9


@pytest.mark.parametrize("d, k", [(3, 8), (40, 8), (120, 5)])
def test_other_widths(spark, d, k):
    rng = np.random.default_rng(d)
    x = (rng.standard_normal((400, d)) * np.geomspace(3, 0.05, d)).astype(np.float32)
    model = whitening.fit(whitening.fixed_point(table(spark, [(i, v.tolist()) for i, v in enumerate(x)])), k)
    whole = np.floor(1024 * x.astype(float)) + 100_000
    _, values, axes = reference(whole, min(k, d))
    assert np.allclose(model.values, values, rtol=1e-11)
    assert np.abs(np.abs((model.axes * axes).sum(axis=0)) - 1).max() < 1e-11
    assert model.passes < 120


def test_equal_eigenvalues_and_lost_rank(spark):
    rows = [(i, [float((i >> b) & 1) for b in range(4)] + [0.0]) for i in range(16)]
    model = whitening.fit(whitening.fixed_point(table(spark, rows)))
    assert len(model.values) == 4 and np.allclose(model.values, 1024**2 / 4)
    out = whitening.whiten(table(spark, rows))
    assert out.count() == 64 and out.agg(F.max("identity_error")).first()[0] < 1e-9


def test_edges(spark):
    good = [(i, [float(i % 5), float(i % 3), 0.5]) for i in range(30)]
    odd = [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan"), 1.0, 1.0]), (103, [float("inf"), 1.0, 1.0]), (104, []), (105, [1.0, 2.0])]
    rows = good + odd + [(None, [9.0, 1.0, 0.5]), (3, [9.0, 1.0, 0.5])]
    got = whitening.whiten(table(spark, rows)).collect()
    assert len(got) == 32 * 2 and {r["n"] for r in got} == {32} and sum(r["vec_id"] is None for r in got) == 2
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
    assert whitening.whiten(table(spark, odd[:5])).count() == 0
    empty = whitening.whiten(table(spark, []))
    assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviation_stays_exact_beyond_a_long(spark):
    rows = [(1, [3e12, 0.0]), (2, [0.0, 1e10]), (3, [1.0, 1.0])]
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for _, v in rows]
    want = {i + 1: sum((3 * v[j] - sum(u[j] for u in x)) ** 2 for j in range(2)) for i, v in enumerate(x)}
    assert {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(table(spark, rows)).collect()} == want
