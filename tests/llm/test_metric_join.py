import numpy as np
import pytest

from tidemark.llm import metric_join


def brute(rows, cosine):
    good = {k: np.array(v, dtype=np.float64) for k, (i, v) in enumerate(rows)
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    near = {k: [j for j in good if j != k and len(good[j]) == len(v) and
                v @ good[j] / np.sqrt(v @ v) / np.sqrt(good[j] @ good[j]) >= cosine] for k, v in good.items()}
    label = {k: rows[k][0] for k in good}
    for _ in rows:
        for k, others in near.items():
            label[k] = min([label[k], *(label[j] for j in others)])
    return sorted((str(i), len(near.get(k, [])), str(label.get(k, i)), i is None or label.get(k, i) == i) for k, (i, _) in enumerate(rows))


def found(df):
    return sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in df.collect())


@pytest.mark.parametrize("options", [{}, {"per_cell": 20, "block": 15, "sample": 64}])
def test_equals_brute_force(spark, options):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 8))
    rows = [(int(i), [float(x) for x in centres[rng.integers(12)] + rng.normal(scale=0.12, size=8)]) for i in rng.permutation(160)]
    rows += [(500 + i, rows[0][1]) for i in range(5)]  # copies
    vectors = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, n long, root long")
    assert found(metric_join.near_vectors(vectors, cosine=0.9, **options)) == brute(rows, 0.9)


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [2.0, 0.1]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]),
            (9, [1.0, 0.0, 0.0]), (10, [1.0, 0.01, 0.0]), (None, [1.0, 0.0]), (11, [1e200, 0.0]), (12, [-1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(metric_join.near_vectors(vectors))
    # 1e200 squared overflows in the plain rule, not in the operator: it is parallel to 1 and 2.
    assert [r for r in got if r[0] in ("3", "4", "5", "6", "7", "8", "None", "12")] == sorted(
        (i, 0, i, True) for i in ("3", "4", "5", "6", "7", "8", "None", "12"))
    assert [r for r in got if r[0] in ("1", "2", "9", "10", "11")] == sorted(
        [("1", 3, "1", True), ("2", 3, "1", False), ("2", 3, "1", False), ("9", 1, "9", True), ("10", 1, "9", False), ("11", 3, "1", False)])
    assert metric_join.near_vectors(vectors.where("vec_id < 0")).count() == 0


def test_border_is_exact(spark):
    # Cosines a hair above and below the threshold.
    c = 0.95
    rows = [(1, [1.0, 0.0])] + [(10 + k, [c + d, float(np.sqrt(1 - (c + d) ** 2))]) for k, d in enumerate((1e-9, -1e-9, 1e-6, -1e-6))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    links = {r["vec_id"]: r["n_links"] for r in metric_join.near_vectors(vectors).collect()}
    assert links == {1: 2, 10: 4, 11: 3, 12: 4, 13: 3}
