import pytest


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with columns whose names an operator might use itself."""

    def build(rows, **more):
        schema = "doc_id long, text string, lang string, source string, n_chars long, id long, words long, pos int"
        full = [(i, t, more.get("lang", {}).get(i), "s", len(t or ""), 7, 8, 9) for i, t in rows]
        return spark.createDataFrame(full, schema)

    return build
