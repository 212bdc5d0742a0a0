"""Queries with SQL against DuckDB, and the guard of the entry module."""

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    want = db.execute(SQL[name])
    names = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


def test_every_operator_is_registered_once():
    names = set(contract.queries())
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    assert set(SQL) <= set(contract.oracle_sql())
