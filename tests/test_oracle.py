"""Every registered query against its SQL in DuckDB on the same parquet files."""

import math
import os
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.plans.oracle import SQL
from tidemark.plans.registry import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        raise AssertionError("DECIMAL left in a result")
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([_plain(r[i]) for i in order] for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    got = QUERIES[name](spark, SF_DIR)
    want = db.execute(SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    expected = _rows(names, want.fetchall())
    found = _rows(got.columns, got.collect())
    assert len(found) == len(expected)
    types = lambda rows: [type(v).__name__ for v in rows[0]] if rows else []
    assert found == expected
    assert types(found) == types(expected)


def test_entry(spark):
    assert contract.entry(spark).columns == ["customer_id", "revenue", "frequency", "ticket", "diversity"]
