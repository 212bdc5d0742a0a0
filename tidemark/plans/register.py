"""The table of registered queries, and the decorators that fill it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions import money
from tidemark.plans.tables import Retail, testdata_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    """Register a query; DECIMAL results leave as DOUBLE so that other engines can be compared."""

    def register(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: money.decimals_to_double(f(spark, sf_dir))
        return f

    return register


def retail_query(name: str):
    """Register a query that needs only the seven retail tables."""

    def register(f: Callable[[Retail], DataFrame]):
        query(name)(lambda spark, sf_dir: f(testdata_tables(spark, sf_dir)))
        return f

    return register
