"""The seven tables the operators read, from a loaded extract or from the test data."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.money import MONEY
from tidemark.sources.storage import read_table


class Retail(NamedTuple):
    orders: DataFrame
    order_items: DataFrame
    product_variants: DataFrame
    products: DataFrame
    categories: DataFrame
    customers: DataFrame
    addresses: DataFrame


def loaded_tables(spark: SparkSession, root: str) -> Retail:
    """Tables written by the loader."""
    return Retail(*[read_table(spark, f"{root}/{name}") for name in Retail._fields])


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def testdata_tables(spark: SparkSession, sf_dir: str) -> Retail:
    """The star-schema test data under the retail names.

    A part is both product and variant, its brand the category, the customer's
    nation the state of the one primary address, the priority the sales channel.
    """
    orders = raw_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast(MONEY).alias("total"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderpriority").alias("channel"),
        F.col("o_orderstatus").alias("status"),
    )
    items = raw_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_variant_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").cast(MONEY).alias("line_total"),
    )
    part = raw_table(spark, sf_dir, "part")
    brand_number = F.regexp_extract("p_brand", r"\d+", 0).cast("int")
    customer = raw_table(spark, sf_dir, "customer")
    nation = raw_table(spark, sf_dir, "nation")
    return Retail(
        orders=orders,
        order_items=items,
        product_variants=part.select(
            F.col("p_partkey").alias("id"), F.col("p_partkey").alias("product_id")
        ),
        products=part.select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
            brand_number.alias("category_id"),
        ),
        categories=part.select(
            brand_number.alias("id"), F.col("p_brand").alias("name")
        ).distinct(),
        customers=customer.select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("legal_name")
        ),
        addresses=customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select(
            F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("state"),
            F.lit(True).alias("is_primary"),
        ),
    )


def supplier_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second set of addresses with several states per customer: nations of the suppliers bought from."""
    lines = raw_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    suppliers = raw_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    orders = raw_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        lines.join(suppliers, lines["l_suppkey"] == suppliers["s_suppkey"])
        .join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .select(F.col("o_custkey").alias("customer_id"), F.col("s_nationkey").alias("state"))
        .distinct()
    )
