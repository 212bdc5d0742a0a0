"""Customer value: average ticket, category diversity, the elite group and what it buys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import ratio


def with_status(orders: DataFrame, statuses: list[str] | None) -> DataFrame:
    """Orders in the given states; all of them by default."""
    return orders if statuses is None else orders.where(F.col("status").isin(statuses))


def variant_categories(variants: DataFrame, products: DataFrame) -> DataFrame:
    """(product_variant_id, product_id, category_id); a join of catalogue tables only."""
    v = variants.select(F.col("id").alias("product_variant_id"), "product_id")
    p = products.select(F.col("id").alias("product_id"), "category_id")
    return v.join(p, "product_id")


def customer_sales(
    orders: DataFrame, statuses: list[str] | None = None, unique_orders: bool = True
) -> DataFrame:
    """Revenue and number of distinct orders per customer.

    The loader refuses an orders table with a repeated id, so rows are orders
    and the shuffle carries one partial row per customer and task. For tables
    from elsewhere ``unique_orders=False`` counts ids, which shuffles the orders.
    """
    n = F.count("id") if unique_orders else F.count_distinct("id")
    return (
        with_status(orders, statuses)
        .groupBy("customer_id")
        .agg(F.sum("total").alias("revenue"), n.alias("frequency"))
    )


def customer_diversity(
    orders: DataFrame,
    order_items: DataFrame,
    variants: DataFrame,
    products: DataFrame,
    statuses: list[str] | None = None,
) -> DataFrame:
    """Distinct categories per customer.

    The lines are narrowed to (order, category) before they meet the orders.
    The distinct count works on (customer, category) pairs that each task has
    already reduced, so a customer with most of the lines weighs no more than
    its number of categories.
    """
    bought = order_items.select("order_id", "product_variant_id").join(
        variant_categories(variants, products), "product_variant_id"
    ).select("order_id", "category_id")
    owners = with_status(orders, statuses).select(F.col("id").alias("order_id"), "customer_id")
    return (
        bought.join(owners, "order_id")
        .groupBy("customer_id")
        .agg(F.count_distinct("category_id").alias("diversity"))
    )


def customer_metrics(sales: DataFrame, diversity: DataFrame) -> DataFrame:
    """Average ticket (revenue per order, unrounded) beside the diversity of each customer."""
    return sales.join(diversity, "customer_id").select(
        "customer_id", "revenue", "frequency",
        ratio(F.col("revenue"), F.col("frequency")).alias("ticket"),
        "diversity",
    )


def elite(metrics: DataFrame, min_diversity: int = 13, k: int = 10) -> DataFrame:
    """The k best tickets among customers of enough categories; the id breaks ties."""
    return (
        metrics.where(F.col("diversity") >= min_diversity)
        .orderBy(F.desc_nulls_last("ticket"), "customer_id")
        .limit(k)
    )


def elite_customers(metrics: DataFrame, min_diversity: int = 13, k: int = 10) -> DataFrame:
    """The elite with the ticket rounded only after it has been ranked."""
    return elite(metrics, min_diversity, k).withColumn("ticket", F.round("ticket", 2))


def group_categories(
    members: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    variants: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    k: int | None = 1,
) -> DataFrame:
    """Categories by units bought in a group of customers, best first; all of them if k is None.

    Units are summed per variant before the catalogue is joined. Whether
    ``members`` is small enough to broadcast is left to the planner.
    """
    ids = members.select("customer_id")
    group_orders = orders.join(ids, "customer_id", "left_semi").select(F.col("id").alias("order_id"))
    units = (
        order_items.select("order_id", "product_variant_id", "quantity")
        .join(group_orders, "order_id")
        .groupBy("product_variant_id")
        .agg(F.sum("quantity").alias("units"))
    )
    names = categories.select(F.col("id").alias("category_id"), F.col("name").alias("category"))
    ranked = (
        units.join(variant_categories(variants, products), "product_variant_id")
        .groupBy("category_id")
        .agg(F.sum("units").alias("units"))
        .join(names, "category_id")
        .select("category_id", "category", "units")
        .orderBy(F.desc_nulls_last("units"), "category_id")
    )
    return ranked if k is None else ranked.limit(k)


def ticket_range(members: DataFrame) -> DataFrame:
    return members.agg(F.min("ticket").alias("min_ticket"), F.max("ticket").alias("max_ticket"))
