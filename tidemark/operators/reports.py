"""Report figures: revenue by state, anchor customers, product rankings.

Orders and lines are summed per customer or variant before any join, so the
joins run at customer or catalogue size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.money import money_br, millions_br, number_br, rounded_ratio
from tidemark.operators.customers import customer_sales


def kpis(orders: DataFrame, customers: DataFrame) -> DataFrame:
    n_customers = customers.agg(F.count(F.lit(1))).scalar()
    return orders.agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("total").alias("revenue"),
        rounded_ratio(F.sum("total"), F.count("total")).alias("mean_ticket"),
    ).withColumn("n_customers", n_customers)


def kpi_texts(kpi: DataFrame) -> DataFrame:
    """The same figures as Brazilian text."""
    return kpi.select(
        millions_br(F.col("revenue").cast("double")).alias("revenue_millions"),
        money_br(F.col("revenue")).alias("revenue"),
        number_br(F.col("n_orders"), 0).alias("orders"),
        money_br(F.col("mean_ticket")).alias("mean_ticket"),
        number_br(F.col("n_customers"), 0).alias("customers"),
    )


def primary_states(addresses: DataFrame) -> DataFrame:
    """(customer_id, state, copies): a customer with two primary addresses counts twice."""
    return (
        addresses.where("is_primary")
        .groupBy("customer_id", "state")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def primary_address_audit(customers: DataFrame, addresses: DataFrame) -> DataFrame:
    """Customers that the state reports drop (no primary address) or count twice."""
    n = primary_states(addresses).groupBy("customer_id").agg(F.sum("copies").alias("n"))
    found = F.coalesce("n", F.lit(0))
    return customers.select(F.col("id").alias("customer_id")).join(n, "customer_id", "left").agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.count_if(found == 0).alias("without_primary"),
        F.count_if(found == 1).alias("one_primary"),
        F.count_if(found > 1).alias("several_primaries"),
    )


def _sales_by_state(
    orders: DataFrame, addresses: DataFrame, statuses: list[str] | None = None
) -> DataFrame:
    """Sales of each customer in each state of a primary address."""
    return (
        customer_sales(orders, statuses)
        .join(primary_states(addresses), "customer_id")
        .withColumn("spent", F.col("revenue") * F.col("copies"))
    )


def revenue_by_state(
    orders: DataFrame, addresses: DataFrame, k: int | None = 10, statuses: list[str] | None = None
) -> DataFrame:
    """Revenue, distinct orders and distinct customers per state, best k.

    An order has one customer, so its distinct counts per state are sums over
    (customer, state) pairs and need no distinct aggregate over orders.
    """
    ranked = (
        _sales_by_state(orders, addresses, statuses)
        .groupBy("state")
        .agg(
            F.sum("spent").alias("revenue"),
            F.sum("frequency").alias("n_orders"),
            F.count(F.lit(1)).alias("n_customers"),
        )
        .orderBy(F.desc_nulls_last("revenue"), "state")
    )
    return ranked if k is None else ranked.limit(k)


def ticket_by_state(
    orders: DataFrame, addresses: DataFrame, k: int | None = 10, statuses: list[str] | None = None
) -> DataFrame:
    """Order rows and mean ticket per state, best tickets first.

    States are ranked by the mean in cents that is shown, so equal figures are ties and go by name.
    """
    rows = F.sum(F.col("frequency") * F.col("copies"))
    ranked = (
        _sales_by_state(orders, addresses, statuses)
        .groupBy("state")
        .agg(rows.alias("n_orders"), rounded_ratio(F.sum("spent"), rows).alias("mean_ticket"))
        .orderBy(F.desc_nulls_last("mean_ticket"), "state")
    )
    return ranked if k is None else ranked.limit(k)


def anchor_customers(
    orders: DataFrame,
    addresses: DataFrame,
    customers: DataFrame,
    k: int | None = 10,
    ties: bool = False,
    statuses: list[str] | None = None,
) -> DataFrame:
    """Best customer of each state, best k states; with ``ties`` all who share the first place.

    ``k`` counts states, never rows: a state that is in keeps all who share its first place.
    """
    names = customers.select(F.col("id").alias("customer_id"), "legal_name")
    spent = _sales_by_state(orders, addresses, statuses).join(names, "customer_id")
    by_spent = F.desc_nulls_last("spent")
    place = (
        F.rank().over(W.partitionBy("state").orderBy(by_spent))
        if ties
        else F.row_number().over(W.partitionBy("state").orderBy(by_spent, "customer_id"))
    )
    first = spent.withColumn("place", place).where("place = 1").select("state", "customer_id", "legal_name", "spent")
    if k is not None and ties:
        states = first.groupBy("state").agg(F.max("spent").alias("best")).orderBy(F.desc_nulls_last("best"), "state").limit(k)
        first = first.join(states.select("state"), "state", "left_semi")
    ranked = first.orderBy(by_spent, "state", "customer_id")
    # Without ties a state has one row, so the best rows are those of the best states.
    return ranked if k is None or ties else ranked.limit(k)


def top_products(
    order_items: DataFrame,
    variants: DataFrame,
    products: DataFrame,
    orders: DataFrame | None = None,
    addresses: DataFrame | None = None,
    state: str | None = None,
    k: int | None = 10,
) -> DataFrame:
    """Products by units sold, keyed by id, with their revenue.

    With ``state`` only lines of customers whose primary address is there count
    (once per such address); this needs ``orders`` and ``addresses``.
    """
    lines = order_items.select("order_id", "product_variant_id", "quantity", "line_total")
    copies = F.lit(1)
    if state is not None:
        local = primary_states(addresses).where(F.col("state") == state).select("customer_id", "copies")
        local_orders = orders.select(F.col("id").alias("order_id"), "customer_id").join(
            local, "customer_id"
        ).select("order_id", "copies")
        lines = lines.join(local_orders, "order_id")
        copies = F.col("copies")
    v = variants.select(F.col("id").alias("product_variant_id"), "product_id")
    p = products.select(F.col("id").alias("product_id"), "name")
    ranked = (
        lines.groupBy("product_variant_id")
        .agg(
            F.sum(F.col("quantity") * copies).alias("units"),
            F.sum(F.col("line_total") * copies).alias("revenue"),
        )
        .join(v, "product_variant_id")
        .groupBy("product_id")
        .agg(F.sum("units").alias("units"), F.sum("revenue").alias("revenue"))
        .join(p, "product_id")
        .select("product_id", "name", "units", "revenue")
        .orderBy(F.desc_nulls_last("units"), "product_id")
    )
    return ranked if k is None else ranked.limit(k)


def ranking_spread(ranking: DataFrame, value: str = "units") -> DataFrame:
    """Distance between the first and the last of a ranking, in percent of the first."""
    return ranking.agg(F.max(value).alias("first"), F.min(value).alias("last")).withColumn(
        "spread_pct", (F.col("first") - F.col("last")) * 100.0 / F.nullif("first", F.lit(0))
    )


def multi_state_customers(
    orders: DataFrame,
    addresses: DataFrame,
    customers: DataFrame,
    min_states: int = 2,
    k: int | None = 5,
    statuses: list[str] | None = None,
) -> DataFrame:
    """Best customers among those with addresses in several states.

    States and spending are counted apart and joined per customer, since a join
    of orders with addresses would repeat every order.
    """
    states = (
        addresses.groupBy("customer_id")
        .agg(F.count_distinct("state").alias("n_states"))
        .where(F.col("n_states") >= min_states)
    )
    names = customers.select(F.col("id").alias("customer_id"), "legal_name")
    ranked = (
        customer_sales(orders, statuses)
        .join(states, "customer_id")
        .join(names, "customer_id")
        .select("customer_id", "legal_name", "n_states", F.col("revenue").alias("spent"))
        .orderBy(F.desc_nulls_last("spent"), "customer_id")
    )
    return ranked if k is None else ranked.limit(k)


def common_products(ranking_a: DataFrame, ranking_b: DataFrame) -> DataFrame:
    """Product ids that two rankings share."""
    return ranking_a.select("product_id").intersect(ranking_b.select("product_id"))


def leads_overall(multi_state: DataFrame, sales: DataFrame) -> DataFrame:
    """Whether the best multi-state customer is also the best of all customers."""

    def first(ranked: DataFrame, value: str):
        return ranked.orderBy(F.desc_nulls_last(value), "customer_id").limit(1)

    best = first(sales, "revenue").select("customer_id").scalar()
    return first(multi_state, "spent").select(
        F.col("customer_id").alias("multi_state_customer"),
        best.alias("top_customer"),
        (F.col("customer_id") == best).alias("same"),
    )
