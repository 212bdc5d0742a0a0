"""Monthly demand per product and its recursive moving-average forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.dates import month_label, month_start, months_inclusive


def product_lines(
    orders: DataFrame, order_items: DataFrame, variants: DataFrame, product_id: int | None = None
) -> DataFrame:
    """Sold lines of all variants of a product (of every product by default) with their date."""
    v = variants.select(F.col("id").alias("product_variant_id"), "product_id")
    if product_id is not None:
        v = v.where(F.col("product_id") == product_id)
    dates = orders.select(F.col("id").alias("order_id"), "created_at")
    return (
        order_items.select("order_id", "product_variant_id", "quantity")
        .join(v, "product_variant_id")
        .join(dates, "order_id")
        .select("product_id", "order_id", "created_at", "quantity")
    )


def monthly_demand(
    orders: DataFrame, order_items: DataFrame, variants: DataFrame, product_id: int | None = None
) -> DataFrame:
    """Units per product and month with a sale.

    Units are summed per variant and month first, so the catalogue meets one row
    per variant and month, and a best-seller is no larger than its months.
    """
    v = variants.select(F.col("id").alias("product_variant_id"), "product_id")
    lines = order_items.select("order_id", "product_variant_id", "quantity")
    if product_id is not None:
        v = v.where(F.col("product_id") == product_id)
        lines = lines.join(v.select("product_variant_id"), "product_variant_id", "left_semi")
    months = orders.select(F.col("id").alias("order_id"), month_start(F.col("created_at")).alias("month"))
    return (
        lines.join(months, "order_id")
        .groupBy("product_variant_id", "month")
        .agg(F.sum("quantity").alias("units"))
        .join(v, "product_variant_id")
        .groupBy("product_id", "month")
        .agg(F.sum("units").alias("units"))
    )


def fill_months(demand: DataFrame) -> DataFrame:
    """Every month from a product's first to its last sale, with 0 where it sold nothing."""
    following = F.lead("month").over(W.partitionBy("product_id").orderBy("month"))
    last = F.coalesce(F.add_months(following, -1), F.col("month"))
    spread = demand.withColumn("last", last).select(
        "product_id", F.col("month").alias("sold"), "units",
        F.explode(F.sequence("month", "last", F.expr("interval 1 month"))).alias("month"),
    )
    return spread.select(
        "product_id", "month",
        F.when(F.col("month") == F.col("sold"), F.col("units")).otherwise(0).alias("units"),
    )


def _recursive_mean(seed: Column, k: int, horizon: int) -> Column:
    """``horizon`` forecasts, each the rounded mean of the k values before it, forecasts included.

    Halves round to the even number.
    """
    none = F.array().cast("array<double>")

    def step(state, _):
        mean = F.aggregate(state["window"], F.lit(0.0), lambda a, x: a + x) / k
        nxt = F.array(F.bround(mean, 0))
        return F.struct(
            F.concat(F.slice(state["window"], 2, k - 1), nxt).alias("window"),
            F.concat(state["out"], nxt).alias("out"),
        )

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(horizon)),
        F.struct(seed.alias("window"), none.alias("out")),
        step,
        lambda state: state["out"],
    )


def forecast_ma(demand: DataFrame, start: str, k: int = 3, horizon: int = 3) -> DataFrame:
    """Forecast against actual for the ``horizon`` months from ``start`` ('yyyy-MM').

    One group-by holds all it needs: the k months before ``start`` and the test
    months are sums under a condition, and an absent month inside the series is
    0. A product is forecast when its series reaches from the first window month
    to the last test month. The forecast uses no value from ``start`` on.
    """
    first = F.lit(f"{start}-01").cast("date")

    def month(offset: int) -> Column:
        return F.add_months(first, offset)

    def units_in(offset: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("month") == month(offset), F.col("units"))), F.lit(0))

    series = (
        demand.groupBy("product_id")
        .agg(
            F.min("month").alias("first_month"), F.max("month").alias("last_month"),
            F.sum("units").alias("all_units"),
            F.sum(F.when(F.col("month") < first, F.col("units"))).alias("past_units"),
            F.array(*[units_in(o).cast("double") for o in range(-k, 0)]).alias("seed"),
            F.array(*[units_in(o) for o in range(horizon)]).alias("actuals"),
        )
        .where((F.col("first_month") <= month(-k)) & (F.col("last_month") >= month(horizon - 1)))
    )
    both = F.arrays_zip(_recursive_mean(F.col("seed"), k, horizon).alias("p"), F.col("actuals").alias("a"))
    return series.select(
        "product_id",
        (F.col("all_units") / months_inclusive(F.col("first_month"), F.col("last_month"))).alias("mean_units"),
        (F.col("past_units") / months_inclusive(F.col("first_month"), month(-1))).alias("mean_before"),
        F.posexplode(both).alias("step", "m"),
    ).select(
        "product_id",
        month_label(F.add_months(first, F.col("step"))).alias("month"),
        F.col("m.p").cast("bigint").alias("predicted"),
        F.col("m.a").alias("actual"),
        "mean_units", "mean_before",
    )


def forecast_error(forecast: DataFrame) -> DataFrame:
    """Sums, mean absolute error, and the error in percent of the mean month.

    ``mean_units`` covers the whole series, test months included; ``mean_before``
    stops before the test.
    """
    return (
        forecast.groupBy("product_id")
        .agg(
            F.sum("predicted").alias("sum_predicted"),
            F.sum("actual").alias("sum_actual"),
            (F.sum(F.abs(F.col("predicted") - F.col("actual"))) / F.count(F.lit(1))).alias("mae"),
            F.max("mean_units").alias("mean_units"),
            F.max("mean_before").alias("mean_before"),
        )
        .withColumn("mae_pct", F.col("mae") / F.nullif("mean_units", F.lit(0.0)) * 100)
    )


def product_by_name(
    products: DataFrame, variants: DataFrame, order_items: DataFrame, name: str | None = None
) -> DataFrame:
    """Per name the id with the most sold lines, the smaller id on a tie."""
    named = products.select(F.col("id").alias("product_id"), "name")
    if name is not None:
        named = named.where(F.col("name") == name)
    v = variants.select(F.col("id").alias("product_variant_id"), "product_id")
    records = (
        order_items.groupBy("product_variant_id").agg(F.count(F.lit(1)).alias("n"))
        .join(v, "product_variant_id")
        .groupBy("product_id").agg(F.sum("n").alias("n"))
    )
    best = F.struct(F.col("n"), (-F.col("product_id")).alias("id_desc"))
    return (
        named.join(records, "product_id", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .groupBy("name")
        .agg(
            F.max_by("product_id", best).alias("product_id"),
            F.max("n").alias("n_records"),
            F.count(F.lit(1)).alias("n_ids"),
        )
    )
