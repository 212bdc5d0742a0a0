"""Profile of one table: size, summary, outliers, duplicates, NULLs, consistency."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import plain_mean
from tidemark.operators.quantiles import exact_quantiles, quantile_values

# Names and cells that stand for no real record.
PLACEHOLDERS = ["asdf", "test", "??", "n/a", "tbd"]


def order_summary(orders: DataFrame, date: str = "created_at", amount: str = "total") -> DataFrame:
    """Row count, date range, and smallest, largest and mean amount, in one scan."""
    return orders.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.min(amount).alias("min_amount"),
        F.max(amount).alias("max_amount"),
        plain_mean(F.sum(amount), F.count(amount)).alias("mean_amount"),
    )


def table_shape(df: DataFrame) -> DataFrame:
    """Rows, columns and column names."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(", ".join(df.columns)).alias("column_names"),
    )


def text_date_range(df: DataFrame, column: str) -> DataFrame:
    """First and last moment of a date column that was read as text."""
    moment = F.col(column).cast("timestamp_ntz")
    return df.agg(F.min(moment).alias("first_date"), F.max(moment).alias("last_date"))


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum in one row."""
    q = quantile_values(df, column, [0.25, 0.5, 0.75])
    value = F.col(column)
    return df.agg(
        F.count(value).alias("n"),
        plain_mean(F.sum(value), F.count(value)).alias("mean"),
        F.stddev_samp(value.cast("double")).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ).select(
        "n", "mean", "std", "min",
        *[F.lit(q[p]).cast("double").alias(f"q{p * 100:.0f}") for p in sorted(q)],
        "max",
    )


def preview(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """First rows. A distributed table has no row order, so the keys give one."""
    return df.orderBy(*keys).limit(n)


def median(df: DataFrame, column: str) -> DataFrame:
    return exact_quantiles(df, column, [0.5]).select(F.col("value").alias("median"))


def iqr_outliers(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Fences at ``factor`` quartile ranges beyond the quartiles, and the rows outside them."""
    q = quantile_values(df, column, [0.25, 0.75])
    v = F.col(column).cast("double")
    q1, q3 = [F.lit(q[p]).cast("double") for p in (0.25, 0.75)]
    low, high = q1 - (q3 - q1) * factor, q3 + (q3 - q1) * factor
    return df.agg(
        F.count(v).alias("n"),
        F.count_if(v < low).alias("n_low"),
        F.count_if(v > high).alias("n_high"),
    ).select(
        "n", low.alias("lower_fence"), high.alias("upper_fence"), "n_low", "n_high",
        (F.col("n_high") * 100.0 / F.nullif("n", F.lit(0))).alias("pct_high"),
        ((F.col("n_low") + F.col("n_high")) * 100.0 / F.nullif("n", F.lit(0))).alias("pct_outside"),
    )


def duplicate_count(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Keys seen more than once and the surplus rows; without keys, whole rows are compared."""
    groups = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.count_if(F.col("copies") > 1).alias("n_repeated"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("n_surplus"),
    )


def inconsistent_rows(df: DataFrame, left: Column, right: Column) -> DataFrame:
    """Rows where two expressions that should agree differ."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(left != right).alias("n_different")
    )


def amount_mismatches(orders: DataFrame) -> DataFrame:
    """Orders whose subtotal less discount is not the total, in exact decimals."""
    return inconsistent_rows(
        orders, F.col("subtotal") - F.col("discount_amount"), F.col("total")
    )


def line_total_mismatches(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Orders with lines whose total is not the sum of the lines."""
    lines = order_items.groupBy("order_id").agg(F.sum("line_total").alias("lines_total"))
    both = orders.join(lines, orders["id"] == lines["order_id"])
    return inconsistent_rows(both, F.col("lines_total"), F.col("total"))


def null_profile(df: DataFrame) -> DataFrame:
    """NULL rows and percent per column, from one scan that keeps one row per task."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)],
    )
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("n_null"))
        for i, c in enumerate(df.columns)
    ]
    return counts.select("n_rows", F.explode(F.array(*pairs)).alias("p")).select(
        "p.column", "p.n_null",
        (F.col("p.n_null") * 100.0 / F.nullif("n_rows", F.lit(0))).alias("pct_null"),
    )


def null_by_group(df: DataFrame, column: str, group: str) -> DataFrame:
    """Where the NULLs of a column sit: per group, and as a share of all NULLs."""
    groups = df.groupBy(F.col(group).alias("group")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(column).isNull()).alias("n_null")
    )
    total = groups.agg(F.sum("n_null")).scalar()
    return groups.select(
        "group", "n_rows", "n_null",
        (F.col("n_null") * 100.0 / F.col("n_rows")).alias("pct_null"),
        (F.col("n_null") * 100.0 / F.nullif(total, F.lit(0))).alias("share_of_nulls"),
    )


def repeated_names(df: DataFrame, key: str = "id", name: str = "name") -> DataFrame:
    """Every record whose name several ids share, one row each, so that no group is collected."""
    shared = (
        df.groupBy(name).agg(F.count_distinct(key).alias("n_ids")).where("n_ids > 1")
    )
    return df.join(shared, name).select(F.col(name).alias("name"), F.col(key).alias("id"), "n_ids")


def placeholder_records(
    df: DataFrame, columns: list[str], words: list[str] | None = None
) -> DataFrame:
    """Rows with a filler such as 'asdf' in one of the columns, whatever its case or outer blanks."""
    words = PLACEHOLDERS if words is None else words
    return df.where(reduce(or_, [F.lower(F.trim(c)).isin(words) for c in columns]))
