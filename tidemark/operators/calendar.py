"""Date dimension and weekday means that count the days without a sale."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.dates import iso_weekday, weekday_name
from tidemark.functions.money import rounded_ratio


def calendar(orders: DataFrame) -> DataFrame:
    """Every day from the first to the last order of any channel."""
    day = F.to_date("created_at")
    span = orders.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).where("lo is not null")
    return span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("day")).select(
        "day", iso_weekday(F.col("day")).alias("isodow"), weekday_name(F.col("day")).alias("weekday")
    )


def daily_sales(orders: DataFrame, channel: str) -> DataFrame:
    """Sales per day of one channel; days without a sale are absent."""
    return (
        orders.where(F.col("channel") == channel)
        .groupBy(F.to_date("created_at").alias("day"))
        .agg(F.sum("total").alias("sales"))
    )


def calendar_sales(orders: DataFrame, channel: str) -> DataFrame:
    """The calendar with the sales of one channel, NULL on days without one.

    Equal to the calendar left-joined with ``daily_sales``, but from one scan:
    days on which only other channels sold come from the same group-by, and each
    day then fills the gap up to the next one. The window runs over one row per
    day, whatever the number of orders.
    """
    seen = (
        orders.groupBy(F.to_date("created_at").alias("seen"))
        .agg(F.sum(F.when(F.col("channel") == channel, F.col("total"))).alias("sales"))
        .where("seen is not null")
    )
    following = F.lead("seen").over(W.orderBy("seen"))
    last = F.coalesce(F.date_sub(following, 1), F.col("seen"))
    filled = seen.select("seen", "sales", last.alias("last")).select(
        "seen", "sales", F.explode(F.sequence("seen", "last", F.expr("interval 1 day"))).alias("day")
    )
    return filled.select(
        "day", iso_weekday(F.col("day")).alias("isodow"), weekday_name(F.col("day")).alias("weekday"),
        F.when(F.col("day") == F.col("seen"), F.col("sales")).alias("sales"),
    )


def weekday_mean(orders: DataFrame, channel: str) -> DataFrame:
    """Mean sales per weekday over all calendar days, and over days with a sale only."""
    return (
        calendar_sales(orders, channel)
        .groupBy("isodow", "weekday")
        .agg(
            rounded_ratio(F.coalesce(F.sum("sales"), F.lit(0)), F.count("day")).alias("mean_sales"),
            rounded_ratio(F.sum("sales"), F.count("sales")).alias("naive_mean"),
            F.count("day").alias("n_days"),
            F.count("sales").alias("n_sale_days"),
        )
        .orderBy("isodow")
    )


def weekday_extremes(means: DataFrame) -> DataFrame:
    """Worst and best weekday; the earlier one in the week wins a tie."""
    low = F.struct("mean_sales", "isodow")
    high = F.struct(F.col("mean_sales"), (-F.col("isodow")).alias("later"))
    return means.agg(
        F.min_by("weekday", low).alias("worst_day"), F.min("mean_sales").alias("worst_mean"),
        F.max_by("weekday", high).alias("best_day"), F.max("mean_sales").alias("best_mean"),
    )
