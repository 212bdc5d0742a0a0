"""Exact money arithmetic and Brazilian number text."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,2)"


def ratio(total: Column, n: Column) -> Column:
    """Exact decimal quotient of a money sum by a count; NULL when the count is 0."""
    return total / F.when(n != 0, n).cast("decimal(20,0)")


def rounded_ratio(total: Column, n: Column) -> Column:
    """Quotient rounded to cents, halves away from zero (as SQL NUMERIC rounds); ``total`` has whole cents.

    Computed on whole cents: a DECIMAL quotient keeps so few places when its
    terms are wide that rounding it would round twice.
    """
    cents = (total * 100).cast("decimal(37,0)")
    twice = (F.abs(cents) * 2 + n.cast("decimal(20,0)")).cast("decimal(38,0)")
    by = F.when(n != 0, n * 2).cast("decimal(20,0)")
    whole = ((twice - twice % by) / by).cast("decimal(36,0)")
    return (F.when(cents < 0, -whole).otherwise(whole) * F.lit(Decimal("0.01"))).cast("decimal(38,2)")


def plain_mean(total: Column, n: Column) -> Column:
    """Unrounded mean as DOUBLE. ``avg`` on DECIMAL would cut it after six digits."""
    return total.cast("double") / F.when(n != 0, n)


def number_br(value: Column, decimals: int = 1) -> Column:
    """1234.5 -> '1.234,5'."""
    return F.translate(F.format_number(value, decimals), ",.", ".,")


def money_br(value: Column) -> Column:
    """1234.56 -> 'R$ 1.234,56'."""
    return F.concat(F.lit("R$ "), number_br(value, 2))


def millions_br(value: Column) -> Column:
    """1234567.8 -> 'R$ 1,2 mi'."""
    return F.concat(F.lit("R$ "), number_br(value / 1e6, 1), F.lit(" mi"))


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Same frame with every DECIMAL column as DOUBLE, for engines that compare doubles."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
