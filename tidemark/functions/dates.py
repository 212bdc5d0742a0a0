"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names in ISO order, Monday first.
WEEKDAY_NAMES = [
    "Segunda-feira",
    "Terça-feira",
    "Quarta-feira",
    "Quinta-feira",
    "Sexta-feira",
    "Sábado",
    "Domingo",
]


def iso_weekday(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + 1


def weekday_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAY_NAMES]), iso_weekday(day))


def month_start(ts: Column) -> Column:
    """First day of the month of a date or timestamp, as DATE."""
    return F.trunc(ts.cast("date"), "MM")


def month_label(month: Column) -> Column:
    """2026-01-01 -> '2026-01'."""
    return F.date_format(month, "yyyy-MM")


def months_inclusive(first: Column, last: Column) -> Column:
    """Number of calendar months from ``first`` to ``last``, both counted (month starts)."""
    whole = (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first)
    return (whole + 1).cast("bigint")


def micros(ts: Column) -> Column:
    """Microseconds of a timestamp without zone since 1970, whatever the zone of the session."""
    seconds = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("long")
    within = seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    return F.unix_date(ts.cast("date")).cast("long") * 86_400_000_000 + within


def instant(ts: Column) -> Column:
    """A timestamp without zone, read as UTC, as the instant that watermarks need."""
    return F.timestamp_micros(micros(ts))


def wall_time(instant_: Column) -> Column:
    """The timestamp without zone that an instant has in UTC."""
    whole = F.unix_micros(instant_)
    zero = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    parts = F.make_dt_interval(
        F.floor(whole / 86_400_000_000).cast("int"), F.lit(0), F.lit(0), (F.pmod(whole, F.lit(86_400_000_000)) / F.lit(1_000_000).cast("decimal(10,0)")).cast("decimal(18,6)")
    )
    return zero + parts
