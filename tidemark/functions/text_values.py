"""What a raw CSV cell looks like: code, boolean, integer, number, date or text.

The rules are those of a Python loader (``int``, ``float``, ``strptime``), written
as regular expressions so that they run inside the scan stage.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = r"\d+(_\d+)*"
INTEGER = rf"^\s*[+-]?{_DIGITS}\s*$"
NUMBER = (
    rf"(?i)^\s*[+-]?(({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})(e[+-]?{_DIGITS})?"
    r"|nan|inf|infinity)\s*$"
)
BOOLEAN = r"(?i)^(true|false)\z"
LEADING_ZERO = r"^0[0-9]"
LONGEST_QUANTITY = 15  # an integer with more characters is a code

_TIME = r"(\s+\d{1,2}:\d{1,2}:\d{1,2})?"
ISO_DATE = rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}}{_TIME}\z"
DAY_FIRST_DATE = rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}}{_TIME}\z"


# What a cell that is not plain text may start with; most text is told apart by this alone.
_HEADS = list("+-. \t\n\r\f\v") + list("nNiItTfF")


def is_integer(v: Column) -> Column:
    return v.rlike(INTEGER)


def is_number(v: Column) -> Column:
    return v.rlike(NUMBER)


def is_boolean(v: Column) -> Column:
    return F.length(v).between(4, 5) & v.rlike(BOOLEAN)


def to_timestamp(v: Column) -> Column:
    """Zone-free timestamp of the four accepted date forms, NULL for anything else."""
    day_first = F.regexp_replace(v, r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$2-$1")
    iso = F.when(v.rlike(ISO_DATE), v).when(v.rlike(DAY_FIRST_DATE), day_first)
    one_blank = F.regexp_replace(iso, r"\s+", " ")
    return F.coalesce(iso.try_cast("timestamp_ntz"), one_blank.try_cast("timestamp_ntz"))


def without_marks(v: Column) -> Column:
    """Number text without the blanks and underscores that Python allows."""
    return F.regexp_replace(v, r"[\s_]", "")


def bare_digits(v: Column) -> Column:
    """Number text without signs, blanks and underscores, which are rare enough to look for first."""
    return F.when(v.rlike(r"[\s_+-]"), F.regexp_replace(v, r"[\s_+-]", "")).otherwise(v)


def value_class(v: Column) -> Column:
    """code, boolean, integer, number, date or text.

    The cheap tests come first: the head of the cell, and integers that are nothing
    but digits. One pattern then covers every other number. (A ``try_cast`` would be
    no shortcut: it throws and catches an exception for each cell that does not fit.)
    """
    head, tail = F.substring(v, 1, 1), F.substring(v, -1, 1)
    digit = head.between("0", "9")
    only_digits = digit & tail.between("0", "9") & v.rlike(rf"^[0-9]{{1,{LONGEST_QUANTITY}}}\z")
    without_point = ~v.rlike(r"[.a-zA-Z]")
    number = (
        F.when(without_point & (F.length(v) > LONGEST_QUANTITY), "code")
        .when(without_point, "integer")
        .otherwise("number")
    )
    return (
        F.when(~(digit | head.isin(_HEADS)), "text")
        .when(v.startswith("0") & v.rlike(LEADING_ZERO), "code")
        .when(only_digits, "integer")
        .when(is_boolean(v), "boolean")
        .when(is_number(v), number)
        .when(to_timestamp(v).isNotNull(), "date")
        .otherwise("text")
    )
