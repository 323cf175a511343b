"""Column expressions shared by the operators. All of them are built-ins, so they stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Doubles pass through this type before rounding: ten decimals hide the order-dependent noise of floating sums, and
# decimal rounding is half-up on exact digits.
_EXACT = "decimal(38,10)"


def half_up(value: Column, digits: int) -> Column:
    """Round half-up on decimal digits and return a double."""
    return F.round(value.cast(_EXACT), digits).cast("double")


def rank_value(value: Column) -> Column:
    """The form of a mean score to rank on, so that equal means tie whatever order they were summed in.

    Eighteen digits are what Spark still keeps and compares as a long.
    """
    return value.cast("decimal(18,10)")


def event_date(df: DataFrame, column: str) -> Column:
    """The calendar day of an event column.

    Text is parsed as a timestamp and gives NULL when it is none (ANSI mode would raise).
    """
    value = F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        value = value.try_cast("timestamp")
    return value.cast("date")


def time_id(day: Column) -> Column:
    """Month key yyyymm of a date, as int."""
    return F.year(day) * 100 + F.month(day)


def list_items(text: Column) -> Column:
    """Items of a comma-joined string, without the blanks around them; may hold empty items."""
    return F.split(F.trim(text), r"\s*,\s*")


def growth_pct(current: Column, previous: Column) -> Column:
    """Growth over the previous value in percent, two decimals; NULL when there is no previous value or it is 0."""
    return half_up((current - previous) / F.nullif(previous.cast("double"), F.lit(0.0)) * 100, 2)


def surrogate_key(*natural: str) -> Column:
    """A bigint key that depends on the natural key alone.

    It needs neither a window over all rows nor a stored counter, and a recomputed or retried task yields the same
    value. Hash keys can collide: the staging job checks them (``operators.checks.require_unique``), and the reports
    join on natural keys where they can.
    """
    return F.xxhash64(*natural)
