"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_key(column: Column) -> Column:
    """Integer key ``yyyyMMdd``."""
    return (F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)).cast("int")


def year_text(column: Column) -> Column:
    """Four-digit year as text."""
    return F.date_format(column, "yyyy")


def slash_year(column: Column) -> Column:
    """Year cut from the ``yyyy/MM/dd`` rendering of a date."""
    return F.substring(F.date_format(column, "yyyy/MM/dd"), 1, 4)


def day_bin(column: Column) -> Column:
    """Start of the day a time falls in."""
    return F.date_trunc("day", column)


def as_of(df: DataFrame, time_column: str, moment: str | Column | None = None) -> Column:
    """The report's "now": a given moment, or the newest time in ``df``.

    Give the whole table, not a selection: "now" must not depend on a filter.

    The default is a scalar subquery, so it runs on the executors as one
    partially aggregated max and nothing is read back to the driver.
    """
    if moment is not None:
        return F.lit(moment).cast("timestamp")
    return df.select(F.max(time_column).alias("as_of")).scalar()


def newer_than(time: Column, now: Column, age: str) -> Column:
    """Strictly newer than ``now`` minus an interval such as ``"1 hour"``."""
    return time > now - F.expr(f"INTERVAL {age}")
