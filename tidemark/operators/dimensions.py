"""Dimension tables from cleaned sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import date_key
from tidemark.functions.text import first_name, item_info, item_name, last_name


def date_dimension(sales: DataFrame, column: str = "OrderDate") -> DataFrame:
    """One row per order date. Dates are made distinct before anything is derived."""
    day = F.col("OrderDate")
    return sales.select(F.col(column).alias("OrderDate")).distinct().select(
        day,
        F.dayofmonth(day).alias("Day"),
        F.month(day).alias("Month"),
        F.year(day).alias("Year"),
        F.date_format(day, "MMM-yyyy").alias("mmmyyyy"),
        F.date_format(day, "yyyyMM").alias("yyyymm"),
    )


def warehouse_date_dimension(rows: DataFrame, column: str) -> DataFrame:
    """One row per date with an integer key; the week starts on Sunday as day 1."""
    day = F.col("DateAltKey")
    return rows.select(F.col(column).cast("date").alias("DateAltKey")).distinct().select(
        date_key(day).alias("DateKey"),
        day,
        F.dayofweek(day).alias("DayOfWeek"),
        F.date_format(day, "EEEE").alias("WeekDayName"),
        F.dayofmonth(day).alias("DayOfMonth"),
        F.month(day).alias("Month"),
        F.date_format(day, "MMMM").alias("MonthName"),
        F.year(day).alias("Year"),
    )


def customer_dimension(sales: DataFrame) -> DataFrame:
    """Distinct name and e-mail pairs with first and last name."""
    name = F.col("CustomerName")
    return sales.select("CustomerName", "Email").distinct().select(
        "CustomerName", "Email", first_name(name).alias("First"), last_name(name).alias("Last")
    )


def product_dimension(sales: DataFrame) -> DataFrame:
    """One row per item name and info, with the least item text that gives them.

    Items that differ only beyond the second part, or in a trailing separator,
    are one product, so that a sales line finds one member. Items are made
    distinct before they are split.
    """
    item = F.col("Item")
    return (
        sales.select("Item")
        .distinct()
        .groupBy(item_name(item).alias("ItemName"), item_info(item).alias("ItemInfo"))
        .agg(F.min("Item").alias("Item"))
        .select("Item", "ItemName", "ItemInfo")
    )
