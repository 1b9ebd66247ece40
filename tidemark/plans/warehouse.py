"""Sales warehouse report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sales_by_region(fact: DataFrame, dates: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue per calendar month and region.

    Totals have no decimals, so they are added as integers. Facts are summed per
    date and customer first, so the joins see one row per pair of keys and a hot
    customer is no heavier than its number of days.
    """
    per_key = fact.groupBy("SalesOrderDateKey", "CustomerKey").agg(
        F.sum(F.col("SalesTotal").cast("bigint")).alias("_total")
    )
    return (
        per_key.join(
            dates.select("DateKey", "Year", "Month", "MonthName"),
            F.col("SalesOrderDateKey") == F.col("DateKey"),
        )
        .join(customers.select("CustomerKey", "CountryRegion"), "CustomerKey")
        .groupBy(
            F.col("Year").alias("CalendarYear"),
            F.col("Month").alias("MonthOfYear"),
            "MonthName",
            F.col("CountryRegion").alias("SalesRegion"),
        )
        .agg(F.sum("_total").cast("decimal(38,0)").alias("SalesRevenue"))
    )
