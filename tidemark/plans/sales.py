"""Sales exploration reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import exact_sum, gross
from tidemark.operators.aggregates import sum_numeric
from tidemark.operators.ranking import top


def distinct_customers(sales: DataFrame, item: str | None = None) -> DataFrame:
    """Distinct customers, of one item or of all."""
    if item is not None:
        sales = sales.where(F.col("Item") == item)
    return sales.select("CustomerName", "Email").distinct()


def product_quantity(sales: DataFrame) -> DataFrame:
    return sum_numeric(sales.select("Item", "Quantity"), ["Item"])


def yearly_orders(sales: DataFrame) -> DataFrame:
    """Order lines per year."""
    year = F.year("OrderDate").alias("Year")
    return sales.groupBy(year).agg(F.count(F.lit(1)).alias("count")).orderBy("Year")


def _revenue() -> Column:
    line = gross(F.col("UnitPrice"), F.col("Quantity"), F.col("Tax"))
    return exact_sum(line).alias("GrossRevenue")


def yearly_revenue(sales: DataFrame) -> DataFrame:
    year = F.year("OrderDate").alias("OrderYear")
    return sales.groupBy(year).agg(_revenue()).orderBy("OrderYear")


def yearly_revenue_and_orders(sales: DataFrame) -> DataFrame:
    """Revenue and number of different orders per year, the year as text."""
    year = F.year("OrderDate").cast("string").alias("OrderYear")
    return (
        sales.groupBy(year)
        .agg(_revenue(), F.count_distinct("SalesOrderNumber").alias("YearlyCounts"))
        .orderBy("OrderYear")
    )


def category_stats(products: DataFrame) -> DataFrame:
    """Number of products and price range per category."""
    price = F.col("ListPrice")
    return products.groupBy("Category").agg(
        F.count(F.lit(1)).alias("NumProducts"),
        F.min(price).alias("MinPrice"),
        F.max(price).alias("MaxPrice"),
        F.avg(price).alias("AvgPrice"),
    )


def largest_categories(stats: DataFrame, n: int = 10) -> DataFrame:
    return top(stats.select("Category", "NumProducts"), n, F.col("NumProducts"), ["Category"])


def dearest_categories(stats: DataFrame, n: int = 6) -> DataFrame:
    shown = stats.select("Category", "MinPrice", "MaxPrice", "AvgPrice")
    return top(shown, n, F.col("AvgPrice"), ["Category"])
