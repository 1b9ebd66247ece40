"""Parameterised trading reports.

Each takes the trading tables it needs. A filter on a parameter is placed on the
table that holds the column, before any join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import year_text
from tidemark.functions.numbers import (
    amount_of,
    coarser,
    exact_sum,
    net_line,
    units,
    whole_percent,
)
from tidemark.operators.cleaning import where_between
from tidemark.operators.ranking import top


def customer_order_history(
    products: DataFrame,
    details: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    customer_id=None,
) -> DataFrame:
    """Quantity per product that a customer bought.

    Without a customer the history of every customer is given, with its id.
    """
    by = ["ProductName"]
    if customer_id is None:
        by = ["CustomerID", *by]
    else:
        customers = customers.where(F.col("CustomerID") == customer_id)
        orders = orders.where(F.col("CustomerID") == customer_id)
    known = orders.select("OrderID", "CustomerID").join(
        customers.select("CustomerID"), "CustomerID"
    )
    bought = details.select("OrderID", "ProductID", "Quantity").join(known, "OrderID")
    per_product = bought.groupBy("CustomerID", "ProductID").agg(F.sum("Quantity").alias("_q"))
    named = per_product.join(products.select("ProductID", "ProductName"), "ProductID")
    return named.groupBy(*by).agg(F.sum("_q").alias("Total"))


def order_details(products: DataFrame, details: DataFrame, order_id=None) -> DataFrame:
    """Lines of one order (or of all orders, with the order id) with net price."""
    shown = [] if order_id is not None else ["OrderID"]
    if order_id is not None:
        details = details.where(F.col("OrderID") == order_id)
    price, quantity, discount = F.col("_price"), F.col("Quantity"), F.col("Discount")
    lines = details.withColumnRenamed("UnitPrice", "_price").join(
        products.select("ProductID", "ProductName"), "ProductID"
    )
    return lines.select(
        *shown,
        "ProductName",
        F.round(price, 2).alias("UnitPrice"),
        "Quantity",
        whole_percent(discount).alias("Discount"),
        amount_of(coarser(units(net_line(quantity, discount, price), 4))).alias("ExtendedPrice"),
    )


def customer_orders(orders: DataFrame, customer_id=None) -> DataFrame:
    """Orders of one customer (or of all, with the customer id) with their dates."""
    shown = ["OrderID", "OrderDate", "RequiredDate", "ShippedDate"]
    if customer_id is None:
        return orders.select("CustomerID", *shown).orderBy("CustomerID", "OrderID")
    return orders.where(F.col("CustomerID") == customer_id).select(shown).orderBy("OrderID")


def shipped_subtotals(orders: DataFrame, details: DataFrame, first, last) -> DataFrame:
    """Net amount of the orders shipped in a date range, with their columns.

    The range is applied before the details come in, and the sum per order keeps
    the partitioning of the join: the details are shuffled once.
    """
    shipped = where_between(orders, "ShippedDate", first, last)
    net = net_line(F.col("Quantity"), F.col("Discount"), F.col("UnitPrice"))
    lines = details.select("OrderID", "Quantity", "Discount", "UnitPrice")
    columns = [c for c in ("EmployeeID", "ShippedDate") if c in shipped.columns]
    return (
        shipped.select("OrderID", *columns)
        .join(lines, "OrderID")
        .groupBy("OrderID", *columns)
        .agg(exact_sum(net, 4).alias("Subtotal"))
    )


def employee_sales(
    employees: DataFrame, orders: DataFrame, details: DataFrame, first, last
) -> DataFrame:
    """Shipped orders in a date range with the employee who made them."""
    return (
        shipped_subtotals(orders, details, first, last)
        .join(employees.select("EmployeeID", "Country", "LastName", "FirstName"), "EmployeeID")
        .select(
            "Country",
            "LastName",
            "FirstName",
            "ShippedDate",
            "OrderID",
            F.col("Subtotal").alias("SaleAmount"),
        )
    )


def sales_by_year(orders: DataFrame, details: DataFrame, first, last) -> DataFrame:
    """Shipped orders in a date range with amount and year."""
    return shipped_subtotals(orders, details, first, last).select(
        "ShippedDate", "OrderID", "Subtotal", year_text(F.col("ShippedDate")).alias("Year")
    )


# Years the category report knows and the one it falls back to.
REPORT_YEARS = ("1996", "1997", "1998")
DEFAULT_YEAR = "1998"


def sales_by_category(
    details: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    categories: DataFrame,
    category: str,
    year: str = DEFAULT_YEAR,
) -> DataFrame:
    """Rounded purchases per product of a category in one year.

    Each line is rounded to cents before the sum. An unknown year means the
    default year. The year is a date range, which reaches the scan, and lines of
    other categories go before the orders come in.
    """
    chosen = year if year in REPORT_YEARS else DEFAULT_YEAR
    of_category = products.select("ProductID", "ProductName", "CategoryID").join(
        categories.where(F.col("CategoryName") == category).select("CategoryID"), "CategoryID"
    )
    day = F.col("OrderDate")
    new_year = F.lit(f"{chosen}-01-01").cast("date")
    next_year = F.lit(f"{int(chosen) + 1}-01-01").cast("date")
    of_year = orders.where((day >= new_year) & (day < next_year)).select("OrderID")
    net = net_line(F.col("Quantity"), F.col("Discount"), F.col("UnitPrice"))
    cents = coarser(units(net, 4))
    return (
        details.join(of_category.select("ProductID", "ProductName"), "ProductID")
        .join(of_year, "OrderID")
        .groupBy("ProductName")
        .agg(F.round(amount_of(F.sum(cents)), 0).alias("TotalPurchase"))
        .orderBy("ProductName")
    )


def most_expensive_products(products: DataFrame, n: int = 10) -> DataFrame:
    named = products.select(F.col("ProductName").alias("TenMostExpensiveProducts"), "UnitPrice")
    return top(named, n, F.col("UnitPrice"), ["TenMostExpensiveProducts"])
