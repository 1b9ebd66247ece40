"""Bronze files to silver table to gold star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from tidemark.operators.cleaning import clean_sales, with_provenance
from tidemark.operators.dimensions import (
    customer_dimension,
    date_dimension,
    product_dimension,
)
from tidemark.operators.keys import key_new_members
from tidemark.operators.merge import merge_into_table
from tidemark.operators.star import fact_sales
from tidemark.schemas import (
    DIM_CUSTOMER_GOLD,
    DIM_DATE_GOLD,
    DIM_PRODUCT_GOLD,
    FACT_SALES_GOLD,
    ORDERS_CSV,
    SALES_SILVER,
)
from tidemark.sources.readers import csv_files
from tidemark.sources.writers import append_table, create_if_absent

# Fixed value: orders before this date are flagged.
FLAG_BEFORE = "2019-08-01"

SILVER_KEY = ["SalesOrderNumber", "OrderDate", "CustomerName", "Item"]
CUSTOMER_KEY = ["CustomerName", "Email"]
PRODUCT_KEY = ["ItemName", "ItemInfo"]
FACT_KEY = ["OrderDate", "CustomerID", "ItemID"]

GOLD_TABLES = {
    "sales_silver": SALES_SILVER,
    "dimdate_gold": DIM_DATE_GOLD,
    "dimcustomer_gold": DIM_CUSTOMER_GOLD,
    "dimproduct_gold": DIM_PRODUCT_GOLD,
    "factsales_gold": FACT_SALES_GOLD,
}


def create_tables(spark: SparkSession, database: str) -> None:
    for name, schema in GOLD_TABLES.items():
        create_if_absent(spark, f"{database}.{name}", schema)


def bronze_to_silver(
    spark: SparkSession,
    bronze: DataFrame,
    database: str,
    cutoff: str = FLAG_BEFORE,
    source: Column | None = None,
) -> None:
    """Clean the delivered rows and add those that silver does not have."""
    cleaned = clean_sales(with_provenance(bronze, source), cutoff)
    merge_into_table(spark, f"{database}.sales_silver", cleaned, SILVER_KEY)


def silver_to_gold(spark: SparkSession, database: str) -> None:
    """Grow the dimensions by new members, then the fact by new lines."""
    silver = spark.table(f"{database}.sales_silver")
    merge_into_table(spark, f"{database}.dimdate_gold", date_dimension(silver), ["OrderDate"])

    customers = spark.table(f"{database}.dimcustomer_gold")
    append_table(
        key_new_members(customer_dimension(silver), customers, CUSTOMER_KEY, "CustomerID").select(
            customers.columns
        ),
        f"{database}.dimcustomer_gold",
    )
    products = spark.table(f"{database}.dimproduct_gold")
    append_table(
        key_new_members(product_dimension(silver), products, PRODUCT_KEY, "ItemID").select(
            products.columns
        ),
        f"{database}.dimproduct_gold",
    )
    facts = fact_sales(
        silver,
        spark.table(f"{database}.dimcustomer_gold"),
        spark.table(f"{database}.dimproduct_gold"),
    )
    merge_into_table(spark, f"{database}.factsales_gold", facts, FACT_KEY)


def run(
    spark: SparkSession, pattern: str, database: str, cutoff: str = FLAG_BEFORE
) -> dict[str, DataFrame]:
    """Load bronze CSV files and bring silver and gold up to date."""
    create_tables(spark, database)
    bronze_to_silver(spark, csv_files(spark, pattern, ORDERS_CSV), database, cutoff)
    silver_to_gold(spark, database)
    return {name: spark.table(f"{database}.{name}") for name in GOLD_TABLES}
