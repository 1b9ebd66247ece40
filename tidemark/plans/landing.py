"""Landing loads: a delivered file to a table named by the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.cleaning import transform_orders
from tidemark.schemas import PRODUCTS_TYPED
from tidemark.sources.readers import csv_as_text, csv_typed
from tidemark.sources.writers import append_table, replace_table


def shape_sales(text: DataFrame) -> DataFrame:
    """Delivered sales (all text) with calendar and name columns."""
    return transform_orders(text, email="EmailAddress", tax="TaxAmount")


def load_sales(spark: SparkSession, path: str, table_name: str = "sales") -> None:
    append_table(shape_sales(csv_as_text(spark, path)), table_name)


def load_products(spark: SparkSession, path: str, table_name: str = "products") -> None:
    append_table(csv_as_text(spark, path), table_name)


def refresh_products(spark: SparkSession, path: str, table_name: str = "products") -> None:
    """Replace the product table by a typed reading of a delivered file."""
    replace_table(csv_typed(spark, path, PRODUCTS_TYPED), table_name)


# The loads an orchestrator starts, by name.
LOADS = {"sales": load_sales, "products": load_products}


def load(spark: SparkSession, kind: str, path: str, table_name: str) -> None:
    LOADS[kind](spark, path, table_name)
