"""Bronze to silver to gold by what each delivery adds.

The tables are those of :mod:`tidemark.plans.medallion`, but keyed and batched:
silver takes a delivery, and gold takes the silver rows it has not seen yet, as
silver's feed gives them. So a run's cost follows its delivery.

Unlike a full run, a silver line whose customer is not found comes into the fact
once and not again with every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.cleaning import clean_sales, with_provenance
from tidemark.operators.dimensions import (
    customer_dimension,
    date_dimension,
    product_dimension,
)
from tidemark.operators.keyed import KeyedTable
from tidemark.operators.keys import dense_row_numbers, max_key
from tidemark.operators.star import fact_sales
from tidemark.plans.medallion import (
    CUSTOMER_KEY,
    FACT_KEY,
    FLAG_BEFORE,
    GOLD_TABLES,
    PRODUCT_KEY,
    SILVER_KEY,
)
from tidemark.schemas import ORDERS_CSV
from tidemark.sources.readers import csv_files

GOLD = "gold"
_KEYS = {
    "sales_silver": (SILVER_KEY, "OrderDate"),
    "dimdate_gold": (["OrderDate"], None),
    "dimcustomer_gold": (CUSTOMER_KEY, None),
    "dimproduct_gold": (PRODUCT_KEY, None),
    "factsales_gold": (FACT_KEY, "OrderDate"),
}


def tables(
    spark: SparkSession, database: str, buckets: int = 16, period: str = "yyyyMM"
) -> dict[str, KeyedTable]:
    """The silver and gold tables, created on first use; the dimensions have one bucket."""
    found = {}
    for name, schema in GOLD_TABLES.items():
        key, date = _KEYS[name]
        n = buckets if date else 1
        found[name] = KeyedTable(spark, f"{database}.{name}", schema, key, date, n, period)
    return {name: table.create_if_absent() for name, table in found.items()}


def to_silver(
    silver: KeyedTable, bronze: DataFrame, cutoff: str = FLAG_BEFORE, source: Column | None = None
) -> int:
    """Clean a delivery and add its new rows as the next batch, whose number is given back."""
    batch = silver.position() + 1
    silver.merge(clean_sales(with_provenance(bronze, source), cutoff), batch)
    return batch


def to_gold(found: dict[str, KeyedTable]) -> int:
    """Bring gold up to the newest silver batch and give back its number.

    Reads the silver rows since gold's position, the dimensions, and the keys of
    the fact rows in the months of these rows. A run that failed is done again
    from the same position.
    """
    silver = found["sales_silver"]
    after, batch = silver.position(GOLD), silver.position()
    if after == batch:
        return batch
    added = silver.changes(after, batch)
    found["dimdate_gold"].merge(date_dimension(added), batch)
    _add_members(found["dimcustomer_gold"], customer_dimension(added), "CustomerID", batch)
    _add_members(found["dimproduct_gold"], product_dimension(added), "ItemID", batch)
    facts = fact_sales(added, found["dimcustomer_gold"].rows(), found["dimproduct_gold"].rows())
    found["factsales_gold"].merge(facts, batch)
    silver.commit(batch, GOLD)
    return batch


def _add_members(dimension: KeyedTable, members: DataFrame, key: str, batch: int) -> None:
    """New members get keys above those of the earlier batches, in the order of their names."""
    fresh = dimension.missing(members.withColumn(key, F.lit(None).cast("long")), batch)
    numbered = dense_row_numbers(fresh, dimension.key, "_number")
    next_key = F.col("_number") + max_key(dimension.changes(0, batch - 1), key)
    dimension.insert(numbered.withColumn(key, next_key).select(*fresh.columns), batch)


def run(
    spark: SparkSession,
    pattern: str,
    database: str,
    cutoff: str = FLAG_BEFORE,
    buckets: int = 16,
    period: str = "yyyyMM",
) -> dict[str, KeyedTable]:
    """Load a delivery of bronze CSV files and bring gold up to date."""
    found = tables(spark, database, buckets, period)
    to_silver(found["sales_silver"], csv_files(spark, pattern, ORDERS_CSV), cutoff)
    to_gold(found)
    return found
