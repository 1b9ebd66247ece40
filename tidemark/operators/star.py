"""Fact builds, star expansion and default measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import item_info, item_name
from tidemark.operators.joins import lookup


def fact_sales(silver: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Sales lines with customer and product keys; no match leaves a null key.

    No sort: the order of a written table is not part of it.
    """
    item = F.col("Item")
    lines = silver.select(
        "CustomerName",
        "Email",
        item_name(item).alias("ItemName"),
        item_info(item).alias("ItemInfo"),
        "OrderDate",
        "Quantity",
        "UnitPrice",
        "Tax",
    )
    with_customer = lookup(lines, customers, ["CustomerName", "Email"], ["CustomerID"])
    with_product = lookup(with_customer, products, ["ItemName", "ItemInfo"], ["ItemID"])
    return with_product.select(
        "CustomerID", "ItemID", "OrderDate", "Quantity", "UnitPrice", "Tax"
    )


class Relation(NamedTuple):
    """Many-to-one: ``fact_column`` of the fact points at ``key`` of ``dimension``."""

    fact_column: str
    dimension: str
    key: str


# The relations and default measures of the two star models.
GOLD_RELATIONS = [
    Relation("ItemID", "dimproduct_gold", "ItemID"),
    Relation("OrderDate", "dimdate_gold", "OrderDate"),
    Relation("CustomerID", "dimcustomer_gold", "CustomerID"),
]
GOLD_MEASURES = {"Quantity": "sum", "UnitPrice": "sum", "Tax": "sum"}

WAREHOUSE_RELATIONS = [
    Relation("ProductKey", "DimProduct", "ProductKey"),
    Relation("CustomerKey", "DimCustomer", "CustomerKey"),
    Relation("SalesOrderDateKey", "DimDate", "DateKey"),
]
WAREHOUSE_MEASURES = {"SalesOrderKey": "count", "Quantity": "sum", "SalesTotal": "sum"}


def expand(
    fact: DataFrame,
    dimensions: Mapping[str, DataFrame],
    relations: Sequence[Relation],
    attributes: Mapping[str, Sequence[str]],
) -> DataFrame:
    """Fact rows with the asked attributes of each dimension.

    ``attributes`` maps a dimension to its columns. Dimensions that are not
    asked for are not joined. Attribute names must not repeat a fact column.
    """
    for relation in relations:
        wanted = attributes.get(relation.dimension)
        if not wanted:
            continue
        side = dimensions[relation.dimension].select(
            F.col(relation.key).alias("_key"), *[F.col(a).alias(f"_{a}") for a in wanted]
        )
        fact = fact.join(side, F.col(relation.fact_column) == F.col("_key"), "left").drop("_key")
        fact = fact.withColumnsRenamed({f"_{a}": a for a in wanted})
    return fact


def measures_by(
    fact: DataFrame,
    dimensions: Mapping[str, DataFrame],
    relations: Sequence[Relation],
    attributes: Mapping[str, Sequence[str]],
    measures: Mapping[str, str],
) -> DataFrame:
    """Default measures grouped by dimension attributes.

    Facts meet the dimensions as they are: the combination of all foreign keys
    is near unique, so summing by it first would shuffle the fact for nothing.
    Small dimensions are broadcast by their known size; where one is not, its
    join is a plain shuffle that AQE can split at a hot key. The groups are few,
    so the sums combine in each task.
    """
    used = [r for r in relations if attributes.get(r.dimension)]
    wide = expand(fact, dimensions, used, attributes)
    by = [a for r in used for a in attributes[r.dimension]]
    kinds = {"sum": F.sum, "count": F.count}
    return wide.groupBy(*by).agg(
        *[kinds[kind](column).alias(f"{kind}_{column}") for column, kind in measures.items()]
    )
