"""Data tests. Each gives one row: table, test, column, number of failures."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _labels(table: str, test: str, column: str) -> list[Column]:
    return [
        F.lit(table).alias("table_name"),
        F.lit(test).alias("test_name"),
        F.lit(column).alias("column_name"),
    ]


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Values that occur more than once; nulls are ignored."""
    per_value = df.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return per_value.agg(F.count_if(F.col("_n") > 1).alias("failures")).select(
        *_labels(table, "unique", column), "failures"
    )


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Null counts of all columns from one scan, one row per column."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit("not_null").alias("test_name"),
            F.lit(c).alias("column_name"),
            F.col(f"`{c}`").alias("failures"),
        )
        for c in columns
    ]
    return counted.select(F.inline(F.array(*rows)))


def accepted_values(df: DataFrame, table: str, column: str, values: Sequence[str]) -> DataFrame:
    """Rows' distinct values outside the list; nulls pass."""
    bad = df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
    return bad.agg(F.count_distinct(column).alias("failures")).select(
        *_labels(table, "accepted_values", column), "failures"
    )


class Check(NamedTuple):
    """A test of one column: ``unique``, ``not_null`` or ``accepted_values`` with its values."""

    test: str
    column: str
    values: Sequence[str] | None = None


def table_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """All tests of a table from one scan, one row per test.

    Every row gives a cell per tested column: its value where values matter, and
    whether it is null. Equal cells are counted, combined in each task first, and
    the counts of a column's cells answer all its tests.
    """
    columns = list(dict.fromkeys(c.column for c in checks))
    by_value = {c.column for c in checks if c.test != "not_null"}
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"`{c}`").isNull().alias("empty"),
                (F.col(f"`{c}`").cast("string") if c in by_value else F.lit(None).cast("string")).alias("value"),
            )
            for c in columns
        ]
    )
    counted = (
        df.select(F.inline(cells))
        .groupBy("column", "empty", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    filled = ~F.col("empty")

    def failures(check: Check) -> Column:
        own = F.col("column") == check.column
        if check.test == "unique":
            return F.count_if(own & filled & (F.col("n") > 1))
        if check.test == "accepted_values":
            return F.count_if(own & filled & ~F.col("value").isin(list(check.values or ())))
        return F.coalesce(F.sum(F.when(own & F.col("empty"), F.col("n"))), F.lit(0))

    one = counted.agg(*[failures(check).cast("bigint").alias(f"_{i}") for i, check in enumerate(checks)])
    rows = [
        F.struct(*_labels(table, check.test, check.column), F.col(f"_{i}").alias("failures"))
        for i, check in enumerate(checks)
    ]
    return one.select(F.inline(F.array(*rows)))


def relationships(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows whose non-null key has no parent.

    Child keys are counted per value and parent keys made distinct before the
    join, so neither side can be skewed.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    known = parent.select(F.col(parent_column).alias("_k")).distinct()
    return (
        keys.join(known, "_k", "left_anti")
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("failures"))
        .select(*_labels(table, "relationships", column), "failures")
    )


def report(*tests: DataFrame) -> DataFrame:
    """All test rows together, with a verdict."""
    return reduce(DataFrame.unionByName, tests).withColumn("passed", F.col("failures") == 0)
