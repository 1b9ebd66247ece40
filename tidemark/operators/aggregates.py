"""Aggregates beyond plain ``groupBy().agg()``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidemark.functions.numbers import exact_sum


def row_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and distinct rows of a projection, in one aggregation by value.

    Counting per value first lets copies collapse before the shuffle.
    """
    per_value = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    return per_value.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.count(F.lit(1)).alias("distinct_count"),
    )


def sum_numeric(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sum of every numeric column that is not a grouping column."""
    numeric = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, NumericType) and f.name not in by
    ]
    return df.groupBy(*by).agg(*[F.sum(c).alias(f"sum_{c}") for c in numeric])


def sum_where(
    df: DataFrame, by: Sequence[str], kind: str, values: Sequence[str], amount: str
) -> DataFrame:
    """One ``<value>_<amount>`` sum of money per value of ``kind`` plus the total.

    All sums come out of the same aggregation. Joined to the table that ``by`` is
    the key of, it needs no other shuffle.
    """
    money = F.col(amount)
    split = [
        exact_sum(F.when(F.col(kind) == v, money).otherwise(F.lit(0))).alias(f"{v}_{amount}")
        for v in values
    ]
    total = exact_sum(money).alias(f"total_{amount}")
    return df.groupBy(*by).agg(*split, total)


def latest(
    df: DataFrame,
    by: Sequence[str],
    time: str,
    tie: str,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The newest row per key; equal times are settled by ``tie``."""
    kept = [c for c in (columns or df.columns) if c not in by]
    newest = F.max_by(F.struct(*kept), F.struct(time, tie)).alias("_row")
    return df.groupBy(*by).agg(newest).select(*by, *[f"_row.{c}" for c in kept])


def latest_and_earliest(
    df: DataFrame,
    by: Sequence[str],
    time: str,
    tie: str,
    latest_columns: Sequence[str],
    earliest_columns: Sequence[str],
) -> DataFrame:
    """Newest values per key beside the earliest ones, in one aggregation.

    An earliest column whose name is taken gets the suffix ``1``.
    """
    order = F.struct(time, tie)
    aggregated = df.groupBy(*by).agg(
        F.max_by(F.struct(*latest_columns), order).alias("_new"),
        F.min_by(F.struct(*earliest_columns), order).alias("_old"),
    )
    taken = {*by, *latest_columns}
    return aggregated.select(
        *by,
        *[f"_new.{c}" for c in latest_columns],
        *[F.col(f"_old.{c}").alias(f"{c}1" if c in taken else c) for c in earliest_columns],
    )


def subtotals(df: DataFrame, levels: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Sums for every level of a hierarchy and the grand total.

    ``level`` counts the levels that are rolled up: 0 is the finest. The finest
    sums are built first, so the rollup multiplies few rows and not the input.
    """
    finest = df.groupBy(*levels).agg(*[F.sum(c).alias(c) for c in sums])
    rolled = finest.rollup(*levels).agg(
        F.grouping_id().alias("_gid"), *[F.sum(c).alias(c) for c in sums]
    )
    return rolled.select(*levels, F.bit_count("_gid").alias("level"), *sums)


def labelled_counts(df: DataFrame, conditions: Mapping[str, Column | None]) -> DataFrame:
    """One row per label with the number of rows that meet its condition.

    All counts come from one scan; ``Order`` follows the order of the labels.
    """
    counted = df.agg(
        *[
            (F.count(F.lit(1)) if condition is None else F.count_if(condition)).alias(name)
            for name, condition in conditions.items()
        ]
    )
    entries = [
        F.struct(
            F.lit(name).alias("Label"),
            F.col(f"`{name}`").alias("Count"),
            F.lit(position).alias("Order"),
        )
        for position, name in enumerate(conditions, start=1)
    ]
    return counted.select(F.inline(F.array(*entries)))
