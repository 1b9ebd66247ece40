"""Surrogate keys for new dimension members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import rows_without_match
from tidemark.session import ensure_checkpoint_dir

_ROW_BITS = 33  # low bits of monotonically_increasing_id: row number in its partition


def max_key(table: DataFrame, key: str) -> Column:
    """Largest key so far as a scalar subquery, 0 for an empty table."""
    return table.select(F.coalesce(F.max(key), F.lit(0)).cast("long").alias("m")).scalar()


def dense_row_numbers(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number all rows 1..n in the order of ``order`` without a single-task sort.

    The rows are range-partitioned and sorted inside their partitions, then
    checkpointed so that every later pass sees the same partitions (this is the
    one action here). A row's number is its place in its partition plus the
    count of rows in the partitions before it. The table of those counts has one
    row per partition, so its running sum and its broadcast are small whatever
    the data size.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    placed = ranged.withColumn("_m", F.monotonically_increasing_id()).select(
        "*",
        F.shiftright("_m", _ROW_BITS).cast("int").alias("_p"),
        F.col("_m").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_i"),
    )
    counts = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    return placed.join(F.broadcast(offsets), "_p").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_o") + F.col("_i") + 1).alias(name)
    )


def key_new_members(
    members: DataFrame, dimension: DataFrame, natural_key: Sequence[str], key: str
) -> DataFrame:
    """Members that are not in the dimension yet, with keys above its largest."""
    fresh = rows_without_match(members, dimension, natural_key)
    numbered = dense_row_numbers(fresh, natural_key, "_number")
    return numbered.select(
        *[F.col(f"`{c}`") for c in members.columns],
        (F.col("_number") + max_key(dimension, key)).alias(key),
    )
