"""Merge and update on plain tables, as DataFrame operators.

The default merge inserts what is missing and leaves matched rows alone. Key
equality is plain ``=``: a row with a null in its key matches nothing, so it is
inserted again on every run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tidemark.operators.joins import aggregate_for_join, rows_without_match, same_key


def rows_to_insert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    when_not_matched: Mapping[str, str] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Update rows with no match, in the target's columns.

    ``when_not_matched`` maps a target column to a SQL expression over ``u``;
    columns left out become null. By default all columns are taken by name.
    """
    missing = rows_without_match(updates, target, keys, null_safe)
    return _in_columns_of(target, missing, when_not_matched)


def _in_columns_of(
    target: DataFrame, rows: DataFrame, values: Mapping[str, str] | None = None
) -> DataFrame:
    missing = rows.alias("u")
    types = {f.name: f.dataType for f in target.schema.fields}
    if values is None:
        return missing.select(
            *[F.col(f"u.`{c}`").cast(types[c]).alias(c) for c in target.columns]
        )
    return missing.select(
        *[F.expr(values.get(c, "NULL")).cast(types[c]).alias(c) for c in target.columns]
    )


def merge(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    when_matched: Mapping[str, str] | None = None,
    when_not_matched: Mapping[str, str] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """The target after the merge.

    ``when_matched`` maps target columns to SQL expressions over ``t`` and
    ``u``. Two update rows for one target row make such an update ambiguous and
    fail the job; with nothing to set they are ignored.
    """
    inserted = rows_to_insert(target, updates, keys, when_not_matched, null_safe)
    if not when_matched:
        return target.unionByName(inserted)
    return _updated(target, updates, keys, when_matched, null_safe).unionByName(inserted)


def merge_changes(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    when_matched: Mapping[str, str] | None = None,
    when_not_matched: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Only the rows a merge adds (``insert``) and changes (``update``)."""
    changes = {"insert": rows_to_insert(target, updates, keys, when_not_matched)}
    if when_matched:
        changes["update"] = _updated(target, updates, keys, when_matched, False, "inner")
    return changes


def _updated(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    when_matched: Mapping[str, str],
    null_safe: bool,
    kind: str = "left",
) -> DataFrame:
    # One row per key before the join: copies collapse map-side, and the count
    # tells an ambiguous update from a clean one.
    per_key = aggregate_for_join(
        updates,
        keys,
        F.count(F.lit(1)).alias("_copies"),
        F.first(F.struct(*[F.col(f"`{c}`") for c in updates.columns])).alias("_row"),
    )
    source = per_key.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in updates.columns], F.col("_copies")
    ).alias("u")
    joined = target.alias("t").join(source, same_key("t", "u", keys, null_safe), kind)
    copies = F.col("u._copies")
    types = {f.name: f.dataType for f in target.schema.fields}
    merged = []
    for name in target.columns:
        old = F.col(f"t.`{name}`")
        if name in when_matched:
            clash = F.raise_error(F.lit("several update rows match one target row"))
            new = F.expr(when_matched[name]).cast(types[name])
            value = (
                F.when(copies.isNull(), old)
                .when(copies > 1, clash.cast(types[name]))
                .otherwise(new)
            )
        else:
            value = old
        merged.append(value.alias(name))
    return joined.select(merged)


def conditional_update(
    df: DataFrame, condition: Column, changes: Mapping[str, Column]
) -> DataFrame:
    """Set columns on the rows that satisfy ``condition``, keep the others."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {
            name: F.when(condition, value.cast(types[name])).otherwise(F.col(f"`{name}`"))
            for name, value in changes.items()
        }
    )


def rows_to_append(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`rows_to_insert`, where only rows within the dates of a stored target are joined.

    If a key column is a date, rows before the first or after the last date of
    the target, or without a date, can have no match: they take no shuffle.
    """
    dates = [k for k in keys if isinstance(target.schema[k].dataType, DateType)]
    if not dates:
        return rows_to_insert(target, updates, keys)
    day = F.col(f"`{dates[0]}`")
    first, last = target.agg(F.min(day), F.max(day)).first()
    if first is None:
        return _in_columns_of(target, updates)
    inside = F.coalesce(day.between(F.lit(first), F.lit(last)), F.lit(False))
    joined = rows_to_insert(target, updates.where(inside), keys)
    return joined.unionByName(_in_columns_of(target, updates.where(~inside)))


def merge_into_table(
    spark: SparkSession, name: str, updates: DataFrame, keys: Sequence[str]
) -> None:
    """Insert-only merge into a named table: append what is missing.

    Nothing that is stored is rewritten, so the cost follows the batch and the
    key columns of the table, not its full width.
    """
    rows_to_append(spark.table(name), updates, keys).write.mode("append").saveAsTable(name)
