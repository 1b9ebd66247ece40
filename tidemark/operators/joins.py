"""Equi-joins against a keyed table that stay balanced on skewed keys.

Two rules hold in this package. No broadcast hints on data: Spark broadcasts a
side on its own when its size is known to be under the limit, and shuffles both
sides otherwise. And a join whose row side may have a hot key gets two plain
shuffles under it, since that is the shape in which AQE splits a hot partition
over several tasks. An aggregate between shuffle and join would prevent that.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = "_bucket"
BUCKETS = 4096


def columns(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def key_bucket(keys: Sequence[str]) -> Column:
    """A number that follows from the key, to group by beside the key.

    It changes no group, but the grouped table is then not partitioned by the
    key alone, so that a join on the key shuffles it again. Only for joins with
    rows of possibly hot keys: against a side that is unique per key a plain
    ``groupBy`` saves that shuffle.
    """
    return F.pmod(F.xxhash64(*columns(keys)), F.lit(BUCKETS)).alias(BUCKET)


def aggregate_for_join(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """``groupBy(keys).agg(...)`` for a result that is joined on the same keys."""
    grouped = df.groupBy(*columns(keys), key_bucket(keys))
    return grouped.agg(*aggregates).drop(BUCKET)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; copies collapse before the shuffle."""
    return df.select(*columns(keys), key_bucket(keys)).distinct().select(*columns(keys))


def same_key(left: str, right: str, keys: Sequence[str], null_safe: bool = False) -> Column:
    """Join condition between two aliases."""

    def same(key: str) -> Column:
        a, b = F.col(f"{left}.`{key}`"), F.col(f"{right}.`{key}`")
        return a.eqNullSafe(b) if null_safe else a == b

    return reduce(lambda a, b: a & b, map(same, keys))


def rows_without_match(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Rows whose key is not in ``table`` (all copies of such rows).

    With plain equality a null never matches, so those rows are all returned.
    """
    known = distinct_keys(table, keys).alias("_t")
    on = same_key("_r", "_t", keys, null_safe)
    return rows.alias("_r").join(known, on, "left_anti").select(*columns(rows.columns))


def lookup(
    rows: DataFrame, dimension: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Add ``values`` of the matching dimension row, null when there is none."""
    side = dimension.select(*columns(keys), *columns(values)).alias("_t")
    joined = rows.alias("_r").join(side, same_key("_r", "_t", keys), "left")
    return joined.select(
        *[F.col(f"_r.`{c}`") for c in rows.columns], *[F.col(f"_t.`{v}`") for v in values]
    )
