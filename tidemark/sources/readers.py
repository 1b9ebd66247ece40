"""Readers: CSV, Parquet and named tables, always with a declared schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.schemas import ColumnMap, struct


def csv_with_header(
    spark: SparkSession, path: str, schema: str, by_position: bool = True
) -> DataFrame:
    """CSV whose first line is a header, read with a declared schema.

    Columns are taken by their position; with ``by_position`` false a header
    that names them otherwise fails the job.
    """
    reader = spark.read.schema(schema).option("header", True)
    return reader.option("enforceSchema", by_position).csv(path)


def csv_as_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and every column as text; cast with :func:`typed`."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def csv_files(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """Many headerless CSV files as one table."""
    return spark.read.schema(schema).option("header", False).csv(pattern)


def csv_positional(spark: SparkSession, path: str) -> DataFrame:
    """CSV without header or schema: text columns ``_c0``, ``_c1`` and so on."""
    return spark.read.option("header", False).option("inferSchema", False).csv(path)


def typed(df: DataFrame, schema: str) -> DataFrame:
    """Cast text columns to the declared types; text that does not fit is null."""
    return df.select(
        [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in struct(schema)]
    )


def csv_typed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with promoted header, no quoting, and typed columns."""
    text = spark.read.option("header", True).option("quote", "").csv(path)
    return typed(text, schema)


def delimited(
    spark: SparkSession,
    path: str,
    separator: str = ",",
    quote: str = '"',
    escape: str = "\\",
    header: bool = True,
) -> DataFrame:
    """Delimited text with a chosen dialect, all columns as text."""
    return (
        spark.read.option("sep", separator)
        .option("quote", quote)
        .option("escape", escape)
        .option("header", header)
        .csv(path)
    )


def parquet_subtree(spark: SparkSession, root: str, subtree: str) -> DataFrame:
    """One branch of a partitioned tree, partition columns kept."""
    return spark.read.option("basePath", root).parquet(f"{root.rstrip('/')}/{subtree}")


def mapped(df: DataFrame, mapping: Sequence[ColumnMap]) -> DataFrame:
    """Select, rename and cast columns by a mapping list."""
    return df.select([F.col(f"`{m.source}`").cast(m.type).alias(m.target) for m in mapping])


def mapped_parquet(
    spark: SparkSession,
    root: str,
    mapping: Sequence[ColumnMap],
    schema: StructType | None = None,
) -> DataFrame:
    """All files below a folder without partition discovery, mapped.

    The folder is listed by Spark and its names add no columns. With the files'
    ``schema`` no footer is read before the job.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    return mapped((reader.schema(schema) if schema else reader).parquet(root), mapping)


def table(spark: SparkSession, name: str, limit: int | None = None) -> DataFrame:
    """A named table, optionally its first ``limit`` rows in no set order."""
    df = spark.table(name)
    return df if limit is None else df.limit(limit)


class NullKeyError(ValueError):
    """A declared NOT NULL column holds null."""


def typed_load(df: DataFrame, schema: str) -> DataFrame:
    """Cast to a warehouse schema and fail the job on null in a NOT NULL column.

    Casts are strict: a value that does not fit its type fails the job. ``char``
    and ``varchar`` lengths are enforced by the same check. Everything is a
    column expression, so it runs inside the scan stage.
    """
    columns = []
    for field in struct(schema):
        source = F.col(f"`{field.name}`")
        kind = field.dataType.simpleString()
        if kind.startswith(("varchar", "char")):
            size = int(kind[kind.index("(") + 1 : -1])
            value = source.cast("string")
            value = F.when(
                F.length(value) > size,
                F.raise_error(F.lit(f"{field.name}: text longer than {size}")).cast("string"),
            ).otherwise(value)
        else:
            value = source.cast(field.dataType)
        if not field.nullable:
            value = F.when(
                value.isNull(),
                F.raise_error(F.lit(f"{field.name}: null in a NOT NULL column")).cast(
                    value_type(kind)
                ),
            ).otherwise(value)
        columns.append(value.alias(field.name))
    return df.select(columns)


def value_type(kind: str) -> str:
    return "string" if kind.startswith(("varchar", "char")) else kind


def reject_null_keys(df: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """Split rows into those with all NOT NULL columns filled and the rejects."""
    required = [f.name for f in struct(schema) if not f.nullable]
    if not required:
        return df, df.where(F.lit(False))
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(f"`{name}`").isNull()
    return df.where(~missing), df.where(missing)
