"""Writers: files, managed and external tables, views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import struct


def managed_table(df: DataFrame, name: str) -> None:
    """Write a new managed table; it is an error if the table exists."""
    df.write.mode("error").saveAsTable(name)


def external_table(df: DataFrame, name: str, path: str) -> None:
    """Write files at ``path`` and name them as a table."""
    df.write.mode("error").option("path", path).saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """Append to a table, creating it on first use."""
    df.write.mode("append").saveAsTable(name)


def replace_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def partitioned_parquet(
    df: DataFrame, path: str, by: Sequence[str], max_rows_per_file: int = 20_000_000
) -> None:
    """Write one folder per value of ``by``.

    A rebalance by the partition columns brings the rows of a folder together,
    so a folder gets few files, and AQE splits a folder that holds far more rows
    than the others over several tasks instead of piling it on one.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in by])
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy(*by)
        .parquet(path)
    )


def csv(df: DataFrame, path: str, header: bool = True, **dialect: str) -> None:
    df.write.mode("overwrite").options(**dialect).option("header", header).csv(path)


def copy_delimited(
    source: DataFrame,
    path: str,
    separator: str = ",",
    quote: str = '"',
    escape: str = "\\",
    header: bool = True,
) -> None:
    """Write a table as delimited text with a chosen dialect."""
    csv(source, path, header=header, sep=separator, quote=quote, escape=escape)


def create_if_absent(spark: SparkSession, name: str, schema: str) -> bool:
    """Create an empty table with declared columns; False if it was there."""
    if spark.catalog.tableExists(name):
        return False
    spark.createDataFrame([], struct(schema)).write.saveAsTable(name)
    return True


def register_files(spark: SparkSession, name: str, path: str) -> None:
    """Name Parquet files that exist already as a table."""
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def describe(spark: SparkSession, name: str, formatted: bool = False) -> DataFrame:
    """Column list and table properties as rows."""
    detail = "FORMATTED" if formatted else "EXTENDED"
    return spark.sql(f"DESCRIBE {detail} {name}")


def as_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def materialise(df: DataFrame, name: str, kind: str) -> DataFrame:
    """Publish a model as a ``view`` (lazy) or a ``table`` (written)."""
    if kind == "view":
        as_view(df, name)
    elif kind == "table":
        replace_table(df, name)
    else:
        raise ValueError(f"unknown kind of model: {kind}")
    return df.sparkSession.table(name)
