"""Row filters and cleaning columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import blank_to, first_name, last_name


def where_in(df: DataFrame, choices: Mapping[str, Sequence | None]) -> DataFrame:
    """Keep rows whose columns hold one of the chosen values.

    An empty or missing choice puts no condition on its column.
    """
    for column, values in choices.items():
        if values:
            df = df.where(F.col(column).isin(list(values)))
    return df


def where_between(df: DataFrame, column: str, first, last) -> DataFrame:
    """Keep rows from ``first`` to ``last``, both included."""
    return df.where(F.col(column).between(F.lit(first), F.lit(last)))


def flag_before(df: DataFrame, date_column: str, cutoff: str, name: str = "IsFlagged") -> DataFrame:
    """True for dates before the cutoff; later and null dates are False."""
    early = F.col(date_column) < F.lit(cutoff).cast("date")
    return df.withColumn(name, F.when(early, True).otherwise(False))


def fill_blank(df: DataFrame, column: str, default: str) -> DataFrame:
    return df.withColumn(column, blank_to(F.col(column), default))


def with_provenance(df: DataFrame, source=None) -> DataFrame:
    """Add source file name and load dates.

    ``source`` defaults to the file path Spark tracks for file scans.
    """
    origin = F.col("_metadata.file_path") if source is None else source
    today = F.current_timestamp().cast("date")
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns],
        origin.alias("FileName"),
        today.alias("CreatedTS"),
        today.alias("ModifiedTS"),
    )


def clean_sales(df: DataFrame, cutoff: str) -> DataFrame:
    """Flag early orders and name unknown customers."""
    return fill_blank(flag_before(df, "OrderDate", cutoff), "CustomerName", "Unknown")


def with_calendar(df: DataFrame, date_column: str = "OrderDate") -> DataFrame:
    """Add ``Year`` and ``Month``; text dates that do not parse give null."""
    day = F.col(date_column).try_cast("date")
    return df.withColumns({"Year": F.year(day), "Month": F.month(day)})


def with_names(df: DataFrame, name_column: str = "CustomerName") -> DataFrame:
    name = F.col(name_column)
    return df.withColumns({"FirstName": first_name(name), "LastName": last_name(name)})


def transform_orders(df: DataFrame, email: str = "Email", tax: str = "Tax") -> DataFrame:
    """Calendar and name columns, in report order, without the full name."""
    shaped = with_names(with_calendar(df))
    return shaped.select(
        "SalesOrderNumber",
        "SalesOrderLineNumber",
        "OrderDate",
        "Year",
        "Month",
        "FirstName",
        "LastName",
        email,
        "Item",
        "Quantity",
        "UnitPrice",
        tax,
    )
