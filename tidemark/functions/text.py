"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(column: Column) -> Column:
    """True for null and for the empty string."""
    return column.isNull() | (column == "")


def blank_to(column: Column, default: str) -> Column:
    """Replace null and empty text by ``default``."""
    return F.when(is_blank(column), F.lit(default)).otherwise(column)


def part(column: Column, separator: str, position: int) -> Column:
    """The text between separators at ``position``, null when there is none.

    ``F.get`` is used since plain indexing throws past the end in ANSI mode.
    """
    return F.get(F.split(column, separator), F.lit(position))


def first_name(column: Column) -> Column:
    return part(column, " ", 0)


def last_name(column: Column) -> Column:
    """Second word of a name; further words are dropped."""
    return part(column, " ", 1)


def item_name(column: Column) -> Column:
    """Text of an item before the first ", "."""
    return part(column, ", ", 0)


def item_info(column: Column) -> Column:
    """Second part of an item, empty text when missing."""
    return blank_to(part(column, ", ", 1), "")


def label(*columns: Column | str) -> Column:
    """Concatenate values as text; a null counts as empty text."""
    pieces = [c if isinstance(c, Column) else F.lit(c) for c in columns]
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in pieces])
