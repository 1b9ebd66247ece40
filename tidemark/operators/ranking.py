"""Top rows and changes between consecutive rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top(
    df: DataFrame, n: int, by: Column, tie: Sequence[str], ascending: bool = False
) -> DataFrame:
    """The ``n`` rows with the largest (or smallest) value, nulls last.

    Each task keeps its own ``n`` rows, so only those travel.
    """
    first = by.asc_nulls_last() if ascending else by.desc_nulls_last()
    return df.orderBy(first, *[F.col(c).asc() for c in tie]).limit(n)


def change_from_previous(
    df: DataFrame, by: Sequence[str], time: str, tie: str, changes: dict[str, str]
) -> DataFrame:
    """The last two rows of every key with the previous minus the current value.

    ``changes`` maps new column names to the columns compared. The rank filter is
    applied per task before the shuffle, so a hot key sends two rows per task.
    """
    newest_first = Window.partitionBy(*by).orderBy(F.col(time).desc(), F.col(tie).desc())
    last_two = df.withColumn("_rank", F.row_number().over(newest_first)).where("_rank <= 2")
    previous = {
        name: F.lead(column).over(newest_first) - F.col(column) for name, column in changes.items()
    }
    return last_two.withColumns(previous).drop("_rank")
