"""Time series on a regular grid, as rows (key, bin) instead of arrays.

A series covers ``[start, end)`` in equal steps. The step is a hundredth of the
range but at least ``min_step``, so a key has about a hundred grid rows at most.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEPS = 100


class Grid(NamedTuple):
    """Bounds of a series in microseconds since the epoch."""

    start: Column
    end: Column
    step: Column

    @property
    def last_bin(self) -> Column:
        return F.floor((self.end - self.start - 1) / self.step)


def bind_grid(
    df: DataFrame,
    time: str,
    min_step: str,
    now: str | Column | None = None,
    since: str | None = None,
) -> tuple[DataFrame, Grid]:
    """Attach the grid of a table's time column to its rows.

    The range runs from the later of ``since`` and the first time to ``now``,
    which is not in it. By default it ends just past the newest time, so that
    the newest rows are in it. The bounds are one scalar subquery: an aggregate
    with a single row that Spark runs once and hands to all tasks.
    """
    lower = F.unix_micros(F.min(time))
    upper = F.unix_micros(F.max(time)) + 1
    if since is not None:
        lower = F.greatest(lower, F.unix_micros(F.lit(since).cast("timestamp")))
    if now is not None:
        upper = F.first(F.unix_micros(F.lit(now).cast("timestamp")))
    shortest = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {min_step}"))
    step = F.greatest(F.expr(f"(_end - _start) div {STEPS}"), shortest)
    bounds = (
        df.agg(lower.alias("_start"), upper.alias("_end"))
        .select(F.struct("_start", "_end", step.alias("_step")).alias("_grid"))
        .scalar()
    )
    grid = Grid(F.col("_grid._start"), F.col("_grid._end"), F.col("_grid._step"))
    return df.withColumn("_grid", bounds), grid


def make_series(
    df: DataFrame,
    by: Sequence[str],
    time: str,
    value: str,
    min_step: str,
    now: str | Column | None = None,
    since: str | None = None,
) -> DataFrame:
    """Largest value per key and bin, gaps filled along straight lines.

    Result: ``by``, ``bin``, ``bin_time`` and the value as double. Before the
    first and after the last known bin the series is flat; a key with no value
    at all is constant 0.

    Rows collapse to one per key and bin before any shuffle, so the window over
    a key sees about a hundred rows, however many rows the key has. Each known
    bin then emits the bins up to the next known one, which makes the grid and
    fills it in one step without a join.
    """
    bound, grid = bind_grid(df, time, min_step, now, since)
    at = F.unix_micros(time)
    inside = (at >= grid.start) & (at < grid.end)
    known = (
        bound.where(inside)
        .groupBy(*by, F.floor((at - grid.start) / grid.step).alias("_bin"))
        .agg(
            F.max(value).cast("double").alias("_v"),
            F.first(grid.start).alias("_start"),
            F.first(grid.step).alias("_step"),
            F.first(grid.last_bin).alias("_end_bin"),
        )
    )
    return fill_linear(known, by, value)


def fill_linear(known: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Expand known bins (``_bin``, ``_v``, grid columns) to all bins of the grid."""
    per_key = Window.partitionBy(*by)
    # Bins without a value sort last, so they never sit between two known bins.
    in_order = per_key.orderBy(F.col("_v").isNull(), "_bin")
    steps = known.select(
        *by,
        "_bin",
        "_v",
        "_start",
        "_step",
        "_end_bin",
        F.row_number().over(in_order).alias("_nth"),
        F.lead(F.when(F.col("_v").isNotNull(), F.col("_bin"))).over(in_order).alias("_next_bin"),
        F.lead("_v").over(in_order).alias("_next_v"),
    ).where(F.col("_v").isNotNull() | (F.col("_nth") == 1))
    first, last = F.col("_nth") == 1, F.col("_next_bin").isNull()
    low = F.when(first, F.lit(0)).otherwise(F.col("_bin")).cast("long")
    high = F.when(last, F.col("_end_bin")).otherwise(F.col("_next_bin") - 1).cast("long")
    gap = (F.col("_next_bin") - F.col("_bin")).cast("double")
    on_line = F.col("_v") + (F.col("_next_v") - F.col("_v")) * (
        (F.col("bin") - F.col("_bin")).cast("double") / gap
    )
    filled = (
        F.when(F.col("_v").isNull(), F.lit(0.0))
        .when(last | (F.col("bin") <= F.col("_bin")), F.col("_v"))
        .otherwise(on_line)
    )
    return steps.withColumn("bin", F.explode(F.sequence(low, high))).select(
        *by,
        "bin",
        F.timestamp_micros(F.col("_start") + F.col("bin") * F.col("_step")).alias("bin_time"),
        filled.alias(value),
    )


def total_per_bin(series: DataFrame, value: str, name: str) -> DataFrame:
    """Sum over all keys per grid time; each value is cut to a whole number first."""
    return series.groupBy("bin_time").agg(F.sum(F.col(value).cast("int")).alias(name))


def at_least(series: DataFrame, column: str, threshold: float) -> DataFrame:
    """Rows that reach the alert threshold."""
    return series.where(F.col(column) >= F.lit(threshold))
