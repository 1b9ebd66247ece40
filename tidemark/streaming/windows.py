"""Windowed aggregates on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling_bikes(
    events: DataFrame,
    length: str = "5 seconds",
    lateness: str = "1 minute",
    time: str = "EnqueuedTime",
) -> DataFrame:
    """Bikes per street and tumbling window ``[start, end)``.

    Rows of a window are summed per task before the shuffle to the state store,
    so a busy street is no hot spot. ``lateness`` is how long a window waits for
    late events; with ``append`` output a window appears once it is closed.
    """
    summed = (
        events.withWatermark(time, lateness)
        .groupBy(F.window(time, length), "Street")
        .agg(F.sum("No_Bikes").cast("double").alias("SUM_No_Bikes"))
    )
    return summed.select(
        "Street", "SUM_No_Bikes", F.col("window.end").alias("Window_End_Time")
    )


def once(events: DataFrame, key: str, lateness: str, time: str = "EnqueuedTime") -> DataFrame:
    """Events without redeliveries and without those that come too late.

    An event is late when its time is not after the newest time before the last
    micro-batch less ``lateness``. It goes here, row by row, so the dropped rows
    that the stream reports are events. The state holds the keys of the last
    ``lateness`` and nothing older.
    """
    return events.withWatermark(time, lateness).dropDuplicatesWithinWatermark([key])


def closed_windows(
    events: DataFrame,
    key: str,
    length: str = "5 seconds",
    lateness: str = "1 minute",
    time: str = "EnqueuedTime",
) -> DataFrame:
    """Bikes and events per street and window, each window once, when it is closed.

    For the append sink: a window appears when the watermark passes its end, and
    its state goes with it. Redelivered events count once.
    """
    counted = (
        once(events, key, lateness, time)
        .groupBy(F.window(time, length), "Street")
        .agg(F.sum("No_Bikes").cast("double").alias("SUM_No_Bikes"), F.count(F.lit(1)).alias("n_events"))
    )
    return counted.select(
        "Street", "SUM_No_Bikes", "n_events", F.col("window.end").alias("Window_End_Time")
    )


def docks_per_window(
    events: DataFrame, length: str, lateness: str, time: str = "EnqueuedTime"
) -> DataFrame:
    """Largest number of free docks per station and window."""
    return (
        events.withWatermark(time, lateness)
        .groupBy(F.window(time, length), "BikepointID")
        .agg(F.max("No_Empty_Docks").alias("docks"))
        .select("BikepointID", "docks", F.col("window.start").alias("window_start"))
    )


def alerts(windowed: DataFrame, column: str, threshold: float) -> DataFrame:
    """Windows that reach the threshold."""
    return windowed.where(F.col(column) >= F.lit(threshold))
