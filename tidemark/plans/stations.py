"""Bike station reports over the station table.

``TIME`` is the landing time of an event. Reports about "now" take the moment
``now`` as a parameter; :func:`newest` gives the newest time of the whole table,
whatever is selected from it. Without ``now`` the rows given are the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import as_of, day_bin, newer_than
from tidemark.functions.numbers import fill_rate
from tidemark.functions.text import blank_to, label
from tidemark.operators import series
from tidemark.operators.aggregates import (
    labelled_counts,
    latest,
    latest_and_earliest,
    subtotals,
)
from tidemark.operators.alerts import AlertLog
from tidemark.operators.cleaning import where_in
from tidemark.operators.partials import SeriesPartials
from tidemark.operators.ranking import change_from_previous, top

TIME = "EnqueuedTime"
STATION = "BikepointID"
TIE = "EventID"


def base(
    stations: DataFrame,
    neighbourhoods: Sequence[str] | None = None,
    streets: Sequence[str] | None = None,
) -> DataFrame:
    """Chosen neighbourhoods and streets (none chosen means all) with fill rate."""
    chosen = where_in(stations, {"Neighbourhood": neighbourhoods, "Street": streets})
    return chosen.withColumn("fill_rate", fill_rate(F.col("No_Bikes"), F.col("No_Empty_Docks")))


def newest(stations: DataFrame) -> Column:
    """The newest time in the table, as a scalar subquery."""
    return as_of(stations, TIME)


def recent(rows: DataFrame, age: str = "1 hour", now: str | Column | None = None) -> DataFrame:
    return rows.where(newer_than(F.col(TIME), as_of(rows, TIME, now), age))


def neighbourhood_choices(stations: DataFrame) -> DataFrame:
    return stations.select("Neighbourhood").distinct()


def street_choices(stations: DataFrame, neighbourhoods: Sequence[str] | None = None) -> DataFrame:
    return where_in(stations, {"Neighbourhood": neighbourhoods}).select("Street").distinct()


def points_on_street(stations: DataFrame, street: str) -> DataFrame:
    return stations.where(F.col("Street") == street).select(STATION).distinct()


def latest_state(
    rows: DataFrame, age: str | None = "1 hour", now: str | Column | None = None
) -> DataFrame:
    """Newest row of every station."""
    seen = rows if age is None else recent(rows, age, now)
    return latest(seen, [STATION], TIME, TIE)


def station_change(rows: DataFrame) -> DataFrame:
    """Newest values of every station and the change since its earliest row."""
    ends = latest_and_earliest(
        rows,
        [STATION],
        TIME,
        TIE,
        ["Neighbourhood", "Street", "No_Bikes", "No_Empty_Docks", "fill_rate"],
        ["No_Empty_Docks", "No_Bikes"],
    )
    return ends.withColumn("Bikes_change", F.col("No_Bikes") - F.col("No_Bikes1"))


def fullest(
    rows: DataFrame,
    n: int = 10,
    age: str | None = "1 hour",
    now: str | Column | None = None,
    emptiest: bool = False,
) -> DataFrame:
    """Stations with the highest (or lowest) fill rate and their change."""
    seen = rows if age is None else recent(rows, age, now)
    ranked = top(station_change(seen), n, F.col("fill_rate"), [STATION], ascending=emptiest)
    return ranked.select(
        STATION, "Neighbourhood", "Street", "No_Bikes", "No_Empty_Docks", "Bikes_change"
    )


def map_points(
    rows: DataFrame, age: str | None = "1 hour", now: str | Column | None = None
) -> DataFrame:
    """Map labels: one row per station place and per number of free docks seen.

    The label is part of the key, so a station shows once per dock count.
    """
    seen = rows if age is None else recent(rows, age, now)
    text = label(F.col("No_Empty_Docks"), " @", F.col(STATION))
    labelled = seen.withColumn("available docks", text)
    keys = [STATION, "Latitude", "Longitude", "available docks"]
    return latest(labelled, keys, TIME, TIE, [TIME, "No_Empty_Docks"])


def bikes_per_street(rows: DataFrame) -> DataFrame:
    return rows.groupBy("Street").agg(F.sum("No_Bikes").alias("countBikes"))


def streets_with_most_docks(rows: DataFrame, n: int = 5) -> DataFrame:
    per_street = rows.groupBy("Street").agg(F.sum("No_Empty_Docks").alias("countEmptyDocks"))
    return top(per_street, n, F.col("countEmptyDocks"), ["Street"])


def most_popular_point(rows: DataFrame, n: int = 1) -> DataFrame:
    per_point = rows.groupBy(STATION).agg(F.sum("No_Bikes").alias("SumOfBikes"))
    return top(per_point, n, F.col("SumOfBikes"), [STATION])


def points_per_neighbourhood(rows: DataFrame) -> DataFrame:
    return rows.groupBy("Neighbourhood").agg(F.count(F.lit(1)).alias("count_"))


def bikes_per_neighbourhood(rows: DataFrame) -> DataFrame:
    """Sums per neighbourhood, blank ones named, largest first."""
    summed = rows.groupBy("Neighbourhood").agg(F.sum("No_Bikes").alias("_bikes"))
    named = summed.select(
        blank_to(F.col("Neighbourhood"), "Unidentified").alias("Neighbourhood"),
        F.col("_bikes").alias("Total Number of Bikes"),
    )
    return (
        named.groupBy("Neighbourhood")
        .agg(F.sum("Total Number of Bikes").alias("Total Number of Bikes"))
        .orderBy(F.col("Total Number of Bikes").desc_nulls_last(), "Neighbourhood")
    )


def bikes_per_day(rows: DataFrame) -> DataFrame:
    return rows.groupBy(day_bin(F.col(TIME)).alias("day")).agg(
        F.sum("No_Bikes").alias("countBikes")
    )


def event_counts(rows: DataFrame, now: str | Column | None = None) -> DataFrame:
    """Events in total, in the last hour and in the last minute, from one scan."""
    moment = as_of(rows, TIME, now)
    time = F.col(TIME)
    counts = labelled_counts(
        rows,
        {
            "Total": None,
            "Last hour": newer_than(time, moment, "1 hour"),
            "Last minute": newer_than(time, moment, "1 minute"),
        },
    )
    return counts.orderBy("Order")


def matrix(rows: DataFrame) -> DataFrame:
    """Bikes and docks for neighbourhood, street and station with subtotals."""
    levels = ["Neighbourhood", "Street", STATION]
    return subtotals(rows, levels, ["No_Bikes", "No_Empty_Docks"])


def points_per_street(rows: DataFrame) -> DataFrame:
    """Events with a station id and free docks per street, largest count first."""
    per_street = rows.groupBy("Street").agg(
        F.count(STATION).alias("point_count"), F.sum("No_Empty_Docks").alias("empty_docks")
    )
    return per_street.orderBy(F.col("point_count").desc(), "Street")


def bikes_per_place(rows: DataFrame) -> DataFrame:
    return rows.groupBy("Longitude", "Latitude").agg(F.sum("No_Bikes").alias("bikes"))


def previous_change(rows: DataFrame) -> DataFrame:
    """The last two events of every station with the change from the one before."""
    return change_from_previous(
        rows,
        [STATION],
        TIME,
        TIE,
        {"CountChange": "No_Bikes", "EmptyCountChange": "No_Empty_Docks"},
    )


def available_docks(
    rows: DataFrame,
    min_step: str = "2 minutes",
    now: str | Column | None = None,
    since: str | None = None,
) -> DataFrame:
    """Free docks of all stations over time, gaps filled per station."""
    filled = series.make_series(rows, [STATION], TIME, "No_Empty_Docks", min_step, now, since)
    return series.total_per_bin(filled, "No_Empty_Docks", "Available Docks")


def dock_partials(spark: SparkSession, path: str, base: str = "2 minutes") -> SeriesPartials:
    """Stored partials of the free docks, by station and the columns the dashboard selects by."""
    by = [STATION, "Neighbourhood", "Street"]
    return SeriesPartials(spark, path, by, TIME, "No_Empty_Docks", base)


def refreshed_docks(
    partials: SeriesPartials, unread: DataFrame, min_step: str, since: str | None = None
) -> DataFrame:
    """:func:`available_docks` of the whole table from partials and the rows they do not hold yet."""
    partials.require_step(min_step)
    return available_docks(partials.rows(unread), min_step, since=since)


# Fixed value: the alert threshold of the daily series.
ALERT_DOCKS = 1500


def dock_alerts(
    rows: DataFrame,
    threshold: float = ALERT_DOCKS,
    now: str | Column | None = None,
    since: str | None = None,
) -> DataFrame:
    """Days on which the free docks reach the threshold."""
    daily = available_docks(rows, "1 day", now, since)
    return series.at_least(daily, "Available Docks", threshold)


def dock_alert_run(
    log: AlertLog,
    number: int,
    rows: DataFrame,
    threshold: float = ALERT_DOCKS,
    now: str | Column | None = None,
    since: str | None = None,
) -> DataFrame:
    """A scheduled run over the rows so far: what it raised, corrected or cleared, by day.

    The days come from the same series as :func:`dock_alerts`. A day that stays
    above the threshold is raised by the first run that sees it and by no other.
    """
    daily = available_docks(rows, "1 day", now, since)
    return log.run(
        number,
        daily.select(F.to_date("bin_time").alias("day"), F.col("Available Docks").alias("docks")),
        threshold,
    )


def dashboard(
    stations: DataFrame,
    neighbourhoods: Sequence[str] | None = None,
    streets: Sequence[str] | None = None,
    now: str | Column | None = None,
    since: str | None = None,
    partials: SeriesPartials | None = None,
    unread: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All dashboard tiles over one filtered base, each still lazy.

    "Now" is the newest time of the unfiltered table, so an area without recent
    events shows none. Give ``now`` to let all tiles agree on the moment while
    the table grows; a series then ends before it. With ``partials`` (and
    ``unread``, the rows they do not hold) the series and the newest time come
    from these; ``now`` must then be after the rows they hold.
    """
    rows = base(stations, neighbourhoods, streets)
    whole, docks = stations, rows
    if partials is not None:
        partials.require_step("2 minutes")
        whole = partials.rows(unread)
        docks = where_in(whole, {"Neighbourhood": neighbourhoods, "Street": streets})
    end = now if now is not None else newest(whole) + F.expr("INTERVAL 1 microsecond")
    now = now if now is not None else newest(whole)
    return {
        "fullest": fullest(rows, now=now),
        "emptiest": fullest(rows, now=now, emptiest=True),
        "map": map_points(rows, now=now),
        "bikes_per_street": bikes_per_street(rows),
        "event_counts": event_counts(rows, now),
        "docks_fine": available_docks(docks, "2 minutes", end, since),
        "docks_daily": available_docks(docks, "1 day", end, since),
        "neighbourhood_choices": neighbourhood_choices(stations),
        "street_choices": street_choices(stations, neighbourhoods),
    }
