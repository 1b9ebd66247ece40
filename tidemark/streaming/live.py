"""Dashboard figures that are kept up to date by a stream instead of by scans.

Each job is a streaming DataFrame for the ``update`` sink: a micro-batch writes
the keys it changed, and the readers below put the newest rows together.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.plans import stations
from tidemark.streaming.sinks import current_results

# Rolling windows of the counters, newest last.
ROLLING = {"Last hour": "1 hour", "Last minute": "1 minute"}
TOTAL = "Total"

_MILLI = 1000
_COUNTS = (
    "shard int, bucket bigint, events bigint, newest bigint, "
    "inside array<bigint>, edges array<array<bigint>>"
)
_STATE = "events bigint, newest bigint, times array<bigint>"


def _micros(interval: str) -> int:
    return pd.Timedelta(interval).value // 1000


def station_state(events: DataFrame) -> DataFrame:
    """Newest values of every station and the change since its earliest row, as they change.

    The state is one newest and one earliest row per station. Both follow from
    time and event id alone, so the order of arrival does not matter and a row
    that is delivered again changes nothing.
    """
    return stations.station_change(stations.base(events))


def rolling_counts(
    events: DataFrame,
    lateness: str,
    windows: Mapping[str, str] = ROLLING,
    bucket: str = "1 minute",
    shards: int = 16,
    time: str = stations.TIME,
) -> DataFrame:
    """Counts of all events and of those in windows that end at the newest event.

    "Now" is the newest time seen, which the watermark gives to all groups, also
    to those without new rows. State is kept per ``bucket`` of event time and
    shard (a hash of the row, so a busy moment is spread): the number of events,
    and their times while a window may still cut the bucket. A timer wakes a
    bucket when a time leaves a window and when no more rows can come, which
    ends its state. Rows more than ``lateness`` behind the newest are dropped,
    and Spark reports how many.

    The watermark has whole milliseconds. Times that only the microseconds of
    the newest event put in or out of a window are given one by one in
    ``edges``; :func:`current_counts` decides them. Null times take no part.
    """
    size = _micros(bucket)
    at = F.unix_micros(time)
    rows = events.where(F.col(time).isNotNull()).withWatermark(time, lateness)
    keyed = rows.select(
        F.pmod(F.xxhash64(*events.columns), F.lit(shards)).cast("int").alias("shard"),
        (at - F.pmod(at, F.lit(size))).alias("bucket"),
        at.alias("at"),
        time,
    )
    counter = _counter(_micros(lateness), [_micros(w) for w in windows.values()], size)
    return keyed.groupBy("shard", "bucket").applyInPandasWithState(
        counter, _COUNTS, _STATE, "update", GroupStateTimeout.EventTimeTimeout
    )


def _counter(lateness: int, spans: list[int], size: int):
    def count(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        shard, bucket = map(int, key)
        watermark = state.getCurrentWatermarkMs()
        now = watermark * _MILLI + lateness  # the newest time, less its last three digits
        events, newest, kept = state.get if state.exists else (0, bucket, [])
        times = [np.array(kept, np.int64)]
        for frame in () if state.hasTimedOut else frames:
            times.append(frame["at"].to_numpy(np.int64))
            events += len(frame)
            newest = max(newest, int(frame["at"].max()))
        times = np.sort(np.concatenate(times))
        times = times[times > now - max(spans)]
        inside, edges, wake = [], [], []
        for span in spans:
            sure = times[times > now - span + _MILLI - 1]
            edge = times[(times > now - span) & (times <= now - span + _MILLI - 1)]
            inside.append(len(sure))
            edges.append(edge.tolist())
            if len(sure):
                wake.append((int(sure[0]) + span) // _MILLI)
            if len(edge):
                wake.append(-(-(int(edge[0]) + span) // _MILLI))
        # A moment as "now" is reached when the watermark is `lateness` before it.
        wake = [moment - lateness // _MILLI for moment in wake] or [-(-(bucket + size) // _MILLI)]
        if len(times) == 0 and watermark > wake[0]:
            state.remove()
        else:
            state.update((events, newest, times.tolist()))
            state.setTimeoutTimestamp(max(min(wake) - 1, watermark, 1))
        yield pd.DataFrame(
            [(shard, bucket, events, newest, inside, edges)],
            columns=["shard", "bucket", "events", "newest", "inside", "edges"],
        )

    return count


def _number_after(times: Column, start: Column) -> Column:
    return F.size(F.filter(times, lambda t: t > start))


def current_counts(
    spark: SparkSession, path: str, windows: Mapping[str, str] = ROLLING
) -> DataFrame:
    """Label, count and order as of the last micro-batch of :func:`rolling_counts`.

    Reads one row per bucket and shard that ever had events, not the events.
    """
    buckets = current_results(spark, path, _COUNTS, ["shard", "bucket"])
    now = buckets.agg(F.max("newest").alias("now")).scalar()
    total = (F.lit(TOTAL).alias("Label"), F.col("events").alias("n"), F.lit(1).alias("Order"))
    labelled = [F.struct(*total)]
    for k, (label, window) in enumerate(windows.items()):
        last_ones = _number_after(F.col("edges")[k], F.col("now") - _micros(window))
        labelled.append(
            F.struct(
                F.lit(label).alias("Label"),
                (F.col("inside")[k] + last_ones).alias("n"),
                F.lit(k + 2).alias("Order"),
            )
        )
    each = buckets.withColumn("now", now).select(F.inline(F.array(*labelled)))
    return each.groupBy("Label", "Order").agg(F.sum("n").alias("Count")).select(
        "Label", "Count", "Order"
    )
