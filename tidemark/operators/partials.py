"""Stored partials of a series, so that a refresh reads them and the open rows only.

The grid of a series moves with its range, so no fixed bins can be stored. Kept
instead, per key and base bin, are the values that a part of that bin can have as
its largest: going down from the largest value, those that are seen earlier or
later than all larger ones. Each is kept at its first and its last time. A grid
whose step is no shorter than a base bin cuts it once at most, and the kept rows
before and after the cut have the largest values of either part: a series of the
kept rows is the series of all rows. This also holds for a union of deliveries,
so partials of files, days and late rows need no merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.series import make_series
from tidemark.session import folder_names

DELIVERY = "_delivery"


def kept_rows(df: DataFrame, by: Sequence[str], time: str, value: str, base: str) -> DataFrame:
    """The rows (``by``, time, value) that stand for all of them in every grid not finer than ``base``.

    Rows collapse to one per key, base bin and value before the shuffle, so a hot
    key costs each task a row per bin and value. A bin's null values are kept too:
    they bound the range, and a key may have no others. Rows without a time go.
    """
    length = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {base}"))
    at = F.unix_micros(time)
    keys = [F.col(f"`{c}`") for c in by]
    seen = (
        df.where(F.col(time).isNotNull())
        .groupBy(*keys, F.floor(at / length).alias("_bin"), F.col(value).alias("_v"))
        .agg(F.min(at).alias("_first"), F.max(at).alias("_last"))
    )
    larger = (
        Window.partitionBy(*keys, "_bin")
        .orderBy(F.col("_v").desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = F.min("_first").over(larger)
    later = F.max("_last").over(larger)
    ranked = seen.select(*keys, "_v", "_first", "_last", earlier.alias("_e"), later.alias("_l"))
    first, last = F.col("_first"), F.col("_last")
    top = F.col("_e").isNull() | F.col("_v").isNull()
    times = F.array_distinct(
        F.array_compact(
            F.array(
                F.when(top | (first < F.col("_e")), first), F.when(top | (last > F.col("_l")), last)
            )
        )
    )
    return ranked.select(*keys, "_v", F.explode(times).alias("_at")).select(
        *keys, F.timestamp_micros("_at").alias(time), F.col("_v").alias(value)
    )


class SeriesPartials:
    """Partials of one value at ``path``, one folder per delivery of rows.

    ``base`` is the shortest step a series of them may have, such as "2 minutes".
    Rows kept by some columns can be filtered by them, and also serve series by
    fewer of them.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        by: Sequence[str],
        time: str,
        value: str,
        base: str,
    ):
        self.spark, self.path, self.by = spark, path, list(by)
        self.time, self.value, self.base = time, value, base

    def add(self, number: int, rows: DataFrame) -> None:
        """Store the partials of a delivery; each row of the table belongs to one delivery.

        A delivery that is tried again, by its number, replaces what it wrote, and
        counts once its mark is written after that.
        """
        kept = kept_rows(rows, self.by, self.time, self.value, self.base)
        kept.write.mode("overwrite").parquet(f"{self.path}/rows/{DELIVERY}={number}")
        mark = self.spark.createDataFrame([(number,)], "number int").coalesce(1)
        mark.write.mode("overwrite").parquet(f"{self.path}/marks/{DELIVERY}={number}")

    def deliveries(self) -> list[int]:
        """The numbers of the finished deliveries."""
        names = folder_names(self.spark, f"{self.path}/marks")
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{DELIVERY}="))

    def rows(self, unread: DataFrame) -> DataFrame:
        """The kept rows of all finished deliveries and the table's rows that no delivery holds yet.

        They have the first and the newest time of all rows. A series of them may
        start anywhere, and end after the newest row that a delivery holds.
        """
        columns = [F.col(f"`{c}`") for c in (*self.by, self.time, self.value)]
        found = unread.select(*columns)
        folders = [f"{self.path}/rows/{DELIVERY}={n}" for n in self.deliveries()]
        if not folders:
            return found
        stored = self.spark.read.schema(found.schema).parquet(*folders)
        return stored.select(*columns).unionByName(found)

    def series(self, unread: DataFrame, min_step: str, since: str | None = None) -> DataFrame:
        """:func:`~tidemark.operators.series.make_series` of the whole table, up to its newest row.

        Reads the partials and ``unread``, the rows no delivery holds.
        """
        self.require_step(min_step)
        rows = self.rows(unread)
        return make_series(rows, self.by, self.time, self.value, min_step, since=since)

    def require_step(self, min_step: str) -> None:
        if self._micros(min_step) < self._micros(self.base):
            raise ValueError(f"the partials hold steps of {self.base} and more")

    def _micros(self, interval: str) -> int:
        length = f"unix_micros(timestamp_micros(0) + INTERVAL {interval})"
        return self.spark.range(1).selectExpr(length).first()[0]
