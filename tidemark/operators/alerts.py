"""Alerts between scheduled runs: each is raised once, corrected when its value changes, and cleared.

The state is a version log of the alerts that stand; a run is a version, and its
events are the rows that version changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import rows_without_match
from tidemark.operators.versions import CHANGE, VERSION, ChangeLog

EVENTS = {"insert": "raised", "update": "corrected", "delete": "cleared"}


class AlertLog:
    """Alerts of a keyed value that reach a threshold.

    ``key`` names the column and ``key_type`` its type. Run 0 opens the log.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        key_type: str,
        value: str = "value",
        snapshot_every: int = 30,
    ):
        self.key, self.value = key, value
        schema = f"`{key}` {key_type}, `{value}` double"
        self.log = ChangeLog(spark, path, schema, [key], snapshot_every)

    def run(self, number: int, series: DataFrame, threshold: float) -> DataFrame:
        """Compare a series, one row per key, with the alerts that stand, and give the run's events.

        A key the series does not hold is left as it is: it was not looked at.
        A run that is tried again, by its number, gives the same events. Null
        keys and values take no part.
        """
        if number < 1:
            raise ValueError("runs are numbered from 1")
        if number == 1:
            self.log.commit(0, "OPEN", {})
        seen = series.select(
            F.col(f"`{self.key}`"), F.col(f"`{self.value}`").cast("double").alias(self.value)
        ).dropna()
        reached = seen.where(F.col(f"`{self.value}`") >= threshold)
        standing = self.log.as_of(number - 1)
        before = standing.select(self.key, F.col(f"`{self.value}`").alias("_before"))
        known = reached.join(before, self.key)
        self.log.commit(
            number,
            "RUN",
            {
                "insert": rows_without_match(reached, standing, [self.key]),
                "update": known.where(F.col(f"`{self.value}`") != F.col("_before")).drop("_before"),
                "delete": standing.join(
                    seen.where(F.col(f"`{self.value}`") < threshold).select(self.key), self.key, "left_semi"
                ),
            },
        )
        return self.events(number)

    def events(self, number: int) -> DataFrame:
        """What a run raised, corrected (with the new value) or cleared (with the last one)."""
        kinds = F.create_map(*[F.lit(x) for pair in EVENTS.items() for x in pair])
        changed = self.log.log().where(F.col(VERSION) == number)
        return changed.select(self.key, self.value, kinds[F.col(CHANGE)].alias("event"))

    def standing(self, number: int) -> DataFrame:
        """The alerts that stand after a run."""
        return self.log.as_of(number)
