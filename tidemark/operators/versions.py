"""Older states of a keyed table, kept as a log of changed rows.

The log has two Parquet folders with one partition per version: the rows a
version changed, each marked ``insert``, ``update`` or ``delete``, and one row
per version that names its operation. Version 0 is the first full load. Every
so many versions the whole table is written beside the log, so that a read
starts at the newest such snapshot and adds the few versions after it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import rows_without_match
from tidemark.operators.merge import conditional_update, merge_changes
from tidemark.session import folder_names

VERSION = "_version"
CHANGE = "_change"
OPERATION = "_operation"
CHANGES = ("insert", "update", "delete")


class ChangeLog:
    """A keyed table with readable history at ``path``.

    ``snapshot_every`` versions a snapshot is written; none without it.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: str,
        key: Sequence[str],
        snapshot_every: int | None = None,
    ):
        self.spark = spark
        self.path = path
        self.key = list(key)
        self.schema = schema
        self.snapshot_every = snapshot_every
        self._log_schema = f"{schema}, {CHANGE} string, {VERSION} int"

    def commit(self, version: int, operation: str, changes: Mapping[str, DataFrame]) -> None:
        """Add a version: its operation and the rows it inserted, updated or deleted.

        ``changes`` maps kinds of change to rows; a key occurs in one kind only.
        All kinds go into one folder that is replaced as a whole, and the version
        counts once its operation is written after that, so a commit that is
        tried again after a failure leaves the same log. A version may change
        nothing.
        """
        if unknown := set(changes) - set(CHANGES):
            raise ValueError(f"unknown kinds of change: {sorted(unknown)}")
        marked = [rows.withColumn(CHANGE, F.lit(kind)) for kind, rows in changes.items()]
        empty = self.spark.createDataFrame([], f"{self.schema}, {CHANGE} string")
        rows = reduce(DataFrame.unionByName, marked) if marked else empty
        rows.write.mode("overwrite").parquet(f"{self.path}/rows/{VERSION}={version}")
        self.spark.createDataFrame([(operation,)], f"{OPERATION} string").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{self.path}/commits/{VERSION}={version}")
        if self.snapshot_every and version and version % self.snapshot_every == 0:
            self.snapshot(version)

    def snapshot(self, version: int) -> None:
        """Write the table as of a version, for later reads to start from.

        It counts once its mark is written after it, so one that stopped half
        way is never read, and is replaced when it is tried again.
        """
        self._state(version, version - 1).write.mode("overwrite").parquet(
            f"{self.path}/snapshots/{VERSION}={version}"
        )
        mark = self.spark.createDataFrame([(version,)], "version int").coalesce(1)
        mark.write.mode("overwrite").parquet(f"{self.path}/marks/{VERSION}={version}")

    def snapshots(self) -> list[int]:
        """The versions that have a finished snapshot."""
        names = folder_names(self.spark, f"{self.path}/marks")
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{VERSION}="))

    def merge(
        self, version: int, updates: DataFrame, when_matched: Mapping[str, str] | None = None
    ) -> None:
        """Commit a merge into the state before ``version``: inserts and updates together."""
        before = self.as_of(version - 1)
        self.commit(version, "MERGE", merge_changes(before, updates, self.key, when_matched))

    def update(self, version: int, condition: Column, changes: Mapping[str, Column]) -> None:
        """Commit a conditional update of the state before ``version``."""
        touched = self.as_of(version - 1).where(condition)
        changed = conditional_update(touched, F.lit(True), changes)
        self.commit(version, "UPDATE", {"update": changed})

    def commits(self) -> DataFrame:
        """One row per version: its number and operation."""
        return self.spark.read.schema(f"{OPERATION} string, {VERSION} int").parquet(
            f"{self.path}/commits"
        )

    def log(self) -> DataFrame:
        return self.spark.read.schema(self._log_schema).parquet(f"{self.path}/rows")

    def as_of(self, version: int) -> DataFrame:
        """Rows of the table as they were after ``version``.

        Reads the newest snapshot up to it, or else the first load, and the
        versions after that. These few are reduced to the newest change of each
        key; the others of the snapshot's rows stay as they are, so it is read
        without a sort, and not shuffled either while Spark knows the changes
        to be small.
        """
        return self._state(version, version)

    def _state(self, version: int, newest_snapshot: int) -> DataFrame:
        base = max((v for v in self.snapshots() if v <= newest_snapshot), default=0)
        if base:
            start = self.spark.read.schema(self.schema).parquet(f"{self.path}/snapshots/{VERSION}={base}")
        else:
            start = self.log().where(F.col(VERSION) == 0).drop(VERSION, CHANGE)
        if version <= base:
            return start
        values = [c for c in start.columns if c not in self.key]
        newest = (
            self.log()
            .where((F.col(VERSION) > base) & (F.col(VERSION) <= version))
            .groupBy(*[F.col(f"`{c}`") for c in self.key])
            .agg(F.max_by(F.struct(CHANGE, *[F.col(f"`{c}`") for c in values]), VERSION).alias("_last"))
        )
        changed = newest.where(F.col(f"_last.{CHANGE}") != "delete").select(
            *[F.col(f"`{c}`") if c in self.key else F.col(f"_last.`{c}`").alias(c) for c in start.columns]
        )
        return rows_without_match(start, newest, self.key, null_safe=True).unionByName(changed)

    def history(self) -> DataFrame:
        """One row per version, also for those that changed nothing: operation and counts."""
        counted = self.log().groupBy(VERSION).agg(
            *[F.count_if(F.col(CHANGE) == kind).alias(kind) for kind in CHANGES]
        )
        names = dict(zip(CHANGES, ("rows_inserted", "rows_updated", "rows_deleted"), strict=True))
        return (
            self.commits()
            .join(counted, VERSION, "left")
            .select(
                F.col(VERSION).alias("version"),
                F.col(OPERATION).alias("operation"),
                *[F.coalesce(kind, F.lit(0)).alias(name) for kind, name in names.items()],
            )
        )
