"""Tables laid out for merges, with a feed of the rows each batch added.

A keyed table is bucketed by its key and partitioned by period (if it has a date)
and by the batch that added a row. A merge then shuffles the batch to the
table's buckets and reads the key columns of the periods the batch touches; the
table itself is neither shuffled nor read as a whole. Readers see the batches up
to the committed one, so a batch that failed half way is invisible, and trying
it again replaces its own partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import columns
from tidemark.schemas import struct

BATCH = "_batch"
PERIOD = "_period"
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
BUCKET_ROWS = 250_000  # delivered and known rows that a task of a merge sorts in one bucket


class KeyedTable:
    """An insert-only table that knows which batch brought which row.

    Keys match by plain equality, so a row with a null in its key is always new.
    ``period`` is a date pattern of digits. Take it and ``buckets`` so that a
    bucket of one period fits a task's memory and is not a small file either.
    One writer at a time; a batch is the next whole number.

    The buckets only serve merges of up to ``BUCKET_ROWS`` rows a bucket. Larger
    ones, and joins with ``rows()``, leave the number of tasks to Spark.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        schema: str,
        key: Sequence[str],
        date: str | None = None,
        buckets: int = 16,
        period: str = "yyyyMM",
    ):
        self.spark, self.name, self.key = spark, name, list(key)
        self.date, self.buckets, self.period = date, buckets, period
        self.columns = struct(schema).names
        self._schema = schema
        self._log = f"{name}_batches"

    def create_if_absent(self) -> KeyedTable:
        if not self.spark.catalog.tableExists(self.name):
            parts = [f"{PERIOD} int"] if self.date else []
            listed = ", ".join([self._schema, *parts, f"{BATCH} int"])
            by = ", ".join(p.split()[0] for p in [*parts, BATCH])
            key = ", ".join(f"`{k}`" for k in self.key)
            self.spark.sql(
                f"CREATE TABLE {self.name} ({listed}) USING parquet PARTITIONED BY ({by}) "
                f"CLUSTERED BY ({key}) INTO {self.buckets} BUCKETS"
            )
        if not self.spark.catalog.tableExists(self._log):
            self.spark.sql(f"CREATE TABLE {self._log} (consumer string, batch int) USING parquet")
        return self

    def position(self, consumer: str = "") -> int:
        """The last batch the table itself, or a consumer of its rows, has finished; 0 for none."""
        log = self.spark.table(self._log).where(F.col("consumer") == consumer)
        return log.agg(F.coalesce(F.max("batch"), F.lit(0))).first()[0]

    def commit(self, batch: int, consumer: str = "") -> None:
        """Note a batch as finished; noting it again changes nothing."""
        done = self.spark.createDataFrame([(consumer, batch)], "consumer string, batch int")
        done.coalesce(1).write.mode("append").insertInto(self._log)

    def rows(self) -> DataFrame:
        """All rows of the finished batches; joins of them are not held to the buckets."""
        return self._files().where(F.col(BATCH) <= self.position()).select(*columns(self.columns))

    def changes(self, after: int, up_to: int) -> DataFrame:
        """The rows that the batches after one and up to another have added; only these are read."""
        batch = F.col(BATCH)
        rows = self.spark.table(self.name).where((batch > after) & (batch <= up_to))
        return rows.select(*columns(self.columns))

    def _files(self) -> DataFrame:
        """The table without its buckets: a join of it on the key has as many tasks as any other."""
        described = self.spark.sql(f"DESCRIBE FORMATTED {self.name}")
        path = described.where(F.col("col_name") == "Location").first()["data_type"]
        return self.spark.read.schema(self.spark.table(self.name).schema).parquet(path)

    def missing(self, updates: DataFrame, batch: int) -> DataFrame:
        """Rows of ``updates`` whose key no earlier batch has, in the layout of the table.

        The periods come to the driver, with their number of delivered rows. The
        other side of the join is the bucketed table, unless that would give a
        task more than ``BUCKET_ROWS`` rows or the table has no date to count by:
        then both sides are shuffled. Without known rows there is no join.
        """
        period, delivered = None, None
        earlier = F.col(BATCH) < batch
        if self.date:
            period = F.date_format(F.col(f"`{self.date}`"), self.period).cast("int")
            found = updates.groupBy(period.alias(PERIOD)).count().collect()
            delivered = sum(r["count"] for r in found)
            earlier &= F.col(PERIOD).isin([r[PERIOD] for r in found if r[PERIOD] is not None])
        known = self._files().where(earlier)
        stored = known.count()
        if delivered is not None and delivered + stored <= BUCKET_ROWS * self.buckets:
            known = self.spark.table(self.name).where(earlier)
        new = updates
        if stored:
            new = updates.join(known.select(*columns(self.key)), self.key, "left_anti")
        types = {f.name: f.dataType for f in struct(self._schema).fields}
        layout = [] if period is None else [period.alias(PERIOD)]
        return new.select(
            *[F.col(f"`{c}`").cast(types[c]).alias(c) for c in self.columns],
            *layout,
            F.lit(batch).alias(BATCH),
        )

    def insert(self, rows: DataFrame, batch: int) -> None:
        """Write a batch's rows over those of an earlier try, and finish it."""
        before = self.spark.conf.get(_OVERWRITE)
        self.spark.conf.set(_OVERWRITE, "dynamic")
        try:
            rows.write.mode("overwrite").insertInto(self.name)
        finally:
            self.spark.conf.set(_OVERWRITE, before)
        self.commit(batch)

    def merge(self, updates: DataFrame, batch: int) -> None:
        """Insert the rows whose key is new; all of them if several share a key."""
        self.insert(self.missing(updates, batch), batch)
