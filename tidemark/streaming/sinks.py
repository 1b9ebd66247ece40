"""Streaming sinks. All of them survive a restart from their checkpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BATCH = "_batch"


def append_files(
    stream: DataFrame, path: str, checkpoint: str, drain: bool = True
) -> StreamingQuery:
    """Append to a Parquet folder exactly once.

    ``drain`` processes what is there and stops; otherwise the query goes on.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if drain else writer).start()


def update_files(
    stream: DataFrame, path: str, checkpoint: str, drain: bool = True
) -> StreamingQuery:
    """Write every changed result row, one folder per micro-batch.

    A batch that is tried again replaces its own folder, so nothing doubles.
    Read the current results back with :func:`current_results`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    writer = (
        stream.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if drain else writer).start()


def current_results(spark: SparkSession, path: str, schema: str, key: Sequence[str]) -> DataFrame:
    """The last written row of every key of an update sink."""
    rows = spark.read.schema(f"{schema}, {BATCH} int").parquet(path)
    kept = [c for c in rows.columns if c not in (*key, BATCH)]
    newest = F.max_by(F.struct(*kept), F.col(BATCH)).alias("_row")
    return rows.groupBy(*key).agg(newest).select(*key, *[f"_row.{c}" for c in kept])
