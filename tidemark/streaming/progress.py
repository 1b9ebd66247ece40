"""What a stream reports about its micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

BATCHES = (
    "batch bigint, input_rows bigint, late_rows bigint, state_rows bigint, watermark string"
)


def batches(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per micro-batch of a finished run: rows in, rows dropped as late, rows of state.

    ``late_rows`` are those the first stateful operator dropped; where that one
    sees rows as they come (see ``windows.once``), they are rows of the input,
    behind an aggregate they would be groups. Spark keeps the newest
    ``spark.sql.streaming.numRecentProgressUpdates`` batches.
    """
    rows = []
    for progress in query.recentProgress:
        operators = progress["stateOperators"]
        rows.append(
            (
                progress["batchId"],
                progress["numInputRows"],
                operators[-1]["numRowsDroppedByWatermark"] if operators else 0,
                sum(o["numRowsTotal"] for o in operators),
                progress["eventTime"].get("watermark"),
            )
        )
    return spark.createDataFrame(rows, BATCHES)
