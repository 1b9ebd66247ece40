"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import BROKER_MESSAGES, DEVICE_STATUS, STATION_EVENTS, STATION_TABLE


def json_files(
    spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1
) -> DataFrame:
    """JSON line files that appear in a folder, a set number per micro-batch."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)
    )


def device_status(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    return json_files(spark, path, DEVICE_STATUS, files_per_trigger)


def station_events(
    spark: SparkSession, path: str, files_per_trigger: int = 1, more: str | None = None
) -> DataFrame:
    """Station events that carry their own landing time; ``more`` declares further columns."""
    schema = f"{STATION_TABLE}, {more}" if more else STATION_TABLE
    return json_files(spark, path, schema, files_per_trigger)


def broker_messages(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Raw messages as a broker lands them: the body as text and the time it arrived."""
    return json_files(spark, path, BROKER_MESSAGES, files_per_trigger)


def parse_station_events(messages: DataFrame, body: str, time: str) -> DataFrame:
    """Station events from JSON text and the arrival time the broker recorded."""
    event = F.from_json(F.col(body).cast("string"), STATION_EVENTS)
    return messages.select(event.alias("_e"), F.col(time).alias("EnqueuedTime")).select(
        "_e.*", "EnqueuedTime"
    )
