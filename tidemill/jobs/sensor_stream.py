"""Sensor messages to a table of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemill.streaming.messages import ingest_stream, stored_records, stored_rejects

# Fields of a message.
READING = (
    StructType().add("sensor_id", "string", False).add("timestamp", "timestamp", False).add("value", "double", False)
)


def run(spark: SparkSession, messages: DataFrame, root: str, trigger: dict | None = None) -> DataFrame:
    """Ingests what has arrived (or runs on, with another ``trigger``); returns the readings."""
    table = f"{root}/sensor_readings"
    query = ingest_stream(messages, READING, table, f"{root}/sensor_rejects", trigger=trigger)
    query.awaitTermination()
    return stored_records(spark, table, READING)


def rejects(spark: SparkSession, root: str) -> DataFrame:
    return stored_rejects(spark, f"{root}/sensor_rejects")
