"""Streaming source of JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(
    servers: str = "localhost:9092",
    topic: str = "sensor_readings",
    max_rows: int = 300_000,
    consumers: int = 3,
    **extra: str,
) -> dict[str, str]:
    """Options of the topic read: earliest offset on the first run, the checkpoint's after."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(max_rows),
        "minPartitions": str(consumers),
        # A topic that lost offsets must stop the job, not skip rows.
        "failOnDataLoss": "true",
        **extra,
    }


def read_stream(spark: SparkSession, fmt: str, options: dict[str, str]) -> DataFrame:
    """Messages as text in column ``value``; ``fmt`` is ``kafka``, or ``text`` for files that
    hold one JSON object per line."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema("value string")
    return reader.load().select(F.col("value").cast("string").alias("value"))
