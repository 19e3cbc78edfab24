"""Minute rollup with bounded state: each minute is emitted once, when the watermark passes it.

Rows later than ``delay`` are lost and the newest minutes are held back; ``stream_rollup`` has
neither limit and is the default. A windowed query cannot set malformed messages aside, so a second
query over the same source keeps them and enforces the error budget.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.measures import MEASURES, partial_exprs
from ..operators.joins import enrich
from ..operators.rollup import STREAM_KEYS
from ..sources.conform import conform
from .jobs import EVERY, MAX_ERRORS, stream_rejects


def stream_rollup_bounded(
    spark: SparkSession,
    messages: DataFrame,
    path: str,
    job_key: str,
    checkpoint: str,
    quarantine: str,
    delay: str = "10 minutes",
    dim: DataFrame | None = None,
    max_errors: int = MAX_ERRORS,
    trigger: Mapping[str, object] = EVERY,
) -> tuple[StreamingQuery, StreamingQuery]:
    """The rollup, and the query that keeps its rejects. When the latter fails, stop the former."""
    rejects = stream_rejects(spark, messages, quarantine, f"{job_key}-rejects", f"{checkpoint}_rejects", max_errors, trigger)
    good, _ = conform(messages)
    if dim is not None:
        good = enrich(good, dim)
    minute = F.window("event_time", "1 minute")
    folded = (
        good.withWatermark("event_time", delay)
        .groupBy(minute, *STREAM_KEYS)
        .agg(*partial_exprs(MEASURES))
        .select(F.col("window.start").alias("event_minute"), *STREAM_KEYS, *MEASURES)
    )
    rollup = (
        folded.writeStream.queryName(job_key)
        .format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
    return rollup, rejects
