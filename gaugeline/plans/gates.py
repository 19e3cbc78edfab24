"""The gates of the raw table, read from its newest partitions only."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import moment, today
from ..operators.quality import Fresh, Gate, NullRatio, RowCount, in_flight, publish, run_gates
from . import catalog
from .raw import load_batch, readings_of

T = TypeVar("T")

# The limits of the gates.
MIN_ROWS = 1
MAX_NULL_RATIO = 0.05
MAX_LAG_MINUTES = 60


def daily_gates(as_of: str | datetime | None = None) -> list[Gate]:
    """Today has rows, few of them without a value, and the newest row is recent."""
    return [
        RowCount(MIN_ROWS, today(as_of)),
        NullRatio("value", MAX_NULL_RATIO, today(as_of)),
        Fresh("event_time", MAX_LAG_MINUTES, as_of),
    ]


def newest_rows(
    spark: SparkSession, table: str, as_of: str | datetime | None = None
) -> DataFrame:
    """Rows from today on, or from the newest day there is.

    The daily gates give the same on these as on the whole table: two look at today, and the
    newest row lies in the newest day, which the catalog knows without a scan.
    """
    rows = readings_of(spark, table)
    days = [spec["event_date"] for spec in catalog.partitions(spark, table)]
    if not days:
        return rows
    newest = F.lit(max(days)).cast("date")
    return rows.filter(F.col("event_date") >= F.least(F.to_date(moment(as_of)), newest))


def report(spark: SparkSession, table: str, as_of: str | datetime | None = None) -> DataFrame:
    return run_gates(newest_rows(spark, table, as_of), daily_gates(as_of))


def publish_if_sound(
    spark: SparkSession, table: str, action: Callable[[], T], as_of: str | datetime | None = None
) -> T:
    """Run ``action``, such as a rollup refresh, only if all daily gates pass; else raise."""
    return publish(newest_rows(spark, table, as_of), daily_gates(as_of), action, table)


def load_if_sound(
    spark: SparkSession, table: str, df: DataFrame, label: str, gates: Sequence[Gate], as_of: str | datetime | None = None
) -> None:
    """Load a batch whose own rows pass ``gates``; else raise, with the table as it was.

    The gates are measured while the rows are written beside the table, so the source is read once
    and what is published is what was measured.
    """
    measured, enforce_seen = in_flight(df, gates, table)
    load_batch(spark, table, measured, label, as_of, check=enforce_seen)
