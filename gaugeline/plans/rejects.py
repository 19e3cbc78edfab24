"""What happens to malformed messages: a budget, and a table that keeps them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import catalog
from .labels import batch_label


class ErrorBudgetExceeded(RuntimeError):
    """A batch holds more malformed messages than tolerated; nothing of it was written."""


def check_budget(label: str, errors: int, max_errors: int) -> None:
    if errors > max_errors:
        raise ErrorBudgetExceeded(f"{label}: {errors} malformed messages, limit {max_errors}")


def need_quarantine(max_errors: int, quarantine: str | None) -> None:
    """Malformed messages are tolerated only where they are kept."""
    if max_errors and quarantine is None:
        raise ValueError(f"up to {max_errors} malformed messages are tolerated: name a quarantine table for them")


def create_quarantine(spark: SparkSession, table: str) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} (reason string, payload string, load_label string) "
        "USING parquet OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (load_label)"
    )


def keep_rejects(
    spark: SparkSession, table: str, bad: DataFrame, label: str, check: Callable[[], None] | None = None
) -> None:
    catalog.load_label(spark, table, bad, label, catalog.Layout({"reason": F.col("reason")}), check)


def expire_rejects(spark: SparkSession, table: str, job_key: str, before_batch: int) -> list[str]:
    """Drop what the micro-batches of a stream before a number have set aside; returns their labels."""
    old = [s for s in catalog.partitions(spark, table) if batch_label(job_key, 0) <= s["load_label"] < batch_label(job_key, before_batch)]
    catalog.drop_partitions(spark, table, old)
    return sorted(s["load_label"] for s in old)
