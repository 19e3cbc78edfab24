"""Session settings and the shared folder every written table lives in."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Readings are zone-less wall-clock times; UTC makes truncation and day keys stable.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Without this, a group-by on (hour, device, metric) over a table bucketed by device skips
    # its shuffle and runs in one task per bucket, a hot device in a single task. A join on the
    # bucket key alone still needs no shuffle.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
}

_local_root: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on. Sizing stays with the cluster."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder that all executors can reach, as the cluster names it in ``spark.checkpoint.dir``."""
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="gaugeline-")
    return _local_root


def unique(prefix: str) -> str:
    return f"{prefix}{uuid.uuid4().hex[:12]}"


def create_lake(spark: SparkSession, name: str | None = None, location: str | None = None) -> str:
    """Create a database whose managed tables live under the shared folder; returns its name."""
    name = name or unique("lake_")
    location = location or f"{shared_root(spark)}/{name}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    return name


def lake_location(spark: SparkSession, table: str) -> str:
    database = table.split(".")[0]
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")
