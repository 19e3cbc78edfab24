"""The control table: one watermark per job."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions.times import moment
from ..schemas import WATERMARK, ddl
from . import catalog


def create_control(spark: SparkSession, table: str) -> None:
    """One partition per job: jobs do not touch each other's row."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({ddl(WATERMARK)}) USING parquet PARTITIONED BY (job_key)"
    )


def get_watermark(
    spark: SparkSession, table: str, key: str, default: str | None = None
) -> str | None:
    row = spark.table(table).filter(F.col("job_key") == key).select("watermark").first()
    return row["watermark"] if row else default


def set_watermark(
    spark: SparkSession,
    table: str,
    key: str,
    value: str,
    as_of: str | datetime | None = None,
) -> None:
    """Insert or replace the job's row, by one catalog statement: the old value stays readable
    until the new one is written, and a crash in between loses neither."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", key):
        raise ValueError(f"job key {key!r} may hold letters, digits and _ . - only")
    row = spark.range(1).select(
        F.lit(value).alias("watermark"), moment(as_of).alias("updated_at"), F.lit(key).alias("job_key")
    )
    old = catalog.swap_partition(spark, table, row.coalesce(1), {"job_key": key}, catalog.Layout())
    if old:
        catalog.remove_folder(spark, old)
