from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from gaugeline.plans import raw
from gaugeline.schemas import READING, READING_COLS
from gaugeline.session import create_lake


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def readings(spark, rows):
    """Rows of (time, device, metric, value); times as ISO text in UTC."""
    text = "event_time string, device_id bigint, metric string, value double"
    df = spark.createDataFrame(rows, text)
    return df.withColumn("event_time", F.col("event_time").cast("timestamp"))


def empty(spark):
    return spark.createDataFrame([], READING)


def lake(spark) -> str:
    return create_lake(spark)


def raw_table(spark, buckets: int = 0) -> str:
    table = f"{lake(spark)}.raw"
    raw.create_raw(spark, table, buckets)
    return table


def content(spark, table) -> list[tuple]:
    return rows_of(spark.table(table))


def rows_of(df) -> list[tuple]:
    cols = [F.col("event_time").cast("string").alias("t"), *READING_COLS[1:]]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def executed(df) -> str:
    """Plan after adaptive execution has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def timed_rows(day: str, n: int, device: int = 1, start: int = 0):
    return [(f"{day} {h:02d}:{m:02d}:00", device, "temp_c", float(i))
            for i in range(start, start + n) for h, m in [divmod(i % 1440, 60)]]
