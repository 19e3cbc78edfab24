"""Batch reads of a readings source: one increment above a watermark, one day, or JDBC."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.times import as_datetime, as_text, literal, time_range
from ..schemas import BATCH_LIMIT, READING_COLS

# Bucket widths in microseconds: day, minute, 50 ms, one microsecond. Each level splits one
# bucket of the level above, so no level yields more than 50,000 buckets (days apart).
_WIDTHS = (86_400_000_000, 60_000_000, 50_000, 1)


@dataclass(frozen=True)
class Increment:
    """Rows of ``(low, high]``; ``high`` is None when there are none."""

    rows: DataFrame
    low: str
    high: str | None


def _micros(df: DataFrame, ts: str, value: int) -> Column:
    return F.timestamp_micros(F.lit(value)).cast(df.schema[ts].dataType)


def increment_cutoff(
    src: DataFrame, low: str | datetime, limit: int | None, ts: str = "event_time"
) -> str | None:
    """Time of the ``limit``-th oldest row above ``low``, or of the newest row if there are fewer.

    An ordered limit would gather ``limit`` rows of every partition in one task. Counting rows
    per time bucket and narrowing to the bucket that holds the ``limit``-th row needs only one
    column and partial counts, whatever the limit. Where no more than ``limit`` rows are left, as
    in steady state, one count of all of them is enough. A limit of 0 finds nothing.
    """
    if limit is not None and limit < 0:
        raise ValueError(f"limit {limit} is negative")
    if limit == 0:
        return None
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    inside = _above(src, low, ts)
    told = inside.agg(F.count(F.lit(1)).alias("n"), F.max(micros).alias("newest")).first()
    if not told["n"]:
        return None
    if limit is None or told["n"] <= limit:
        return _from_micros(told["newest"])

    cut = _bucket_of_nth(inside, micros, _WIDTHS[0], limit)

    left = limit
    for width, finer in zip(_WIDTHS, (*_WIDTHS[1:], None)):
        if cut["upto"] <= left or finer is None:
            return _from_micros(cut["newest"])
        left -= cut["upto"] - cut["n"]
        start, end = (_micros(src, ts, cut["b"] + add) for add in (0, width))
        inside = inside.filter((F.col(ts) >= start) & (F.col(ts) < end))
        cut = _bucket_of_nth(inside, micros, finer, left)
    raise AssertionError("unreachable")


def _above(src: DataFrame, low: str | datetime, ts: str) -> DataFrame:
    """Times above ``low``."""
    return time_range(src, low, None, ts=ts).filter(F.col(ts) > literal(src, ts, low)).select(ts)


def _bucket_of_nth(times: DataFrame, micros: Column, width: int, nth: int) -> Row | None:
    """The bucket with the ``nth`` oldest row, or the last one if there are fewer rows: its start
    ``b``, rows ``n``, rows ``upto`` its end, and ``newest`` row."""
    counts = (
        times.select(micros.alias("t"))
        .groupBy((F.col("t") - F.pmod("t", F.lit(width))).alias("b"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("t").alias("newest"))
    )
    upto = counts.withColumn("upto", F.sum("n").over(Window.orderBy("b")))
    short = F.col("upto") < nth
    return upto.orderBy(short, F.when(short, -F.col("b")).otherwise(F.col("b"))).first()


def _from_micros(value: int) -> str:
    return as_text(datetime(1970, 1, 1) + timedelta(microseconds=value))


def read_increment(
    src: DataFrame,
    low: str | datetime,
    limit: int | None = BATCH_LIMIT,
    ts: str = "event_time",
) -> Increment:
    """Oldest rows strictly above ``low``, about ``limit`` of them.

    Rows that share the cutoff time all belong to the batch: the next one starts strictly above
    it, so a row left behind would never be read.
    """
    high = increment_cutoff(src, low, limit, ts)
    end = as_datetime(low if high is None else high) + timedelta(microseconds=1)
    rows = time_range(src, low, end, ts=ts).filter(F.col(ts) > literal(src, ts, low))
    return Increment(rows.select(*READING_COLS), as_text(low), high)


def read_day(src: DataFrame, day: str | date, ts: str = "event_time") -> DataFrame:
    """Rows of ``[day, day + 1)``."""
    start = as_datetime(day)
    return time_range(src, start, start + timedelta(days=1), ts=ts).select(*READING_COLS)


def jdbc_options(
    url: str,
    table: str,
    low: str,
    high: str,
    partitions: int,
    column: str = "event_time",
    driver: str = "org.postgresql.Driver",
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of a partitioned JDBC read: ``partitions`` range queries over ``column``.

    The bounds only shape the ranges; rows outside them are read as well.
    """
    return {
        "url": url,
        "dbtable": table,
        "driver": driver,
        "partitionColumn": column,
        "lowerBound": low,
        "upperBound": high,
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
        "pushDownPredicate": "true",
        **extra,
    }


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Relational source. Filters on it, such as a day or a watermark, run in the database."""
    return spark.read.format("jdbc").options(**options).load()
