"""Time buckets, time literals and range predicates."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAINS = ("minute", "hour", "day")


def bucket_name(grain: str) -> str:
    return f"event_{grain}"


def bucket(ts: str | Column, grain: str) -> Column:
    """Start of the minute, hour or day that holds ``ts``."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, got {grain!r}")
    return F.date_trunc(grain, ts)


def as_datetime(value: str | date | datetime) -> datetime:
    """Naive UTC datetime for any accepted time argument."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if not isinstance(value, datetime):
        value = datetime.combine(value, time.min)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


def as_text(value: str | date | datetime) -> str:
    return as_datetime(value).isoformat(sep=" ", timespec="microseconds")


def literal(df: DataFrame, column: str, value: str | date | datetime) -> Column:
    """``value`` as a constant of the column's own type, so that the comparison needs no cast on
    the column and the filter reaches the scan."""
    return F.lit(as_text(value)).cast(df.schema[column].dataType)


def moment(as_of: str | date | datetime | None = None) -> Column:
    """The clock: ``as_of`` where given, else the time of the query."""
    return F.current_timestamp() if as_of is None else F.lit(as_text(as_of)).cast("timestamp")


def time_range(
    df: DataFrame,
    start: str | date | datetime | None = None,
    end: str | date | datetime | None = None,
    ts: str = "event_time",
    day: str = "event_date",
) -> DataFrame:
    """Rows of the half-open range ``[start, end)``.

    A table partitioned by a derived day is pruned only by a filter on that day, so the same
    range is put on it as well.
    """
    partitioned = day in df.columns
    if start is not None:
        df = df.filter(F.col(ts) >= literal(df, ts, start))
        if partitioned:
            df = df.filter(F.col(day) >= F.lit(as_datetime(start).date().isoformat()).cast("date"))
    if end is not None:
        df = df.filter(F.col(ts) < literal(df, ts, end))
        if partitioned:
            last = (as_datetime(end) - timedelta(microseconds=1)).date()
            df = df.filter(F.col(day) <= F.lit(last.isoformat()).cast("date"))
    return df


def today(as_of: str | date | datetime | None = None, ts: str = "event_time") -> Column:
    """``ts`` lies on the day of ``as_of`` or later; there is no upper bound."""
    return F.col(ts) >= F.to_date(moment(as_of)).cast("timestamp")


def days_between(start: str | date | datetime, end: str | date | datetime) -> list[str]:
    """ISO days of the half-open range ``[start, end)``."""
    first, last = as_datetime(start).date(), as_datetime(end).date()
    return [(first + timedelta(days=i)).isoformat() for i in range((last - first).days)]
