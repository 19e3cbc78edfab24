"""The append-only table of readings: every row kept, one folder per day and load."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import as_datetime, literal, moment, time_range
from ..schemas import (
    BUCKETS,
    LABEL_CHARS,
    LABEL_LENGTH,
    LIVE_DAYS,
    MAX_LENGTH,
    READING,
    READING_COLS,
    SORT_KEY,
    ddl,
)
from ..session import unique
from . import catalog, labels
from .catalog import Layout, Spec

# A partition that holds the whole day, as opposed to one load's rows of it; one that holds several
# micro-batches of a stream.
_DAY = "day-"
FOLDED = "part"


def buckets_for(bytes_per_day: float, bytes_per_bucket: float = 512 * 2**20) -> int:
    """Buckets for a table of this daily volume: the design point, doubled until one day's bucket
    is of a size that one task reads well."""
    buckets = BUCKETS
    while bytes_per_day / buckets > bytes_per_bucket:
        buckets *= 2
    return buckets


def create_raw(spark: SparkSession, table: str, buckets: int = BUCKETS) -> None:
    """Day partitions, hash buckets on the join key, rows sorted by time, device and metric.

    ``load_label`` is a second partition level, so a load can be found and replaced. Row groups carry a Bloom
    filter of the device: as rows lie by time first, statistics alone tell nothing about a device.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({ddl(READING)}, ingested_at timestamp, "
        "event_date date, load_label string) USING parquet "
        "OPTIONS (partitionOverwriteMode 'dynamic', compression 'zstd', 'parquet.bloom.filter.enabled#device_id' 'true') "
        "PARTITIONED BY (event_date, load_label) "
        + catalog.bucket_clause("device_id", SORT_KEY, buckets)
    )


def label_for(job_key: str, part: str) -> str:
    """Load label: readable, of safe characters, and unique per job and part."""
    raw = f"{job_key}_{part}"
    digest = hashlib.md5(raw.encode()).hexdigest()[:16]
    clean = re.sub(f"[^{LABEL_CHARS}]", "_", raw)
    return f"{clean[: LABEL_LENGTH - 17]}_{digest}"


def with_audit(df: DataFrame, as_of: str | datetime | None = None) -> DataFrame:
    return df.withColumn("ingested_at", moment(as_of))


def _checked(df: DataFrame) -> DataFrame:
    """Loads are all or nothing: a row that breaks the schema fails the load."""

    def check(name: str, required: bool) -> Column:
        column = F.col(name)
        if required:
            column = F.when(column.isNull(), F.raise_error(F.lit(f"{name} missing"))).otherwise(column)
        if name in MAX_LENGTH:
            long = F.length(name) > MAX_LENGTH[name]
            column = F.when(long, F.raise_error(F.lit(f"{name} too long"))).otherwise(column)
        return column.alias(name)

    kept = [check(f.name, not f.nullable) for f in READING.fields]
    return df.select(*kept, *[c for c in df.columns if c not in READING_COLS])


def _prepared(df: DataFrame, as_of: str | datetime | None) -> DataFrame:
    if "ingested_at" not in df.columns:
        df = with_audit(df, as_of)
    rows = _checked(df.withColumn("event_time", F.col("event_time").cast("timestamp")))
    return rows.select(*READING_COLS, "ingested_at", F.to_date("event_time").alias("event_date"))


def _layout(spark: SparkSession, table: str, gather: bool = True) -> Layout:
    """By default rows gather by day and bucket. ``gather=False`` saves that shuffle; it suits a
    source that is in day order already and a table without buckets."""
    buckets = catalog.bucket_count(spark, table)
    by = {"event_date": F.col("event_date"), **catalog.bucket_of("device_id", buckets)}
    # A bucketed table sorts by itself.
    sort = [] if buckets else ["event_date", "load_label", *SORT_KEY]
    return Layout(by if gather else {}, sort)


def load_batch(
    spark: SparkSession,
    table: str,
    df: DataFrame,
    label: str,
    as_of: str | datetime | None = None,
    gather: bool = True,
    done: bool = False,
    check: Callable[[], None] | None = None,
) -> None:
    """Append ``df``. A second load under the same label replaces the first, all of it or nothing.

    ``check`` may refuse the load once it is written and before it is seen. ``done`` finishes the label: the same label again changes nothing, also after its rows were
    compacted or backfilled.
    """
    if labels.finished(spark, table, [label]):
        return
    catalog.load_label(spark, table, _prepared(df, as_of), label, _layout(spark, table, gather), check)
    if done:
        labels.finish(spark, table, label)


def days_of_label(spark: SparkSession, table: str, label: str) -> list[str]:
    return sorted(s["event_date"] for s in catalog.partitions(spark, table, load_label=label))


def _held(spark: SparkSession, table: str, first: str, last: str) -> list[Spec]:
    """Partitions of the days ``first`` to ``last``, both included."""
    one_day = {"event_date": first} if first == last else {}
    held = catalog.partitions(spark, table, **one_day)
    return [s for s in held if first <= s["event_date"] <= last]


def _only_day(df: DataFrame, day: str) -> DataFrame:
    """Guard: a row of another day fails the write before the table changes."""
    inside = F.to_date("event_time") == F.lit(day).cast("date")
    outside = F.raise_error(F.concat(F.lit(f"row outside {day}: "), F.col("event_time").cast("string")))
    return df.withColumn("event_time", F.when(inside, F.col("event_time")).otherwise(outside))


def _replace(
    spark: SparkSession,
    table: str,
    rows: DataFrame,
    old: list[Spec],
    as_of: str | datetime | None,
    gather: bool = True,
    prefix: str = _DAY,
) -> list[Spec]:
    label = unique(prefix)
    placed = _prepared(rows, as_of).withColumn("load_label", F.lit(label))
    return catalog.replace_partitions(spark, table, placed, old, _layout(spark, table, gather))


def _rows_in(spark: SparkSession, table: str, specs: list[Spec]) -> int:
    """Rows of partitions just written, which share a label: the files tell, no column is read."""
    if not specs:
        return 0
    days = sorted(s["event_date"] for s in specs)
    held = F.col("event_date").between(F.lit(days[0]).cast("date"), F.lit(days[-1]).cast("date"))
    held &= F.col("load_label") == specs[0]["load_label"]
    return spark.table(table).filter(held).count()


def overwrite_day(
    spark: SparkSession,
    table: str,
    df: DataFrame,
    day: str | date,
    as_of: str | datetime | None = None,
) -> int:
    """Replace one day by ``df``; an empty ``df`` leaves an empty day. Returns the rows written."""
    iso = as_datetime(day).date().isoformat()
    catalog.finish_swap(spark, table)
    rows = _only_day(df.withColumn("event_time", F.col("event_time").cast("timestamp")), iso)
    return _rows_in(spark, table, _replace(spark, table, rows, _held(spark, table, iso, iso), as_of))


def swap_day(
    spark: SparkSession,
    table: str,
    df: DataFrame,
    day: str | date,
    as_of: str | datetime | None = None,
) -> str | None:
    """As ``overwrite_day``, by a single catalog statement where the day is one partition.

    That holds for a day which was overwritten, backfilled or compacted before; a day that still
    consists of several loads takes two statements. Returns the folder to remove once readers
    under way are done.
    """
    iso = as_datetime(day).date().isoformat()
    catalog.finish_swap(spark, table)
    held = _held(spark, table, iso, iso)
    if len(held) == 1 and held[0]["load_label"].startswith(_DAY):
        rows = _only_day(df.withColumn("event_time", F.col("event_time").cast("timestamp")), iso)
        label = F.lit(held[0]["load_label"])
        placed = _prepared(rows, as_of).withColumn("load_label", label)
        return catalog.swap_partition(spark, table, placed, held[0], _layout(spark, table))
    overwrite_day(spark, table, df, iso, as_of)
    return None


def backfill(
    spark: SparkSession,
    table: str,
    src: DataFrame,
    start: str | date,
    end: str | date,
    upto: str | datetime | None = None,
    as_of: str | datetime | None = None,
    gather: bool = True,
) -> int:
    """Replace every day of ``[start, end)`` by the source's rows, in one job.

    ``upto`` is the watermark of incremental loads into the same table: rows above it are left to
    them, so none is read twice.
    """
    catalog.finish_swap(spark, table)
    first = as_datetime(start).date()
    last = as_datetime(end).date() - timedelta(days=1)
    rows = time_range(src, first, last + timedelta(days=1))
    if upto is not None:
        rows = rows.filter(F.col("event_time") <= literal(rows, "event_time", upto))
    held = _held(spark, table, first.isoformat(), last.isoformat())
    return _rows_in(spark, table, _replace(spark, table, rows.select(*READING_COLS), held, as_of, gather))


def expire(
    spark: SparkSession, table: str, as_of: str | date | datetime, keep: int = LIVE_DAYS
) -> list[str]:
    """Drop the days that are ``keep`` or more days older than ``as_of``; returns them."""
    catalog.finish_swap(spark, table)
    last = (as_datetime(as_of).date() - timedelta(days=keep)).isoformat()
    old = [s for s in catalog.partitions(spark, table) if s["event_date"] <= last]
    catalog.drop_partitions(spark, table, old)
    return sorted({s["event_date"] for s in old})


def compact(
    spark: SparkSession,
    table: str,
    start: str | date,
    end: str | date,
    upto: str | datetime | None = None,
) -> list[str]:
    """Fold the loads of each day of ``[start, end)`` into one partition per day, in one job;
    returns the days that changed.

    Finished loads are folded; an open one, which may be sent again, stays as it is. ``upto`` is
    the watermark of increments into the table: with it, open loads are folded up to there; rows
    above it belong to an increment whose retry writes them again, and are left out.
    """
    catalog.finish_swap(spark, table)
    last = as_datetime(end).date() - timedelta(days=1)
    held = _held(spark, table, as_datetime(start).date().isoformat(), last.isoformat())
    names = {s["load_label"] for s in held}
    done = labels.finished(spark, table, names) | {n for n in names if n.startswith((_DAY, FOLDED))}
    by_day: dict[str, list[Spec]] = {}
    for spec in held:
        if upto is not None or spec["load_label"] in done:
            by_day.setdefault(spec["event_date"], []).append(spec)
    split = {
        day: specs
        for day, specs in by_day.items()
        if len(specs) > 1 or not specs[0]["load_label"].startswith(_DAY)
    }
    if not split:
        return []
    days = [F.lit(day).cast("date") for day in sorted(split)]
    rows = spark.table(table).filter(F.col("event_date").isin(days))
    if upto is not None:
        below = F.col("event_time") <= literal(rows, "event_time", upto)
        rows = rows.filter(F.col("load_label").isin(sorted(done)) | below)
    elif names - done:
        rows = rows.filter(~F.col("load_label").isin(sorted(names - done)))
    old = [spec for specs in split.values() for spec in specs]
    _replace(spark, table, rows.select(*READING_COLS, "ingested_at"), old, None)
    return sorted(split)


def compact_day(
    spark: SparkSession, table: str, day: str | date, upto: str | datetime | None = None
) -> bool:
    """``compact`` for one day; False if there was nothing to fold."""
    return bool(compact(spark, table, day, as_datetime(day) + timedelta(days=1), upto))


def fold_raw(spark: SparkSession, table: str, fan: int) -> None:
    """Fold the finished micro-batches of each day, ``fan`` or more, into one part, and parts that
    have become as many into a greater one. Safe while the stream that loads the table runs it."""
    while (found := labels.mergeable(spark, table, "event_date", fan, FOLDED)) is not None:
        kind, old = found
        rows = spark.table(table).filter(
            F.col("event_date").isin([F.lit(day).cast("date") for day in sorted({s["event_date"] for s in old})])
            & F.col("load_label").isin(sorted({s["load_label"] for s in old}))
        )
        _replace(spark, table, rows.select(*READING_COLS, "ingested_at"), old, None, prefix=f"{FOLDED}{kind + 1}-")


def readings_of(spark: SparkSession, table: str, columns: Sequence[str] = READING_COLS) -> DataFrame:
    """Rows of the table with the day, which range filters need."""
    return spark.table(table).select(*columns, "event_date")
