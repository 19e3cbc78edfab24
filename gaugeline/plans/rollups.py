"""Stored rollups: tables of partial aggregates that merge when read."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import MEASURES, merge_exprs, partial_exprs
from ..functions.times import GRAINS, as_datetime, bucket, bucket_name, time_range
from ..operators.joins import enrich, enriched_rollup
from ..operators.rollup import DEVICE_KEYS, merge_partials, presummed, rollup
from ..schemas import LIVE_DAYS
from ..session import unique
from . import catalog, labels
from .catalog import Layout, Spec
from .raw import FOLDED

_TYPES = {"device_id": "bigint", "reading_cnt": "bigint", "value_cnt": "bigint"}


@dataclass(frozen=True)
class Rollup:
    """A stored rollup. ``keys`` and ``measures`` say which queries it can answer.

    Days that were refreshed from a table are known to hold what the table held. ``complete``
    vouches for all others: every reading is loaded here as well, as a stream's rollup does.
    """

    table: str
    grain: str = "hour"
    keys: Sequence[str] = DEVICE_KEYS
    measures: Sequence[str] = field(default=MEASURES)
    complete: bool = False

    @property
    def time(self) -> str:
        return bucket_name(self.grain)

    @property
    def slot(self) -> str:
        """Partition column: the hour for minute rollups, else the day."""
        return "event_hour_key" if self.grain == "minute" else "event_date"

    def slot_of(self, ts: str) -> Column:
        if self.grain == "minute":
            return F.date_format(ts, "yyyy-MM-dd-HH")
        return F.to_date(ts)

    def slot_key(self, moment: datetime) -> str:
        return moment.strftime("%Y-%m-%d-%H" if self.grain == "minute" else "%Y-%m-%d")


def create_agg(spark: SparkSession, spec: Rollup, buckets: int = 0) -> None:
    """A table of partials. Buckets serve joins with a dimension too large to broadcast; without
    them a rollup is one file per partition key while it is small."""
    columns = [f"`{spec.time}` timestamp"]
    columns += [f"`{k}` {_TYPES.get(k, 'string')}" for k in spec.keys]
    columns += [f"`{m}` {_TYPES.get(m, 'double')}" for m in spec.measures]
    columns += [f"`{spec.slot}` {'string' if spec.grain == 'minute' else 'date'}", "load_label string"]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {spec.table} ({', '.join(columns)}) USING parquet "
        "OPTIONS (partitionOverwriteMode 'dynamic', compression 'zstd') "
        f"PARTITIONED BY ({spec.slot}, load_label) "
        + catalog.bucket_clause("device_id", [spec.time, *spec.keys], buckets)
    )


def _layout(spark: SparkSession, spec: Rollup) -> Layout:
    buckets = catalog.bucket_count(spark, spec.table)
    sort = [] if buckets else [spec.slot, "load_label", spec.time, *spec.keys]
    return Layout({spec.slot: F.col(spec.slot), **catalog.bucket_of("device_id", buckets)}, sort)


def _rolled(readings: DataFrame, spec: Rollup, dim: DataFrame | None) -> DataFrame:
    if dim is None:
        rolled = rollup(readings, spec.grain, spec.keys, spec.measures)
    else:
        rolled = enriched_rollup(readings, dim, spec.grain, spec.keys, spec.measures)
    return rolled.withColumn(spec.slot, spec.slot_of(spec.time))


def load_agg(
    spark: SparkSession,
    spec: Rollup,
    readings: DataFrame,
    label: str,
    dim: DataFrame | None = None,
    done: bool = False,
    check: Callable[[], None] | None = None,
) -> None:
    """Add a batch of new readings to the rollup. The same label twice counts once; with ``done``
    it is finished, and the label again changes nothing. ``dim`` supplies keys that the readings
    lack, such as the site. ``check`` may refuse the load once it is written and before it is seen."""
    if labels.finished(spark, spec.table, [label]):
        return
    rolled = _rolled(readings, spec, dim)
    catalog.load_label(spark, spec.table, rolled, label, _layout(spark, spec), check)
    if done:
        labels.finish(spark, spec.table, label)


def read_agg(spark: SparkSession, spec: Rollup) -> DataFrame:
    """The rollup with the partials of all loads merged. The partition column stays a group
    column, so that a filter on it passes through to the scan."""
    return merge_partials(spark.table(spec.table), [spec.slot, spec.time, *spec.keys], spec.measures)


def _slots(spec: Rollup, days: Iterable[str]) -> set[str]:
    if spec.grain != "minute":
        return set(days)
    return {f"{d}-{h:02d}" for d in days for h in range(24)}


def _days_filter(days: Sequence[str], ts: str) -> Column:
    """Days as an OR of ranges on ``ts``: a list of dates would not reach the file statistics."""
    spans: list[list[date]] = []
    for day in sorted(as_datetime(d).date() for d in days):
        if spans and day - spans[-1][1] == timedelta(days=1):
            spans[-1][1] = day
        else:
            spans.append([day, day])
    condition = F.lit(False)
    for first, last in spans:
        start = F.lit(first.isoformat()).cast("timestamp")
        end = F.lit((last + timedelta(days=1)).isoformat()).cast("timestamp")
        condition = condition | ((F.col(ts) >= start) & (F.col(ts) < end))
    return condition


def refresh_rollup(
    spark: SparkSession,
    spec: Rollup,
    readings: DataFrame,
    days: Iterable[str | date],
    dim: DataFrame | None = None,
    source: str | None = None,
    dim_table: str | None = None,
) -> None:
    """Recompute the given days of the rollup from the readings; all other days stay.

    After a load these are the days the load wrote (``days_of_label``). With ``source``, the table
    of the readings, and ``dim_table``, that of the dimension if there is one, it is noted from
    which versions of them the days were made, so that queries can tell whether they still hold.
    """
    listed = sorted({as_datetime(d).date().isoformat() for d in days})
    if not listed:
        return
    catalog.finish_swap(spark, spec.table)
    # Taken before the rows are read: what changes meanwhile makes the day stale, not fresh.
    made_of = versions(spark, source, listed[0], listed[-1], dim_table) if source else {}
    rows = readings.filter(_days_filter(listed, "event_time"))
    if "event_date" in readings.columns:
        rows = rows.filter(F.col("event_date").isin([as_datetime(d).date() for d in listed]))
    rolled = _rolled(rows, spec, dim).withColumn("load_label", F.lit(unique("day-")))
    slots = _slots(spec, listed)
    old = [s for s in catalog.partitions(spark, spec.table) if s[spec.slot] in slots]
    catalog.replace_partitions(spark, spec.table, rolled, old, _layout(spark, spec))
    if source:
        _note_versions(spark, spec, {day: made_of.get(day, _NO_FILES) for day in listed})


def rebuild_agg(
    spark: SparkSession,
    spec: Rollup,
    readings: DataFrame,
    day: str | date,
    dim: DataFrame | None = None,
    source: str | None = None,
    dim_table: str | None = None,
) -> None:
    """Recompute one day."""
    refresh_rollup(spark, spec, readings, [day], dim, source, dim_table)


# --- what a day of a rollup was made of ----------------------------------------------------------

_NO_FILES = "none"


def versions(
    spark: SparkSession, source: str, first: str, last: str, dim_table: str | None = None
) -> dict[str, str]:
    """A version of each day of the table from ``first`` to ``last`` that has rows: a digest of its
    files' names, which are never used twice, and of the dimension's folder.

    The names are folded by day where the files are read, no column of them is; the driver gets a row a day.
    """
    days = F.col("event_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    files = spark.table(source).filter(days).groupBy("event_date", F.col("_metadata.file_name").alias("file")).agg(F.lit(1))
    folded = files.groupBy(F.col("event_date").cast("string").alias("day")).agg(
        F.count("file").alias("n"),
        F.sum(F.xxhash64("file").cast("decimal(20,0)")).alias("total"),
        F.bit_xor(F.xxhash64("file", F.lit(1))).alias("both"),
    )
    beside = catalog.table_location(spark, dim_table) if dim_table else ""
    return {
        r["day"]: hashlib.md5(f"{r['n']} {r['total']} {r['both']} {beside}".encode()).hexdigest() for r in folded.collect()
    }


def _noted(spec: Rollup) -> str:
    return f"{spec.table}_made_of"


def _note_versions(spark: SparkSession, spec: Rollup, made_of: dict[str, str]) -> None:
    """The record is a table of partitions without rows: entries are catalog statements."""
    noted = _noted(spec)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {noted} (n int, day string, version string) USING parquet PARTITIONED BY (day, version)")
    entries = [{"day": day, "version": version} for day, version in made_of.items()]
    before = [s for s in catalog.partitions(spark, noted) if s["day"] in made_of and s not in entries]
    catalog.drop_partitions(spark, noted, before)
    catalog.add_partitions(spark, noted, entries, catalog.table_location(spark, noted))


def fresh_days(
    spark: SparkSession, spec: Rollup, source: str, first: str, last: str, dim_table: str | None = None
) -> list[str]:
    """Days from ``first`` to ``last`` whose source and dimension are still what they were made of."""
    if not spark.catalog.tableExists(_noted(spec)):
        return []
    made_of = {s["day"]: s["version"] for s in catalog.partitions(spark, _noted(spec)) if first <= s["day"] <= last}
    if not made_of:
        return []
    now = versions(spark, source, first, last, dim_table)
    return sorted(day for day, version in made_of.items() if now.get(day, _NO_FILES) == version)


def compact_agg(
    spark: SparkSession,
    spec: Rollup,
    first: str | None = None,
    last: str | None = None,
    final: Sequence[str] | None = None,
) -> list[str]:
    """Merge the partials of each partition key from ``first`` to ``last`` (both included, by
    default all) into one load, in one job; returns the keys that changed.

    Finished loads are merged, and those in ``final``, which lists further labels that will not be
    written again. An open load stays as it is.
    """
    catalog.finish_swap(spark, spec.table)
    inside = [
        s for s in catalog.partitions(spark, spec.table)
        if (first is None or first <= s[spec.slot]) and (last is None or s[spec.slot] <= last)
    ]
    names = {s["load_label"] for s in inside}
    done = labels.finished(spark, spec.table, names) | set(final or ())
    done |= {n for n in names if re.match(rf"(merged|day|{FOLDED}\d+)-", n)}
    by_slot: dict[str, list[Spec]] = {}
    for held in inside:
        if held["load_label"] in done:
            by_slot.setdefault(held[spec.slot], []).append(held)
    split = {slot: held for slot, held in by_slot.items() if len(held) > 1}
    if split:
        _merge(spark, spec, [held for many in split.values() for held in many], "merged-")
    return sorted(split)


def _merge(spark: SparkSession, spec: Rollup, old: list[Spec], prefix: str) -> None:
    """Put the merged partials of ``old``, all loads of a label set in their slots, in its place."""
    kind = spark.table(spec.table).schema[spec.slot].dataType
    rows = spark.table(spec.table).filter(
        F.col(spec.slot).isin([F.lit(slot).cast(kind) for slot in sorted({s[spec.slot] for s in old})])
        & F.col("load_label").isin(sorted({s["load_label"] for s in old}))
    )
    merged = merge_partials(rows, [spec.slot, spec.time, *spec.keys], spec.measures)
    merged = merged.withColumn("load_label", F.lit(unique(prefix)))
    catalog.replace_partitions(spark, spec.table, merged, old, _layout(spark, spec))


def fold_agg(spark: SparkSession, spec: Rollup, fan: int) -> None:
    """Merge the finished micro-batches of each slot, ``fan`` or more, into one part, and parts that
    have become as many into a greater one. Safe while the stream that loads the rollup runs it."""
    while (found := labels.mergeable(spark, spec.table, spec.slot, fan, FOLDED)) is not None:
        kind, old = found
        _merge(spark, spec, old, f"{FOLDED}{kind + 1}-")


def expire_agg(spark: SparkSession, spec: Rollup, as_of: str | date | datetime, keep: int = LIVE_DAYS) -> list[str]:
    """Drop the days, or the hours of days, that are ``keep`` or more days older than ``as_of``; returns
    their keys. The catalog alone is asked."""
    catalog.finish_swap(spark, spec.table)
    last = (as_datetime(as_of).date() - timedelta(days=keep)).isoformat()
    old = [s for s in catalog.partitions(spark, spec.table) if s[spec.slot][: len(last)] <= last]
    catalog.drop_partitions(spark, spec.table, old)
    return sorted({s[spec.slot] for s in old})


def partials_between(
    spark: SparkSession, spec: Rollup, start: str | date | datetime, end: str | date | datetime
) -> DataFrame:
    """Partials of ``[start, end)``, read from that range's partitions only."""
    rows = time_range(spark.table(spec.table), start, end, ts=spec.time)
    if spec.grain != "minute":
        return rows
    last = as_datetime(end) - timedelta(microseconds=1)
    return rows.filter(
        F.col(spec.slot).between(spec.slot_key(as_datetime(start)), spec.slot_key(last))
    )


# --- answering a query from the smallest rollup that covers it ---------------------------------

_AVG = {"value_avg": ("value_sum", "value_cnt"), "avg_per_reading": ("value_sum", "reading_cnt")}


def _needed(measures: Iterable[str]) -> list[str]:
    parts = [p for m in measures for p in _AVG.get(m, (m,))]
    return [m for m in MEASURES if m in parts]


Span = tuple[datetime, datetime]


def _floor(moment: datetime, grain: str) -> datetime:
    zeros = {"second": 0, "microsecond": 0}
    if grain != "minute":
        zeros["minute"] = 0
    if grain == "day":
        zeros["hour"] = 0
    return moment.replace(**zeros)


def _whole_buckets(span: Span, grain: str) -> Span | None:
    """The part of the span that consists of whole buckets."""
    first, last = _floor(span[0], grain), _floor(span[1], grain)
    if first < span[0]:
        first += timedelta(**{f"{grain}s": 1})
    return (first, last) if first < last else None


def fitting(
    rollups: Iterable[Rollup], grain: str | None, columns: Iterable[str], measures: Sequence[str]
) -> list[Rollup]:
    """Rollups that hold the columns and measures and are at least as fine as ``grain``, the
    coarsest first, of these the one with fewest keys."""
    coarsest = len(GRAINS) if grain is None else GRAINS.index(grain)
    return [
        spec
        for spec in sorted(rollups, key=lambda r: (-GRAINS.index(r.grain), len(r.keys)))
        if GRAINS.index(spec.grain) <= coarsest
        and set(columns) <= set(spec.keys)
        and set(_needed(measures)) <= set(spec.measures)
    ]


def route(
    spark: SparkSession,
    rollups: Iterable[Rollup],
    grain: str | None,
    columns: Sequence[str],
    measures: Sequence[str],
    start: str | date | datetime,
    end: str | date | datetime,
    source: str | None = None,
    dim_table: str | None = None,
) -> list[tuple[Rollup | None, datetime, datetime]]:
    """Which part of ``[start, end)`` is read from which rollup; None means the readings.

    The coarsest fitting rollup gives the whole buckets in the middle, a finer one what is left,
    the readings the rest. A rollup gives only days it is known to hold: all if it is ``complete``,
    else those that are fresh against ``source`` and ``dim_table``.
    """
    parts: list[tuple[Rollup | None, datetime, datetime]] = []
    left: list[Span] = [(as_datetime(start), as_datetime(end))]
    for spec in fitting(rollups, grain, columns, measures):
        rest: list[Span] = []
        for span in left:
            held = _held_spans(spark, spec, span, source, dim_table)
            at = span[0]
            for first, last in held:
                parts.append((spec, first, last))
                rest += [(at, first)] if at < first else []
                at = last
            rest += [(at, span[1])] if at < span[1] else []
        left = rest
    return [*parts, *[(None, first, last) for first, last in left if first < last]]


def _held_spans(
    spark: SparkSession, spec: Rollup, span: Span, source: str | None, dim_table: str | None
) -> list[Span]:
    inner = _whole_buckets(span, spec.grain)
    if inner is None:
        return []
    if spec.complete:
        return [inner]
    if source is None:
        return []
    last_day = (inner[1] - timedelta(microseconds=1)).date().isoformat()
    spans: list[Span] = []
    for day in fresh_days(spark, spec, source, inner[0].date().isoformat(), last_day, dim_table):
        first = max(inner[0], as_datetime(day))
        last = min(inner[1], as_datetime(day) + timedelta(days=1))
        if spans and spans[-1][1] == first:
            spans[-1] = (spans[-1][0], last)
        else:
            spans.append((first, last))
    return spans


def _chosen(df: DataFrame, where: Mapping[str, Sequence], columns: Iterable[str]) -> DataFrame:
    for name in columns:
        if name in where:
            df = df.filter(F.col(name).isin(list(where[name])))
    return df


def rollup_query(
    spark: SparkSession,
    readings: DataFrame,
    rollups: Iterable[Rollup],
    grain: str | None,
    dims: Sequence[str],
    measures: Sequence[str],
    start: str | date | datetime,
    end: str | date | datetime,
    where: Mapping[str, Sequence] | None = None,
    source: str | None = None,
    dim: DataFrame | None = None,
    dim_table: str | None = None,
) -> DataFrame:
    """Group-by per time bucket and dimension over ``[start, end)``, from the rollups that
    ``route`` picks; without a ``grain``, one bucket for the whole range. The answer is the same
    as from the readings.

    ``where`` gives the values that a column may have. ``source`` is the table of the readings,
    against which days of rollups are checked. ``dim`` supplies columns that the readings lack,
    where they answer; ``dim_table`` is its table. A rollup with such columns shows the dimension
    as it is now: one made of another version of it is not taken.
    """
    needed, where = _needed(measures), dict(where or {})
    columns = list(dict.fromkeys([*dims, *where]))
    keys = list(dims) if grain is None else [bucket_name(grain), *dims]
    partials = []
    for spec, first, last in route(spark, rollups, grain, columns, measures, start, end, source, dim_table):
        if spec is None:
            partials.append(_from_readings(readings, dim, grain, dims, needed, first, last, where))
        else:
            rows = _chosen(partials_between(spark, spec, first, last), where, where)
            partials.append(_folded(rows, spec.time, grain, dims, needed))
    if len(partials) > 1:
        whole = partials[0]
        for part in partials[1:]:
            whole = whole.unionByName(part)
        folded = merge_partials(whole, keys, needed)
    else:
        folded = partials[0] if partials else _from_readings(readings, dim, grain, dims, needed, start, start, where)
    ratios = [F.try_divide(*_AVG[m]).alias(m) if m in _AVG else F.col(m) for m in measures]
    return folded.select(*keys, *ratios)


def _folded(rows: DataFrame, ts: str, grain: str | None, keys: Sequence[str], needed: list[str]) -> DataFrame:
    if grain is None:
        return presummed(rows, keys, needed)
    aggs = partial_exprs(needed) if "value" in rows.columns else merge_exprs(needed)
    return rows.groupBy(bucket(ts, grain).alias(bucket_name(grain)), *keys).agg(*aggs)


def _from_readings(
    readings: DataFrame,
    dim: DataFrame | None,
    grain: str | None,
    dims: Sequence[str],
    needed: list[str],
    first: datetime,
    last: datetime,
    where: Mapping[str, Sequence],
) -> DataFrame:
    """Partials of ``[first, last)`` from the readings, folded before they meet the dimension."""
    columns = dict.fromkeys([*dims, *where])
    lacking = [c for c in columns if c not in readings.columns]
    own = [c for c in columns if c in readings.columns]
    rows = _chosen(time_range(readings, first, last), where, own)
    if not lacking:
        return _folded(rows, "event_time", grain, dims, needed)
    if dim is None:
        raise ValueError(f"the readings have no {', '.join(lacking)}: pass the dimension that has")
    by_device = _folded(rows, "event_time", grain, list(dict.fromkeys(["device_id", *own])), needed)
    sited = _chosen(enrich(by_device, dim, lacking), where, lacking)
    keys = list(dims) if grain is None else [bucket_name(grain), *dims]
    return merge_partials(sited, keys, needed)
