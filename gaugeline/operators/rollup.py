"""Group-by-time operators over readings and over partial aggregates."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame

from ..functions.measures import MEASURES, measures_of, merge_exprs, partial_exprs
from ..functions.times import GRAINS, bucket, bucket_name, time_range

DEVICE_KEYS = ("device_id", "metric")
STREAM_KEYS = ("device_id", "metric", "site_code")


def rollup(
    df: DataFrame,
    grain: str,
    keys: Iterable[str] = DEVICE_KEYS,
    measures: Iterable[str] = MEASURES,
) -> DataFrame:
    """One row per time bucket and key. All measures have map-side partials, so a hot device
    reaches the shuffle as at most one row per task and bucket."""
    by = bucket("event_time", grain).alias(bucket_name(grain))
    return df.groupBy(by, *keys).agg(*partial_exprs(measures))


def merge_partials(
    partials: DataFrame, keys: Iterable[str], measures: Iterable[str] | None = None
) -> DataFrame:
    """Fold partials of equal key: sums of sums and counts, maximum of maxima, and so on."""
    return partials.groupBy(*keys).agg(*merge_exprs(measures or measures_of(partials)))


def grain_of(rolled: DataFrame) -> str:
    return next(g for g in GRAINS if bucket_name(g) in rolled.columns)


def rollup_up(rolled: DataFrame, grain: str, keys: Iterable[str] = DEVICE_KEYS) -> DataFrame:
    """A coarser rollup from a finer one."""
    finer = grain_of(rolled)
    if GRAINS.index(grain) < GRAINS.index(finer):
        raise ValueError(f"cannot split {finer} buckets into {grain} buckets")
    measures = measures_of(rolled)
    by = bucket(bucket_name(finer), grain).alias(bucket_name(grain))
    return rolled.groupBy(by, *keys).agg(*merge_exprs(measures))


def presummed(df: DataFrame, keys: Iterable[str], measures: Iterable[str] = MEASURES) -> DataFrame:
    """Partial measures per key, from readings or from partials.

    Over a table with day partitions the day joins the key first. Otherwise a table bucketed by
    ``device_id`` would be grouped without a shuffle, a hot device in one task.
    """
    keys = list(keys)
    first = partial_exprs(measures) if "value" in df.columns else merge_exprs(measures)
    if "event_date" not in df.columns or "event_date" in keys:
        return df.groupBy(*keys).agg(*first)
    return merge_partials(df.groupBy("event_date", *keys).agg(*first), keys, measures)


def timeseries(
    df: DataFrame,
    grain: str,
    start: str | date | datetime | None = None,
    end: str | date | datetime | None = None,
    where: Column | None = None,
    measures: Iterable[str] = MEASURES,
) -> DataFrame:
    """One row per non-empty time bucket of a filtered slice."""
    sliced = time_range(df, start, end)
    if where is not None:
        sliced = sliced.filter(where)
    by = bucket("event_time", grain).alias(bucket_name(grain))
    return sliced.groupBy(by).agg(*partial_exprs(measures))
