"""Joins of readings or rollups with device dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import MEASURES, measures_of, merge_exprs
from ..functions.times import bucket_name
from ..schemas import BUCKETS
from .rollup import STREAM_KEYS, merge_partials, presummed, rollup

KEY = "device_id"


def with_device(fact: DataFrame, dim: DataFrame, how: str = "inner", key: str = KEY) -> DataFrame:
    """Fact joined with its device on equal key.

    The plan is Spark's choice: a broadcast where the dimension's size is below the session's
    limit, else a sort-merge join whose skewed partitions adaptive execution splits, without a
    shuffle where both tables are bucketed alike (see ``colocated_join`` for hot devices there).
    """
    return fact.join(dim, key, how)


def hot_keys(fact: DataFrame, key: str = KEY, buckets: int = BUCKETS) -> list:
    """Keys that hold more than half of what a bucket holds on average, found in one pass; there
    are fewer than ``2 * buckets``."""
    extra = ["event_date"] if "event_date" in fact.columns else []
    # Days are counted apart first: grouping a table bucketed by key on the key alone would
    # count a hot key in one task.
    counts = fact.groupBy(key, *extra).agg(F.count(F.lit(1)).alias("n"))
    if extra:
        counts = counts.groupBy(key).agg(F.sum("n").alias("n"))
    # One row per key: kept, so that the total and the hot keys need one pass over the fact.
    counts = counts.persist()
    try:
        total = counts.agg(F.sum("n")).first()[0] or 0
        hot = counts.filter((F.col("n") > total / (2 * buckets)) & F.col(key).isNotNull())
        return [row[key] for row in hot.select(key).collect()]
    finally:
        counts.unpersist()


def colocated_join(
    fact: DataFrame,
    dim: DataFrame,
    how: str = "inner",
    key: str = KEY,
    buckets: int = BUCKETS,
    hot: list | None = None,
) -> DataFrame:
    """Join with a large dimension bucketed like the fact, without a shuffle and without hot tasks.

    A bucket is one task, so a device with a third of all rows would hold one task back. Devices
    with more rows than half a bucket of the ``buckets`` that the tables have are joined apart:
    their rows stay in scan order and meet a broadcast of their dimension rows, fewer than
    ``2 * buckets`` since ``key`` is unique in ``dim``. All other rows take the co-located join.
    Pass ``hot`` where the keys are known.
    """
    if hot is None:
        hot = hot_keys(fact, key, buckets)
    bucketed = dim.hint("merge")
    if not hot:
        return fact.join(bucketed, key, how)
    is_hot = F.col(key).isin(hot)
    cold_rows = fact.filter(~is_hot | F.col(key).isNull()).join(bucketed, key, how)
    hot_rows = fact.filter(is_hot).join(F.broadcast(dim.filter(is_hot)), key, how)
    return cold_rows.unionByName(hot_rows)


def enrich(
    readings: DataFrame, dim: DataFrame, attributes: Sequence[str] = ("site_code",)
) -> DataFrame:
    """Readings with device attributes attached before any rollup.

    A left join: a reading of an unknown device stays. An attribute that the reading already
    carries wins over the dimension's. ``readings`` may be a stream.
    """
    dim = dim.select(KEY, *[F.col(a).alias(f"_dim_{a}") for a in attributes])
    joined = readings.join(dim, KEY, "left")
    for name in attributes:
        own = [F.col(name)] if name in readings.columns else []
        joined = joined.withColumn(name, F.coalesce(*own, F.col(f"_dim_{name}")))
    return joined.drop(*[f"_dim_{a}" for a in attributes])


def enriched_rollup(
    readings: DataFrame,
    dim: DataFrame,
    grain: str,
    keys: Sequence[str] = STREAM_KEYS,
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """``rollup(enrich(readings, dim))``, folded before the join.

    The attributes belong to the device, so a device's readings share them. Folding first means
    that the join sees one row per bucket, device and metric, hot device or not.
    """
    own = [k for k in keys if k in readings.columns]
    attributes = [k for k in keys if k not in readings.columns or k == "site_code"]
    folded = rollup(readings, grain, dict.fromkeys([KEY, *own]), measures)
    enriched = enrich(folded, dim, attributes)
    if KEY in keys and not set(own) & set(attributes):
        return enriched.select(bucket_name(grain), *keys, *measures)
    # A site that some readings carry and others get from the dimension is one group.
    return merge_partials(enriched, [bucket_name(grain), *keys], measures)


def groupby_dims(
    fact: DataFrame,
    dims: Iterable[tuple[DataFrame, str]],
    keys: Sequence[str],
    measures: Sequence[str] = MEASURES,
) -> DataFrame:
    """Group-by over columns of the fact and of any number of dimensions.

    ``dims`` is a list of ``(dimension, join column)``, applied in order, so that a later one may
    join on a column of an earlier one. The fact is first folded to its own group and join
    columns: the joins then see partials and not readings, which also removes hot devices. Where
    a row has a column already, from the fact or an earlier dimension, that value wins over the
    same column of a dimension, which fills in NULLs.
    """
    dims = list(dims)
    own = [c for c in dict.fromkeys([*[k for _, k in dims], *keys]) if c in fact.columns]
    wanted = measures if "value" in fact.columns else [m for m in measures if m in measures_of(fact)]
    folded = presummed(fact, own, wanted)
    if not dims:
        return folded
    for dim, key in dims:
        both = [c for c in dim.columns if c in folded.columns and c != key]
        folded = folded.join(dim.withColumnsRenamed({c: f"_dim_{c}" for c in both}), key)
        folded = folded.withColumns({c: F.coalesce(c, f"_dim_{c}") for c in both}).drop(*[f"_dim_{c}" for c in both])
    return folded.groupBy(*keys).agg(*merge_exprs(wanted))
