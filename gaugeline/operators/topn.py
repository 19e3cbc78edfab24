"""Top-N reports."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.times import time_range
from .rollup import presummed

# Sums of doubles differ in the last of about 15 digits from run to run; ranks must not.
_DIGITS = 12


def _ranking(measure: str) -> Column:
    """Descending, by the first digits of the measure whatever its size."""
    value = F.col(measure).cast("double")
    unit = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(value))) - (_DIGITS - 1))
    return F.desc_nulls_last(F.when(value == 0, value).otherwise(F.round(value / unit) * unit))


def site_topn(
    fact: DataFrame, dim: DataFrame | None, metric: str, n: int, measure: str = "value_sum"
) -> DataFrame:
    """The ``n`` devices of each site with the largest measure within one metric.

    The fact, readings or a rollup, is folded to one row per device before it meets the
    dimension, and each task keeps ``n`` rows per site before the shuffle to the ranking.
    ``dim`` is None for a rollup that holds the site already; devices without one are left out.
    """
    one_metric = fact.filter(F.col("metric") == metric)
    if dim is None:
        sited = one_metric.filter(F.col("site_code").isNotNull())
        per_site = presummed(sited, ["site_code", "device_id"], [measure])
    else:
        per_device = presummed(one_metric, ["device_id"], [measure])
        per_site = per_device.join(dim.select("device_id", "site_code"), "device_id")
    order = Window.partitionBy("site_code").orderBy(_ranking(measure), "device_id")
    return (
        per_site.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .select("site_code", "rank", "device_id", measure)
    )


def topn(
    df: DataFrame,
    dim: str,
    metric: str,
    n: int,
    start: str | date | datetime | None = None,
    end: str | date | datetime | None = None,
    measure: str = "value_sum",
) -> DataFrame:
    """The ``n`` values of one dimension with the largest measure in a time range; exact."""
    rows = time_range(df, start, end).filter(F.col("metric") == metric)
    return presummed(rows, [dim], [measure]).orderBy(_ranking(measure), dim).limit(n)
