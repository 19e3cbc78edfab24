"""The measures of a rollup: how each starts from readings and how its partials merge."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ("reading_cnt", "value_cnt", "value_sum", "value_max", "value_min")

_PARTIAL = {
    "reading_cnt": lambda: F.count(F.lit(1)),
    "value_cnt": lambda: F.count("value"),
    "value_sum": lambda: F.sum("value"),
    "value_max": lambda: F.max("value"),
    "value_min": lambda: F.min("value"),
}
_MERGE = {
    "reading_cnt": F.sum,
    "value_cnt": F.sum,
    "value_sum": F.sum,
    "value_max": F.max,
    "value_min": F.min,
}


def partial_exprs(measures: Iterable[str] = MEASURES) -> list[Column]:
    return [_PARTIAL[m]().alias(m) for m in measures]


def merge_exprs(measures: Iterable[str] = MEASURES) -> list[Column]:
    return [_MERGE[m](m).alias(m) for m in measures]


def measures_of(df: DataFrame) -> list[str]:
    return [m for m in MEASURES if m in df.columns]


def with_avg(rollup: DataFrame) -> DataFrame:
    """``value_avg`` is the mean of the values present; ``avg_per_reading`` divides by all
    readings, so that missing values lower it."""
    return rollup.withColumns(
        {
            "value_avg": F.try_divide("value_sum", "value_cnt"),
            "avg_per_reading": F.try_divide("value_sum", "reading_cnt"),
        }
    )
