"""Quality gates. A violated gate raises; it never skips quietly."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.times import moment

T = TypeVar("T")


class DataQualityError(AssertionError):
    """A gate failed; whatever depends on it must not run."""


def _where(where: str | Column | None) -> Column:
    """Optional predicate; parsed on its own, so that an OR in it cannot bind to what follows."""
    if where is None:
        return F.lit(True)
    return F.expr(where) if isinstance(where, str) else where


@dataclass(frozen=True)
class RowCount:
    """At least ``min_rows`` rows."""

    min_rows: int = 1
    where: str | Column | None = None
    name: str = "row_count"

    def stats(self) -> list[Column]:
        return [F.count_if(_where(self.where))]

    def observed(self, rows: Column) -> Column:
        return rows.cast("double")

    def limit(self) -> float:
        return float(self.min_rows)

    def passed(self, observed: Column) -> Column:
        return F.coalesce(observed, F.lit(0.0)) >= self.limit()

    def result(self, observed: float | None) -> int:
        return int(observed or 0)


@dataclass(frozen=True)
class NullRatio:
    """At most ``max_ratio`` of the rows have no ``column``; an empty input fails."""

    column: str
    max_ratio: float
    where: str | Column | None = None
    name: str = "null_ratio"

    def stats(self) -> list[Column]:
        where = _where(self.where)
        return [F.count_if(where), F.count_if(where & F.col(self.column).isNull())]

    def observed(self, rows: Column, nulls: Column) -> Column:
        return F.try_divide(nulls, rows)

    def limit(self) -> float:
        return float(self.max_ratio)

    def passed(self, observed: Column) -> Column:
        return F.coalesce(observed <= self.limit(), F.lit(False))

    def result(self, observed: float | None) -> float:
        return float(observed)


@dataclass(frozen=True)
class Fresh:
    """The newest ``ts`` is at most ``max_lag_minutes`` whole minutes old; no rows at all fail."""

    ts: str = "event_time"
    max_lag_minutes: int = 60
    as_of: str | datetime | None = None
    name: str = "freshness"

    def stats(self) -> list[Column]:
        return [F.max(F.col(self.ts).cast("timestamp"))]

    def observed(self, newest: Column) -> Column:
        return F.timestamp_diff("MINUTE", newest, moment(self.as_of)).cast("double")

    def limit(self) -> float:
        return float(self.max_lag_minutes)

    def passed(self, observed: Column) -> Column:
        return F.coalesce(observed <= self.limit(), F.lit(False))

    def result(self, observed: float | None) -> int:
        return int(observed)


Gate = RowCount | NullRatio | Fresh


def run_gates(df: DataFrame, gates: Sequence[Gate]) -> DataFrame:
    """One report row per gate: ``gate, observed, max_or_min, passed``.

    All gates share one pass. Their predicates sit in conditional aggregates, since a common
    filter would hide rows from the gates that have none.
    """
    return _report(df.agg(*_stats(gates)), gates)


def _stats(gates: Sequence[Gate]) -> list[Column]:
    return [c.alias(f"g{i}_{j}") for i, gate in enumerate(gates) for j, c in enumerate(gate.stats())]


def _report(totals: DataFrame, gates: Sequence[Gate]) -> DataFrame:
    rows = []
    for i, gate in enumerate(gates):
        observed = gate.observed(*[F.col(f"g{i}_{j}") for j in range(len(gate.stats()))])
        rows.append(
            F.struct(
                F.lit(gate.name).alias("gate"),
                observed.alias("observed"),
                F.lit(gate.limit()).alias("max_or_min"),
                gate.passed(observed).alias("passed"),
            )
        )
    return totals.select(F.inline(F.array(*rows)))


def figures(seen: Observation, df: DataFrame, stats: Sequence[Column]) -> dict[str, object]:
    """What ``seen`` has observed in the job that ran ``df``.

    Where no row is left behind a shuffle, adaptive execution drops the plan that has observed them, and
    Spark hands out a row without fields that Python cannot read. Then ``stats`` are computed.
    """
    try:
        told = seen.get
    except Py4JJavaError:
        told = {}
    return told or df.agg(*stats).first().asDict()


def in_flight(df: DataFrame, gates: Sequence[Gate], table: str = "table") -> tuple[DataFrame, Callable[[], dict[str, float | int]]]:
    """``df``, measured by whatever job runs it, and ``enforce`` for what that job has seen, to be
    called once it has ended. The rows are read once, by that job."""
    seen = Observation(f"gates_{id(gates)}_{time.monotonic_ns()}")
    measured = df.observe(seen, *_stats(gates))

    def enforce_seen() -> dict[str, float | int]:
        told = figures(seen, df, _stats(gates))
        types = df.agg(*_stats(gates)).schema.fields
        totals = df.sparkSession.range(1).select(*[F.lit(told[f.name]).cast(f.dataType).alias(f.name) for f in types])
        return _judged(_report(totals, gates), gates, table)

    return measured, enforce_seen


def enforce(df: DataFrame, gates: Sequence[Gate], table: str = "table") -> dict[str, float | int]:
    """Observed value per gate; raises with every failed gate, its value and its limit."""
    return _judged(run_gates(df, gates), gates, table)


def _judged(told: DataFrame, gates: Sequence[Gate], table: str) -> dict[str, float | int]:
    report = {r["gate"]: r for r in told.collect()}
    failed = [r for r in report.values() if not r["passed"]]
    if failed:
        told = "; ".join(
            f"{r['gate']}={_told(r['observed'])}, limit {r['max_or_min']:g}" for r in failed
        )
        raise DataQualityError(f"{table}: {told}")
    return {g.name: g.result(report[g.name]["observed"]) for g in gates}


def _told(observed: float | None) -> str:
    return "undefined (no rows)" if observed is None else f"{observed:.4f}"


def row_count_at_least(
    df: DataFrame, min_rows: int, where: str | Column | None = None, table: str = "table"
) -> int:
    gate = RowCount(min_rows, where)
    return int(enforce(df, [gate], table)[gate.name])


def null_ratio_below(
    df: DataFrame,
    column: str,
    max_ratio: float,
    where: str | Column | None = None,
    table: str = "table",
) -> float:
    gate = NullRatio(column, max_ratio, where)
    return float(enforce(df, [gate], table)[gate.name])


def fresh(
    df: DataFrame,
    ts: str = "event_time",
    max_lag_minutes: int = 60,
    as_of: str | datetime | None = None,
    table: str = "table",
) -> int:
    gate = Fresh(ts, max_lag_minutes, as_of)
    return int(enforce(df, [gate], table)[gate.name])


def publish(df: DataFrame, gates: Sequence[Gate], action: Callable[[], T], table: str = "table") -> T:
    """Run ``action`` only if every gate passes."""
    enforce(df, gates, table)
    return action()
