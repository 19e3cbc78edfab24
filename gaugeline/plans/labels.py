"""Which loads of a table are finished for good.

A finished load is never written again: sent once more, it changes nothing, and compaction may fold
it with others. An open one is replaced when it is sent again, and left alone by compaction. The
record is a table of partitions without rows, so that each entry is one catalog statement.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import SparkSession

from . import catalog

_DIGITS = 12


def batch_label(job_key: str, batch_id: int) -> str:
    return f"{job_key}-{batch_id:0{_DIGITS}d}"


def _of_batch(label: str) -> tuple[str, str] | None:
    """Job and number of a micro-batch's label."""
    job, _, number = label.rpartition("-")
    return (job, number) if job and len(number) == _DIGITS and number.isdigit() else None


def _ledger(table: str) -> str:
    return f"{table}_finished"


def finish(spark: SparkSession, table: str, job: str, upto: int | None = None) -> None:
    """Note that the load ``job`` is finished, or the micro-batches of ``job`` up to a number.

    A stream has one entry, which moves: the new one is added before the old one goes.
    """
    ledger = _ledger(table)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {ledger} (n int, job string, upto string) USING parquet PARTITIONED BY (job, upto)")
    entry = {"job": job, "upto": "all" if upto is None else f"{upto:0{_DIGITS}d}"}
    before = [s for s in catalog.partitions(spark, ledger, job=job) if s != entry]
    spark.sql(f"ALTER TABLE {ledger} ADD IF NOT EXISTS PARTITION (job='{entry['job']}', upto='{entry['upto']}')")
    if before:
        catalog.drop_partitions(spark, ledger, before)


def _entries(spark: SparkSession, table: str, job: str) -> list[str]:
    ledger = _ledger(table)
    if not spark.catalog.tableExists(ledger):
        return []
    return [s["upto"] for s in catalog.partitions(spark, ledger, job=job)]


def finished(spark: SparkSession, table: str, labels: Iterable[str]) -> set[str]:
    """Those of ``labels`` that are finished."""
    done, known = set(), {}
    for label in labels:
        batch = _of_batch(label)
        job = batch[0] if batch else label
        if job not in known:
            known[job] = _entries(spark, table, job)
        if "all" in known[job] if batch is None else any(upto >= batch[1] for upto in known[job]):
            done.add(label)
    return done


def mergeable(
    spark: SparkSession, table: str, slot: str, fan: int, prefix: str
) -> tuple[int, list[catalog.Spec]] | None:
    """Partitions to fold next, all of one kind: finished micro-batches (kind 0), or parts of kind k,
    labelled ``prefix`` and k, of the slots that hold ``fan`` or more of it. None if there are none."""
    held = catalog.partitions(spark, table)
    done = finished(spark, table, {s["load_label"] for s in held if _of_batch(s["load_label"])})
    kinds: dict[int, dict[str, list[catalog.Spec]]] = {}
    for spec in held:
        part = re.match(rf"{prefix}(\d+)-", spec["load_label"])
        if part or spec["load_label"] in done:
            kinds.setdefault(int(part[1]) if part else 0, {}).setdefault(spec[slot], []).append(spec)
    for kind in sorted(kinds):
        full = [spec for specs in kinds[kind].values() if len(specs) >= fan for spec in specs]
        if full:
            return kind, full
    return None
