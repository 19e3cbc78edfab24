"""Continuous loads of a message stream into the raw table and into a rollup.

Each micro-batch is written under its own load label. A micro-batch that runs again after a
failure has the same messages and the same label, so it replaces its first attempt. Late rows
are kept: a rollup holds partials per micro-batch, which merge when read. A micro-batch runs only
when those before it are committed, so the job notes them as finished and folds them as it goes.

Batch ids start again at 0 with a new checkpoint; a new checkpoint needs a new ``job_key``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.dimension import sound_changes
from ..operators.quality import figures

from ..plans import labels
from ..plans.dimension import pinned, upsert
from ..plans.labels import batch_label
from ..plans.raw import fold_raw, load_batch
from ..plans.rejects import check_budget, keep_rejects, need_quarantine
from ..plans.rollups import Rollup, compact_agg, fold_agg, load_agg
from ..schemas import DEVICE_CHANGE, LABEL_CHARS, STREAM_READING
from ..session import unique
from ..sources.conform import parse, split

# Pacing and tolerance of the continuous load.
EVERY = {"processingTime": "10 seconds"}
MAX_ERRORS = 100


# A partition is folded with others of its kind when there are so many: micro-batches into one
# part, parts into a greater part. So a day or hour has fewer than this of each kind, however long
# the stream runs, and a row is rewritten once per kind.
FOLD = 16

# Labels that compaction, folding and refresh give; no stream may be called so.
_RESERVED = re.compile(r"merged|day|part\d+")


Batch = Callable[[DataFrame, int], None]
#: Loads the good rows of a micro-batch under its label; what it is given last must run before they are seen.
Load = Callable[[DataFrame, str, Callable[[], None]], None]


def _batches(
    spark: SparkSession,
    table: str,
    load: Load,
    fold: Callable[[], None],
    job_key: str,
    max_errors: int,
    quarantine: str | None,
    schema: T.StructType = STREAM_READING,
) -> Batch:
    """What a job does with a micro-batch.

    The messages are read once: the job that writes the good rows beside the table counts the malformed ones as they
    pass. Then the batch is published, or dropped if there are too many. Only a batch that has
    some is read again, for their text.
    """
    if _RESERVED.fullmatch(job_key) or not re.fullmatch(f"[{LABEL_CHARS}]+", job_key):
        raise ValueError(f"job key {job_key!r}: use letters, digits, _ and -, and not merged, day or part")
    need_quarantine(max_errors, quarantine)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        label = batch_label(job_key, batch_id)
        if batch_id:
            labels.finish(spark, table, job_key, batch_id - 1)
        seen = Observation(unique("batch_"))
        malformed = F.count_if(F.col("reason").isNotNull()).alias("errors")
        parsed = parse(batch, schema).observe(seen, malformed)

        def check() -> None:
            told = figures(seen, parse(batch, schema), [malformed])
            check_budget(label, told["errors"], max_errors)
            if told["errors"]:
                keep_rejects(spark, quarantine, split(parse(batch, schema))[1], label)

        load(split(parsed)[0], label, check)
        if batch_id and batch_id % FOLD == 0:
            fold()

    return one_batch


def _start(messages: DataFrame, batches: Batch, job_key: str, checkpoint: str, trigger: Mapping[str, object]) -> StreamingQuery:
    return (
        messages.writeStream.queryName(job_key)
        .foreachBatch(batches)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def stream_raw(
    spark: SparkSession,
    messages: DataFrame,
    table: str,
    job_key: str,
    checkpoint: str,
    max_errors: int = MAX_ERRORS,
    quarantine: str | None = None,
    trigger: Mapping[str, object] = EVERY,
) -> StreamingQuery:
    """Append the stream's readings to a raw table of its own."""

    def load(good: DataFrame, label: str, check: Callable[[], None]) -> None:
        load_batch(spark, table, good.drop("site_code"), label, check=check)

    def fold() -> None:
        fold_raw(spark, table, FOLD)

    batches = _batches(spark, table, load, fold, job_key, max_errors, quarantine)
    return _start(messages, batches, job_key, checkpoint, trigger)


def rollup_batches(
    spark: SparkSession,
    spec: Rollup,
    job_key: str,
    dim: DataFrame | str | None = None,
    max_errors: int = MAX_ERRORS,
    quarantine: str | None = None,
) -> Batch:
    """What ``stream_rollup`` does with each micro-batch, for a stream started elsewhere."""

    def load(good: DataFrame, label: str, check: Callable[[], None]) -> None:
        sites = pinned(spark, dim, f"{spec.table}_dim_of", job_key, label) if isinstance(dim, str) else dim
        load_agg(spark, spec, good, label, sites, False, check)

    def fold() -> None:
        fold_agg(spark, spec, FOLD)

    return _batches(spark, spec.table, load, fold, job_key, max_errors, quarantine)


def stream_rollup(
    spark: SparkSession,
    messages: DataFrame,
    spec: Rollup,
    job_key: str,
    checkpoint: str,
    dim: DataFrame | str | None = None,
    max_errors: int = MAX_ERRORS,
    quarantine: str | None = None,
    trigger: Mapping[str, object] = EVERY,
) -> StreamingQuery:
    """Fold the stream into a rollup as it arrives. ``dim`` supplies the site of readings that carry none.

    As the name of a dimension table, it is followed: each micro-batch takes the version that is
    there when it begins, which is noted under its label, so that the same micro-batch run again
    gives the same rows. As a DataFrame, it is what it was at the start.
    """
    batches = rollup_batches(spark, spec, job_key, dim, max_errors, quarantine)
    return _start(messages, batches, job_key, checkpoint, trigger)


def stream_dim(
    spark: SparkSession,
    messages: DataFrame,
    table: str,
    job_key: str,
    checkpoint: str,
    order: Sequence[str] = ("updated_at",),
    schema: T.StructType = DEVICE_CHANGE,
    max_errors: int = MAX_ERRORS,
    quarantine: str | None = None,
    trigger: Mapping[str, object] = EVERY,
) -> StreamingQuery:
    """Keep the dimension current from its change feed: JSON messages of ``schema``, each a row and ``__op``.

    Of a device the change that is last by ``order`` counts, in whatever order and how often changes
    come: the table keeps deleted devices, and a change older than what is stored is passed over. A
    micro-batch that runs again changes nothing. Malformed changes go to ``quarantine``.
    """
    need_quarantine(max_errors, quarantine)

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        label = batch_label(job_key, batch_id)
        parsed = parse(batch, schema).persist()
        try:
            good, bad = split(parsed)
            sound, unsound = sound_changes(good)
            rejects = bad.unionByName(unsound)
            errors = rejects.count()
            check_budget(label, errors, max_errors)
            if errors:
                keep_rejects(spark, quarantine, rejects, label)
            upsert(spark, table, sound, order=order)
        finally:
            parsed.unpersist()

    return _start(messages, one_batch, job_key, checkpoint, trigger)


def stream_rejects(
    spark: SparkSession,
    messages: DataFrame,
    quarantine: str,
    job_key: str,
    checkpoint: str,
    max_errors: int = MAX_ERRORS,
    trigger: Mapping[str, object] = EVERY,
) -> StreamingQuery:
    """Keep the stream's malformed messages, and fail beyond the budget; for a job that reads the
    same messages but cannot set them aside itself."""

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        label = batch_label(job_key, batch_id)
        bad = split(parse(batch))[1]
        seen = Observation(unique("batch_"))
        counted = F.count(F.lit(1)).alias("errors")

        def check() -> None:
            check_budget(label, figures(seen, bad, [counted])["errors"], max_errors)

        keep_rejects(spark, quarantine, bad.observe(seen, counted), label, check)

    need_quarantine(max_errors, quarantine)
    return _start(messages, one_batch, job_key, checkpoint, trigger)


def compact_stream_rollup(
    spark: SparkSession, spec: Rollup, first: str | None = None, last: str | None = None
) -> list[str]:
    """Merge what is finished in each partition key; a micro-batch that may still run again stays.
    Run it while the stream is paused: a table has one writer at a time."""
    return compact_agg(spark, spec, first, last)
