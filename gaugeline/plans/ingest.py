"""Loads into the raw table: increments of a source, and JSON batch files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import as_datetime, as_text
from ..schemas import BATCH_LIMIT, WATERMARK_FLOOR
from ..sources.conform import parse, split
from ..sources.json_batch import read_json_batch
from ..session import lake_location, unique
from ..sources.readings import read_increment
from . import labels
from .catalog import remove_folder
from .raw import label_for, load_batch
from .rejects import check_budget, keep_rejects, need_quarantine
from .watermark import get_watermark, set_watermark


def ingest_increment(
    spark: SparkSession,
    src: DataFrame,
    table: str,
    control: str,
    job_key: str,
    limit: int | None = BATCH_LIMIT,
    as_of: str | datetime | None = None,
) -> str | None:
    """Load the next increment; returns the new watermark, or None if there was nothing to load.

    The label depends on the job and the low watermark only. A retry after a crash starts from
    the same low watermark, so it replaces the rows of the first attempt, also if the source has
    grown since. The watermark moves after the write, and only forward.
    """
    low = as_text(get_watermark(spark, control, job_key, WATERMARK_FLOOR))
    step = read_increment(src, low, limit)
    if step.high is None:
        return None
    load_batch(spark, table, step.rows, label_for(job_key, low), as_of)
    if as_datetime(step.high) > as_datetime(low):
        set_watermark(spark, control, job_key, step.high, as_of)
    return step.high


def ingest_all(
    spark: SparkSession,
    src: DataFrame,
    table: str,
    control: str,
    job_key: str,
    limit: int | None = BATCH_LIMIT,
    as_of: str | datetime | None = None,
) -> list[str]:
    """Load increments until the source has no more; returns the watermarks passed."""
    passed = []
    while (high := ingest_increment(spark, src, table, control, job_key, limit, as_of)) is not None:
        passed.append(high)
    return passed


def load_json(
    spark: SparkSession,
    table: str,
    path: str | list[str],
    array: bool,
    name: str = "json",
    max_errors: int = 0,
    quarantine: str | None = None,
    as_of: str | datetime | None = None,
) -> str:
    """Load a batch of JSON files, all of it or nothing; returns its label.

    The label comes from the content: the same messages sent again change nothing, in whatever
    order and files they come, also after the table was compacted. More than ``max_errors``
    malformed messages fail the load; fewer go to ``quarantine``, without which none is tolerated.
    """
    need_quarantine(max_errors, quarantine)
    staged = f"{lake_location(spark, table)}/_staged/{unique('json_')}"
    try:
        return _load_staged(spark, table, read_json_batch(spark, path, array), staged, name, max_errors, quarantine, as_of)
    finally:
        remove_folder(spark, staged)


def _load_staged(
    spark: SparkSession,
    table: str,
    lines: DataFrame,
    staged: str,
    name: str,
    max_errors: int,
    quarantine: str | None,
    as_of: str | datetime | None,
) -> str:
    # The text is read and parsed once; only rejects keep theirs.
    rejected = F.when(F.col("reason").isNotNull(), F.col("payload"))
    rows = parse(lines).withColumn("digest", F.xxhash64("payload")).withColumn("payload", rejected)
    rows.write.parquet(staged)
    parsed = spark.read.schema(rows.schema).parquet(staged)
    digest = F.col("digest")
    told = parsed.agg(
        F.count_if(F.col("reason").isNotNull()).alias("errors"),
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bit_xor(digest), F.lit(0)).alias("mixed"),
        F.coalesce(F.sum(digest.cast("decimal(38,0)")), F.lit(0)).alias("added"),
    ).first()
    label = label_for(name, f"{told['n']}_{told['mixed']}_{told['added']}")
    check_budget(label, told["errors"], max_errors)
    if labels.finished(spark, table, [label]):
        return label
    good, bad = split(parsed.drop("digest"))
    if told["errors"]:
        keep_rejects(spark, quarantine, bad, label)
    load_batch(spark, table, good, label, as_of, done=True)
    return label
