"""The device dimension as a table kept current from a change feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dimension import KEY, OP, apply_changes, serving, sound_changes
from ..schemas import BUCKETS, DEVICE, ddl
from ..session import lake_location
from . import catalog
from .raw import label_for
from .rejects import keep_rejects


def create_dim(
    spark: SparkSession,
    table: str,
    schema: T.StructType = DEVICE,
    key: str = KEY,
    buckets: int = BUCKETS,
) -> None:
    """Bucketed like the raw table, so that the two join without a shuffle."""
    location = f"{lake_location(spark, table)}/_staged/{table.split('.')[-1]}_0"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({ddl(schema)}, `{OP}` int) USING parquet "
        "OPTIONS (compression 'zstd') "
        + catalog.bucket_clause(key, [key], buckets)
        + f" LOCATION '{location}'"
    )


def upsert(
    spark: SparkSession,
    table: str,
    changes: DataFrame,
    key: str = KEY,
    order: Sequence[str] = ("updated_at",),
    quarantine: str | None = None,
    label: str | None = None,
) -> str:
    """Apply a batch of upserts (``__op`` 0) and deletes (1). Applying it twice changes nothing.

    A change without a key, with a text that is too long or another ``__op`` goes to
    ``quarantine``, under ``label`` or one made of the rejects themselves; without that table it fails
    the batch. Readers see the table before or after the batch. Returns the folder of the version before.
    """
    if OP not in changes.columns:
        changes = changes.withColumn(OP, F.lit(0))
    good, bad = sound_changes(changes, key)
    digest = F.xxhash64("payload")
    # The exclusive or alone would take batches for one in which rows repeat in pairs.
    added = F.coalesce(F.sum(digest.cast("decimal(38,0)")), F.lit(0))
    told = bad.agg(F.count("*"), F.coalesce(F.bit_xor(digest), F.lit(0)), F.min("reason"), added).first()
    if told[0] and quarantine is None:
        raise ValueError(f"{told[0]} changes cannot be applied, for one: {told[2]}")
    if told[0]:
        keep_rejects(spark, quarantine, bad, label or label_for("changes", f"{told[0]}_{told[1]}_{told[3]}"))
    buckets = catalog.bucket_count(spark, table)
    state = apply_changes(spark.table(table), good, key, order, buckets)
    # The join leaves each bucket's rows in one task, so they are written from where they are.
    return catalog.publish_snapshot(spark, table, state, catalog.Layout())


def read_dim(spark: SparkSession, table: str) -> DataFrame:
    return serving(spark.table(table))


# --- versions -------------------------------------------------------------------------------------


def version(spark: SparkSession, table: str) -> str:
    """The folder that holds the dimension now; a change leaves it and makes another."""
    return catalog.table_location(spark, table)


def read_version(spark: SparkSession, table: str, folder: str) -> DataFrame:
    """The dimension as it was in one of its versions, if that was not removed."""
    return serving(spark.read.schema(spark.table(table).schema).parquet(folder))


def pinned(spark: SparkSession, table: str, notes: str, job: str, label: str) -> DataFrame:
    """The dimension for the load ``label`` of ``job``: its version now, or, if that load has begun before,
    the version it had then.

    ``notes`` keeps one row for each job, its newest load, as only that one can run again. The row is
    written before the load writes anything: if it is lost in a crash, nothing was loaded with it. The noted folder must not
    be removed before the job has gone on to its next load.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {notes} (load_label string, version string, job string) "
        "USING parquet OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (job)"
    )
    last = spark.table(notes).filter(F.col("job") == job).first()
    if last is not None and last["load_label"] == label:
        return read_version(spark, table, last["version"])
    now = version(spark, table)
    row = spark.createDataFrame([(label, now, job)], spark.table(notes).schema)
    row.coalesce(1).write.mode("overwrite").insertInto(notes)
    return read_version(spark, table, now)
