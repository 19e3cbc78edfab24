"""Upsert and delete of a keyed dimension from a change feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import MAX_LENGTH

OP = "__op"  # 0 upsert, 1 delete
KEY = "device_id"


def latest(changes: DataFrame, key: str = KEY, order: Sequence[str] = ("updated_at",)) -> DataFrame:
    """The last change of each key; a NULL in ``order`` is oldest.

    Spark keeps one row per key and task ahead of the shuffle, so a device with a third of all
    changes does not meet them in one task. Columns outside ``order`` only break full ties.
    """
    rest = [c for c in changes.columns if c != key and c not in order]
    by = [F.desc_nulls_last(c) for c in [*order, *sorted(rest)]]
    window = Window.partitionBy(key).orderBy(*by)
    return changes.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")


def sound_changes(changes: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """Changes that can be applied, and the others as ``reason`` and ``payload`` (JSON)."""
    reasons = [
        F.when(F.col(key).isNull(), F.lit(f"{key} missing")),
        F.when(F.col(OP).isNull() | ~F.col(OP).isin(0, 1), F.lit(f"{OP} invalid")),
        *[F.when(F.length(c) > n, F.lit(f"{c} too long")) for c, n in MAX_LENGTH.items() if c in changes.columns],
    ]
    reason = F.coalesce(*reasons)
    bad = changes.filter(reason.isNotNull())
    return changes.filter(reason.isNull()), bad.select(reason.alias("reason"), F.to_json(F.struct(*changes.columns)).alias("payload"))


def _version(prefix: str, order: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"{prefix}.{c}") for c in order])


def apply_changes(
    state: DataFrame,
    changes: DataFrame,
    key: str = KEY,
    order: Sequence[str] = ("updated_at",),
    buckets: int = 0,
) -> DataFrame:
    """New state: per key the newer of the stored row and the last change.

    The state keeps deleted keys as rows with ``__op = 1``; otherwise an update older than the
    delete would bring the key back. Only the changes are ranked. Where the state is a table
    with ``buckets`` buckets on ``key``, the changes are brought to its buckets: the state is
    neither shuffled by the join nor by a write into a table bucketed alike.
    """
    columns = state.columns
    changes = changes.select(
        *[
            (F.col(f.name) if f.name in changes.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in state.schema.fields
        ]
    )
    old = state.select(F.col(key), F.struct(*columns).alias("old"))
    new = latest(changes, key, order).select(F.col(key), F.struct(*columns).alias("new"))
    if buckets:
        new = new.repartition(buckets, key)
    both = old.join(new, key, "full_outer")
    newer = F.col("old").isNull() | (_version("new", order) >= _version("old", order))
    pick = F.when(F.col("new").isNotNull() & newer, F.col("new")).otherwise(F.col("old"))
    return both.select(pick.alias("row")).select("row.*")


def serving(state: DataFrame) -> DataFrame:
    """Rows that readers see: the state without deleted keys."""
    return state.filter(F.col(OP) == 0).drop(OP)
