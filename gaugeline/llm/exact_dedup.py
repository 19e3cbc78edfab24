"""Exact deduplication that takes frequent texts out of the shuffle.

Misra-Gries summaries of the digests, one per task, name every digest above a share of the rows.
Their exact winners are counted with map-side partials and broadcast; rows of such digests are
decided where they are. Only the other digests are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, written

#: Counters of a summary. A digest on more than 2 / (COUNTERS + 1) of the rows is always found.
COUNTERS = 255


def digested(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, id, digest) of each row; equal texts up to white space have equal digests."""
    normal = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, " ")
    return df.select(
        F.col(doc_id).alias("id"), F.unhex(F.sha2(normal.cast("binary"), 256)).alias("digest")
    ).withColumn("row", F.monotonically_increasing_id())


def summaries(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Merged Misra-Gries counts (digest, low): too low by at most rows / (counters + 1)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for batch in batches:
            for entry in batch.column(0).value_counts().to_pylist():
                held[entry["values"]] = held.get(entry["values"], 0) + entry["counts"]
            if len(held) > counters:
                off = sorted(held.values(), reverse=True)[counters]
                held = {k: v - off for k, v in held.items() if v > off}
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["digest", "low"]
        )

    partial = digests.select("digest").mapInArrow(count, "digest binary, low bigint")
    return partial.groupBy("digest").agg(F.sum("low").alias("low"))


def _winner(rows: DataFrame) -> DataFrame:
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
    return rows.groupBy("digest").agg(F.count("*").alias("group_size"), first)


def decide(df: DataFrame, doc_id: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after each run of white space became one space; null
    counts as empty. The smallest id stays, a null id comes last; of repeated rows with one id,
    exactly one is kept. An empty table gives an empty result. Other columns of ``df`` are not
    looked at.
    """
    digests = written(digested(df, doc_id, text))
    total = digests.count()
    # At most counters + 1 digests can reach this count, as the counts add up to the rows at most.
    frequent = summaries(digests, counters).where(F.col("low") * (counters + 1) >= max(total, 1)).select("digest")
    names = [bytes(r["digest"]) for r in frequent.collect()]
    named = df.sparkSession.createDataFrame([(n,) for n in names], "digest binary")
    # The candidates are verified: exact counts and the row that stays, one partial per task.
    verified = _winner(digests.join(F.broadcast(named), "digest", "left_semi")) if names else None
    rest = digests.join(F.broadcast(named), "digest", "left_anti") if names else digests
    decided = rest.join(_winner(rest), "digest")
    if verified is not None:
        # Collected and made anew: a table of at most counters + 1 rows, whatever Spark estimates.
        rows = [tuple(r) for r in verified.collect()]
        winners = df.sparkSession.createDataFrame(rows, verified.schema)
        decided = decided.unionByName(digests.join(F.broadcast(winners), "digest"))
    return decided.select(
        F.col("id").alias("doc_id"),
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, whole. Of repeated rows with one id and text, one stays."""
    names = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    inner = df.toDF(*names.values())
    key, body = names[doc_id], names[text]
    stays = decide(inner, key, body).where("kept").select("doc_id", "text_sha256")
    normal = F.regexp_replace(F.coalesce(F.col(body), F.lit("")), SPACE, " ")
    keyed = inner.withColumns({"_sha": F.sha2(normal.cast("binary"), 256), "_id": F.coalesce(F.col(key).cast("string"), F.lit(""))})
    marks = stays.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.col("text_sha256").alias("_sha"))
    whole = keyed.join(marks, ["_sha", "_id"], "left_semi").dropDuplicates(["_sha", "_id"])
    return whole.select(*[F.col(v).alias(k) for k, v in names.items()])
