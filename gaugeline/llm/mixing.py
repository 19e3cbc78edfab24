"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks of words.

A source's documents are dealt to shards; a shard's words, one document after the other, are cut
into blocks of equal size. Blocks are seats: sources get them by highest quotients of their
targets, shards by highest quotients of their sizes. Which blocks of a shard are taken, or taken
once more than the others, follows from a seed: scattered ones, or a run of neighbours, which
leaves whole all documents but those at its two ends.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, written

#: Words of a block, and about those of a shard.
BLOCK, SHARD = 16, 2_000_000
#: Multipliers of the order in which blocks are taken: primes above any number of blocks in a shard
#: of ordinary size, so that a multiple modulo that number runs through all blocks.
_PRIMES = (1_000_000_007, 1_000_000_009, 1_000_000_021, 1_000_000_033)


def _hash(*parts: Column) -> Column:
    """32 bits of the md5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts).cast("binary")), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, limit: float) -> DataFrame:
    """key, source_size, target, place of each source; ``sizes`` has one row per source.

    Sources by code point, null last, weigh ``weights``, repeating. Together they get ``share`` of
    all words in proportion to their weights, each at most ``limit`` times its size, the excess
    going to the others in the same proportion. That is a common level, limit or weight * level
    whichever is less; it is found by passing the sources in the order in which they reach their limits.
    """
    placed = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1)
    weighed = placed.withColumn("weight", weight).withColumn("most", limit * F.col("source_size"))
    reach = Window.orderBy(F.col("most") / F.col("weight"), "place")
    full = F.coalesce(F.sum("most").over(reach.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    others = F.sum("weight").over(reach.rowsBetween(0, Window.unboundedFollowing))
    everything = share * F.sum("source_size").over(Window.partitionBy())
    passed = weighed.withColumn("level", (everything - full) / others)
    open_ = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))
    # Past the source at which the level fits, levels only fall: they count full what isn't.
    level = F.max(open_).over(Window.partitionBy())
    target = F.least("most", F.coalesce(level * F.col("weight"), F.col("most")))
    return passed.withColumn("target", target).select("key", "source_size", "target", "place")


def apportion(cells: DataFrame, group: list[str], claim: str, seats: str, tie: list[str]) -> DataFrame:
    """``cells`` with ``quota``: the ``seats`` of each group go, one by one, to the cell with the
    highest ``claim`` / (2 * quota + 1), ties in the order of ``tie``.

    A cell's seats differ from its rounded share by no more than its part of half the number of
    cells, plus one. So only the quotients that near are ranked, five a cell on average.
    """
    among = Window.partitionBy(*group)
    all_claims = F.sum(claim).over(among)
    part = F.when(all_claims > 0, F.col(claim) / all_claims).otherwise(0.0)
    near = cells.withColumns({"_part": part, "_cells": F.count("*").over(among)}).withColumns({
        "_fair": F.floor(F.col("_part") * F.col(seats) + 0.5),
        "_wide": F.ceil(F.col("_part") * F.col("_cells") / 2) + 1,
    })
    sure = near.withColumn("_sure", F.greatest(F.lit(0), F.col("_fair") - F.col("_wide")))
    sure = sure.withColumn("_open", F.col(seats) - F.sum("_sure").over(among))
    asked = F.when(F.col(claim) > 0, F.sequence("_sure", F.col("_fair") + F.col("_wide") - 1)).otherwise(F.array(F.lit(None).cast("long")))
    rows = sure.withColumn("_k", F.explode(asked))
    quotient = F.col(claim) / (2 * F.col("_k") + 1)
    rank = F.row_number().over(among.orderBy(F.col("_k").isNull(), quotient.desc(), *tie, "_k"))
    won = rows.withColumn("_won", (rank <= F.col("_open")) & F.col("_k").isNotNull())
    return won.groupBy(*cells.columns).agg((F.max("_sure") + F.count_if("_won")).alias("quota"))


def spans(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    limit: int = 2,
    seed: int = 17,
    row: str | None = None,
    run: bool = False,
) -> DataFrame:
    """id, row, size, source_size, target and spans (array of from, words, times) of each row.

    ``row`` is the column of that name, else a number given here. ``spans`` lists the parts of a document, from its first word (1) on, and how often the mix takes each: 0 to ``limit``.
    A text without words has no spans. Null text counts as empty, null source is a source of its
    own; repeated rows are dealt each. Same rows, same seed: same spans. With ``run``, the blocks
    of a shard that are taken once more than the others are neighbours, from a seeded one on.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    sized = written(df.select(
        F.col(doc_id).alias("id"), number.alias("row"), F.col(source).alias("source"),
        F.coalesce(F.concat(F.lit("s"), source), F.lit("n")).alias("key"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        _hash(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).alias("draw"),
    ))
    per_source = sized.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    known = targets(per_source, weights, share, float(limit))
    known = known.withColumn("seats", F.floor(F.sum("target").over(Window.partitionBy()) / BLOCK + 0.5)).withColumn("_all", F.lit(1))
    won = apportion(known, ["_all"], "target", "seats", ["place"]).withColumnRenamed("quota", "source_seats")
    of_source = written(won.select(
        "key", "source_size", "target", "source_seats",
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD)).alias("shards"),
    ))
    dealt = sized.join(of_source, "key").withColumn("shard", F.pmod("draw", "shards"))
    cells = dealt.groupBy("key", "shard", "source_seats").agg(F.sum("size").alias("words"))
    quotas = apportion(cells, ["key"], "words", "source_seats", ["shard"]).select("key", "shard", "words", "quota")
    along = Window.partitionBy("key", "shard").orderBy("draw", "id", "row")
    placed = dealt.withColumn("end", F.sum("size").over(along)).join(quotas, ["key", "shard"])
    blocks = F.ceil(F.col("words") / BLOCK)
    held = placed.withColumns({"start": F.col("end") - F.col("size"), "blocks": blocks}).withColumns({
        "each": F.least(F.expr("quota div greatest(blocks, 1)"), F.lit(limit)),
        "more": F.when(F.col("quota") >= limit * F.col("blocks"), F.lit(0)).otherwise(F.col("quota") % F.greatest("blocks", F.lit(1))),
        "turn": _hash(F.lit(seed), F.lit("order"), F.col("key"), F.col("shard")),
    }).withColumn("step", F.element_at(F.array(*[F.lit(p) for p in _PRIMES]), (F.col("turn") % len(_PRIMES) + 1).cast("int")))

    def part(b: Column) -> Column:
        first = F.greatest(b * BLOCK, F.col("start"))
        last = F.least((b + 1) * BLOCK, F.col("end"))
        chosen = (b * (F.col("step") % F.col("blocks")) + F.col("turn")) % F.col("blocks") < F.col("more")
        return F.struct(
            (first - F.col("start") + 1).alias("from"), (last - first).alias("words"),
            (F.col("each") + F.when(chosen, 1).otherwise(0)).alias("times"),
        )

    touched = F.sequence(F.expr(f"start div {BLOCK}"), F.expr(f"(end - 1) div {BLOCK}"))
    none = F.array().cast("array<struct<from:bigint,words:bigint,times:bigint>>")
    if run:
        lead = F.pmod("turn", F.col("blocks") - F.col("more") + 1) * BLOCK
        left = F.greatest(F.col("start"), F.least(F.col("end"), lead))
        right = F.greatest(left, F.least(F.col("end"), lead + F.col("more") * BLOCK))
        stretches = [(F.col("start"), left, 0), (left, right, 1), (right, F.col("end"), 0)]
        listed = F.array(*[
            F.struct((a - F.col("start") + 1).alias("from"), (b - a).alias("words"), (F.col("each") + extra).alias("times"))
            for a, b, extra in stretches
        ])
        touching = F.filter(listed, lambda s: s["words"] > 0)
    else:
        touching = F.transform(touched, part)
    parts = F.when(F.col("size") > 0, touching).otherwise(none)
    return held.select("id", "row", "size", "source_size", "target", parts.alias("spans"))


def _words(spans_: Column) -> Column:
    return F.aggregate(spans_, F.lit(0).cast("long"), lambda n, s: n + s["words"] * s["times"])


def mix(df: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken of each row; see ``spans``."""
    return spans(df, **options).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", _words(F.col("spans")).alias("taken")
    )


def mixed_rows(df: DataFrame, doc_id: str = "doc_id", text: str = "text", chars: str = "n_chars", **options) -> DataFrame:
    """The mix as rows with the columns of ``df``: copy k of a document, with the words that are
    taken k times or more.

    Blocks are taken as runs (see ``spans``). A copy that has all words is the text as it is; one
    at an end of its shard's run is one stretch of the text with its white space, and ``chars``
    counts its code points. A document of which nothing is taken goes, as does one without words.
    """
    names = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    rows = written(df.toDF(*names.values()).withColumn("row", F.monotonically_increasing_id()))
    chosen = spans(rows, names[doc_id], names[text], names[options.pop("source", "source")], row="row", run=True, **options)
    most = F.array_max(F.col("spans.times"))
    copies = chosen.where(F.size("spans") > 0).where(most > 0).select("row", "spans", F.explode(F.sequence(F.lit(1).cast("long"), most)).alias("copy"))
    whole = rows.join(copies, "row").drop("row")
    kept = df.schema.fields
    schema = T.StructType([T.StructField(names[f.name], f.dataType, f.nullable) for f in kept])
    at, spans_at, copy_at = whole.columns.index(names[text]), whole.columns.index("spans"), whole.columns.index("copy")
    chars_at = whole.columns.index(names[chars]) if chars in names else None
    order = [whole.columns.index(c) for c in schema.names]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(WORD).finditer
        for batch in batches:
            parts = batch.column(spans_at)
            ends = np.asarray(parts.offsets)
            first, words, times = (np.asarray(parts.values.field(i)) for i in range(3))
            copy = np.asarray(batch.column(copy_at))
            texts = batch.column(at).to_pylist()
            for i in range(batch.num_rows):
                own = slice(ends[i], ends[i + 1])
                taken = times[own] >= copy[i]
                if not taken.all():
                    places = [m.span() for m in find(texts[i])]
                    begin, stop = first[own][taken][0] - 1, (first[own][taken] + words[own][taken])[-1] - 1
                    texts[i] = texts[i][places[begin][0] if begin else 0 : places[stop - 1][1] if stop < len(places) else None]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, columns[at].type)
            if chars_at is not None:
                columns[chars_at] = pa.array([len(t) for t in texts], columns[chars_at].type)
            yield pa.RecordBatch.from_arrays([columns[i] for i in order], schema.names)

    return whole.mapInArrow(cut, schema).toDF(*names)
