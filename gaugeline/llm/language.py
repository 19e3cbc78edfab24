"""Language identification with a bit-sliced Bloom filter over byte n-grams.

Every slot of the filter holds one bit per language. An n-gram sets its language's bit in all
of its slots; looking it up ANDs the slots, which returns all languages that hold the n-gram at
once. The hits of a text are counted per language, the false positives that the filling of each
language's slice predicts are taken off, and the language with most true hits wins.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flat, slices, written

#: Bytes of an n-gram.
GRAM = 4
UNDETERMINED = "und"
#: Parts of a corpus that is judged by its own labels: each is judged by what the others teach.
FOLDS = 4
#: A found language with this score, half as many hits again as the next one, outweighs a label.
CLEAR = 0.6
#: Slots of a filter for each gram of the language that has most; bytes of a filter at most.
ROOM, MODEL_BYTES = 64, 32 << 20
_BLOCK = 16
_PRIMES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _letters(texts: pa.Array) -> pa.Array:
    """Lower-cased letters, words two spaces apart."""
    return pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}]+", "  ")


def _folds(letters: pa.Array, folds: int) -> np.ndarray:
    """The fold of each text. It hangs on the letters alone, so copies share one."""
    if folds == 1:
        return np.zeros(len(letters), np.int32)
    return np.array([zlib.crc32(x.strip().encode()) % folds for x in letters.to_pylist()], np.int32)


def _grams(letters: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n-grams of what ``_letters`` gives; where each text starts; a mask that is false for those
    that run over the end of a text."""
    data, starts = flat(pc.binary_join_element_wise("  ", letters, "  ", ""))
    grams = np.zeros(data.size, np.uint32)
    for i in range(GRAM):
        grams <<= np.uint32(8)
        grams[: data.size - i] |= data[i:]
    whole = np.ones(data.size, bool)
    for i in range(1, GRAM):
        last = starts[1:] - i
        whole[last[last >= starts[:-1]]] = False
    return grams, starts, whole


def gram_counts(df: DataFrame, text: str = "text", lang: str = "lang", folds: int = 1) -> DataFrame:
    """(fold, lang, gram, n) over all whole texts with a language; counted per task before the shuffle."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, str], list] = {}

        def fold(parts: list) -> tuple[np.ndarray, np.ndarray]:
            keys = np.concatenate([p[0] for p in parts])
            grams, where = np.unique(keys, return_inverse=True)
            return grams, np.bincount(where, np.concatenate([p[1] for p in parts]), grams.size).astype(np.int64)

        for batch in batches:
            for name in pc.unique(batch.column(1)).to_pylist():
                own = batch.filter(pc.equal(batch.column(1), name))
                for piece in slices(own, 0):
                    letters = _letters(piece.column(0))
                    place = _folds(letters, folds)
                    for k in np.unique(place).tolist():
                        grams, _, whole = _grams(letters.filter(pa.array(place == k)))
                        parts = held.setdefault((k, name), [])
                        parts.append(np.unique(grams[whole], return_counts=True))
                        if len(parts) > 16:
                            held[k, name] = [fold(parts)]
        for (k, name), parts in held.items():
            grams, counts = fold(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * grams.size, pa.int32()), pa.array([name] * grams.size, pa.string()), pa.array(grams.astype(np.int64)), pa.array(counts)],
                ["fold", "lang", "gram", "n"],
            )

    taught = df.select(F.col(text).alias("_text"), F.col(lang).alias("_lang")).where("_lang is not null and _text is not null")
    counted = taught.mapInArrow(partial, "fold int, lang string, gram bigint, n bigint")
    return counted.groupBy("fold", "lang", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Filters:
    """Slots by languages, packed eight to a byte; the false-positive rate of each slice."""

    languages: tuple[str, ...]
    slots: np.ndarray
    wrong: np.ndarray
    fallback: str


def _slots_of(grams: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(grams.astype(np.uint64) * p) >> np.uint64(64 - bits) for p in _PRIMES]


def learn(
    df: DataFrame, text: str = "text", lang: str = "lang", share: float = 0.25, model_bytes: int = MODEL_BYTES
) -> Filters:
    """Build the filters from all rows with a text and a language.

    A gram goes to a language if its rate there is at least ``share`` of its highest rate in any
    language, so that foreign passages don't teach. All such grams are in the filter. It has ``ROOM``
    slots for each gram of the language that has most, and ``model_bytes`` at most (one byte a slot for
    each eight languages): a model that is then fuller than planned has more false positives, which
    are known from its filling and taken off. Bits are set in Spark; the driver gets the filled slots in
    blocks. No rows to learn from: no languages, and every prediction is ``und``.
    """
    return _filters(written(gram_counts(df, text, lang).drop("fold")), share, model_bytes)


def learn_apart(df: DataFrame, text: str = "text", lang: str = "lang", folds: int = FOLDS, **options) -> list[Filters]:
    """The filters for each fold, built as ``learn`` does from the texts of all other folds."""
    counts = written(gram_counts(df, text, lang, folds))
    others = [counts.where(F.col("fold") != k).groupBy("lang", "gram").agg(F.sum("n").alias("n")) for k in range(folds)]
    return [_filters(o, **options) for o in others]


def _filters(counts: DataFrame, share: float = 0.25, model_bytes: int = MODEL_BYTES) -> Filters:
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rate = counts.join(total, "lang").withColumn("rate", F.col("n") / F.col("total"))
    best = F.max("rate").over(Window.partitionBy("gram"))
    typical = rate.withColumn("best", best).where(F.col("rate") >= share * F.col("best"))
    typical = written(typical.select("lang", "gram", "total"))
    rows = typical.groupBy("lang").agg(F.count("gram").alias("grams"), F.max("total").alias("total")).collect()
    rows.sort(key=lambda r: r["lang"])
    if not rows:
        return Filters((), np.zeros((1 << _BLOCK, 1), np.uint8), np.zeros(0), UNDETERMINED)
    size = (len(rows) + 7) // 8
    wished = max(ROOM * max(r["grams"] for r in rows), 1 << _BLOCK)
    bits = max(_BLOCK, min((wished - 1).bit_length(), (model_bytes // size).bit_length() - 1))
    slots = _set_bits(typical, [r["lang"] for r in rows], bits, size)
    wrong = np.zeros(len(rows))
    for i in range(len(rows)):
        filled = np.count_nonzero(slots[:, i // 8] & (1 << i % 8)) / (1 << bits)
        wrong[i] = filled ** len(_PRIMES)
    fallback = max(rows, key=lambda r: r["total"])["lang"]
    return Filters(tuple(r["lang"] for r in rows), slots, wrong, fallback)


def _set_bits(typical: DataFrame, languages: list[str], bits: int, size: int) -> np.ndarray:
    """The slots: bits of a slot are joined before they meet, and a block of slots is one value."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which = np.asarray(pc.index_in(batch.column(0), value_set=pa.array(languages, pa.string())), np.int32)
            for at in _slots_of(np.asarray(batch.column(1)).astype(np.uint32), bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(which // 8), pa.array(at.astype(np.int64)), pa.array(np.int32(1) << which % 8)], ["byte", "slot", "mask"]
                )

    def block(rows: pa.Table) -> pa.Table:
        held = np.zeros(1 << _BLOCK, np.uint8)
        at = np.asarray(rows["slot"])
        held[at & ((1 << _BLOCK) - 1)] = np.asarray(rows["mask"]).astype(np.uint8)
        return pa.table({"byte": rows["byte"][:1], "block": pa.array([int(at[0]) >> _BLOCK], pa.int64()), "held": pa.array([held.tobytes()])})

    filled = typical.select("lang", "gram").mapInArrow(spread, "byte int, slot bigint, mask int")
    filled = filled.groupBy("byte", "slot").agg(F.bit_or("mask").alias("mask"))
    blocks = filled.groupBy("byte", F.shiftright("slot", _BLOCK)).applyInArrow(block, "byte int, block bigint, held binary")
    slots = np.zeros((1 << bits, size), np.uint8)
    for row in blocks.collect():
        slots[row["block"] << _BLOCK : (row["block"] + 1) << _BLOCK, row["byte"]] = np.frombuffer(row["held"], np.uint8)
    return slots


def judge(texts: pa.Array, model: Filters, letters: pa.Array | None = None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and coverage of each text.

    Score: share of the winner in the corrected hits of the best two. Coverage: corrected hits
    of the winner a gram. ``letters`` of the texts may be given, if already known.
    """
    known = len(model.languages)
    some = np.asarray(pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False))
    if not known or not len(texts):
        return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    grams, starts, whole = _grams(_letters(texts) if letters is None else letters)
    bits = int(model.slots.shape[0]).bit_length() - 1
    first, second = _slots_of(grams, bits)
    n = np.add.reduceat(whole, starts[:-1], dtype=np.int64).astype(float)  # padding: no text is empty
    hits = np.empty((len(texts), known))
    for byte in range(model.slots.shape[1]):
        column = np.ascontiguousarray(model.slots[:, byte])
        mask = (column[first] & column[second]) * whole.astype(np.uint8)
        for i in range(8 * byte, min(known, 8 * byte + 8)):
            hits[:, i] = np.add.reduceat((mask >> np.uint8(i % 8)) & np.uint8(1), starts[:-1], dtype=np.int64)
    true = np.maximum(0, (hits - n[:, None] * model.wrong) / (1 - model.wrong))
    best = true.argmax(1)
    most = true.max(1)
    rest = true.copy()
    rest[np.arange(len(texts)), best] = -1
    second_most = np.maximum(rest.max(1), 0)
    score = np.where(most > 0, most / np.maximum(most + second_most, 1e-300), 0.0)
    names = [
        UNDETERMINED if not ok else model.languages[b] if m > 0 else model.fallback
        for ok, b, m in zip(some, best, most)
    ]
    covered = np.where(some, most / np.maximum(n, 1), 0.0)
    return names, np.where(some, np.clip(score, 0, 1), 0.0), np.clip(covered, 0, 1)


def identify(df: DataFrame, model: Filters | list[Filters], text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred``, ``lang_score`` and ``lang_coverage`` after its own columns.

    A null text, or one without a letter, is ``und`` with score and coverage 0. A text whose
    grams no filter holds gets the language with most taught text, score 0. Ties go to the
    first language by code point. Columns of those names are replaced. Rows stay where they are.
    A list of filters, from ``learn_apart``, judges each text by those of its fold. Filters are
    broadcast; ``model_bytes`` bounds each.
    """
    models = [model] if isinstance(model, Filters) else model
    added = [("lang_pred", T.StringType()), ("lang_score", T.DoubleType()), ("lang_coverage", T.DoubleType())]
    kept = df.drop(*[name for name, _ in added])
    at = kept.columns.index(text)
    schema = T.StructType([*kept.schema.fields, *[T.StructField(n, t) for n, t in added]])
    sent = df.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for batch in batches:
            for piece in slices(batch, at):
                letters = _letters(piece.column(at))
                place = _folds(letters, len(held))
                for k in np.unique(place).tolist():
                    here = pa.array(place == k)
                    own = piece.filter(here) if len(held) > 1 else piece
                    names, score, covered = judge(own.column(at), held[k], letters.filter(here))
                    yield pa.RecordBatch.from_arrays(
                        [*own.columns, pa.array(names, pa.string()), pa.array(score), pa.array(covered)], schema.names
                    )

    return kept.mapInArrow(run, schema)


def keep_identified(df: DataFrame, min_coverage: float = 0.3, text: str = "text", lang: str = "lang") -> DataFrame:
    """Rows with a language; learns from the labelled rows of ``df`` itself.

    Each text is judged by what the labelled texts of the other folds teach, so neither it nor a
    copy of it (the same letters) vouches for itself; a language needs texts in two folds to be known.
    Goes: a text without a letter, or with less than ``min_coverage`` of its grams typical of
    the language found. The found language fills in a missing one, and replaces one that it clearly
    contradicts (``CLEAR``). Where the other folds have no label at all, texts with a letter stay as they are.
    """
    names = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    inner = df.toDF(*names.values())
    models = learn_apart(inner, names[text], names[lang])
    named = identify(inner, models, names[text])
    found = F.col("lang_pred") != UNDETERMINED
    # No language though there are letters: the other folds had nothing to teach.
    good = named.where(F.when(found, F.col("lang_coverage") >= min_coverage).otherwise(F.col(names[text]).rlike(r"\p{L}")))
    clear = found & (F.col(names[lang]).isNull() | (F.col("lang_score") >= CLEAR))
    good = good.withColumn(names[lang], F.when(clear, F.col("lang_pred")).otherwise(F.col(names[lang])))
    return good.select(*[F.col(v).alias(k) for k, v in names.items()])
