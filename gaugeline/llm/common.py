"""What several operators share: tables, written intermediates, texts as byte arrays."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.catalog import remove_folder
from ..session import configure, shared_root, unique

#: Space and the controls 9 to 13, the only characters that separate words here.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
_made: list[str] = []


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings of this folder: those of the library, and small Arrow batches, as a row is a
    whole text. Batches are held on both sides of the pipe."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, *by: str) -> DataFrame:
    """Write to the folder that all executors share, in folders ``by`` some columns, and read again.

    Cuts the lineage: what is read later survives the loss of any executor, and row numbers
    given before the write stay as they are.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{unique('llm_')}"
    _made.append(path)
    # A few folders are written side by side, without sorting rows by folder first.
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "8")
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession) -> None:
    """Remove what ``written`` has made in this session, once the results that rest on it are stored."""
    while _made:
        remove_folder(spark, _made.pop())


def remainder(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts, F.lit(-1))


def slices(batch: pa.RecordBatch, column: int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece has about ``limit`` bytes of text, one row at least.

    Bounds the scratch arrays of vectorised code whatever the batch size and text lengths are.
    """
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


_BREAK = re.compile(r"(?<=\S)(?=\s)")


def stretched(text: str, limit: int = 1 << 20) -> Iterator[str]:
    """A text in parts of at least ``limit`` characters, cut where white space follows another character.

    Splitting by ``public_tokenizers.PATTERN`` gives the same pieces for the parts as for the whole: none
    spans such a place, and none is chosen by what stands before it.
    """
    start = 0
    while len(text) - start > limit and (cut := _BREAK.search(text, start + limit)):
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in one array, and where each text starts (plus the end)."""
    texts = pc.fill_null(texts, "" if not pa.types.is_binary(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, everything else as it is."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


_FOLD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (multiply and xor-shift)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word, and the number of words before each text (plus the end)."""
    return placed_words(data, starts)[:2]


def placed_words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``words``, and where each word begins.

    Words are runs of bytes other than ``SPACE``, cut at the ends of texts. The hash sums the
    mixed (byte, place) pairs of a word, so it needs no loop over words.
    """
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = starts[:-1][starts[:-1] < starts[1:]]
    first[edges] = inside[edges]
    heads = np.flatnonzero(first)
    before = np.searchsorted(heads, starts)
    if not heads.size:
        return np.zeros(0, np.uint64), before, heads
    kept = np.flatnonzero(inside)
    which = np.cumsum(first, dtype=np.int64)[kept] - 1
    place = (kept - heads[which]).astype(np.uint64)
    code = mixed((place << np.uint64(8) | data[kept]) * _FOLD + _FOLD)
    runs = np.flatnonzero(first[kept])
    return mixed(np.add.reduceat(code, runs)), before, heads
