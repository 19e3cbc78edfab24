"""Document fingerprints that can be subtracted: invertible Bloom lookup sketches of paragraphs.

Each paragraph's digest goes to one cell in each of three parts of a sketch; a cell holds the
number, the exclusive or, and a check of its digests. In the difference of two sketches common
digests are gone. A cell with one digest left gives it away; taken out of its other cells, more
follow, until all that differ are recovered. If that ends early, both texts are sketched larger.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from .common import flat, mixed, placed_words, slices, written

#: Cells of a fingerprint, a third in each part; a line is cut after one of so many words, on average,
#: and after so many at the latest.
CELLS, WORDS, MOST = 24, 8, 32
#: The order of documents is cut into ranges, one task each: of about so many rows while there are fewer
#: ranges than shuffle partitions, of at most about so many bytes of text however many that makes.
ROWS, RANGE = 1000, 256 << 20
_PARTS = 3

_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
#: Rows of a range, and (``side`` given) its first and last text.
_MADE = pa.schema([*_RESULT, ("part", pa.int64()), ("side", pa.string()), ("packed", pa.binary())])


def paragraphs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit digests of the paragraphs of all texts, and where each text's begin (plus the end).

    A paragraph is a stretch of a line that ends after a word whose hash is a multiple of ``WORDS``,
    after ``MOST`` words, or with the line. So the words themselves say where, and the cuts meet again
    after a word that was put in. White space inside does not count, lines without words are none.
    The second of two equal paragraphs has another digest.
    """
    data, starts = flat(pa.array(texts, pa.large_string()))
    hashes, before, heads = placed_words(data, starts)
    if not hashes.size:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    line = np.cumsum(data == 10)[heads]
    text = np.repeat(np.arange(len(texts)), np.diff(before))
    new = np.ones(hashes.size, bool)
    new[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
    new[1:] |= hashes[:-1] % np.uint64(WORDS) == 0
    at = np.arange(hashes.size)
    since = (at - np.maximum.accumulate(np.where(new, at, 0))) % MOST
    begin = np.flatnonzero(since == 0)
    digests = mixed(np.add.reduceat(mixed(hashes + since.astype(np.uint64)), begin))
    owner = text[begin]
    order = np.lexsort((digests, owner))
    same = np.zeros(order.size, bool)
    same[1:] = (digests[order][1:] == digests[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    run = np.arange(order.size)
    run -= np.maximum.accumulate(np.where(same, 0, run))
    digests[order] = np.where(run > 0, mixed(digests[order] + run.astype(np.uint64)), digests[order])
    return digests, np.searchsorted(owner, np.arange(len(texts) + 1))


def _cells(digests: np.ndarray, size: int) -> np.ndarray:
    """The cell of each digest in each part, one row a part; other cells at other sizes."""
    part = size // _PARTS
    seeds = mixed(np.arange(1, _PARTS + 1, dtype=np.uint64) + np.uint64(size << 8))
    spread = mixed(digests[None, :] ^ seeds[:, None])
    return ((spread >> np.uint64(32)) * np.uint64(part) >> np.uint64(32)).astype(np.int64) + (np.arange(_PARTS) * part)[:, None]


def _check(digests: np.ndarray) -> np.ndarray:
    return mixed(digests ^ np.uint64(0xA5A5A5A5A5A5A5A5)) & np.uint64(0xFFFFFFFF)


def sketch(digests: np.ndarray, owner: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, digests and checks of the cells of ``n`` sketches; ``owner``: whose each digest is."""
    at = (owner[None, :] * size + _cells(digests, size)).ravel()
    number = np.bincount(at, minlength=n * size).astype(np.int64)
    key, check = np.zeros(n * size, np.uint64), np.zeros(n * size, np.uint64)
    np.bitwise_xor.at(key, at, np.tile(digests, _PARTS))
    np.bitwise_xor.at(check, at, np.tile(_check(digests), _PARTS))
    return number, key, check


def peel(number: np.ndarray, key: np.ndarray, check: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ``n`` differences of sketches: whether all came out, and how many digests only the first
    and only the second text had. The cells are used up."""
    first, second = np.zeros(n, np.int64), np.zeros(n, np.int64)
    look = np.arange(n * size)
    while True:
        look = look[np.abs(number[look]) == 1]
        pure = look[_check(key[look]) == check[look]]
        if not pure.size:
            break
        found = np.unique(np.rec.fromarrays([pure // size, key[pure], number[pure]], names="owner,key,sign"))
        owner, digests, sign = found["owner"], found["key"], found["sign"]
        first += np.bincount(owner[sign > 0], minlength=n)
        second += np.bincount(owner[sign < 0], minlength=n)
        at = (owner[None, :] * size + _cells(digests, size)).ravel()
        np.subtract.at(number, at, np.tile(sign, _PARTS))
        np.bitwise_xor.at(key, at, np.tile(digests, _PARTS))
        np.bitwise_xor.at(check, at, np.tile(_check(digests), _PARTS))
        look = np.unique(at)
    left = (number != 0) | (key != 0) | (check != 0)
    return ~left.reshape(n, size).any(1), first, second


def likeness(digests: np.ndarray, starts: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common part of the paragraphs of each pair of texts, 0 to 1, by subtraction and peeling.

    Two texts without paragraphs are alike. A pair that doesn't come out, or whose numbers of
    paragraphs differ by more than a sketch can hold, is sketched with twice the cells.
    """
    sizes = np.diff(starts)
    out = np.ones(left.size)
    pending = np.flatnonzero(sizes[left] + sizes[right] > 0)
    size = CELLS

    def gather(texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = sizes[texts]
        owner = np.repeat(np.arange(texts.size), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[texts], n)
        return digests[at], owner

    while pending.size:
        now = pending[np.abs(sizes[left[pending]] - sizes[right[pending]]) <= size]
        if now.size:
            a = sketch(*gather(left[now]), now.size, size)
            b = sketch(*gather(right[now]), now.size, size)
            good, first, second = peel(a[0] - b[0], a[1] ^ b[1], a[2] ^ b[2], now.size, size)
            good &= (first <= sizes[left[now]]) & (sizes[left[now]] - first == sizes[right[now]] - second)
            common = sizes[left[now]] - first
            out[now[good]] = (common / np.maximum(common + first + second, 1))[good]
            pending = np.setdiff1d(pending, now[good], assume_unique=True)
        size *= 2
    return out


def _written(number: np.ndarray, key: np.ndarray, check: np.ndarray, n: int, sizes: np.ndarray) -> list[str]:
    """Sketches of ``CELLS`` cells as text: number of paragraphs, then the cells, in base 64."""
    cells = np.zeros((n, CELLS), np.dtype([("number", "<i4"), ("key", "<u8"), ("check", "<u4")]))
    cells["number"], cells["key"], cells["check"] = (x.reshape(n, CELLS) for x in (number, key, check))
    return [base64.b64encode(int(s).to_bytes(8, "little") + c.tobytes()).decode() for s, c in zip(sizes, cells)]


def fingerprints(digests: np.ndarray, starts: np.ndarray) -> list[str]:
    n = starts.size - 1
    owner = np.repeat(np.arange(n), np.diff(starts))
    return _written(*sketch(digests, owner, n, CELLS), n, np.diff(starts))


def _compared(ids: list, texts: list[str]) -> dict[str, list]:
    """Rows for all texts but the last, each compared with its edited text and the one after it."""
    own, n = texts[:-1], len(texts) - 1
    cuts = [len(t) // 3 for t in own]
    edited = [t[: len(t) - k] + following[:k] for t, following, k in zip(own, texts[1:], cuts)]
    digests, starts = paragraphs([*texts, *edited])
    marks = fingerprints(digests, starts)
    at = np.arange(n)
    return {
        "doc_id": ids[:n], "n_chars": [len(t) for t in own],
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
        "fingerprint": marks[:n], "edited_fingerprint": marks[n + 1 :],
        "near_edited": likeness(digests, starts, at, at + n + 1), "near_next": likeness(digests, starts, at, at + 1),
    }


def compare(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text of a document is its own with the last third of its code points (rounded down)
    replaced by the first as many, or all, of the next document: by descending integral id, a null id
    last; rows with one id by their texts; after the last comes the first. Null counts as empty. Equal texts
    have equal fingerprints. A single row is next to itself; an empty table gives no rows.

    Rows are ranged by id, text and place, so that a null id, one id or one text may have any share of them.
    Neighbours in a range are compared where they meet; the last row of a range meets the first of the
    next one in a join, so text is shuffled once, and two texts a range once more.
    """
    slim = df.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows, size = slim.select(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n = max(1, min(rows // ROWS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), size // RANGE)
    made = written(_ranged(slim, n).mapInArrow(_neighbours, from_arrow_schema(_MADE)))
    ends = made.where("side is not null").select("part", "side", "doc_id", "packed")
    first, last = ends.where("side = 'first'"), ends.where("side = 'last'")
    # One number a range.
    follows = first.select("part", F.lead("part").over(Window.orderBy("part")).alias("next"), F.min("part").over(Window.partitionBy()).alias("top"))
    follows = follows.select("part", F.coalesce("next", "top").alias("next"))
    met = last.join(follows, "part").join(first.select(F.col("part").alias("next"), F.col("packed").alias("following")), "next")
    across = met.select("doc_id", "packed", "following").mapInArrow(_across, from_arrow_schema(_RESULT))
    return made.where("side is null").select(*_RESULT.names).unionByName(across)


def _ranged(slim: DataFrame, n: int) -> DataFrame:
    """part, id, packed (the compressed text) in the order of documents, in ``n`` ranges."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for piece in slices(batch, 1):
                raw = [t.encode() for t in piece.column(1).to_pylist()]
                ties = [hashlib.blake2b(t, digest_size=8).digest() for t in raw]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(ties, pa.binary()), pa.array([press.compress(t) for t in raw], pa.binary())], ["id", "tie", "packed"])

    order = [F.col("id").desc_nulls_last(), F.col("tie"), F.col("place")]
    packed = slim.mapInArrow(pack, "id bigint, tie binary, packed binary").withColumn("place", F.monotonically_increasing_id())
    ranged = packed.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id().cast("long"))
    return ranged.sortWithinPartitions(*order).select("part", "id", "packed")


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows for all documents of a range but the last, then its first and last text."""
    unpack = zstandard.ZstdDecompressor()
    ids, texts, size = [], [], 0
    first = last = None
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in range(3)]):
            first, last = first or row, row
            ids.append(row[1])
            texts.append(unpack.decompress(row[2]).decode())
            size += len(texts[-1]) + 64
            if len(texts) > 1 and size > 1 << 20:
                yield _rows(_compared(ids, texts), _MADE)
                ids, texts, size = ids[-1:], texts[-1:], len(texts[-1]) + 64
    if len(texts) > 1:
        yield _rows(_compared(ids, texts), _MADE)
    if first:
        ends = {"doc_id": [first[1], last[1]], "part": [first[0]] * 2, "side": ["first", "last"], "packed": [first[2], last[2]]}
        yield _rows(ends, _MADE)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The row of a range's last document, which the next range's first one follows."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for own, *packed in zip(*[batch.column(c).to_pylist() for c in range(3)]):
            yield _rows(_compared([own], [unpack.decompress(t).decode() for t in packed]), _RESULT)


def _rows(columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    """A batch of the schema; a column not given is null."""
    n = len(columns["doc_id"])
    return pa.RecordBatch.from_arrays([pa.array(columns.get(f.name, [None] * n), f.type) for f in schema], schema=schema)
