"""Documents packed into sequences of a fixed length, online and in bounded space.

Each task reads its documents once. What fills a sequence by itself leaves at once; the rest of a
document goes to that open window which it fills best. If none has room, the fullest one is filled
up with the beginning of the rest and emitted. A task's open windows are merged when its documents
end; less than one sequence is then left of a task, and the leftovers of neighbouring tasks are
merged in a second step of bounded groups.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, stretched, written

LENGTH, WINDOWS = 1024, 128
#: Tasks whose leftovers are merged together: at most so many times one sequence.
TASKS = 256
VOCABULARY = "byte_bpe_50k.json"
#: Bytes of text that the tokenizer gets at once, where the text has a place to cut.
STRETCH = 1 << 20


def _byte_of_sign() -> dict[str, int]:
    """The signs that a byte-level vocabulary writes for bytes: printable ones stand for themselves,
    the others are numbered from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def tokenizer(vocabulary: str) -> Callable[[str], list[int]]:
    """Ids of a text by a byte-level vocabulary file; strings of special tokens are ordinary text.

    The file's merges are in the order of their ids, so its ids serve as ranks.
    """
    told = json.loads(vocabulary)
    special = {t["content"] for t in told["added_tokens"]}
    sign = _byte_of_sign()
    ranks = {bytes(sign[c] for c in token): i for token, i in told["model"]["vocab"].items() if token not in special}
    coder = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return coder.encode_ordinary


def ids_of(text: str, encode: Callable[[str], list[int]], end: int, stretch: int = STRETCH) -> np.ndarray:
    """Ids of the whole text, then ``end``.

    A long text is given to the tokenizer in stretches.
    """
    parts = [np.array(encode(part), "<u4") for part in stretched(text, stretch)]
    return np.concatenate([*parts, np.array([end], "<u4")])


class Packer:
    """Windows of ``length`` ids. Pieces are (document, start, ids); a document is whatever the
    caller names it by. ``emit`` gets the pieces of each sequence that is done."""

    def __init__(self, emit: Callable[[list], None], length: int = LENGTH, windows: int = WINDOWS):
        self.emit, self.length, self.windows = emit, length, windows
        self.open: list[list] = []
        self.room: list[int] = []

    def add(self, document: object, ids: np.ndarray) -> None:
        whole = ids.size - ids.size % self.length
        for start in range(0, whole, self.length):
            self.emit([(document, start, ids[start : start + self.length])])
        if whole < ids.size:
            self._place(document, whole, ids[whole:])

    def _place(self, document: object, start: int, rest: np.ndarray) -> None:
        fits = [r - rest.size for r in self.room]
        best = min((f for f in fits if f >= 0), default=None)
        if best is not None:
            at = fits.index(best)
            self.open[at].append((document, start, rest))
            self.room[at] = best
            if not best:
                self._emit(at)
        elif len(self.open) < self.windows:
            self.open.append([(document, start, rest)])
            self.room.append(self.length - rest.size)
        else:
            at = self.room.index(min(self.room))
            cut = self.room[at]
            self.open[at].append((document, start, rest[:cut]))
            self._emit(at)
            self._place(document, start + cut, rest[cut:])

    def _emit(self, at: int) -> None:
        self.emit(self.open.pop(at))
        self.room.pop(at)

    def close(self) -> list:
        """Merge the open windows, fullest first; returns the pieces left, less than one sequence."""
        order = sorted(range(len(self.open)), key=self.room.__getitem__)
        pieces = [piece for at in order for piece in self.open[at]]
        self.open, self.room = [], []
        return fill(pieces, self.length, self.emit)


def fill(pieces: list, length: int, emit: Callable[[list], None]) -> list:
    """Sequences of ``length`` ids from ``pieces`` in their order, cut where needed; returns the
    pieces left, fewer than ``length`` ids."""
    held, room = [], length
    for document, start, ids in pieces:
        while ids.size >= room:
            held.append((document, start, ids[:room]))
            emit(held)
            start, ids = start + room, ids[room:]
            held, room = [], length
        if ids.size:
            held.append((document, start, ids))
            room -= ids.size
    return held


def split_at_powers(pieces: list, length: int, emit: Callable[[list], None]) -> None:
    """Sequences from what is left in the end, each as long as a power of two, so none is padded."""
    left = sum(ids.size for _, _, ids in pieces)
    power = length
    while left:
        if left >= power:
            sizes: list[int] = []
            pieces = fill(pieces, power, lambda done: (sizes.append(power), emit(done)))
            left -= sum(sizes)
        power //= 2


def _schema(kind: T.DataType) -> T.StructType:
    long = T.LongType()
    return T.StructType([
        T.StructField("doc_id", kind), T.StructField("start", long), T.StructField("length", long), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", long), T.StructField("sequence_id", long), T.StructField("offset", long),
    ])


class _Rows:
    """Pieces of sequences as Arrow batches. A document is named by (id, tokens)."""

    def __init__(self, schema: pa.Schema, first: int):
        self.schema, self.next = schema, first
        self.rows: list[tuple] = []
        self.size = 0

    def sequence(self, pieces: list, number: int | None = -1) -> None:
        """One sequence; number None: pieces that still belong to none."""
        if number == -1:
            number, self.next = self.next, self.next + 1
        offset = 0
        for (name, tokens), start, ids in pieces:
            self.rows.append((name, start, ids.size, ids.tobytes(), tokens, number, offset))
            offset += ids.size
        self.size += offset

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else [[]] * len(self.schema)
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)
        self.rows, self.size = [], 0
        return out


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def pack(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
    length: int = LENGTH, windows: int = WINDOWS, end: int = 0,
) -> DataFrame:
    """Pieces of documents in sequences: doc_id, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset.

    A document is the ids of its whole text and then the id ``end``; null text counts as empty, so
    it is ``end`` alone. Every id lies in exactly one piece: ``start`` of its ``doc_tokens`` ids come
    before it, and the pieces of a sequence follow each other without a gap from ``offset`` 0. All
    sequences have ``length`` ids but the last ones of a group of tasks, which have a power of two
    each: with a power of two as ``length``, none needs padding. Each row is a document of its own,
    also one with a null or a repeated id. Other columns are not looked at. No rows give no rows.
    """
    data = open(vocabulary or public_tokenizers.path(VOCABULARY), encoding="utf-8").read()
    slim = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = _schema(slim.schema["doc_id"].dataType)
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = tokenizer(data)
        out = _Rows(arrow, TaskContext.get().partitionId() << 40)
        first = out.next
        packer = Packer(out.sequence, length, windows)
        for batch in batches:
            for piece in slices(batch, 1):
                for name, body in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    ids = ids_of(body, encode, end)
                    packer.add((name, ids.size), ids)
                if out.size > 1 << 18:
                    yield out.batch()
        left = packer.close()
        yield out.batch()
        out.sequence(left, None)
        # Of pieces without a sequence, the offset carries the task.
        out.rows = [(*row[:6], first >> 40) for row in out.rows]
        yield out.batch()

    pieces = written(slim.mapInArrow(run, schema))

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        rows = sorted(group.select(["offset", "start", "doc_id", "doc_tokens", "ids"]).to_pylist(), key=lambda r: r["offset"])
        out = _Rows(arrow, 1 << 62 | key[0].as_py() << 20)
        held = [((r["doc_id"], r["doc_tokens"]), r["start"], np.frombuffer(r["ids"], "<u4")) for r in rows]
        split_at_powers(fill(held, length, out.sequence), 1 << length.bit_length() - 1, out.sequence)
        return pa.Table.from_batches([out.batch()])

    left = pieces.where("sequence_id IS NULL").groupBy(F.expr(f"offset DIV {TASKS}"))
    return pieces.where("sequence_id IS NOT NULL").unionByName(left.applyInArrow(merge, schema))
