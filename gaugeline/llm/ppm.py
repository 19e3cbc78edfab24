"""Language-model scoring by prediction by partial matching over bytes.

The trie holds, for each context of up to ``ORDER`` bytes, how often each byte followed it in the
training texts. A byte is coded in the longest context seen; if it never followed there, an
escape is coded (method D: each follower's first occurrence counts half for it and half for the
escape) and the next shorter context is tried, without the bytes that the longer one had excluded. As the training counts are
fixed, the cost of a byte depends on its ``ORDER`` predecessors only, so the work is done once for
each distinct window of ``ORDER`` + 1 symbols and not for each byte.

Texts are packed into blocks, each of which asks for its distinct windows and words only. Keys are
spread over buckets by hash; a bucket adds up what the blocks report and answers them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flat, lower_ascii, mixed, slices, words, written

ORDER = 5
#: Bytes, and one symbol before the first and after the last byte of a text.
SYMBOLS, EDGE = 257, 256
_BITS = 9
#: Stands for the token at the end of a text among the word hashes.
_END_WORD = np.uint64(0x9E3779B97F4A7C15)
#: Text bytes of a block, and of texts for which there is a bucket.
BLOCK, BUCKET = 16 << 20, 32 << 20
#: Texts are taken in pieces of about so many bytes, which bounds the scratch arrays.
_PIECE = 2 << 20


def _squeeze(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(array.tobytes())


def _expand(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _keys_out(keys: np.ndarray) -> bytes:
    return _squeeze(np.diff(keys, prepend=np.uint64(0)))


def _keys_in(data: bytes) -> np.ndarray:
    return np.cumsum(_expand(data, np.uint64), dtype=np.uint64)


def windows(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The window that ends at each byte and at the end of each text; where each text's begin."""
    sizes = np.diff(starts)
    first = starts[:-1] + (ORDER + 1) * np.arange(sizes.size) + ORDER
    symbols = np.full(data.size + (ORDER + 1) * sizes.size, EDGE, np.uint16)
    own = np.arange(data.size) + np.repeat(first - starts[:-1], sizes)
    symbols[own] = data
    packed = np.zeros(symbols.size - ORDER, np.uint64)
    for i in range(ORDER + 1):
        packed <<= np.uint64(_BITS)
        packed |= symbols[i : symbols.size - ORDER + i]
    ends = np.zeros(symbols.size, bool)
    ends[own] = True
    ends[first + sizes] = True
    return packed[ends[ORDER:]], starts[:-1] + np.arange(sizes.size)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([p[0] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    counts = np.concatenate([p[1] for p in parts])[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if keys.size else np.zeros(0, np.int64)
    return keys[heads], np.add.reduceat(counts, heads) if heads.size else counts


class _Places:
    """Places of keys in a sorted array of distinct keys, all of which must be there."""

    def __init__(self, keys: np.ndarray, bits: int = 22):
        self.keys, self.shift = keys, np.uint64(64 - bits)
        self.slots = np.zeros(1 << bits, np.int32)
        self.slots[self._slot(keys)] = np.arange(keys.size, dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        places = self.slots[self._slot(keys)]
        others = np.flatnonzero(self.keys[places] != keys)
        places[others] = np.searchsorted(self.keys, keys[others])
        return places


def pack(df: DataFrame, doc_id: str, text: str, held_out: Column, block_bytes: int) -> DataFrame:
    """Rows of about ``block_bytes`` of text: block, ids, held, sizes, data (compressed).

    A text is never cut; one of more than that is a block of its own.
    """
    slim = df.select(F.col(doc_id).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text).alias("text"))
    kind = slim.schema["id"].dataType
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(kind)),
        T.StructField("held", T.ArrayType(T.BooleanType())), T.StructField("sizes", T.ArrayType(T.LongType())),
        T.StructField("data", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        parts: list[tuple] = []
        size = 0

        def block() -> pa.RecordBatch:
            ids = pa.concat_arrays([p[0] for p in parts])
            held = pa.concat_arrays([p[1] for p in parts])
            sizes = pa.array(np.concatenate([p[2] for p in parts]))
            data = _squeeze(np.concatenate([p[3] for p in parts]))
            whole = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), a) for a in (ids, held, sizes)]
            return pa.RecordBatch.from_arrays([pa.array([(task << 31) + made]), *whole, pa.array([data], pa.binary())], schema.names)

        for batch in batches:
            for piece in slices(batch, 2, block_bytes // 4):
                data, starts = flat(piece.column(2))
                if parts and size + data.size > block_bytes:
                    yield block()
                    parts, size, made = [], 0, made + 1
                parts.append((piece.column(0), piece.column(1), np.diff(starts), lower_ascii(data)))
                size += data.size
        if parts:
            yield block()

    return slim.mapInArrow(run, schema)


def _pieces(row_sizes: np.ndarray, data: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``_PIECE`` bytes: which texts, their bytes, where each starts."""
    ends = np.cumsum(row_sizes)
    begin = 0
    while begin < row_sizes.size:
        before = int(ends[begin - 1]) if begin else 0
        # An empty text counts too, so that a run of them is not one piece.
        until = max(begin + 1, int(np.searchsorted(ends + np.arange(1, ends.size + 1), before + begin + _PIECE, side="right")))
        starts = np.concatenate([[before], ends[begin:until]]) - before
        yield slice(begin, until), data[before : int(ends[until - 1])], starts
        begin = until


def _distinct(sizes: np.ndarray, held: np.ndarray, data: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    parts: dict[str, list] = {"gram": [], "word": []}
    for which, own, starts in _pieces(sizes, data):
        apart = held[which]
        grams, at = windows(own, starts)
        n = np.diff(np.append(at, grams.size))
        parts["gram"].append(_by_text(grams, np.repeat(apart, n)))
        hashes, before = words(own, starts)
        parts["word"].append(_by_text(hashes, np.repeat(apart, np.diff(before))))
        parts["word"].append((np.array([_END_WORD]), np.array([np.count_nonzero(~apart)])))
    return {k: _merge(v) for k, v in parts.items()}


def _by_text(keys: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and how many of each are of training texts."""
    kinds = [np.unique(keys[~held], return_counts=True)]
    kinds.append((u := np.unique(keys[held]), np.zeros(u.size, np.int64)))
    return _merge(kinds)


def _buckets(kind: str, keys: np.ndarray, buckets: int) -> np.ndarray:
    spread = keys if kind == "word" else mixed(keys)
    return ((spread >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _split(kind: str, keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts keys by bucket, and where each bucket begins in it (plus the end)."""
    own = _buckets(kind, keys, buckets)
    order = np.argsort(own, kind="stable")
    return order, np.searchsorted(own[order], np.arange(buckets + 1))


_ASKED = "kind string, bucket int, block bigint, keys binary, counts binary"


def _ask(blocks: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = _distinct(np.array(row["sizes"], np.int64), np.array(row["held"], bool), _expand(row["data"], np.uint8))
                for kind, (keys, counts) in found.items():
                    order, at = _split(kind, keys, buckets)
                    keys, counts = keys[order], counts[order]
                    own = [b for b in range(buckets) if at[b] < at[b + 1]]
                    yield pa.RecordBatch.from_pydict({
                        "kind": [kind] * len(own), "bucket": pa.array(own, pa.int32()),
                        "block": pa.array([row["block"]] * len(own), pa.int64()),
                        "keys": pa.array([_keys_out(keys[at[b] : at[b + 1]]) for b in own], pa.binary()),
                        "counts": pa.array([_squeeze(counts[at[b] : at[b + 1]].astype(np.uint32)) for b in own], pa.binary()),
                    })

    return blocks.mapInArrow(run, _ASKED)


def _sum_bucket(table: pa.Table) -> pa.Table:
    """All that blocks report for a bucket, added up: one row, without a block."""
    rows = table.to_pylist()
    keys, counts = _merge([(_keys_in(r["keys"]), _expand(r["counts"], np.uint32).astype(np.int64)) for r in rows])
    return pa.table({
        "kind": [rows[0]["kind"]], "bucket": pa.array([rows[0]["bucket"]], pa.int32()), "block": pa.array([-1], pa.int64()),
        "keys": pa.array([_keys_out(keys)], pa.binary()), "counts": pa.array([_squeeze(counts)], pa.binary()),
    })


def window_costs(keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 of the probability of each window's last symbol after the others.

    ``keys`` are sorted; of the windows with the same two symbols before the last they hold all or
    none. ``counts``: how often in training (0: never); ``pairs``: how often each symbol followed
    each other one.
    """
    keys = keys.astype(np.uint64)
    cost = np.zeros(keys.size)
    open_ = np.ones(keys.size, bool)
    row, last = (keys >> np.uint64(_BITS)) & np.uint64(511), keys & np.uint64(511)
    above: dict | None = None
    for order in range(ORDER, -1, -1):
        if order >= 2:
            mask = np.uint64((1 << _BITS * (order + 1)) - 1)
            seen, n = _merge([(keys[counts > 0] & mask, counts[counts > 0])])
            contexts, at = np.unique(seen >> np.uint64(_BITS), return_index=True)
            totals = np.add.reduceat(n, at) if at.size else n
            kinds = np.diff(np.append(at, seen.size))
            own = keys & mask

            def count_of(wanted: np.ndarray, seen=seen, n=n) -> np.ndarray:
                if not seen.size:
                    return np.zeros(wanted.size, np.int64)
                place = np.minimum(np.searchsorted(seen, wanted), seen.size - 1)
                return np.where(seen[place] == wanted, n[place], 0)

            ctx = own >> np.uint64(_BITS)
            place = np.minimum(np.searchsorted(contexts, ctx), max(contexts.size - 1, 0))
            known = contexts[place] == ctx if contexts.size else np.zeros(keys.size, bool)
            total = np.where(known, totals[place], 0) if contexts.size else np.zeros(keys.size, np.int64)
            kind = np.where(known, kinds[place], 0) if contexts.size else np.zeros(keys.size, np.int64)
            count = count_of(own)
        elif order == 1:
            total, kind, count = pairs.sum(1)[row], (pairs > 0).sum(1)[row], pairs[row, last]
            known = total > 0

            def count_of(wanted: np.ndarray) -> np.ndarray:
                return pairs[(wanted >> np.uint64(_BITS)) & np.uint64(511), wanted & np.uint64(511)]

        else:
            single = pairs.sum(0)
            total, kind, count = np.full(keys.size, single.sum()), np.full(keys.size, (single > 0).sum()), single[last]
            known = total > 0

            def count_of(wanted: np.ndarray) -> np.ndarray:
                return single[wanted & np.uint64(511)]

        if above is not None:  # what the longer context had is excluded here
            if above["seen"] is None:
                followers = pairs > 0
                excluded = (followers * pairs.sum(0)[None, :]).sum(1)[row]
            elif above["at"].size:
                short = np.uint64((1 << _BITS * (order + 1)) - 1)
                taken = np.add.reduceat(count_of(above["seen"] & short), above["at"])
                excluded = np.where(above["known"], taken[above["place"]], 0)
            else:
                excluded = 0
            total = total - np.where(above["known"], excluded, 0)
            kind = kind - np.where(above["known"], above["kind"], 0)
        full_kind = kind + (np.where(above["known"], above["kind"], 0) if above is not None else 0)
        here = open_ & known & (count > 0)
        weight = np.maximum(2 * total, 1)  # method D
        cost[here] += np.log10((2 * count[here] - 1) / weight[here])
        escape = open_ & known & ~here & (kind > 0)
        cost[escape] += np.log10(kind[escape] / weight[escape])
        open_ &= ~here
        above = {"known": known, "kind": full_kind, "seen": None, "at": None, "place": None}
        if order >= 2:
            above |= {"seen": seen, "at": at, "place": place}
    if open_.any():
        cost[open_] -= np.log10(SYMBOLS - (pairs.sum(0) > 0).sum())
    return cost


def _pair_counts(summed: DataFrame) -> np.ndarray:
    """How often each symbol followed each other one: 257 by 257 at most, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((512, 512), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = _keys_in(row["keys"]), _expand(row["counts"], np.int64)
                np.add.at(totals, ((keys >> np.uint64(_BITS)) & np.uint64(511), keys & np.uint64(511)), counts)
        left, right = np.nonzero(totals)
        yield pa.RecordBatch.from_pydict({"pair": left * 512 + right, "n": totals[left, right]})

    rows = summed.mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    pairs = np.zeros((SYMBOLS, SYMBOLS), np.int64)
    for pair, n in rows:
        pairs[pair // 512, pair % 512] = n
    return pairs


def _model(summed: DataFrame, buckets: int) -> DataFrame:
    """Costs of all windows, by the buckets in which they are asked for."""
    pairs = summed.sparkSession.sparkContext.broadcast(_pair_counts(summed))

    def regroup(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = _keys_in(row["keys"]), _expand(row["counts"], np.int64)
                context = (keys >> np.uint64(_BITS)) & np.uint64((1 << 2 * _BITS) - 1)
                order, at = _split("gram", context, buckets)
                own = [b for b in range(buckets) if at[b] < at[b + 1]]
                cut = [order[at[b] : at[b + 1]] for b in own]
                yield pa.RecordBatch.from_pydict({
                    "kind": ["gram"] * len(own), "bucket": pa.array(own, pa.int32()), "block": pa.array([-1] * len(own), pa.int64()),
                    "keys": pa.array([_keys_out(keys[c]) for c in cut], pa.binary()),
                    "counts": pa.array([_squeeze(counts[c]) for c in cut], pa.binary()),
                })

    def costs(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys, counts = _merge([(_keys_in(r["keys"]), _expand(r["counts"], np.int64)) for r in rows])
        cost = window_costs(keys, counts, pairs.value)
        order, at = _split("gram", keys, buckets)
        own = [b for b in range(buckets) if at[b] < at[b + 1]]
        cut = [order[at[b] : at[b + 1]] for b in own]
        return pa.table({
            "kind": pa.array(["gram"] * len(own)), "bucket": pa.array(own, pa.int32()), "block": pa.array([-1] * len(own), pa.int64()),
            "keys": pa.array([_keys_out(keys[c]) for c in cut], pa.binary()),
            "counts": pa.array([_squeeze(cost[c]) for c in cut], pa.binary()),
        })

    return summed.mapInArrow(regroup, _ASKED).groupBy("bucket").applyInArrow(costs, _ASKED)


_ANSWERED = "kind string, bucket int, block bigint, values binary, tokens bigint, vocabulary bigint"


def _answer(table: pa.Table) -> pa.Table:
    """For each block its keys' values, in the order asked: counts of words, costs of windows.
    Of words also the bucket's part of the training tokens and of the distinct ones."""
    rows = table.to_pylist()
    kind = rows[0]["kind"]
    asked = [r for r in rows if r["block"] >= 0]
    tokens, vocabulary = None, None
    if kind == "word":
        keys, values = _merge([(_keys_in(r["keys"]), _expand(r["counts"], np.uint32).astype(np.int64)) for r in asked])
        tokens, vocabulary = int(values.sum()), int(np.count_nonzero(values))
    else:
        told = [(_keys_in(r["keys"]), _expand(r["counts"], np.float64)) for r in rows if r["block"] < 0]
        keys, values = _merge(told)
    out = [_squeeze(values[np.searchsorted(keys, _keys_in(r["keys"]))]) for r in asked]
    n = len(asked)
    return pa.table({
        "kind": pa.array([kind] * (n + 1)), "bucket": pa.array([rows[0]["bucket"]] * (n + 1), pa.int32()),
        "block": pa.array([*[r["block"] for r in asked], -1], pa.int64()), "values": pa.array([*out, None], pa.binary()),
        "tokens": pa.array([None] * n + [tokens], pa.int64()), "vocabulary": pa.array([None] * n + [vocabulary], pa.int64()),
    })


def score(
    df: DataFrame,
    held_out: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK,
    bucket_bytes: int = BUCKET,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes of each row.

    The model learns from all rows where ``held_out`` is not true and scores every row: ``score`` is
    log10 of the probability of the lower-cased bytes and the end of the text. ``base_score`` is that
    of words and end under smoothed word counts of the same rows. Null counts as empty: the end
    alone. Repeated rows count each. With nothing to learn from, all symbols are equally likely.
    """
    blocks = written(pack(df, doc_id, text, held_out, block_bytes))
    total = blocks.select(F.sum(F.expr("aggregate(sizes, 0L, (a, x) -> a + x)"))).first()[0] or 0
    buckets = max(4, -(-total // bucket_bytes))
    asked = written(_ask(blocks, buckets))
    summed = written(asked.where("kind = 'gram'").groupBy("bucket").applyInArrow(_sum_bucket, _ASKED))
    known = asked.unionByName(_model(summed, buckets))
    answers = written(known.groupBy("kind", "bucket").applyInArrow(_answer, _ANSWERED))
    sums = answers.where("block = -1 and kind = 'word'").agg(F.sum("tokens"), F.sum("vocabulary")).first()
    tokens, vocabulary = sums[0] or 0, sums[1] or 0
    id_type = blocks.schema["ids"].dataType.elementType
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("base", T.DoubleType()), T.StructField("score", T.DoubleType()), T.StructField("n_bytes", T.LongType()),
    ])

    def texts(table: pa.Table) -> pa.Table:
        values: dict[str, list] = {"gram": [], "word": []}
        for row in table.filter(pc.is_null(table["data"])).select(["kind", "bucket", "values"]).to_pylist():
            values[row["kind"]].append((row["bucket"], row["values"]))
        block = table.filter(pc.is_valid(table["data"]))
        held = np.array(block["held"][0].as_py(), bool)
        sizes = np.array(block["sizes"][0].as_py(), np.int64)
        data = _expand(block["data"][0].as_py(), np.uint8)
        found = _distinct(sizes, held, data)
        places, told = {}, {}
        for kind, (keys, _) in found.items():
            order, _ = _split(kind, keys, buckets)
            parts = [_expand(v, np.int64 if kind == "word" else np.float64) for _, v in sorted(values[kind])]
            told[kind] = np.empty(keys.size)
            told[kind][order] = np.concatenate(parts)
            places[kind] = _Places(keys)
        logs = np.log10(told["word"] + 0.1)
        end = int(np.searchsorted(found["word"][0], _END_WORD))
        out: dict[str, list] = {"n_tokens": [], "n_known": [], "base": [], "score": []}
        for _, own, starts in _pieces(sizes, data):
            grams, at = windows(own, starts)
            out["score"].append(np.add.reduceat(told["gram"][places["gram"](grams)], at))
            hashes, before = words(own, starts)
            where = places["word"](hashes)
            upto = np.concatenate([[0.0], np.cumsum(logs[where])])
            known_ = np.concatenate([[0], np.cumsum(told["word"][where] > 0)])
            out["n_tokens"].append(np.diff(before) + 1)
            out["n_known"].append(np.diff(known_[before]) + int(told["word"][end] > 0))
            out["base"].append(np.diff(upto[before]) + logs[end])
        columns = {k: np.concatenate(v) for k, v in out.items()}
        return pa.table([
            block["ids"].combine_chunks().flatten(), pa.array(held), pa.array(columns["n_tokens"].astype(np.int64)),
            pa.array(columns["n_known"].astype(np.int64)), pa.array(columns["base"]), pa.array(columns["score"]), pa.array(sizes),
        ], schema.names)

    # Both sides hold one block's rows only: its texts, and one answer per bucket.
    whole = blocks.withColumns({"kind": F.lit(None).cast("string"), "bucket": F.lit(None).cast("int"), "values": F.lit(None).cast("binary")})
    replies = answers.where("block >= 0").select("block", "kind", "bucket", "values")
    for name in ("ids", "held", "sizes", "data"):
        replies = replies.withColumn(name, F.lit(None).cast(blocks.schema[name].dataType))
    scored = whole.unionByName(replies).groupBy("block").applyInArrow(texts, schema)
    spread = float(np.log10(tokens + 0.1 * (vocabulary + 1)))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(spread)).alias("base_score"), "score", "n_bytes",
    )
