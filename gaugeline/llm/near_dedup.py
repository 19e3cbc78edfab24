"""Near-duplicates by HyperMinHash sketches, banding, and verification on whole shingle sets.

The hashes of a document's shingles fall into buckets; of each bucket the smallest hash is kept, as
its count of leading zeros and a few bits after them. Bands of such registers propose links. A link
is proposed further only if the estimated similarity, corrected for registers that agree by
accident, can reach the threshold; then the whole sets decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import flat, lower_ascii, mixed, slices, words, written

WIDTH = 5
#: Registers of a sketch and bits kept after the leading zeros; registers of a band.
REGISTERS, MANTISSA, ROWS = 128, 10, 4
_BITS = REGISTERS.bit_length() - 1
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's runs of ``WIDTH`` words; of a shorter text, of
    all its words together; none without words."""
    data, starts = flat(texts)
    hashes, before = words(lower_ascii(data), starts)
    out = []
    sums = np.zeros(max(0, hashes.size - WIDTH + 1), np.uint64)
    for k in range(WIDTH):
        sums += hashes[k : k + sums.size] * _ODD[k]
    sums = mixed(sums)
    for a, b in zip(before[:-1], before[1:]):
        if b - a >= WIDTH:
            own = np.sort(sums[a : b - WIDTH + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif b > a:
            short = np.add.reduce(hashes[a:b] * _ODD[: b - a], keepdims=True) + np.uint64(b - a)
            out.append(mixed(short))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers of each set, one row each: 0 if empty, else one more than the leading
    zeros and the bits after the first one of the smallest hash in the bucket."""
    edges = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(64 - _BITS)
    least = np.zeros((len(sets), REGISTERS), np.uint64)
    some = np.zeros((len(sets), REGISTERS), bool)
    for i, own in enumerate(sets):
        at = np.searchsorted(own, edges)
        some[i] = np.append(at[1:], own.size) > at
        if own.size:
            least[i] = own[np.minimum(at, own.size - 1)]
    rest = (least << np.uint64(_BITS)) & np.uint64(0xFFFFFFFFFFFFF800)  # exact as a float
    zeros = np.minimum(64 - np.frexp(rest.astype(np.float64))[1], 62).astype(np.uint64)
    after = (rest << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    return np.where(some, (zeros << np.uint64(MANTISSA) | after) + np.uint64(1), 0).astype("<u2")


def densified(table: np.ndarray) -> np.ndarray:
    """Registers without gaps: an empty one takes the value of a register drawn for its place, the
    first of the draws that isn't empty. So a band of a small set rests on several of its elements."""
    out = table.copy()
    rows, places = np.nonzero((table == 0) & table.any(1)[:, None])
    for draw in range(1, 2 * REGISTERS):
        if not rows.size:
            return out
        seed = places.astype(np.uint64) * np.uint64(0x1F123BB5) + np.uint64(draw << 32)
        value = table[rows, (mixed(seed) >> np.uint64(64 - _BITS)).astype(np.int64)]
        out[rows, places] = value
        rows, places = rows[value == 0], places[value == 0]
    out[rows, places] = table[rows, (table[rows] > 0).argmax(1)]
    return out


def _tag(doc_id: str, text: str) -> Column:
    """128 bits for id and text, by which rows are found again."""
    return F.struct(F.xxhash64(doc_id, text).alias("x"), F.xxhash64(F.lit(1), doc_id, text).alias("y"))


def sketched(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, tag (hash of id and text), row, n (size of the shingle set), set (digest of it), registers."""
    slim = df.select(
        F.col(doc_id).alias("id"), _tag(doc_id, text).alias("tag"),
        F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"),
    )
    schema = T.StructType([
        slim.schema["id"], slim.schema["tag"], slim.schema["row"], T.StructField("n", T.LongType()),
        T.StructField("set", T.BinaryType()), T.StructField("registers", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, 3, 1 << 19):
                sets = shingle_sets(piece.column(3))
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays([
                    *piece.columns[:3], pa.array([s.size for s in sets], pa.int64()),
                    pa.array(digests, pa.binary()), pa.array([r.tobytes() for r in registers(sets)], pa.binary()),
                ], schema.names)

    return slim.mapInArrow(run, schema)


def _bands(classes: DataFrame) -> DataFrame:
    """key, set, n: one row for each band of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = REGISTERS // ROWS
        for batch in batches:
            if not batch.num_rows:
                continue
            table = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u2").reshape(-1, REGISTERS)
            parts = np.ascontiguousarray(densified(table)).view("<u8").reshape(-1, count)
            keys = mixed(mixed(parts) + np.arange(1, count + 1, dtype=np.uint64))
            own = pa.array(np.repeat(np.arange(batch.num_rows), count))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), batch.column(0).take(own), batch.column(1).take(own)], ["key", "set", "n"]
            )

    return classes.select("set", "n", "registers").mapInArrow(run, "key bigint, set binary, n bigint")


def _alike(percent: int, a: str = "n", b: str = "m") -> Column:
    """Sizes that two sets of the similarity asked for can have."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def estimated(left: np.ndarray, right: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Similarity from registers (one row each), and the number of registers it rests on.

    Different hashes agree in a register by accident about 0.17 / 2**MANTISSA of the time, less if
    the sets differ in size; so many agreements are taken off.
    """
    used = ((left > 0) | (right > 0)).sum(1)
    same = ((left == right) & (left > 0)).sum(1)
    ratio = np.maximum(n, m) / np.maximum(np.minimum(n, m), 1)
    by_chance = 0.169919487159739093975315012348 * used / 2**MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return np.clip((same - by_chance) / np.maximum(used, 1), 0, 1), used


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose estimate is less than six standard errors below the similarity asked for."""
    side = classes.select("set", "n", "registers")
    whole = pairs.join(side.toDF("a", "n", "left"), "a").join(side.toDF("b", "m", "right"), "b")
    wanted = percent / 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, REGISTERS) for i in (4, 5))
            value, used = estimated(left, right, np.asarray(batch.column(2)), np.asarray(batch.column(3)))
            good = value >= wanted - 6 * np.sqrt(wanted * (1 - wanted) / np.maximum(used, 1))
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return whole.select("a", "b", "n", "m", "left", "right").mapInArrow(run, "a binary, b binary")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose whole sets have the similarity asked for."""
    whole = pairs.join(sets.select(F.col("set").alias("a"), F.col("shingles").alias("left")), "a")
    whole = whole.join(sets.select(F.col("set").alias("b"), F.col("shingles").alias("right")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for one, other in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                left, right = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
                both = np.intersect1d(left, right, assume_unique=True).size
                good.append(100 * both >= percent * (left.size + right.size - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return whole.select("a", "b", "left", "right").mapInArrow(run, "a binary, b binary")


def _sets_of(df: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """set, shingles (all hashes) of the classes in ``wanted`` (tag, set). Texts travel compressed."""
    slim = df.select(_tag(doc_id, text).alias("tag"), F.col(text).alias("text"))

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for piece in slices(batch, 1):
                packed = [pack.compress((t or "").encode()) for t in piece.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(packed, pa.binary())], ["tag", "packed"])

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                sets = shingle_sets(pa.array([unpack.decompress(t) for t in part.column(1).to_pylist()], pa.binary()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["set", "shingles"])

    packed = slim.mapInArrow(squeeze, T.StructType([slim.schema["tag"], T.StructField("packed", T.BinaryType())]))
    return packed.join(wanted, "tag").select("set", "packed").mapInArrow(shingle, "set binary, shingles binary").dropDuplicates(["set"])


def _differences(members: DataFrame, sets: DataFrame) -> DataFrame:
    """centre, set, component, n, m (sizes of the set and of the centre's), size, shingle: each shingle that
    only one of the two has, ``size`` in all, of each row of ``members`` (centre, set, component)."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 16):
                part = batch.slice(i, 16)
                pairs = [[np.frombuffer(d, np.uint64) for d in c.to_pylist()] for c in part.columns[3:]]
                apart = [np.setxor1d(x, c, assume_unique=True) for x, c in zip(*pairs)]
                size = np.array([d.size for d in apart])
                own = pa.array(np.repeat(np.arange(part.num_rows), size))
                counts = [pa.array(np.repeat([x.size for x in side], size), pa.int64()) for side in pairs]
                if len(own):
                    yield pa.RecordBatch.from_arrays(
                        [*[part.column(k).take(own) for k in range(3)], *counts, pa.array(np.repeat(size, size)), pa.array(np.concatenate(apart).view(np.int64))],
                        ["centre", "set", "component", "n", "m", "size", "shingle"],
                    )

    whole = members.join(sets.withColumnRenamed("shingles", "own"), "set")
    whole = whole.join(sets.select(F.col("set").alias("centre"), F.col("shingles").alias("other")), "centre")
    schema = "centre binary, set binary, component binary, n bigint, m bigint, size bigint, shingle bigint"
    return whole.select("centre", "set", "component", "own", "other").mapInArrow(spread, schema)


def _first_common(sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of different components that can be linked, among ``members`` (centre, set,
    component) with one centre, all of which were compared with the centre.

    What a template puts into all members would make all of them candidates of each other. So sets are
    told by their differences from the centre. Two sets x, y are as alike as asked if and only if
    2 * (differences they share) * (100 + percent) >= w(x) + w(y), with w = (100 + percent) * differences -
    (100 - percent) * size. The centre has the least w, so a pair that need share none is linked through
    the centre. All others share differences, the more the further they are from the centre. The
    differences of a set are ordered by how many members have them, rare ones first; the first one that
    two such sets share comes so early that what follows it can still hold all they have to share.
    """
    most, less = 100 + percent, 100 - percent
    rows = written(_differences(members, sets))
    often = rows.groupBy("centre", "shingle").agg(F.count("*").alias("often"))
    order = Window.partitionBy("centre", "set").orderBy("often", "shingle")
    placed = rows.join(often, ["centre", "shingle"]).withColumn("place", F.row_number().over(order)).where("often > 1")
    placed = placed.withColumn("w", F.col("size") * most - F.col("n") * less)
    # Linked with the centre or not. Two that are, are in one component.
    far = F.col("w") > F.col("m") * less
    # Shared differences, at least, whatever the other set is: as sizes have to be alike, and by the
    # least w that the other can have, one linked with the centre or one that isn't.
    alike = F.ceil(F.col("size") - F.col("n") * less / percent)

    def early(other_is_far: bool) -> Column:
        least = F.col("m") * (less if other_is_far else -less)
        needed = F.greatest(alike, F.ceil((F.col("w") + least) / (2 * most)), F.lit(1))
        return F.col("place") <= F.col("size") - needed + 1

    def side(where: Column, name: str) -> DataFrame:
        return placed.where(where).select("centre", "shingle", F.col("set").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("component", "n", "size", "place", "w")])

    def found(a: DataFrame, b: DataFrame, once: Column) -> DataFrame:
        rest = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
        can = ((1 + rest) * 2 * most >= F.col("w_a") + F.col("w_b")) & _alike(percent, "n_a", "n_b")
        return a.join(b, ["centre", "shingle"]).where(once & (F.col("component_a") != F.col("component_b")) & can).select("a", "b")

    both_far = found(side(far & early(True), "a"), side(far & early(True), "b"), F.col("a") < F.col("b"))
    one_far = found(side(far & early(False), "a"), side(~far & early(True), "b"), F.lit(True))
    return both_far.unionByName(one_far).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (least node reachable) of every node in ``links`` (a, b).

    Each round every node's neighbours move to the least node next to it, first the greater ones,
    then all but the greater; the rounds needed grow with the logarithm of the longest path.
    """
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        root = large.groupBy("a").agg(F.min("b").alias("root"))
        small = large.join(root, "a")
        moved = small.where("b != root").select(F.col("b").alias("a"), F.col("root").alias("b"))
        edges = written(moved.unionByName(small.select("a", F.col("root").alias("b"))).distinct())
        now = tuple(edges.select(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def decide(df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 85) -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id, kept.

    Words are runs of other characters than white space, A-Z lower-cased. Documents are linked if
    100 * common shingles >= ``percent`` * all their shingles; ``component_id`` is the smallest id
    reachable. One with null text or without words has no shingles and is linked with nothing;
    equal sets are. ``kept`` marks the smallest id of a component; of repeated rows with one id
    exactly one; a null id comes last.

    Equal sets are one class. Of each bucket of a band, the class that shares most buckets is
    compared with the others. Where that leaves a bucket in several components, its classes are
    searched for links by how they differ from that one, rare differences first, so that none is lost
    whatever a bucket's size, and the text that all share proposes none.
    """
    return _decided(df, doc_id, text, percent).drop("tag")


def _decided(df: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    """As ``decide``, with the tag of each row."""
    rows = written(sketched(df, doc_id, text))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
    classes = written(rows.where("n > 0").groupBy("set").agg(
        F.first("n").alias("n"), F.first("registers").alias("registers"), F.min("tag").alias("tag"), first,
    ))
    # Sets so small that one shingle more or less is too much have no other links.
    able = classes.where(F.col("n") * 100 >= (F.col("n") + 1) * percent)
    banded = _bands(able)
    buckets = banded.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    shared = written(banded.join(buckets, "key"))
    weight = shared.groupBy("set").agg(F.sum("size").alias("weight"))
    centre = shared.join(weight, "set").groupBy("key").agg(F.max(F.struct("weight", "set", "n")).alias("centre"))
    star = shared.join(centre.select("key", F.col("centre.set").alias("a"), F.col("centre.n").alias("m")), "key")
    star = star.where(F.col("a") != F.col("set")).where(_alike(percent)).select("a", F.col("set").alias("b")).distinct()
    sets = written(_sets_of(df, classes.join(weight.select("set"), "set", "left_semi").select("tag", "set"), doc_id, text))
    links = written(_linked(_possible(star, classes, percent), sets, percent))
    near = components(links)
    told = shared.join(near.withColumnRenamed("node", "set"), "set", "left").withColumn("component", F.coalesce("component", "set"))
    split = told.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("held")).where("x != y")
    # Two sets alone in a bucket have been compared.
    open_ = told.join(split.where("held > 2").select("key"), "key", "left_semi").join(centre.select("key", F.col("centre.set").alias("centre")), "key")
    open_ = open_.select("centre", "set", "component").where("centre != set").distinct()
    others = written(_linked(_possible(_first_common(sets, open_, percent), classes, percent), sets, percent))
    near = components(links.unionByName(others))
    whole = classes.select("set", "first").join(near.withColumnRenamed("node", "set"), "set", "left")
    whole = whole.withColumn("component", F.coalesce("component", "set"))
    least = whole.groupBy("component").agg(F.min("first").alias("least"))
    known = whole.join(least, "component").select("set", "least")
    decided = rows.select("id", "tag", "row", "n", "set").join(known, "set", "left")
    alone = F.col("n") == 0
    return decided.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("least.id")).alias("component_id"),
        (alone | (F.col("row") == F.col("least.row"))).alias("kept"), "tag",
    )


def drop_near_copies(df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """The rows of ``df`` that stay: of each component the one with the smallest id, whole, and all
    without shingles. Of repeated rows with one id and text, one stays."""
    names = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    inner = df.toDF(*names.values())
    key = _tag(names[doc_id], names[text])
    stays = _decided(inner, names[doc_id], names[text], percent).where("kept")
    whole = inner.withColumn("_tag", key).join(stays.select(F.col("tag").alias("_tag")).distinct(), "_tag", "left_semi")
    once = whole.dropDuplicates(["_tag"])
    return once.select(*[F.col(v).alias(k) for k, v in names.items()])
