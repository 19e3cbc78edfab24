"""A compacted trie of conversations, built as a z-fast trie in batches.

A conversation is a sequence of turns; the hash of a prefix is the exclusive or of its (place, turn)
hashes, twice 64 bits. The trie is kept as paths: a path belongs to the conversation that was
inserted, and leaves another path at some depth. Where conversations end on a path or leave it,
points cut it into the edges of compacted nodes. Each node is entered in a dictionary under its
handle: the hash of the prefix whose length is the two-fattest number (the one with most zero bits at its end)
between the ends of its edge. A conversation's exit node is found by fat binary search in that
dictionary, its exit depth by comparing the one edge that is left. Of those that leave at one place
with the same turn the longest is inserted, all of them at once; the others look again from there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

ROOT = ""
#: Ids that are joined to one text before they meet those of other tasks.
CHUNK = 4096

_KINDS = {"sum": F.sum, "xor": F.bit_xor, "min": F.min}


def running(rows: DataFrame, key: str, order: list[Column], totals: dict[str, tuple[str, Column]]) -> DataFrame:
    """``rows`` with running totals per ``key`` in ``order``, the row itself included.

    Rows are put into ranges of (key, order), so that one key may have any share of them. Totals run
    within a range; what a range needs of those before it is one row, as only its first key can have
    begun earlier.
    """
    spread = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranged = spread.repartitionByRange(F.col(key), *order, F.col("_tie"))
    placed = written(ranged.select("*", F.spark_partition_id().alias("_part"), *[c.alias(f"_{n}") for n, (_, c) in totals.items()]))
    own = Window.partitionBy("_part", key).orderBy(*order, "_tie").rowsBetween(Window.unboundedPreceding, 0)
    whole = placed.groupBy(key, "_part").agg(*[_KINDS[kind](f"_{n}").alias(f"_{n}") for n, (kind, _) in totals.items()])
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = whole.select(
        key, "_part", F.count("*").over(before).alias("_n"), *[_KINDS[kind](f"_{n}").over(before).alias(f"_before_{n}") for n, (kind, _) in totals.items()]
    ).where("_n > 0").drop("_n")
    local = placed.select(*placed.columns, *[_KINDS[kind](f"_{n}").over(own).alias(f"_here_{n}") for n, (kind, _) in totals.items()])
    joined = local.join(F.broadcast(carried), [key, "_part"], "left")  # at most one row a range

    def both(name: str, kind: str) -> Column:
        here, earlier = F.col(f"_here_{name}"), F.col(f"_before_{name}")
        if kind == "min":
            return F.least(here, earlier)
        return here.bitwiseXOR(F.coalesce(earlier, F.lit(0))) if kind == "xor" else here + F.coalesce(earlier, F.lit(0))

    return joined.select(*rows.columns, *[both(n, kind).alias(n) for n, (kind, _) in totals.items()])


def _turns(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, a, b (hashes of role and text), chars. A null role or text is an empty one."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    return df.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.xxhash64(F.lit(1), *said).alias("a"), F.xxhash64(F.lit(2), *said).alias("b"), F.length(said[1]).cast("long").alias("chars"),
    )


def rebuilt(df: DataFrame, conv_id: str, turn: str, role: str, text: str, heads: int, group: int) -> tuple[DataFrame, DataFrame]:
    """(conv, d, a, b, chars) of every turn of the rebuilt conversations, and (conv, n), their lengths.

    A conversation begins with the first h turns of the first one of its ``group`` ids, h the crc32 of its id modulo
    ``heads``, and goes on with its own turns after its first h.
    """
    order = [F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")]
    placed = written(running(_turns(df, conv_id, turn, role, text), "conv", order, {"p": ("sum", F.lit(1).cast("long"))}))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    convs = placed.groupBy("conv").agg(F.max("p").alias("own")).select("conv", "own", h.alias("h"), (F.col("conv") - F.col("conv") % group).alias("base"))
    first = convs.where("conv = base").select("base", F.col("own").alias("has"))
    convs = written(convs.join(first, "base", "left").withColumn("m", F.least("h", F.coalesce("has", F.lit(0)))))
    shared = placed.where((F.col("p") < heads) & (F.col("conv") % group == 0)).select(F.col("conv").alias("base"), F.col("p").alias("d"), "a", "b", "chars")
    begun = convs.join(shared, "base").where("d <= h").select("conv", "d", "a", "b", "chars")
    later = placed.join(convs.select("conv", "h", "m"), "conv").where("p > h")
    rows = begun.unionByName(later.select("conv", F.expr("p - h + m").alias("d"), "a", "b", "chars"))
    return written(rows), written(convs.select("conv", F.expr("m + greatest(own - h, 0)").alias("n")))


def two_fattest(a: str, b: str) -> Column:
    """The number in (a, b] with most zero bits at its end."""
    return F.expr(f"{b} & shiftleft(-1L, length(bin({a} ^ {b})) - 1)")


class Trie:
    """Paths (path, up, x0, n), and for each conversation the paths it follows and how far (conv, path, x)."""

    def __init__(self, prefixes: DataFrame, lengths: DataFrame):
        self.prefixes = prefixes
        self.by_path = prefixes.select(F.col("conv").cast("string").alias("path"), "d", "p", "q")
        self.paths: list[DataFrame] = []
        self.follows: list[DataFrame] = []
        self.ends: list[DataFrame] = []
        pending = written(lengths.select("conv", "n", F.lit(ROOT).alias("path"), F.lit(0).cast("long").alias("x")))
        while True:
            self.follows.append(pending.select("conv", "path", "x"))
            self.ends.append(pending.where("n = x").select("conv", "path", "x"))
            waiting = self._insert(pending.where("n > x"))
            reach = waiting.agg(F.max(F.col("n") - F.col("x"))).first()[0]
            if reach is None:
                return
            pending = self._located(waiting, self._nodes(), reach)

    def _insert(self, pending: DataFrame) -> DataFrame:
        """Of those that leave at one place with the same turn, the longest becomes a path; returns the others."""
        turn = self.prefixes.select("conv", F.col("d").alias("_d"), "p", "q")
        leaving = pending.join(turn, "conv").where("_d = x + 1")
        longest = F.min(F.struct((-F.col("n")).alias("n"), "conv")).alias("w")
        chosen = leaving.groupBy("path", "x", "p", "q").agg(longest)
        new = written(chosen.select(F.col("w.conv").alias("conv"), F.col("path").alias("up"), F.col("x").alias("x0"), (-F.col("w.n")).alias("n")))
        self.paths.append(new.withColumn("path", F.col("conv").cast("string")))
        own = self.paths[-1].select("conv", "path", F.col("n").alias("x"))
        self.follows.append(own)
        self.ends.append(own)
        return written(pending.join(new.select("conv"), "conv", "left_anti"))

    def all_paths(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.paths)

    def all_follows(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.follows)

    def _nodes(self) -> DataFrame:
        """Compacted nodes (path, s, e): the edge goes from depth s to e; hashes of the prefixes that end at
        its first turn, at its handle's depth f, and at e.

        A path has at most as many points as conversations leave it at different depths; these
        have to share so many turns with it that their number is below the square root of twice the rows.
        """
        points = self.all_follows().select("path", F.col("x").alias("e")).distinct()
        points = points.join(self.all_paths().select("path", "x0"), "path").where("e > x0")
        start = F.coalesce(F.lag("e").over(Window.partitionBy("path").orderBy("e")), "x0")
        nodes = points.select("path", start.alias("s"), "e").withColumn("f", two_fattest("s", "e"))
        depths = F.expr("explode(array(named_struct('role', 'first', 'd', s + 1), named_struct('role', 'handle', 'd', f), named_struct('role', 'extent', 'd', e)))")
        at = nodes.select("path", "s", "e", "f", depths.alias("at")).select("path", "s", "e", "f", "at.role", "at.d")
        hashed = at.join(self.by_path, ["path", "d"]).groupBy("path", "s", "e", "f")
        roles = [F.max(F.when(F.col("role") == r, F.struct("p", "q"))).alias(r) for r in ("first", "handle", "extent")]
        return written(hashed.agg(*roles))

    def _located(self, waiting: DataFrame, nodes: DataFrame, reach: int) -> DataFrame:
        """Exit path and depth of each conversation, by fat binary search between the depth known and its length."""
        own = self.prefixes.select("conv", "d", "p", "q")
        handles = nodes.select("f", F.col("handle.p").alias("p"), F.col("handle.q").alias("q"), F.col("path").alias("hit"), F.col("s").alias("hs"), F.col("e").alias("he"))
        state = waiting.select("conv", "n", "path", F.lit(None).cast("long").alias("s"), F.col("x").alias("a"), F.col("n").alias("b"))
        for _ in range(reach.bit_length() + 1):
            probe = state.withColumn("f", F.when(F.col("a") < F.col("b"), two_fattest("a", "b")))
            seen = probe.join(own.withColumnRenamed("d", "f"), ["conv", "f"], "left").join(handles, ["f", "p", "q"], "left")
            missed = F.col("hit").isNull() & F.col("f").isNotNull()
            state = seen.select(
                "conv", "n", F.coalesce("hit", "path").alias("path"), F.coalesce("hs", "s").alias("s"),
                F.coalesce("he", "a").alias("a"), F.when(missed, F.col("f") - 1).otherwise(F.col("b")).alias("b"),
            )
        state = written(state)
        # Whether the whole edge of the node found is matched; else the exit is on it.
        extents = nodes.select("path", F.col("e").alias("a"), "extent")
        here = own.select("conv", F.col("d").alias("a"), F.struct("p", "q").alias("own"))
        checked = state.join(here, ["conv", "a"], "left").join(extents, ["path", "a"], "left")
        passed = F.col("s").isNull() | F.coalesce(F.col("own") == F.col("extent"), F.lit(False))
        # Beyond it, the edge that begins with the conversation's next turn.
        firsts = nodes.select(F.expr("s + 1").alias("a1"), F.col("first.p").alias("p"), F.col("first.q").alias("q"), F.col("path").alias("cp"), F.col("s").alias("cs"), F.col("e").alias("ce"))
        after = own.select("conv", F.col("d").alias("a1"), "p", "q")
        known = checked.withColumn("a1", F.when(passed, F.col("a") + 1)).join(after, ["conv", "a1"], "left").join(firsts, ["a1", "p", "q"], "left")
        on = F.when(F.col("a1").isNull(), F.struct("path", "s", F.col("a").alias("e")))
        edge = F.coalesce(on, F.when(F.col("cp").isNotNull(), F.struct(F.col("cp").alias("path"), F.col("cs").alias("s"), F.col("ce").alias("e"))))
        exits = written(known.select("conv", "n", "path", "a", edge.alias("edge")))
        compared = exits.where("edge IS NOT NULL").select("conv", "n", "edge.*")
        rows = compared.join(own, "conv").where("d > s AND d <= least(e, n)")
        equal = rows.join(self.by_path, ["path", "d", "p", "q"]).groupBy("conv").agg(F.count("*").alias("same"))
        placed = exits.join(equal, "conv", "left")
        depth = F.when(F.col("edge").isNull(), F.col("a")).otherwise(F.col("edge.s") + F.coalesce("same", F.lit(0)))
        return written(placed.select("conv", "n", F.coalesce("edge.path", "path").alias("path"), depth.alias("x")))


def _joined_ids(ends: DataFrame) -> DataFrame:
    """path, x, sha: SHA-256 of the ids that end at a node, ascending, comma-joined.

    A hash needs its text in order, so the ids of a node pass through one task, as a stream; they come
    there as texts of up to CHUNK ids each, joined where the sorted ranges lie.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, out = None, [], []

        def flush() -> None:
            if ids:
                out.append((*at, ids[0], ",".join(map(str, ids))))
                ids.clear()

        for batch in batches:
            for path, x, conv in zip(*[c.to_pylist() for c in batch.columns]):
                if at != (path, x) or len(ids) == CHUNK:
                    flush()
                    at = (path, x)
                ids.append(conv)
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(("path", "x", "first", "ids"), r)) for r in out])
                out.clear()
        flush()
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(("path", "x", "first", "ids"), r)) for r in out])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha, out = None, None, []
        for batch in batches:
            for path, x, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if at == (path, x):
                    sha.update(b",")
                else:
                    if sha:
                        out.append((*at, sha.hexdigest()))
                    at, sha = (path, x), hashlib.sha256()
                sha.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(("path", "d", "sha"), r)) for r in out])
                out = []
        if sha:
            yield pa.RecordBatch.from_pylist([dict(zip(("path", "d", "sha"), (*at, sha.hexdigest())))])

    ranged = ends.select("path", "x", "conv").repartitionByRange("path", "x", "conv").sortWithinPartitions("path", "x", "conv")
    texts = ranged.mapInArrow(chunks, "path string, x bigint, first bigint, ids string")
    ordered = texts.repartition("path", "x").sortWithinPartitions("path", "x", "first")
    return ordered.mapInArrow(digest, "path string, d bigint, sha string")


def build(
    df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", heads: int = 6, group: int = 100,
) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by number, null first, ties by a hash of role and text; repeated rows are turns of
    their own. A null role or text is an empty one. Rows without a conversation id belong to no
    conversation and are left out. A conversation left without turns is a member of the root. Equal
    prefixes are told by hashes of 128 bits. Other columns are not looked at; no rows give no nodes.
    """
    rows, lengths = rebuilt(df, conv_id, turn, role, text, heads, group)
    sums = {"p": ("xor", F.xxhash64("d", "a", F.lit(3))), "q": ("xor", F.xxhash64("d", "b", F.lit(4)))}
    prefixes = written(running(rows, "conv", [F.col("d")], sums).drop("a", "b"))
    trie = Trie(prefixes, lengths)
    paths, follows = trie.all_paths(), trie.all_follows()
    ended = reduce(DataFrame.unionByName, trie.ends)
    sha = _joined_ids(ended)

    # Members, and leaves: a path whose end nothing leaves from is one, for all places it passes.
    attached = paths.groupBy(F.col("up").alias("path"), F.col("x0").alias("d")).agg(F.count("*").alias("attached"))
    leaves = paths.join(attached.select("path", F.col("d").alias("n")), ["path", "n"], "left_anti").select("conv", F.lit(1).cast("long").alias("leaf"))
    points = follows.join(leaves, "conv", "left").groupBy("path", F.col("x").alias("d"))
    points = points.agg(F.count("*").alias("here"), F.min("conv").alias("least"), F.coalesce(F.sum("leaf"), F.lit(0)).alias("leaf"))

    # Edges expanded: a node for each turn of a path beyond the place where it leaves another.
    own = prefixes.join(paths.select("conv", "path", "up", "x0", "n"), "conv").where("d > x0")
    root = lengths.limit(1).select(F.lit(ROOT).alias("path"), F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("chars"), F.lit(None).cast("string").alias("up"), F.lit(0).cast("long").alias("x0"), F.lit(0).cast("long").alias("n"))
    nodes = own.select(*root.columns).unionByName(root).join(points, ["path", "d"], "left")
    zero = F.lit(0).cast("long")
    upward = {"n_convs": ("sum", F.coalesce("here", zero)), "conv_id": ("min", F.col("least")), "n_leaves": ("sum", F.coalesce("leaf", zero))}
    nodes = running(nodes.drop("_tie"), "path", [F.col("d").desc()], upward).drop("here", "least", "leaf")
    nodes = written(nodes.withColumn("worth", (F.col("n_convs") - 1) * F.col("chars")))

    # What subtrees save: that of the paths which leave, where they do, and then up the path.
    of_path = nodes.groupBy("path").agg(F.sum("worth").alias("total")).join(paths.select("path", "conv"), "path").select("conv", "total", F.col("path").alias("own"))
    passed = follows.join(of_path, "conv").where("path != own").groupBy("path", F.col("x").alias("d")).agg(F.sum("total").alias("branches"))
    saved = {"saved_tokens": ("sum", F.col("worth") + F.coalesce("branches", zero))}
    whole = running(nodes.join(passed, ["path", "d"], "left"), "path", [F.col("d").desc()], saved)
    whole = whole.join(attached, ["path", "d"], "left").join(sha, ["path", "d"], "left")

    inside = F.col("d") - 1 > F.col("x0")
    above = nodes.select(F.col("path").alias("above"), F.col("d").alias("above_d"), F.col("conv_id").alias("parent_conv_id"))
    whole = whole.withColumns({"above": F.when(inside, F.col("path")).otherwise(F.col("up")), "above_d": F.when(inside, F.col("d") - 1).otherwise(F.col("x0"))})
    return whole.join(above, ["above", "above_d"], "left").select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs",
        (F.when(F.col("d") < F.col("n"), 1).otherwise(0) + F.coalesce("attached", zero)).cast("long").alias("n_children"),
        F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), "saved_tokens",
        F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
