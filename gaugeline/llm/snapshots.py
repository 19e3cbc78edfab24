"""Conversations logged again and again as they grow, collapsed to the longest, then rendered.

The hash of a prefix is the exclusive or of its (place, turn) hashes, a running aggregate. A
conversation is a snapshot if the hash of all its turns is that of a proper prefix elsewhere.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .prefix_trie import running

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _turn_hash(role: str, text: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(role).isNull(), F.col(role), F.col(text).isNull(), F.col(text))


def _light(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    return turns.select(
        F.col(conv_id).alias("conv"), F.col(turn).alias("turn"),
        _turn_hash(role, text, 1).alias("a"), _turn_hash(role, text, 2).alias("b"),
    )


#: The hash of a turn at its place, twice 64 bits.
_HASHES = {"p": "xxhash64(place, a, 3)", "q": "xxhash64(place, b, 4)"}


def prefixes(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, a, b, place (from 1), 128-bit hash (p, q) of the turns up to it; rows with an id only.

    Places and hashes are running totals over ranges of rows, so one conversation may have any share.
    """
    once = _light(turns, conv_id, turn, role, text).where("conv is not null").distinct()
    order = [F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")]
    placed = running(once, "conv", order, {"place": ("sum", F.lit(1).cast("long"))})
    return running(placed, "conv", order, {c: ("xor", F.expr(e)) for c, e in _HASHES.items()})


def _lone(turns: DataFrame, conv_id: str, role: str, text: str) -> DataFrame:
    """Turns without an id, each a conversation of one turn: its columns, place, p, q."""
    alone = turns.where(F.col(conv_id).isNull()).withColumns(
        {"a": _turn_hash(role, text, 1), "b": _turn_hash(role, text, 2), "place": F.lit(1).cast("long")}
    )
    return alone.withColumns({c: F.expr(e) for c, e in _HASHES.items()})


def maximal(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv, turns, copies, p, q of each conversation that is no prefix of a longer one.

    Of conversations with the same turns the smallest id stays, a null id comes last; ``copies``
    counts them. Turns are ordered by number, ties by the hash of role and text; a repeated row
    counts once. A turn without a conversation id is a conversation of its own.
    """
    slim = turns.select(*[F.col(c).alias(n) for c, n in ((conv_id, "conv"), (turn, "turn"), (role, "role"), (text, "text"))])
    return _maximal(written(prefixes(slim, "conv", "turn", "role", "text")), _lone(slim, "conv", "role", "text"))


def _maximal(known: DataFrame, lone: DataFrame) -> DataFrame:
    ends = known.groupBy("conv").agg(F.max(F.struct("place", "p", "q")).alias("end")).select("conv", "end.*")
    inner = known.join(ends.select("conv", "place"), ["conv", "place"], "left_anti").select("place", "p", "q").distinct()
    first = F.min(F.struct(F.col("conv").isNull(), F.col("conv").alias("conv")))["conv"]
    every = ends.unionByName(lone.select(*ends.columns))
    same = every.groupBy("place", "p", "q").agg(first.alias("conv"), F.count("*").alias("copies"))
    return same.join(inner, ["place", "p", "q"], "left_anti").select("conv", F.col("place").alias("turns"), "copies", "p", "q")


def render(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", part_turns: int = 1000
) -> DataFrame:
    """conv_id, part, n_turns, copies and chat of each maximal conversation.

    A chat is one string of ``part_turns`` turns at most; a longer conversation has further rows, ``part``
    1, 2 and so on, whose strings follow each other. ``n_turns`` counts the turns of all parts.
    A turn is the opening mark, role, newline, text, closing mark, newline. A null role is
    ``unknown``, a null text empty. Marks inside a role or text get a space after ``<``, so that a
    text cannot end its turn. A row with a null conversation id is a conversation of its own. Other columns
    are not looked at; no rows give no rows.
    """
    slim = turns.select(*[F.col(c).alias(n) for c, n in ((conv_id, "conv"), (turn, "turn"), (role, "role"), (text, "text"))])
    known = written(prefixes(slim, "conv", "turn", "role", "text"))
    lone = _lone(slim, "conv", "role", "text")
    kept = written(_maximal(known, lone))

    def plain(c: str, other: str) -> Column:
        value = F.coalesce(F.col(c), F.lit(other))
        return F.replace(F.replace(value, F.lit(OPEN), F.lit("< |im_start|>")), F.lit(CLOSE), F.lit("< |im_end|>"))

    said = F.concat(F.lit(OPEN), plain("role", "unknown"), F.lit("\n"), plain("text", ""), F.lit(CLOSE + "\n")).alias("said")
    hashes = [_turn_hash("role", "text", 1).alias("a"), _turn_hash("role", "text", 2).alias("b")]
    places = known.select("conv", "turn", "a", "b", "place").join(kept.select("conv", "turns", "copies"), "conv")
    spoken = slim.where("conv is not null").select("conv", "turn", *hashes, said).alias("s")
    here = (F.col("s.turn").eqNullSafe(F.col("k.turn"))) & (F.col("s.conv") == F.col("k.conv")) & (F.col("s.a") == F.col("k.a")) & (F.col("s.b") == F.col("k.b"))
    turned = spoken.join(places.alias("k"), here).select("k.conv", "place", "turns", "copies", "said")
    once = turned.groupBy("conv", "place").agg(F.first("turns").alias("turns"), F.first("copies").alias("copies"), F.min("said").alias("said"))
    part = F.expr(f"(place - 1) div {part_turns}").alias("part")
    gathered = once.groupBy("conv", part).agg(
        F.max("turns").alias("n_turns"), F.max("copies").alias("copies"), F.array_sort(F.collect_list(F.struct("place", "said"))).alias("all")
    )
    chats = gathered.select(F.col("conv").alias("conv_id"), "part", "n_turns", "copies", F.array_join(F.col("all.said"), "").alias("chat"))
    apart = lone.select("p", "q", said).groupBy("p", "q").agg(F.min("said").alias("chat"))
    apart = apart.join(kept.where("conv is null"), ["p", "q"])
    return chats.unionByName(
        apart.select(F.col("conv").alias("conv_id"), F.lit(0).cast("long").alias("part"), F.col("turns").alias("n_turns"), "copies", "chat")
    )
