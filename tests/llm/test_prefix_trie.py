"""The prefix trie against a plain one: shared heads, snapshots, one very long conversation, nulls."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import prefix_trie

SCHEMA = "conv_id bigint, turn int, role string, text string"


def plain(rows, heads=6, group=100):
    """Nodes by their prefixes, from (conv_id, turn, role, text) with distinct turns."""
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append(((t is not None, t or 0), role or "", text or ""))
    own = {c: [(r, x) for _, r, x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        whole[c] = own.get(c - int(np.fmod(c, group)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = {}
    for prefix in sorted(members, key=len, reverse=True):
        mine = members[prefix]
        kids = [p for p in out if len(p) == len(prefix) + 1 and p[: len(prefix)] == prefix]
        ends = ",".join(str(c) for c in sorted(c for c in mine if len(whole[c]) == len(prefix)))
        out[prefix] = {
            "conv_id": min(mine), "depth": len(prefix), "parent_conv_id": min(members[prefix[:-1]]) if prefix else None, "n_convs": len(mine),
            "n_children": len(kids), "n_leaves": sum(out[k]["n_leaves"] for k in kids) or 1,
            "saved_tokens": sum(out[k]["saved_tokens"] for k in kids) + ((len(mine) - 1) * len(prefix[-1][1]) if prefix else 0),
            "ends_sha256": hashlib.sha256(ends.encode()).hexdigest(),
        }
    return sorted(map(repr, out.values()))


def got(df, **options):
    return sorted(repr(r.asDict()) for r in prefix_trie.build(df, **options).collect())


def grown(seed, n, texts, longest):
    """Conversations that branch, repeat and prefix each other."""
    rng = np.random.default_rng(seed)
    made = [[]]
    rows = []
    for c in range(n):
        base = made[int(rng.integers(0, len(made)))]
        keep = int(rng.integers(0, len(base) + 1))
        turns = base[:keep] + [(str(rng.choice(["user", "bot"])), str(rng.choice(texts))) for _ in range(int(rng.integers(0, longest)))]
        made.append(turns)
        conv = c * 37 % 251 - 40
        rows += [(conv, i * 3 if i else None, role or None, text or None) for i, (role, text) in enumerate(turns)]
    return rows


@pytest.mark.parametrize("seed, n, longest", [(1, 120, 6), (2, 60, 25)])
def test_against_plain(spark, seed, n, longest):
    rows = grown(seed, n, ["", "a", "bé", "\U0001f600x"], longest)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    heads, group = (6, 100) if seed == 1 else (2, 7)
    assert got(df, heads=heads, group=group) == plain(rows, heads, group)


def test_one_conversation_with_a_third_of_all_rows(spark):
    """Its rows lie in many ranges, others leave it at many depths, and many are equal."""
    spine = [("user", f"t{i % 7}{'x' * (i % 5)}") for i in range(900)]
    rows = [(1, i, r, x) for i, (r, x) in enumerate(spine)]
    for c in range(2, 60):
        rows += [(c, i, r, x) for i, (r, x) in enumerate(spine[: c // 2 + 5])] + ([(c, 1000, "bot", "other")] if c % 3 else [])
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert got(df, heads=1) == plain(rows, heads=1)


def test_edges(spark):
    rows = [(None, 1, "a", "b"), (7, None, None, None), (7, 1, "", ""), (8, 0, "u", "q"), (8, 1, "u", "q"), (200, 5, "u", "z"), (-3, 0, "u", "q")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("z") for c in ("d", "p", "path", "conv", "n", "_part")})
    assert got(df) == plain(rows)
    assert got(df, heads=1) == plain(rows, heads=1)
    assert prefix_trie.build(df.limit(0)).count() == 0
    # Turns with one number, and repeated rows, each count; one order of them is taken.
    ties = spark.createDataFrame([(1, 0, "u", "a"), (1, 0, "u", "a"), (1, 0, "u", "b")], SCHEMA)
    assert {r["depth"] for r in prefix_trie.build(ties, heads=1).collect()} == {0, 1, 2, 3}
    # All conversations without turns are members of the root alone.
    bare = spark.createDataFrame([(c, 0, "u", "a") for c in range(1, 400) if c % 100], SCHEMA)
    kept = [c for c in range(1, 400) if c % 100 and zlib.crc32(str(c).encode()) % 6]
    root = [r for r in prefix_trie.build(bare).collect() if r["depth"] == 0][0]
    assert root["n_convs"] == 396 and root["ends_sha256"] == hashlib.sha256(",".join(map(str, kept)).encode()).hexdigest()


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)] + [(2**40 - 1, 2**40 + 5), (0, 2**62)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint").withColumn("f", prefix_trie.two_fattest("a", "b"))
    for r in df.collect():
        if r["b"] < 100:
            assert r["f"] == max(range(r["a"] + 1, r["b"] + 1), key=lambda v: v & -v)
        else:
            assert r["f"] in (2**40, 2**62)


def test_running_totals_over_many_ranges(spark):
    df = spark.range(5000).select((F.col("id") % 3 % 2).alias("k"), (F.col("id") * 7919 % 5000).alias("o"), (F.col("id") % 11).alias("v"))
    rows = prefix_trie.running(df, "k", [F.col("o").desc()], {"s": ("sum", F.col("v")), "x": ("xor", F.col("o")), "m": ("min", F.col("o"))}).collect()
    for k in (0, 1):
        s = x = 0
        for r in sorted((r for r in rows if r["k"] == k), key=lambda r: -r["o"]):
            s, x = s + r["v"], x ^ r["o"]
            assert (r["s"], r["x"], r["m"]) == (s, x, r["o"])
