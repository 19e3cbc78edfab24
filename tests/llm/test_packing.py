"""Packing: every id once, no gaps, no padding; ids as the tokenizers library gives them."""

from __future__ import annotations

import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gaugeline.llm import packing
from gaugeline.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    made.encode_special_tokens = True
    return lambda text: made.encode(text, add_special_tokens=False).ids


def checked(rows, length=1024):
    """Sequences without gaps; returns their sizes and the ids of each document (by id and size)."""
    held, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] > 0
        held[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"], r["doc_tokens"]].append((r["start"], r["ids"]))
    sizes = []
    for pieces in held.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at == length or at & (at - 1) == 0 and at < length
        sizes.append(at)
    return sizes, docs


def test_ids_and_crc(spark, library):
    rows = QUERIES["op11_packing"](spark, SMALL).collect()
    docs = {r["doc_id"]: np.array([*library(r["text"] or ""), 0], "<u4") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert sum(r["length"] for r in rows) == sum(d.size for d in docs.values())
    ends = defaultdict(set)
    for r in rows:
        own = docs[r["doc_id"]]
        assert r["doc_tokens"] == own.size
        assert r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes())
        ends[r["doc_id"]] |= set(range(r["start"], r["start"] + r["length"]))
    assert all(ends[i] == set(range(d.size)) for i, d in docs.items())


def test_edges(spark, library):
    texts = ["some words here", None, "", "the end <|endoftext|> of it", "x" * 9000, "é漢\U0001f600 \n\n  ", "some words here"] + ["a b c " * 700] * 6
    rows = [(None if i == 3 else i // 2, t, "x", "y") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id int, text string, ids string, sequence_id string").repartition(5)
    sizes, docs = checked(packing.pack(df).collect())
    assert sum(sizes) == sum(len(library(t or "")) + 1 for t in texts)
    assert len([s for s in sizes if s < 1024]) <= 10
    for (i, n), parts in docs.items():
        mine = [[*library(t or ""), 0] for j, t, *_ in rows if j == i and len(library(t or "")) + 1 == n]
        got = b"".join(ids for _, ids in sorted(parts, key=lambda p: p[0]))
        if len(mine) == 1:
            assert np.frombuffer(got, "<u4").tolist() == mine[0]
    assert packing.pack(df.limit(0)).count() == 0
    clashing = df.select(F.col("doc_id").cast("string").alias("k"), F.col("text").alias("t"))
    assert packing.pack(clashing, "k", "t").schema["doc_id"].dataType.simpleString() == "string"


def test_many_tasks_leave_one_group_of_leftovers(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), (F.col("id") % 97 + 1).cast("int")).alias("text"))
    sizes, _ = checked(packing.pack(df.repartition(40)).collect())
    assert len([s for s in sizes if s < 1024]) <= 10


@pytest.mark.parametrize("text", ["a" * 400_000, "word  two\n\n " * 30_000, "漢" * 100_000, "it's \t x1 " * 30_000])
def test_long_texts_in_stretches(library, text):
    encode = packing.tokenizer(open(public_tokenizers.path(packing.VOCABULARY), encoding="utf-8").read())
    began = time.perf_counter()
    got = packing.ids_of(text, encode, 0, 1000)
    assert time.perf_counter() - began < 10
    assert got[:-1].tolist() == library(text) and got[-1] == 0


def test_best_fit_and_fullest():
    done = []
    packer = packing.Packer(done.append, 10, 2)
    for name, size in (("a", 6), ("b", 3), ("c", 4), ("d", 5), ("e", 23)):
        packer.add(name, np.arange(size))
    # b fits with a, d with c; of e two sequences leave, and its rest fills up the fullest window.
    assert [[(n, s, i.size) for n, s, i in seq] for seq in done] == [[("e", 0, 10)], [("e", 10, 10)], [("a", 0, 6), ("b", 0, 3), ("e", 20, 1)]]
    left = packer.close()
    total = sum(i.size for seq in done for _, _, i in seq) + sum(i.size for _, _, i in left)
    assert total == 41 and sum(i.size for _, _, i in left) < 10
    assert all(sum(i.size for _, _, i in seq) == 10 for seq in done)
