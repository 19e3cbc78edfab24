"""Registered queries of the training-data operators against SQL twins or plain versions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry
import ppm_plain
from compare import connect, difference
from gaugeline.llm import bpe, common
from gaugeline.llm.queries import ORACLES, QUERIES

SMALL, MIDDLE, LARGE = (f"/root/testdata/sf{x}" for x in ("0.001", "0.01", "0.1"))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").collect()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name]) is None


def test_all_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, len(QUERIES) + 1))


def test_language_of_held_out_documents(spark):
    truth = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op1_language_id"](spark, MIDDLE).join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    out = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in out) / len(out) >= 0.97


def test_language_model_against_plain(spark, docs):
    rows = {r["doc_id"]: r for r in QUERIES["op2_lm_score"](spark, SMALL).collect()}
    assert len(rows) == len(docs)
    train = [d["text"] for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 10]
    trie = ppm_plain.train(train, 5)
    for d in sorted(docs, key=lambda d: len(d["text"]))[:80:2]:
        r = rows[d["doc_id"]]
        assert r["score"] == pytest.approx(ppm_plain.cost(trie, d["text"], 5), rel=1e-9)
    for d in docs[:4]:
        r = rows[d["doc_id"]]
        n, known, tokens, base = ppm_plain.base(train, d["text"])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, tokens)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)


def test_tokens_against_library(spark, docs):
    rows = {r["doc_id"]: r for r in QUERIES["op3_byte_bpe"](spark, SMALL).collect()}
    with open(public_tokenizers.path(bpe.RANK_FILE), "rb") as f:
        ranks = bpe.read_ranks(f.read())
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for d in docs:
        ids = own.encode_ordinary(d["text"])
        r = rows[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(d["text"].encode()).hexdigest()


def test_toxicity_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{LARGE}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op4_toxicity"](spark, LARGE).join(labels, "doc_id").where("held_out").collect()
    bad = [r["score"] for r in rows if r["toxic"]]
    good = [r["score"] for r in rows if not r["toxic"]]
    above = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / len(bad) / len(good)
    assert above > 0.93
    assert sum(b >= 0.7 for b in bad) / len(bad) > 0.8
    assert sum(g >= 0.7 for g in good) / len(good) < 0.01
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)
    assert all(r["spans"] for r in rows if r["predicted"])


def test_fingerprints_against_plain(spark, docs):
    rows = {r["doc_id"]: r for r in QUERIES["op9_fingerprints"](spark, SMALL).collect()}
    assert len(rows) == len(docs)
    order = sorted(docs, key=lambda d: -d["doc_id"])

    def ends(word: str, known: dict = {}) -> bool:
        if word not in known:
            known[word] = int(common.words(*common.flat(pa.array([word])))[0][0]) % 8 == 0
        return known[word]

    def paragraphs(text: str) -> Counter:
        """Stretches of words, by loops over lines and words; only the hash of a word is the library's."""
        out: list = []
        for line in text.split("\n"):
            held: list = []
            for word in re.findall(r"[^\x20\x09-\x0D]+", line):
                held.append(word)
                if ends(word) or len(held) == 32:
                    out.append(tuple(held))
                    held = []
            out += [tuple(held)] if held else []
        return Counter(out)

    def alike(a: str, b: str) -> float:
        x, y = paragraphs(a), paragraphs(b)
        return (x & y).total() / (x | y).total() if x or y else 1.0

    for d, following in zip(order, [*order[1:], order[0]]):
        r, text = rows[d["doc_id"]], d["text"]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following["text"][:cut]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(alike(text, edited))
        assert r["near_next"] == pytest.approx(alike(text, following["text"]))
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (alike(text, edited) == 1)


def test_mix_reaches_targets(spark):
    mixed = QUERIES["op10_source_mix"](spark, SMALL).join(
        spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source"), "doc_id"
    )
    rows = mixed.groupBy("source").agg(
        F.max("target").alias("target"), F.sum("taken").alias("taken"), F.sum("size").alias("size"),
        F.max("source_size").alias("source_size"), F.max(F.col("taken") - 2 * F.col("size")).alias("over"),
    ).collect()
    assert sum(r["target"] for r in rows) == pytest.approx(1.5 * sum(r["size"] for r in rows))
    free = {round(r["target"] / w, 6) for r, w in zip(sorted(rows, key=lambda r: r["source"]), [3, 1, 2] * 99) if r["target"] < 2 * r["size"]}
    assert len(free) == 1  # one level for all sources below their limit
    for r in rows:
        assert r["size"] == r["source_size"] and r["over"] <= 0
        assert abs(r["taken"] - r["target"]) <= 0.02 * r["target"]
