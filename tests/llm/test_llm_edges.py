"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing column names."""

from __future__ import annotations

import hashlib
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from gaugeline.llm import bpe, exact_dedup, language, mixing, near_dedup, ppm, sketches, snapshots, toxicity, url_rules
from gaugeline.llm import common
from gaugeline.llm.common import mixed

LONG = " ".join(f"word{i % 977}" for i in range(30_000))
PROSE = "the quick brown fox jumps over the lazy dog and then runs far away into the dark green forest of the north"
ROWS = [
    (1, PROSE, "en", "a"), (1, PROSE, "en", "a"), (2, PROSE.replace(" ", "\n\t"), "en", "b"), (3, None, "en", "a"),
    (4, "", None, None), (5, " \n\t ", "de", "b"), (6, LONG, "en", "a"), (None, PROSE, "en", "a"), (7, None, None, None),
    (8, PROSE + " indeed", "en", "c"), (9, "Ünïcode 漢字 \U0001f600 é", "de", "b"), (None, None, None, None), (10, "!!! 123", "de", "c"),
    (11, "der schnelle braune fuchs springt ueber den faulen hund und rennt davon", "de", "c"), (12, "...", None, "c"),
]
CLASH = ["id", "row", "key", "set", "n", "digest", "block", "held", "kept", "spans", "lang_pred", "n_tokens", "component", "part", "_c0", "_tag"]
SCHEMA = "doc_id bigint, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return frame.withColumns({c: F.lit("x") for c in CLASH}).withColumn("n_chars", F.length("text").cast("long")).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_language(docs, none):
    model = language.learn(docs)
    rows = language.identify(docs, model).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert r["lang_pred"] in ("und", "en", "de") and 0 <= r["lang_score"] <= 1
    assert language.keep_identified(docs).columns == docs.columns
    assert all(r["text"] and any(c.isalpha() for c in r["text"]) for r in language.keep_identified(docs).collect())
    assert language.identify(none, model).count() == 0
    assert {r["lang_pred"] for r in language.identify(docs, language.learn(none)).collect()} == {"und"}
    assert language.keep_identified(none).count() == 0


def test_no_text_vouches_for_itself(spark):
    """Labelled gibberish goes, also in exact copies, and a clearly wrong label is replaced."""
    rng = np.random.default_rng(11)
    letters = list("abcdefghijklmnopqrstuvwxyzбвгджзклмнпрст")
    gibberish = [" ".join("".join(rng.choice(letters, rng.integers(4, 10))) for _ in range(200)) for _ in range(3)]
    junk = [(90001, gibberish[0], "en"), (90002, gibberish[1], "en"), (90003, gibberish[1].upper() + "!", "en"), (90004, gibberish[1], None), (90005, gibberish[2], "xx")]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    of_german = docs.where("lang = 'de' and length(text) > 1000").orderBy("doc_id").first()
    wrong = (90006, of_german["text"] + " und so weiter", "en")
    frame = docs.unionByName(spark.createDataFrame([*junk, wrong], docs.schema))
    kept = {r["doc_id"]: r["lang"] for r in language.keep_identified(frame).collect()}
    assert not {i for i, *_ in junk} & set(kept)
    assert kept == {90006: "de", **{r["doc_id"]: r["lang"] for r in docs.collect()}}


def test_bit_slices_hold_all_languages_of_a_gram(spark):
    frame = spark.createDataFrame([(f"aaaa shared{chr(97 + i)}", f"l{i:02}") for i in range(11)], "text string, lang string")
    model = language.learn(frame, share=0.01)
    assert len(model.languages) == 11
    got = language.identify(frame, model).collect()
    assert all(r["lang"] == r["lang_pred"] for r in got)


def test_filter_hits_against_exact_sets(spark):
    """Slots say what exact sets of grams say, but for the false positives that their filling predicts."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.learn(docs.where("doc_id % 2 = 0"))
    rows = [r for r in docs.collect() if r["text"]]

    def grams(text):
        data = ("  " + re.sub(r"[\W\d_]+", "  ", text.lower()) + "  ").encode()
        return [data[i : i + 4] for i in range(len(data) - 3)]

    taught = {}
    for r in rows:
        if r["lang"] and r["doc_id"] % 2 == 0:
            taught.setdefault(r["lang"], Counter()).update(grams(r["text"]))
    rate = {k: {g: n / sum(c.values()) for g, n in c.items()} for k, c in taught.items()}
    typical = {k: {g for g, x in c.items() if x >= 0.25 * max(o.get(g, 0) for o in rate.values())} for k, c in rate.items()}
    assert model.languages == tuple(sorted(typical))
    assert max(model.wrong) < 0.01
    for r in rows:
        own = grams(r["text"])
        codes = np.array([int.from_bytes(g, "big") for g in own], np.uint32)
        first, second = language._slots_of(codes, int(model.slots.shape[0]).bit_length() - 1)
        for i, name in enumerate(model.languages):
            held = (model.slots[first, i // 8] & model.slots[second, i // 8]) >> (i % 8) & 1
            exact = np.array([g in typical[name] for g in own])
            assert held[exact].all()
            assert held[~exact].sum() <= 5 + 3 * model.wrong[i] * len(own)


def test_language_filter_holds_all_grams(spark):
    """More distinct grams than any former limit, in a model of the size asked for, and in one too small."""
    rng = np.random.default_rng(3)
    letters = [chr(c) for c in range(0x4E00, 0x9000)]
    many = [("zh", "".join(rng.choice(letters, 4000))) for _ in range(25)]
    frame = spark.createDataFrame([*many, ("en", "all work and no play makes a dull day " * 20)], "lang string, text string")
    for options, least in (({}, 0.99), ({"model_bytes": 1 << 18}, 0.0)):
        model = language.learn(frame, **options)
        got = language.identify(frame, model).collect()
        assert all(r["lang"] == r["lang_pred"] and r["lang_coverage"] >= least for r in got if options == {} or r["lang"] == "en")
        assert model.slots.nbytes <= options.get("model_bytes", language.MODEL_BYTES)


def test_language_model(docs, none):
    rows = ppm.score(docs, F.col("doc_id") == 6).collect()
    assert len(rows) == len(ROWS)
    empty = [r for r in rows if r["n_bytes"] == 0]
    assert len(empty) == 4 and len({r["score"] for r in empty}) == 1 and all(r["n_tokens"] == 1 for r in empty)
    assert all(r["score"] < 0 for r in rows)
    tiny = {(r["doc_id"], r["n_bytes"]): r["score"] for r in ppm.score(docs, F.col("doc_id") == 6, block_bytes=64, bucket_bytes=512).collect()}
    for r in rows:
        assert tiny[r["doc_id"], r["n_bytes"]] == pytest.approx(r["score"], rel=1e-9)
    assert ppm.score(none, F.lit(False)).count() == 0
    unlearned = ppm.score(docs, F.lit(True)).collect()
    assert all(r["score"] == pytest.approx(-(r["n_bytes"] + 1) * np.log10(257)) for r in unlearned)


def test_bpe(docs, none):
    rows = bpe.encode(docs, with_text=True).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert r["decoded"] == (r["text"] or "")
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
        assert len(r["token_ids"]) == r["n_tokens"]
    assert bpe.encode(none).count() == 0


def test_bpe_with_few_states():
    ranks = {bytes([i]): i for i in range(256)}
    for i, token in enumerate([b"ab", b"bc", b"abc", b"cd", b"abcd", b"aa", b"aaa", b"aab", b"zz"]):
        ranks[token] = 256 + i
    machine = bpe.Transducer(ranks, max_states=3)
    rng = np.random.default_rng(3)
    for _ in range(3000):
        piece = bytes(rng.choice(list(b"abcdz"), rng.integers(1, 12)).tolist())
        want = [ranks[piece]] if piece in ranks else bpe.merge_all(piece, ranks)
        assert list(machine.encode(piece)) == want


@pytest.mark.parametrize("letters, memo", [("abcdefghijklmnopqrstuvwxyz", bpe.MEMO), ("a", bpe.MEMO), ("漢é", bpe.MEMO), ("abcdefghijklmnopqrstuvwxyz", 20_000)])
def test_bpe_of_one_word_of_a_megabyte(letters, memo):
    """Linear time, and states bounded within the word."""
    rng = np.random.default_rng(5)
    word = "".join(rng.choice(list(letters), 1_000_000 // len(letters[0].encode()))) if len(letters) > 1 else letters * 1_000_000
    with open(public_tokenizers.path(bpe.RANK_FILE), "rb") as f:
        ranks = bpe.read_ranks(f.read())
    library = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = bpe.Encoder(ranks, memo=memo)
    began = time.perf_counter()
    got = encoder.encode(word)
    assert time.perf_counter() - began < 20
    assert got == library.encode_ordinary(word)
    assert len(encoder.transducer.states) <= memo + 1 and not encoder.pieces


def test_bpe_of_long_texts_in_stretches():
    text = ("it's 12 x\u00a0\n\n  words, 漢字! " * 60_000) + " \t end"
    assert "".join(common.stretched(text, 1000)) == text
    with open(public_tokenizers.path(bpe.RANK_FILE), "rb") as f:
        ranks = bpe.read_ranks(f.read())
    library = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert bpe.Encoder(ranks).encode(text) == library.encode_ordinary(text)


def test_utf8_stream_in_any_pieces():
    stream = bpe.Utf8Stream({i: bytes([i]) for i in range(256)}, max_steps=7)
    rng = np.random.default_rng(4)
    for _ in range(2000):
        data = bytes(rng.choice([0x41, 0x80, 0xBF, 0xC3, 0xE0, 0xA0, 0xED, 0xF0, 0x9F, 0xF4, 0x90, 0xFF], rng.integers(0, 9)).tolist())
        cut = int(rng.integers(0, len(data) + 1))
        got = stream.feed(list(data[:cut])) + stream.feed(list(data[cut:])) + stream.close()
        assert got == data.decode("utf-8", "replace")


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, None), (6, 0), (8, 1), (11, 0), (None, 1), (99, 1)], "doc_id bigint, toxic int"
    )
    for model in (toxicity.learn(docs, labels), toxicity.learn(none, labels), toxicity.learn(docs, labels.limit(0))):
        rows = toxicity.score(docs, model).collect()
        assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(none, toxicity.Model()).count() == 0


def test_marginals_are_those_of_all_paths():
    rng = np.random.default_rng(5)
    moves = rng.normal(size=(2, 2))
    for sizes in ([3, 0, 1, 5], [70, 2, 130], [0, 0], [200]):
        evidence = rng.normal(size=sum(sizes)) * 2
        starts = np.concatenate([[0], np.cumsum(sizes)])
        got = toxicity.marginals(evidence, starts, moves)
        for a, b in zip(starts[:-1], starts[1:]):
            fore, back = [np.array([1.0, 0.0])], [np.ones(2)]
            steps = [np.exp(moves) * np.array([1, np.exp(e)]) for e in evidence[a:b]]
            for s in steps:
                fore.append(fore[-1] @ s / (fore[-1] @ s).sum())
            for s in steps[::-1]:
                back.append(s @ back[-1] / (s @ back[-1]).sum())
            for i in range(b - a):
                both = fore[i + 1] * back[b - a - i - 1]
                assert got[a + i] == pytest.approx(both[1] / both.sum())


def test_exact_dedup(docs, none):
    rows = exact_dedup.decide(docs, counters=2).collect()
    assert len(rows) == len(ROWS)
    assert sorted(r["group_size"] for r in rows if r["keep_id"] == 1) == [4] * 4
    assert sum(r["kept"] for r in rows if r["keep_id"] == 1) == 1
    assert {r["keep_id"] for r in rows if r["doc_id"] in (3, 4, 7)} == {3}
    assert [r["kept"] for r in rows if r["doc_id"] is None] == [False, False]
    with_default = exact_dedup.decide(docs).collect()
    assert sorted(map(str, rows)) == sorted(map(str, with_default))
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 5, 6, 8, 9, 10, 11, 12]
    assert exact_dedup.decide(none).count() == 0 and exact_dedup.drop_copies(none).count() == 0


def test_summaries_find_every_frequent_digest(spark):
    rng = np.random.default_rng(6)
    values = [bytes([0])] * 300 + [bytes([1])] * 200 + [int(x).to_bytes(4, "big") for x in rng.integers(2, 10**6, 1500)]
    rng.shuffle(values)
    frame = spark.createDataFrame([(bytes(v),) for v in values], "digest binary").repartition(7)
    low = {bytes(r["digest"]): r["low"] for r in exact_dedup.summaries(frame, 15).collect()}
    for v, n in ((bytes([0]), 300), (bytes([1]), 200)):
        assert n - 2000 / 16 <= low[v] <= n


def test_near_dedup(docs, none):
    rows = near_dedup.decide(docs).collect()
    assert len(rows) == len(ROWS)
    group = [r for r in rows if r["component_id"] == 1]
    assert sorted(str(r["doc_id"]) for r in group) == ["1", "1", "2", "8", "None"]
    assert sum(r["kept"] for r in group) == 1
    assert all(r["kept"] and r["component_id"] == r["doc_id"] for r in rows if r["n_shingles"] == 0)
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns and sum(r["doc_id"] == 1 for r in kept.collect()) == 1
    assert near_dedup.decide(none).count() == 0 and near_dedup.drop_near_copies(none).count() == 0


def _of_one_template(n, size, changes):
    rng = np.random.default_rng(n)
    out = []
    for i in range(n):
        words = [f"w{j}" for j in range(size)]
        for at in rng.choice(size, changes, replace=False):
            words[at] = f"x{i}y{at}"
        out.append((i, " ".join(words)))
    return out


def test_pairs_of_one_template_grow_with_its_documents(spark, monkeypatch):
    """Documents near the threshold of each other, none linked: what is proposed beyond the centre doesn't
    grow with the square of the group."""
    proposed = []
    found = near_dedup._first_common

    def counted(*args):
        pairs = found(*args).cache()
        proposed.append(pairs.count())
        return pairs

    monkeypatch.setattr(near_dedup, "_first_common", counted)
    for n in (300, 600, 1200):
        rows = near_dedup.decide(spark.createDataFrame(_of_one_template(n, 100, 2), "doc_id int, text string")).collect()
        assert len(rows) == n
    assert proposed[2] <= 4 * max(proposed[0], 300), proposed


def test_near_dedup_loses_no_link(spark):
    """Families of texts with more and more words changed, so that many pairs are near the limit."""
    rng = np.random.default_rng(7)
    texts = []
    for family in range(6):
        words = [f"w{x}" for x in rng.integers(0, 400, int(rng.integers(20, 260)))]
        for _ in range(60):
            own = list(words)
            for at in rng.integers(0, len(own), int(rng.integers(0, 7))):
                own[at] = f"x{rng.integers(0, 5)}"
            texts.append(" ".join(own))
    common = " ".join(f"passage{i}" for i in range(12))
    texts += [f"{common} {' '.join(f'u{x}' for x in rng.integers(0, 10**6, int(rng.integers(1, 20))))}" for _ in range(150)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    sets = []
    for text in texts:
        words = text.split()
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)})
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = {r["doc_id"]: r for r in near_dedup.decide(frame).collect()}
    assert [got[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i]["component_id"] for i in range(len(texts))] == [root(i) for i in range(len(texts))]


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(8)
    both = mixed(rng.integers(0, 2**63, 4000).astype(np.uint64))
    for common in (0, 1000, 2000, 3000):
        a, b = np.sort(both[: 2000 + common // 2]), np.sort(both[2000 - common // 2 :])
        left, right = near_dedup.registers([a]), near_dedup.registers([b])
        value, used = near_dedup.estimated(left, right, np.array([a.size]), np.array([b.size]))
        real = np.intersect1d(a, b).size / np.union1d(a, b).size
        assert abs(value[0] - real) < 0.2 and used[0] == near_dedup.REGISTERS


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(f"{i:04}", f"{i + 1:04}") for i in range(60)] + [("x", "y")], "a string, b string")
    got = {r["node"]: r["component"] for r in near_dedup.components(links).collect()}
    assert got == {**{f"{i:04}": "0000" for i in range(61)}, "x": "x", "y": "x"}


def test_url_rules(spark):
    urls = [
        "http://Example.net/en/x", "http://a.example.net/EN/x", "https://example.net", "ftp://badexample.net/en/", "no url", None, "http://net/en",
        "http://www.example.com/de/1?x=/fr/", "http://example.com/de", "http://x.org/fr/#y", "http://org?/fr/", "", "http://h/http://net/", "http://Ä.net/",
        "http://a.example.net/en/x", "http://a.example.net/en/x",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumns({"host": F.lit("q"), "rule": F.lit(1), "key": F.lit(2)})
    listed = [
        ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
        ("a.example.net", "/en/", "block"), ("a.example.net", "/en/", "allow"), (None, "/en", "block"), ("com", None, None),
    ]
    rules = spark.createDataFrame(listed, "host string, path string, verdict string")

    def expected(url):
        host, path = "", ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
            host, path = rest[:end], rest[end:]
            path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
            host = "".join(c.lower() if c < "\x80" else c for c in host)
        fits = []
        for h, p, v in listed:
            h, p = h or "", p or ""
            if v and (not h or host == h or host.endswith("." + h)) and path.startswith(p):
                fits.append((len(h + p), len(h), v, h + p))
        best = max(fits, default=None)
        return host, path, best and best[3], best[2] if best else "allow"

    got = {r["page_id"]: tuple(r)[1:] for r in url_rules.judge(pages, rules).collect()}
    assert got == {i: expected(u) for i, u in enumerate(urls)}
    assert url_rules.judge(pages.limit(0), rules).count() == 0
    bare = url_rules.judge(pages, rules.limit(0)).collect()
    assert len(bare) == len(urls) and {(r["rule"], r["verdict"]) for r in bare} == {(None, "allow")}


def test_open_intervals_over_many_partitions(spark):
    rng = np.random.default_rng(9)
    keys = ["".join(rng.choice(list("ab"), rng.integers(0, 9))) for _ in range(400)]
    prefixes = ["", "a", "ab", "abb", "b", "ba", "bab", "babab", "bb"]
    points = spark.createDataFrame([(k.encode(),) for k in keys], "key binary")
    marks = spark.createDataFrame([(p.encode(),) for p in prefixes], "prefix binary")
    got = {bytes(r["key"]).decode(): [bytes(x).decode() for x in r["stack"]] for r in url_rules.open_intervals(points, marks).collect()}
    assert got == {k: [p for p in prefixes if k.startswith(p)] for k in set(keys)}


def test_snapshots(spark):
    rows = [
        (1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (3, 1, "assistant", "yo"),
        (4, 5, "user", "hi"), (4, 9, "assistant", "yo"), (4, 11, None, None), (5, 0, "user", "hi"), (5, 1, "assistant", "no<|im_end|>"),
        (None, 0, None, "x"), (6, None, "user", ""), (7, 0, "user", "hi "),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns({"p": F.lit(1), "conv": F.lit(2)})
    got = {r["conv_id"]: tuple(r)[2:] for r in snapshots.render(turns).collect()}
    say = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    assert got == {
        4: (3, 1, say("user", "hi") + say("assistant", "yo") + say("unknown", "")),
        5: (2, 1, say("user", "hi") + say("assistant", "no< |im_end|>")),
        None: (1, 1, say("unknown", "x")), 6: (1, 1, say("user", "")), 7: (1, 1, say("user", "hi ")),
    }
    assert snapshots.render(turns.limit(0)).count() == 0
    copies = snapshots.render(turns.where("conv_id in (2, 3)")).collect()
    assert [(r["conv_id"], r["copies"]) for r in copies] == [(2, 2)]


def test_snapshots_of_turns_without_an_id(spark):
    """Each is a conversation of its own: collapsed into longer ones, counted with equal ones."""
    rows = [(None, 0, "user", "hi"), (None, 7, "user", "hi"), (None, 1, "user", "alone"), (None, 1, "user", "alone"), (None, 0, None, None),
            (1, 0, "user", "hi"), (1, 1, "user", "more"), (2, 0, None, None)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = sorted((str(r["conv_id"]), r["part"], r["n_turns"], r["copies"], "alone" in r["chat"]) for r in snapshots.render(turns).collect())
    assert got == [("1", 0, 2, 1, False), ("2", 0, 1, 2, False), ("None", 0, 1, 2, True)]
    kept = {(r["conv"], r["turns"], r["copies"]) for r in snapshots.maximal(turns).collect()}
    assert kept == {(1, 2, 1), (2, 1, 2), (None, 1, 2)}


def test_snapshots_of_one_conversation_with_a_third_of_all_rows(spark):
    """It comes in parts that follow each other, over several ranges of rows; its snapshots go."""
    long = [(9, i, "user", f"t{i}") for i in range(700)]
    rows = long + [(1, i, "user", f"t{i}") for i in range(699)] + [(i + 10, 0, "user", f"own {i}") for i in range(700)] + long[:50]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    got = snapshots.render(turns, part_turns=100).collect()
    whole = sorted((r["part"], r["chat"]) for r in got if r["conv_id"] == 9)
    assert [p for p, _ in whole] == list(range(7))
    assert "".join(c for _, c in whole) == "".join(f"<|im_start|>user\nt{i}<|im_end|>\n" for i in range(700))
    assert {r["conv_id"] for r in got} == {9, *range(10, 710)} and {r["n_turns"] for r in got if r["conv_id"] == 9} == {700}


def test_fingerprints(docs, none, spark):
    rows = sketches.compare(docs).collect()
    assert len(rows) == len(ROWS)
    order = sorted(((i, t or "") for i, t, *_ in ROWS), key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.blake2b(r[1].encode(), digest_size=8).digest()))
    want = []
    for (i, t), (_, following) in zip(order, [*order[1:], order[0]]):
        edited = t[: len(t) - len(t) // 3] + following[: len(t) // 3]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["n_chars"], r["edited_sha256"])) for r in rows)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert sketches.compare(none).count() == 0
    one = sketches.compare(docs.where("doc_id = 6")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_mix(docs, none):
    rows = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(5)).collect()
    assert len(rows) == len(ROWS) and sorted(map(str, rows)) == sorted(map(str, again))
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    assert sum(len((r["text"] or "").split()) for r in mixed.collect()) == pytest.approx(sum(r["taken"] for r in rows), abs=64)
    assert all(r["n_chars"] == len(r["text"]) for r in mixed.collect())
    assert mixing.mix(none).count() == 0 and mixing.mixed_rows(none).count() == 0


def test_mixed_rows_are_whole_but_for_the_ends_of_a_run(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD", 3000)
    rows = [(i, f" d{i} one\ttwo\n\n" + "".join(f"w{i}x{j}" + ("\n" if j % 7 == 0 else "  ") for j in range(40 + i % 90)), "en", f"s{i % 3}") for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("n_chars", F.length("text").cast("long"))
    known = {i: t for i, t, *_ in rows}
    shards = {k: -(-sum(len(t.split()) for _, t, _, s in rows if s == k) // 3000) for k in ("s0", "s1", "s2")}
    got = mixing.mixed_rows(docs).collect()
    assert all(r["text"] in known[r["doc_id"]] and r["n_chars"] == len(r["text"]) for r in got)
    cut = [r["source"] for r in got if r["text"] != known[r["doc_id"]]]
    assert all(cut.count(s) <= 2 * n for s, n in shards.items()) and sum(shards.values()) > 3
    taken = {r["source"]: r["n"] for r in spark.createDataFrame([(r["source"], len(r["text"].split())) for r in got], "source string, n long").groupBy("source").agg(F.sum("n").alias("n")).collect()}
    for r in mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.max("target").alias("target")).collect():
        assert abs(taken[r["source"]] - r["target"]) <= 0.02 * r["target"]


def test_apportion_takes_the_highest_quotients(spark):
    rng = np.random.default_rng(10)
    claims = [(int(g), int(i), float(c), int(s)) for g, s in ((0, 7), (1, 100), (2, 1)) for i, c in enumerate(rng.integers(0, 90, 40) ** 2)]
    frame = spark.createDataFrame(claims, "g int, i int, claim double, seats int")
    got = {(r["g"], r["i"]): r["quota"] for r in mixing.apportion(frame, ["g"], "claim", "seats", ["i"]).collect()}
    for g in (0, 1, 2):
        own = [(c, i) for x, i, c, _ in claims if x == g]
        seats = next(s for x, _, _, s in claims if x == g)
        quota = dict.fromkeys(range(40), 0)
        for _ in range(seats):
            c, i = max(own, key=lambda o: (o[0] / (2 * quota[o[1]] + 1), -o[1]))
            quota[i] += 1
        assert {i: got[g, i] for i in quota} == quota


def test_intermediate_tables_can_be_discarded(spark):
    kept = common.written(spark.range(5))
    assert kept.count() == 5
    path = kept.inputFiles()[0]
    common.discard(spark)
    with pytest.raises(Exception, match="(?i)not exist|no such file"):
        spark.read.parquet(path).count()


def test_fingerprints_over_many_stretches(spark, monkeypatch):
    """Neighbours meet across the cuts of the order, with gaps, repeated ids and nulls among them."""
    monkeypatch.setattr(sketches, "ROWS", 5)
    rng = np.random.default_rng(11)
    ids = [int(x) for x in rng.integers(-50, 5000, 90)] + [77] * 40 + [None] * 40
    rows = [(None, "the same text")] * 30 + [(i, " ".join(f"w{x}" for x in rng.integers(0, 50, int(rng.integers(0, 60))))) for i in ids]
    got = sketches.compare(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.blake2b(r[1].encode(), digest_size=8).digest()))
    want = []
    for (i, t), (_, following) in zip(order, [*order[1:], order[0]]):
        edited = t[: len(t) - len(t) // 3] + following[: len(t) // 3]
        want.append(str((i, len(t), hashlib.sha256(edited.encode()).hexdigest())))
    assert sorted(want) == sorted(str((r["doc_id"], r["n_chars"], r["edited_sha256"])) for r in got)


def test_toxic_spans_are_where_the_words_are(spark):
    rng = np.random.default_rng(12)
    calm = [f"word{x}" for x in range(300)]

    def text(bad: bool) -> str:
        words = [calm[x] for x in rng.integers(0, 300, int(rng.integers(5, 80)))]
        if bad:
            for at in rng.integers(0, len(words), 2):
                words[at] = ["Scumbag", "VILE!", "gross-ness"][int(rng.integers(0, 3))]
        return " ".join(words)

    rows = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.learn(frame.where("doc_id % 3 <> 1"), frame.select("doc_id", "toxic"))
    told = {r["doc_id"]: r for r in toxicity.score(frame.drop("toxic"), model).collect()}
    for i, whole, bad in rows:
        if i % 3 == 1:
            assert told[i]["predicted"] == bad
            found = {whole[s["begin"] : s["end"]].lower() for s in told[i]["spans"]}
            assert all(any(w in f for w in ("scumbag", "vile", "gross")) for f in found)
            assert bool(found) == bool(bad)


def test_an_inserted_word_leaves_most_paragraphs_alike():
    """Cuts follow the words, so they meet again after the place of a change; equal words are cut at the latest after 32."""
    rng = np.random.default_rng(4)
    words = [f"w{x}" for x in rng.integers(0, 5000, 2000)]
    changed = [*words[:700], "new", *words[700:1400], *words[1401:]]
    digests, starts = sketches.paragraphs([" ".join(words), "\t".join(changed), "same " * 1000])
    near = sketches.likeness(digests, starts, np.array([0]), np.array([1]))[0]
    assert 0.95 < near < 1
    assert np.diff(starts)[2] in (-(-1000 // 32), 1000)


def test_toxicity_sample_is_bounded_and_the_same_each_time(spark, monkeypatch):
    """By documents, by bytes and by the longest text; ids on several rows count once."""
    rows = [(i, f"calm words number {i} " * (i % 7 + 1) + ("vile scum " if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(300)]
    rows += [(3, "vile scum again", 1)] * 50 + [(6, "vile " * 60000, 1)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").repartition(7)
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda documents, share: seen.append((documents, share)))
    bounds = {"toxic_sample": 40, "clean_sample": 90, "toxic_bytes": 2000, "clean_bytes": 100_000, "longest": 1000}
    for _ in range(2):
        toxicity.learn(frame, frame.select("doc_id", "toxic"), **bounds)
    assert seen[0] == seen[1]
    bad, good = ([" ".join(w) for w, y in seen[0][0] if y == kind] for kind in (True, False))
    assert 0 < len(bad) <= 40 and sum(map(len, bad)) <= 2000 and max(map(len, bad)) <= 1000
    assert len(good) == 90


def test_calibration_finds_the_least_loss_where_classes_are_apart():
    rng = np.random.default_rng(8)
    y = np.repeat([0.0, 1.0], [400, 300])
    x = np.column_stack([np.where(y > 0, 4, -4) + rng.normal(0, 0.3, 700), y + rng.random(700), 5 + rng.random(700)])
    weight = np.where(y > 0, 0.2, 1.3)
    beta = np.array(toxicity._logistic(x, y, weight))
    design = np.column_stack([np.ones(700), x])
    ridge = np.array([1e-3, 1e-2, 1e-2, 1e-2]) * weight.sum() / 100
    loss = lambda b: (weight * (np.logaddexp(0, design @ b) - y * (design @ b))).sum() + (ridge * b * b).sum() / 2
    assert all(loss(beta) <= loss(beta + step) for step in rng.normal(0, 1, (200, 4)) * rng.choice([1e-3, 0.1, 3], (200, 1)))
    p = 1 / (1 + np.exp(-design @ beta))
    assert p[y > 0].min() > 0.7 > p[y == 0].max()
