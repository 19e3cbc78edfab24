"""The pipeline against a plain version of each stage, on documents with some junk added."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from gaugeline.llm import bpe

SMALL = "/root/testdata/sf0.001"
JUNK = [
    (90001, None, "en", "src1"), (90002, "", None, "src1"), (90003, "123 %% 456", "en", None), (90004, "жщ ъыь эюя цчш", None, "src2"),
    (90005, "qzxj wvkq zzxq qqjx", None, "src2"),
]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    junk = spark.createDataFrame(JUNK, "doc_id bigint, text string, lang string, source string").selectExpr("*", "length(text) AS n_chars")
    path = str(tmp_path_factory.mktemp("sf"))
    docs.unionByName(junk).unionByName(docs.where("doc_id = 5")).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Rows before the first stage and after each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        after = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.dtypes == docs.dtypes
        docs = after
        out.append(docs.collect())
    return out


def _grams(text):
    letters = "  " + re.sub(r"[\W\d_]+", "  ", (text or "").lower()) + "  "
    data = letters.encode()
    return [data[i : i + 4] for i in range(len(data) - 3)]


def _fold(text):
    return zlib.crc32(re.sub(r"[\W\d_]+", "  ", (text or "").lower()).strip().encode()) % 4


def test_language_id(stages):
    """Each text is judged by the exact grams of the labelled texts of the three other folds."""
    before, after = stages[0], stages[1]
    typical = []
    for fold in range(4):
        taught = defaultdict(Counter)
        for r in before:
            if r["lang"] and r["text"] is not None and _fold(r["text"]) != fold:
                taught[r["lang"]].update(_grams(r["text"]))
        rate = {l: {g: n / sum(c.values()) for g, n in c.items()} for l, c in taught.items()}
        best = Counter()
        for c in rate.values():
            for g, x in c.items():
                best[g] = max(best[g], x)
        typical.append({l: {g for g, x in c.items() if x >= 0.25 * best[g]} for l, c in rate.items()})
    stay, langs = Counter(), {}
    for r in before:
        grams = _grams(r["text"])
        hits = sorted(((sum(g in t for g in grams), l) for l, t in typical[_fold(r["text"])].items()), reverse=True)
        if re.search(r"[^\W\d_]", r["text"] or "") and hits[0][0] / max(1, len(grams)) >= 0.3:
            stay[r["doc_id"]] += 1
            score = hits[0][0] / (hits[0][0] + hits[1][0])
            if r["lang"] is None or score > 0.65:
                langs[r["doc_id"]] = hits[0][1]
            elif score < 0.55:
                langs[r["doc_id"]] = r["lang"]
    assert Counter(r["doc_id"] for r in after) == stay
    assert not {r["doc_id"] for r in after} & {i for i, *_ in JUNK}
    assert all(r["lang"] and r["lang"] == langs.get(r["doc_id"], r["lang"]) for r in after)
    assert len(langs) > 0.9 * len(stay)


def test_exact_dedup(stages):
    first = {}
    for r in stages[1]:
        key = re.sub(r"[\x20\x09-\x0d]+", " ", r["text"])
        first[key] = min(first.get(key, r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in stages[2]) == sorted(first.values())


def test_near_dedup(stages):
    sets = {}
    for r in stages[2]:
        words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"]))
        sets[r["doc_id"]] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
    ids = sorted(sets)
    least = {i: i for i in ids}
    links = [
        (a, b) for a in ids for b in ids
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    for _ in ids:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert sorted(r["doc_id"] for r in stages[3]) == sorted(set(least.values()))


def test_source_mix(stages):
    words = lambda t: re.findall(r"[^\x20\x09-\x0d]+", t)
    size, taken = Counter(), Counter()
    known = {r["doc_id"]: r for r in stages[3]}
    for r in stages[3]:
        size[r["source"]] += len(words(r["text"]))
    copies = Counter()
    for r in stages[4]:
        own, whole = words(r["text"]), words(known[r["doc_id"]]["text"])
        taken[r["source"]] += len(own)
        copies[r["doc_id"]] += 1
        rest = iter(whole)
        assert all(w in rest for w in own)  # the words of the document, in its order
        assert r["text"] == known[r["doc_id"]]["text"] if own == whole else True
        assert r["n_chars"] == len(r["text"])
    assert max(copies.values()) <= 2
    level = dict(zip(sorted(size), [3, 1, 2] * 99))
    target, capped = {}, set()
    while True:
        rest = 1.5 * sum(size.values()) - sum(2 * size[s] for s in capped)
        share = rest / sum(level[s] for s in level if s not in capped)
        target = {s: 2 * size[s] if s in capped else share * level[s] for s in level}
        over = {s for s in level if target[s] > 2 * size[s]}
        if not over:
            break
        capped |= over
    for s in target:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s]


def test_tokens(stages, spark, sf_dir):
    with open(public_tokenizers.path(bpe.RANK_FILE), "rb") as f:
        ranks = bpe.read_ranks(f.read())
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = Counter((r["doc_id"], tuple(own.encode_ordinary(r["text"]))) for r in stages[4])
    assert Counter((r["doc_id"], tuple(r["token_ids"])) for r in stages[5]) == texts
    for r in stages[5]:
        decoded = own.decode(r["token_ids"])
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in whole.collect()) == sorted((r["doc_id"], r["ids_sha256"]) for r in stages[5])
