"""Toxic spans by a linear-chain conditional random field, added up to a score per document.

Two tags, clean and toxic. A token's evidence is the sum of the weights of its word and of the
word's prefixes; transitions carry it to its neighbours. Labels are of documents, so tokens are
labelled first: in toxic documents those whose word or prefix is much more frequent there than in
clean ones. Forward-backward marginals give spans, and their maximum and sum, calibrated on
labelled documents that the field was not trained on, the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

#: Bounds of the sample of labelled documents that the classifier is fitted on: documents, bytes of all
#: their texts, and bytes of the longest text that is taken.
TOXIC_SAMPLE, CLEAN_SAMPLE = 1_000, 2_000
TOXIC_BYTES, CLEAN_BYTES, LONGEST = 3 << 20, 6 << 20, 64 << 10
#: Documents at or above this score are predicted toxic; spans are tokens at or above the other.
THRESHOLD, SPAN = 0.7, 0.5
_PREFIXES = range(3, 9)
_LANES = 64
_WORD = re.compile(r"[^\W_]+")


def lowered(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def features(word: str) -> list[str]:
    return [word + "$", *[word[:n] for n in _PREFIXES if n <= len(word)]]


@dataclass
class Model:
    """Weights of features, log transitions (from, to), weights of the document score."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -5.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    document: tuple[float, ...] = (-20.0, 0.0, 0.0, 0.0)


def _multiply(a: tuple, b: tuple) -> tuple:
    """Product of two stacks of 2 by 2 matrices, scaled so that it stays finite."""
    p = (a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3])
    scale = 1 / np.maximum(np.maximum(p[0], p[1]), np.maximum(np.maximum(p[2], p[3]), 1e-300))
    return tuple(x * scale for x in p)


def marginals(evidence: np.ndarray, starts: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Probability of the toxic tag at each token; ``starts`` are those of the texts, plus the end.

    Before the first token the tag is clean. Texts are laid out in rows of ``_LANES`` tokens; the
    product of a row's steps carries messages over it, so that the number of steps done one after
    the other is small also for very long texts.
    """
    sizes = np.diff(starts)
    rows = -(-sizes // _LANES)
    first = np.concatenate([[0], np.cumsum(rows)])
    if not first[-1]:
        return np.zeros(0)
    place = np.arange(evidence.size) - np.repeat(starts[:-1], sizes)
    row, lane = np.repeat(first[:-1], sizes) + place // _LANES, place % _LANES
    odds = np.ones((_LANES, first[-1]))
    real = np.zeros((_LANES, first[-1]), bool)
    odds[lane, row] = np.exp(np.clip(evidence, -30, 30))
    real[lane, row] = True
    a = np.exp(moves)

    def step(i: int) -> tuple:
        on = real[i]
        return (
            np.where(on, a[0, 0], 1.0), np.where(on, a[0, 1] * odds[i], 0.0),
            np.where(on, a[1, 0], 0.0), np.where(on, a[1, 1] * odds[i], 1.0),
        )

    whole = step(0)
    for i in range(1, _LANES):
        whole = _multiply(whole, step(i))
    # Messages into the rows, forward and backward, row after row of all texts at once.
    fore = np.tile([[1.0], [0.0]], first[-1])
    back = np.ones((2, first[-1]))
    for k in range(1, int(rows.max())):
        at = first[:-1][rows > k] + k
        f0 = fore[0, at - 1] * whole[0][at - 1] + fore[1, at - 1] * whole[2][at - 1]
        f1 = fore[0, at - 1] * whole[1][at - 1] + fore[1, at - 1] * whole[3][at - 1]
        fore[:, at] = np.array([f0, f1]) / np.maximum(f0 + f1, 1e-300)
    for k in range(1, int(rows.max())):
        at = first[1:][rows > k] - k  # the row that gets the message is the one before
        b0 = whole[0][at] * back[0, at] + whole[1][at] * back[1, at]
        b1 = whole[2][at] * back[0, at] + whole[3][at] * back[1, at]
        back[:, at - 1] = np.array([b0, b1]) / np.maximum(b0 + b1, 1e-300)
    ahead = np.empty((_LANES, 2, first[-1]))
    now = fore
    for i in range(_LANES):
        m = step(i)
        now = np.array([now[0] * m[0] + now[1] * m[2], now[0] * m[1] + now[1] * m[3]])
        now = now / np.maximum(now.sum(0), 1e-300)
        ahead[i] = now
    out = np.empty((_LANES, first[-1]))
    now = back
    for i in range(_LANES - 1, -1, -1):
        both = ahead[i] * now
        out[i] = both[1] / np.maximum(both.sum(0), 1e-300)
        m = step(i)
        now = np.array([m[0] * now[0] + m[1] * now[1], m[2] * now[0] + m[3] * now[1]])
        now = now / np.maximum(now.sum(0), 1e-300)
    return out[lane, row]


def cues(toxic: list[list[str]], clean: list[list[str]], share: float = 0.01, least: int = 5, ratio: float = 20.0) -> set[str]:
    """Features found in that share of the toxic documents, ``least`` at least, and ``ratio`` times
    as often as in clean ones. Rarer ones are mostly chance: there are so many words."""
    support = max(least, share * len(toxic))
    held = Counter(f for words in toxic for f in {f for w in set(words) for f in features(w)})
    held = Counter({f: n for f, n in held.items() if n >= support})
    against = Counter(f for words in clean for f in {f for w in set(words) for f in features(w)} if f in held)
    return {f for f, n in held.items() if (n / len(toxic)) >= ratio * (against[f] + 0.5) / (len(clean) + 1)}


def _train(texts: list[list[str]], tags: list[np.ndarray], rounds: int = 80, rate: float = 0.5, decay: float = 1e-4, least: int = 3) -> Model:
    """Weights that make the tags likely: full-batch gradient steps, scaled per weight (Adagrad).
    Features of fewer than ``least`` texts have none. No text is empty."""
    places: dict[str, int] = {}
    token = np.array([places.setdefault(w, len(places)) for words in texts for w in words])
    held = Counter(f for words in texts for f in {f for w in set(words) for f in features(w)})
    names = {f: i for i, f in enumerate(f for f, n in held.items() if n >= least)}
    pairs_ = [(i, names[f]) for i, w in enumerate(places) for f in features(w) if f in names]
    word, which = np.array(pairs_, np.int64).reshape(-1, 2).T
    gold = np.concatenate(tags).astype(float)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    head = np.zeros(gold.size, bool)
    head[starts[:-1]] = True
    before = np.where(head, 0, np.concatenate([[0], gold[:-1]]))
    theta, bias, moves = np.zeros(len(names)), -2.0, np.zeros((2, 2))
    seen = [np.zeros(len(names)), 0.0, np.zeros((2, 2))]
    for _ in range(rounds):
        evidence = np.bincount(word, theta[which], len(places))[token] + bias
        p = marginals(evidence, starts, moves)
        wrong = gold - p
        # Expected pairs of tags: by the forward message of one step on the marginals.
        prior = np.where(head, 0, np.concatenate([[0], p[:-1]]))
        a = np.exp(moves)
        odds = np.exp(np.clip(evidence, -30, 30))
        tail = np.where(odds > 0, np.clip(p / np.maximum(1 - p, 1e-12), 1e-12, 1e12), 0)
        pairs = np.empty((2, 2))
        to_toxic = [tail * a[k, 1] / (tail * a[k, 1] + a[k, 0]) for k in (0, 1)]
        pairs[0, 1], pairs[1, 1] = ((1 - prior) * to_toxic[0]).sum(), (prior * to_toxic[1]).sum()
        pairs[0, 0], pairs[1, 0] = (1 - prior).sum() - pairs[0, 1], prior.sum() - pairs[1, 1]
        real = np.array([[((1 - before) * (1 - gold)).sum(), ((1 - before) * gold).sum()], [(before * (1 - gold)).sum(), (before * gold).sum()]])
        slopes = [
            np.bincount(which, np.bincount(token, wrong, len(places))[word], len(names)) - decay * len(texts) * theta,
            wrong.sum(),
            np.clip(real - pairs, -1e6, 1e6) - 0.01 * len(texts) * moves,
        ]
        for i, g in enumerate(slopes):
            seen[i] = seen[i] + g * g
        theta = theta + rate * slopes[0] / np.sqrt(seen[0] + 1e-8)
        bias = bias + rate * slopes[1] / np.sqrt(seen[1] + 1e-8)
        moves = np.clip(moves + 0.2 * rate * slopes[2] / np.sqrt(seen[2] + 1e-8), -4, 4)
    return Model({f: float(theta[i]) for f, i in names.items() if abs(theta[i]) > 1e-3}, float(bias), moves)


class Scorer:
    """Evidence of words, kept as seen; the memo holds ``max_words`` at most."""

    def __init__(self, model: Model, max_words: int = 400_000):
        self.model, self.max_words = model, max_words
        self.known: dict[str, float] = {}

    def _evidence(self, word: str) -> float:
        if len(self.known) >= self.max_words:
            self.known.clear()
        get = self.model.weights.get
        value = self.known[word] = self.model.bias + sum(get(f, 0.0) for f in features(word))
        return value

    def evidence(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        known, out = self.known, []
        for words in texts:
            got = list(map(known.get, words))
            if None in got:
                got = [self._evidence(w) if e is None else e for w, e in zip(words, got)]
            out.append(np.array(got, float))
        sizes = [len(w) for w in texts]
        return np.concatenate([np.zeros(0), *out]), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def tags(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        evidence, starts = self.evidence(texts)
        return marginals(evidence, starts, self.model.moves), starts


def _signals(p: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per document: log odds of its most toxic token; logs of one plus the expected number of toxic
    tokens, and of one plus all tokens (a single hit says less in a long text)."""
    out = np.tile([-10.0, 0.0, 0.0], (starts.size - 1, 1))
    out[:, 2] = np.log1p(np.diff(starts))
    some = np.flatnonzero(np.diff(starts))
    if some.size:
        most = np.maximum.reduceat(p, starts[some])
        out[some, 0] = np.clip(np.log(np.maximum(most, 1e-12) / np.maximum(1 - most, 1e-12)), -10, 10)
        out[some, 1] = np.log1p(np.add.reduceat(p, starts[some]))
    return out


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Weighted logistic regression with a small ridge, by Newton steps that never raise the loss."""
    design = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(design.shape[1])
    ridge = np.diag([1e-3] + [1e-2] * x.shape[1]) * weight.sum() / 100

    def loss(at: np.ndarray) -> float:
        z = design @ at
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + at @ ridge @ at / 2)

    now = loss(beta)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (y - p)) - ridge @ beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge
        move = np.linalg.solve(curve, slope)
        # Where classes are apart, whole steps would go too far and miss the least loss.
        while (ahead := loss(beta + move)) > now and np.abs(move).max() > 1e-8:
            move = move / 2
        if np.abs(move).max() < 1e-8:
            break
        beta, now = beta + move, ahead
    return tuple(float(b) for b in beta)


def _one(beta: tuple, signals: np.ndarray) -> np.ndarray:
    z = beta[0] + signals @ np.array(beta[1:])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def learn(
    df: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    toxic_sample: int = TOXIC_SAMPLE,
    clean_sample: int = CLEAN_SAMPLE,
    toxic_bytes: int = TOXIC_BYTES,
    clean_bytes: int = CLEAN_BYTES,
    longest: int = LONGEST,
) -> Model:
    """Fit on whole texts of a sample of labelled documents: the first ``toxic_sample`` and
    ``clean_sample`` ones by the hash of their ids, as far as their texts have ``toxic_bytes`` and
    ``clean_bytes`` together; of these, documents of more than ``longest`` bytes are not used. So the
    same rows give the same sample, and the driver holds a bounded one whatever the texts are.

    Null labels are left out, a document labelled twice is toxic if once, of rows with one id the
    smallest text counts, and of documents with equal text one. Without toxic or clean ones, all
    scores are near 0.
    """
    marked = labels.where(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id"))
    marked = marked.agg((F.max(toxic) > 0).alias("_toxic"))
    held = marked.join(df.select(F.col(doc_id).alias("_id")).distinct(), "_id", "left_semi")
    sizes = {r["_toxic"]: r["count"] for r in held.groupBy("_toxic").count().collect()}
    if len(sizes) < 2:
        return Model()
    held = held.withColumn("_at", F.xxhash64("_id", F.lit(5)))
    parts = [
        held.where(F.col("_toxic") == kind).orderBy("_at", "_id").limit(bound)
        for kind, bound in ((True, toxic_sample), (False, clean_sample))
    ]
    chosen = parts[0].unionByName(parts[1]).collect()
    named = df.sparkSession.createDataFrame(chosen, held.schema)
    texts = df.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    texts = texts.where(F.octet_length("_text") <= longest).join(F.broadcast(named), "_id")
    texts = texts.groupBy("_toxic", "_at", "_id").agg(F.min("_text").alias("_text"))
    so_far = F.sum(F.octet_length("_text")).over(Window.partitionBy("_toxic").orderBy("_at", "_id"))
    allowed = F.when(F.col("_toxic"), toxic_bytes).otherwise(clean_bytes)
    rows = texts.withColumn("_bytes", so_far).where(F.col("_bytes") <= allowed).collect()
    once = {r["_text"]: r["_toxic"] for r in sorted(rows, key=lambda r: (r["_toxic"], str(r["_id"])))}
    return fit([(_WORD.findall(lowered(t)), y) for t, y in sorted(once.items())], sizes[True] / sum(sizes.values()))


def fit(documents: list[tuple[list[str], bool]], share: float) -> Model:
    """Field from two of three documents, document score from the third. ``share``: of toxic ones."""
    first = [d for i, d in enumerate(documents) if i % 3 != 2 and d[0]]
    second = [d for i, d in enumerate(documents) if i % 3 == 2]
    toxic, clean = [w for w, y in first if y], [w for w, y in first if not y]
    if not toxic or not clean:
        return Model()
    found = cues(toxic, clean)
    cue = {w: any(f in found for f in features(w)) for words in toxic for w in set(words)}
    texts = [*toxic, *clean]
    tags = [np.array([cue[w] for w in words], bool) for words in toxic] + [np.zeros(len(words), bool) for words in clean]
    if not any(t.any() for t in tags):
        return Model()
    model = _train(texts, tags)
    p, starts = Scorer(model).tags([w for w, _ in second])
    y = np.array([y for _, y in second], float)
    if 0 < y.sum() < y.size:
        weight = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
        model.document = _logistic(_signals(p, starts), y, weight)
    else:
        model.document = (-2.0, 0.5, 1.0, 0.0)
    return model


def score(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, predicted, spans of each row of ``df``.

    ``spans`` lists the toxic stretches: begin and end in code points, and the highest marginal.
    Null counts as empty; a text without words gets the score of no evidence. Repeated rows are
    scored each. The model is broadcast; the sample bounds its size.
    """
    slim = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    span = T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("p", T.DoubleType())])
    schema = T.StructType([
        slim.schema["doc_id"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
        T.StructField("spans", T.ArrayType(span)),
    ])
    sent = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            for piece in slices(batch, 1, 2 << 20):
                texts = [lowered(t or "") for t in piece.column(1).to_pylist()]
                p, starts = scorer.tags([_WORD.findall(t) for t in texts])
                scores = _one(sent.value.document, _signals(p, starts))
                spans = [[] for _ in texts]
                for d in np.unique(np.searchsorted(starts, np.flatnonzero(p >= SPAN), side="right") - 1):
                    spans[d] = _spans(texts[d], p[starts[d] : starts[d + 1]])
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32)), pa.array(spans, kind)],
                    schema.names,
                )

    return slim.mapInArrow(run, schema)


def _spans(text: str, p: np.ndarray) -> list[dict]:
    out: list[dict] = []
    last = -2
    for i, match in enumerate(_WORD.finditer(text)):
        if p[i] >= SPAN:
            if last == i - 1:
                out[-1] |= {"end": match.end(), "p": max(out[-1]["p"], float(p[i]))}
            else:
                out.append({"begin": match.start(), "end": match.end(), "p": float(p[i])})
            last = i
    return out
