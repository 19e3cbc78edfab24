"""Byte-level BPE as a lazily determinised transducer, and its streaming inverse.

Two adjacent tokens can follow each other in an encoding only if encoding their joint bytes gives
the same two tokens back. Hence the last token of every prefix's encoding is unique, and is found
from the last tokens of shorter prefixes. A state of the transducer is what that needs: the last
token given out and the bytes read since. A token is given out as soon as every position at which
a later token could still begin agrees on it; no position further back than the longest token can
do that, which bounds the lookahead. States are made when first reached.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, stretched

#: States and pre-tokens that an encoder keeps: some 300 MB in all.
MEMO = 300_000
#: Pre-tokens of more characters are not kept.
LONG = 128
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines() if data else [])}


def merge_all(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The definition of BPE: join the adjacent pair of lowest rank, leftmost first, until none is left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    """Encodes one pre-token at a time, in time proportional to its length. ``max_states`` bounds memory: when
    reached, also within a pre-token, all states but the present one are forgotten and made again as
    needed, which changes nothing in the output."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MEMO, max_pairs: int = 300_000):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.max_states, self.max_pairs = max_states, max_pairs
        # A token that the merges don't build from its own bytes never ends an encoding.
        self.built = {token: rank for token, rank in ranks.items() if merge_all(token, ranks) == [rank]}
        self.prefixes = {token[:i] for token in self.built for i in range(len(token) + 1)}
        self.ordered, self.rights, self.lefts = self._edges()
        # Tokens that go on from a beginning, where these are few.
        longer: dict[bytes, list[int]] = {}
        for token, rank in self.built.items():
            for i in range(1, len(token)):
                longer.setdefault(token[:i], []).append(rank)
        self.longer = {begun: tuple(tokens) for begun, tokens in longer.items() if len(tokens) <= 4}
        self.pairs: dict[tuple[int, int], bool] = {}
        self._clear()

    def _edges(self) -> tuple[bool, dict, dict]:
        """The parts that stand at the right and at the left end of a token while it is built, and
        whether every merge has a higher rank than those it needs."""
        ordered, rights, lefts = True, {}, {}
        for token in sorted(self.built, key=len):
            rank = self.built[token]
            if len(token) == 1:
                rights[rank] = lefts[rank] = ((token, -1),)
                continue
            without = {t: r for t, r in ((t, self.ranks.get(t)) for t in _parts(token)) if r is not None and t != token}
            halves = merge_all(token, without)
            if len(halves) != 2 or halves[0] not in rights or halves[1] not in lefts:
                return False, {}, {}
            ordered &= max(halves[0] if len(self.bytes_of[halves[0]]) > 1 else -1, halves[1] if len(self.bytes_of[halves[1]]) > 1 else -1) < rank
            rights[rank] = (*rights[halves[1]], (token, rank))
            lefts[rank] = (*lefts[halves[0]], (token, rank))
        return ordered, rights, lefts

    def _clear(self) -> None:
        # A state is the last token given out (-1 where any would do), the bytes read since, the last
        # token of the encoding of each prefix of them, and the places at which a token that is
        # still being read may begin.
        self.states: list[tuple[int, bytes, tuple, tuple]] = []
        self.numbers: dict[tuple[int, bytes, tuple], int] = {}
        # By state and byte: the next state, as its complement if tokens are given out on the way.
        self.steps: dict[int, int] = {}
        self.given: dict[int, tuple] = {}
        self.left: dict[int, tuple] = {}
        self.places: dict[tuple, tuple] = {}
        if len(self.pairs) > self.max_pairs:
            self.pairs.clear()
        self._number(-1, b"", (), [0])

    def _number(self, prior: int, read: bytes, last: tuple, live: list) -> int:
        """The state's number. Where no token that is still being read from the first place on could
        be refused, the token before it is left out, so that more ways lead to one state."""
        if live[0] or self._all_follow(prior, read):
            prior = -1
        number = self.numbers.get((prior, read, last))
        if number is None:
            number = self.numbers[prior, read, last] = len(self.states)
            places = tuple(live)
            self.states.append((prior, read, last, self.places.setdefault(places, places)))
        return number

    def _all_follow(self, prior: int, read: bytes) -> bool:
        longer = self.longer.get(read)
        if prior < 0 or longer is None:
            return prior < 0
        for token in longer:
            fits = self.pairs.get((prior, token))
            if fits is None:
                fits = self.pairs[prior, token] = self._follows(prior, token)
            if not fits:
                return False
        return True

    def _follows(self, left: int, right: int) -> bool:
        """Whether the merges keep the border between two tokens."""
        if not self.ordered:
            return merge_all(self.bytes_of[left] + self.bytes_of[right], self.ranks) == [left, right]
        # Merges happen in order of rank. Between two of them, the parts at the border are fixed;
        # a merge across it happens if its rank comes before the next one on either side. At equal
        # rank the merge further left is first.
        ends, heads = self.rights[left], self.lefts[right]
        i = j = 0
        while True:
            next_left = ends[i + 1][1] if i + 1 < len(ends) else None
            next_right = heads[j + 1][1] if j + 1 < len(heads) else None
            across = self.ranks.get(ends[i][0] + heads[j][0])
            if across is not None and (next_left is None or across < next_left) and (next_right is None or across <= next_right):
                return False
            if next_left is None and next_right is None:
                return True
            if next_right is None or (next_left is not None and next_left <= next_right):
                i += 1
            else:
                j += 1

    def _tokens(self, last: tuple, end: int) -> tuple:
        tokens = []
        while end:
            tokens.append(last[end - 1])
            end -= len(self.bytes_of[last[end - 1]])
        return tuple(tokens[::-1])

    def _step(self, number: int, byte: int) -> int:
        prior, begun, last, open_ = self.states[number]
        read = begun + bytes((byte,))
        pairs, sizes, n = self.pairs, self.sizes, len(read)
        at, live = -1, []
        for p in open_:
            part = read[p:]
            if part not in self.prefixes:
                continue
            live.append(p)
            if at < 0 and part in self.built:
                token = self.built[part]
                before = last[p - 1] if p else prior
                fits = before < 0 or pairs.get((before, token))
                if fits is None:
                    fits = pairs[before, token] = self._follows(before, token)
                if fits:
                    at = p
        token = self.built[read[at:]]
        last += (token,)
        # Bit p: the encodings up to here and up to each live place have a cut at p.
        agreed = 1 << n | 1
        while at:
            agreed |= 1 << at
            at -= sizes[last[at - 1]]
        for p in live:
            cuts = 1
            while p:
                cuts |= 1 << p
                p -= sizes[last[p - 1]]
            agreed &= cuts
        base = agreed.bit_length() - 1
        live.append(n)
        if not base:
            following = self.steps[number << 8 | byte] = self._number(prior, read, last, live)
            return following
        given = self.given[number << 8 | byte] = self._tokens(last, base)
        following = self._number(given[-1], read[base:], last[base:], [p - base for p in live])
        following = self.steps[number << 8 | byte] = ~following
        return following

    def encode(self, piece: bytes) -> tuple:
        """Tokens of one pre-token. One that is a token as a whole stays whole."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        state, out, steps = 0, [], self.steps
        for byte in piece:
            following = steps.get(state << 8 | byte)
            if following is None:
                if len(self.states) > self.max_states:
                    state = self._forget(state)
                    steps = self.steps
                following = self._step(state, byte)
            if following < 0:
                out += self.given[state << 8 | byte]
                following = ~following
            state = following
        left = self.left.get(state)
        if left is None:
            _, read, last, _ = self.states[state]
            left = self.left[state] = self._tokens(last, len(read))
        out += left
        return tuple(out)

    def _forget(self, state: int) -> int:
        """Forget all states but one, also within a piece; returns the new number of that one."""
        prior, read, last, places = self.states[state]
        self._clear()
        return self._number(prior, read, last, list(places))


def _parts(token: bytes) -> set[bytes]:
    return {token[i:j] for i in range(len(token)) for j in range(i + 1, len(token) + 1)}


class Encoder:
    """Whole texts. The memo holds the pre-tokens seen of late, at most twice ``memo``, and the
    transducer as many states as ``memo``; long pre-tokens are not kept. Long texts are split in
    stretches, which suits patterns like the public one (see ``stretched``)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN, memo: int = MEMO):
        self.transducer = Transducer(ranks, memo)
        self.stream = Utf8Stream(self.transducer.bytes_of)
        self.find = regex.compile(pattern).findall
        self.max_pieces = memo
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        pieces, out = self.pieces, []
        for part in stretched(text):
            for piece in self.find(part):
                tokens = pieces.get(piece)
                if tokens is None:
                    if len(piece) > LONG:
                        out += self.transducer.encode(piece.encode())
                        continue
                    if len(pieces) >= self.max_pieces:
                        self.older, self.pieces = pieces, {}
                        pieces = self.pieces
                    tokens = pieces[piece] = self.older.get(piece) or self.transducer.encode(piece.encode())
                out += tokens
        return out


class Utf8Stream:
    """Incremental UTF-8 decoding of tokens.

    The state is the bytes of a character begun. ``feed`` takes any number of tokens and returns the
    text that is complete; ``close`` ends the stream. A malformed part becomes U+FFFD, as in
    ``bytes.decode(errors="replace")``. Steps (state, token) are kept once made.
    """

    def __init__(self, bytes_of: dict[int, bytes], max_steps: int = 500_000):
        self.bytes_of = bytes_of
        self.max_steps = max_steps
        self.steps: dict[bytes, dict[int, tuple[str, bytes]]] = {}
        self.kept = 0
        self.begun = b""
        # Steps that begin and end between characters, which are nearly all.
        self.whole = {}
        for token, data in bytes_of.items():
            if self.split(data) == len(data):
                with suppress(UnicodeDecodeError):
                    self.whole[token] = data.decode()

    @staticmethod
    def split(data: bytes) -> int:
        """Where the unfinished character at the end of ``data`` begins, or its length."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead < 0x80:
                break
            if lead >= 0xC0:
                need = 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 1
                second = data[-back + 1] if back > 1 else None
                low = 0xA0 if lead == 0xE0 else 0x90 if lead == 0xF0 else 0x80
                high = 0x9F if lead == 0xED else 0x8F if lead == 0xF4 else 0xBF
                open_ = need > back and (second is None or low <= second <= high)
                return len(data) - back if open_ else len(data)
        return len(data)

    def _step(self, begun: bytes, token: int) -> tuple[str, bytes]:
        data = begun + self.bytes_of[token]
        cut = self.split(data)
        step = (data[:cut].decode("utf-8", "replace"), data[cut:])
        if self.kept >= self.max_steps:
            self.steps.clear()
            self.kept = 0
        self.steps.setdefault(begun, {})[token] = step
        self.kept += 1
        return step

    def feed(self, tokens: list[int]) -> str:
        if not self.begun:
            texts = list(map(self.whole.get, tokens))
            if None not in texts:
                return "".join(texts)
        out, begun = [], self.begun
        row = self.steps.get(begun)
        for token in tokens:
            step = row.get(token) if row is not None else None
            if step is None:
                step = self._step(begun, token)
                row = None
            out.append(step[0])
            if row is None or step[1] != begun:
                begun = step[1]
                row = self.steps.get(begun)
        self.begun = begun
        return "".join(out)

    def close(self) -> str:
        rest, self.begun = self.begun, b""
        return rest.decode("utf-8", "replace")


_encoders: dict[tuple[str, str, int], Encoder] = {}


def encoder_for(data: bytes, pattern: str, memo: int) -> Encoder:
    """One encoder per process and vocabulary, so that its states serve all tasks of a worker."""
    key = (hashlib.sha256(data).hexdigest(), pattern, memo)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(read_ranks(data), pattern, memo)
        # Tables of many small objects that stay: searching them for cycles again and again is in vain.
        gc.collect()
        gc.freeze()
        gc.set_threshold(100_000, 50, 100)
    return _encoders[key]


def encode(
    df: DataFrame,
    text: str = "text",
    rank_file: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    with_ids: bool = True,
    with_text: bool = False,
    memo: int = MEMO,
    keep: bool = True,
) -> DataFrame:
    """``df`` with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked for, ``token_ids``
    (array of int) and ``decoded`` (string) after its own columns.

    Null counts as empty: no tokens, digests of no bytes. Texts and words of any length take time in
    proportion to it; the encoder's memory doesn't grow with them. Columns of those names are replaced.
    Rows stay where they are. Workers keep the encoder, with ``memo`` entries of each kind, for
    their next task, unless ``keep`` is false, where other work follows in the same workers. The driver reads ``rank_file`` and broadcasts its bytes, whose size
    is that of a vocabulary.
    """
    with open(rank_file or public_tokenizers.path(RANK_FILE), "rb") as f:
        data = df.sparkSession.sparkContext.broadcast(f.read())
    added = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    added += [("token_ids", T.ArrayType(T.IntegerType()))] * with_ids + [("decoded", T.StringType())] * with_text
    kept = df.drop("n_tokens", "ids_sha256", "decoded_sha256", "token_ids", "decoded")
    at = kept.columns.index(text)
    schema = T.StructType([*kept.schema.fields, *[T.StructField(n, t) for n, t in added]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(data.value, pattern, memo)
        stream = encoder.stream
        for batch in batches:
            for piece in slices(batch, at):
                n, ids_sha, text_sha, ids, texts = [], [], [], [], []
                for value in piece.column(at):
                    tokens = encoder.encode(value.as_py() or "")
                    array = np.array(tokens, "<u4")
                    decoded = stream.feed(tokens) + stream.close()
                    n.append(len(tokens))
                    ids_sha.append(hashlib.sha256(array.tobytes()).hexdigest())
                    text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                    if with_ids:
                        ids.append(array.astype(np.int32))
                    if with_text:
                        texts.append(decoded)
                new = [pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
                new += [pa.array(ids, pa.list_(pa.int32()))] * with_ids + [pa.array(texts, pa.string())] * with_text
                yield pa.RecordBatch.from_arrays([*piece.columns, *new], schema.names)
        if not keep:
            _encoders.clear()

    return kept.mapInArrow(run, schema)


def digests(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row of ``df``."""
    slim = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return encode(slim, with_ids=False, **options).drop("text")
