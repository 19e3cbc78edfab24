"""PPM as the books describe it, one dictionary per context. Slow."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

EDGE = 256


def symbols(text: str | None, order: int) -> list[int]:
    data = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode()
    return [EDGE] * order + list(data) + [EDGE]


def train(texts, order: int) -> dict[tuple, Counter]:
    trie: dict[tuple, Counter] = defaultdict(Counter)
    for text in texts:
        s = symbols(text, order)
        for i in range(order, len(s)):
            for k in range(order + 1):
                trie[tuple(s[i - k : i])][s[i]] += 1
    return trie


def cost(trie: dict[tuple, Counter], text: str | None, order: int) -> float:
    s, total = symbols(text, order), 0.0
    for i in range(order, len(s)):
        excluded: set[int] = set()
        for k in range(order, -1, -1):
            followers = trie.get(tuple(s[i - k : i]))
            if not followers:
                continue
            rest = {b: n for b, n in followers.items() if b not in excluded}
            whole = 2 * sum(rest.values())  # method D
            if s[i] in rest:
                total += math.log10((2 * rest[s[i]] - 1) / whole)
                break
            if rest:
                total += math.log10(len(rest) / whole)
            excluded |= set(followers)
        else:
            total -= math.log10(257 - len(excluded))
    return total


def base(texts_train, text: str | None) -> tuple[int, int, int, float]:
    def tokens(t):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return [*re.findall("[^\x20\x09-\x0d]+", low), None]

    c = Counter(w for t in texts_train for w in tokens(t))
    n, v = sum(c.values()), len(c)
    own = tokens(text)
    return len(own), sum(c[w] > 0 for w in own), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
