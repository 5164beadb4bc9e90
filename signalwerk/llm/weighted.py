"""Weighted shingles of one text and improved consistent weighted sampling, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

WIDTH = 5
_TABLE = 1 << 16


def word_hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word)


class Weigher:
    """Shingle hashes and weights of texts. A word's weight is 1 + ln(N / df) / ln N, from 1 to 2. A text
    brings the weights of its words outside the table of the most frequent; words in neither have 2. A shingle weighs its count in the text times the mean weight of its words."""

    def __init__(self, frequent: dict[int, float], keep: int = 200_000):
        self.frequent, self.keep = frequent, keep
        self.known: dict[str, int] = {}
        self.hash, self.weight = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12)

    def ids(self, words: list[str], rare: dict[int, float]) -> np.ndarray:
        known = self.known
        for w in set(words).difference(known):
            i = len(known)
            if i == len(self.hash):
                self.hash, self.weight = np.resize(self.hash, 2 * i), np.resize(self.weight, 2 * i)
            h = word_hash(w)
            self.hash[i], self.weight[i] = h, self.frequent.get(h) or rare.get(h, 2.0)
            known[w] = i
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def others(self, text: str) -> list[int] | None:
        """Signed hashes of the distinct words outside the table; None without words."""
        words = set(text.lower().split())
        found = [h for h in map(word_hash, words) if h not in self.frequent]
        return np.array(found, np.uint64).view(np.int64).tolist() if words else None

    def shingles(self, text: str, rare: dict[int, float] = {}) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct shingle hashes, the weight of one occurrence of each, and counts.

        A text of one to four words is one shingle."""
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.int64)
        if len(self.known) > self.keep:
            self.known = {}
        ids = self.ids(words, rare)
        n, width = len(words), min(WIDTH, len(words))
        h, w = np.zeros(n - width + 1, np.uint64), np.zeros(n - width + 1)
        with np.errstate(over="ignore"):
            for k in range(width):
                part = ids[k : n - width + 1 + k]
                h = (h ^ self.hash[part]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
                w += self.weight[part]
        keys, first, count = np.unique(h, return_index=True, return_counts=True)
        return keys, w[first] / width, count


def text_key(text: str) -> int:
    """A signed 64-bit hash of the word sequence: what exact copies share."""
    h = xxhash.xxh3_64_intdigest(" ".join(text.lower().split()))
    return h - (1 << 64) if h >> 63 else h


def similarities(docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], columns: int = 4096) -> np.ndarray:
    """Weighted Jaccard similarity of all pairs of a bounded block of shingles(), as matrix products over the shingles that two or more have.

    The t-th occurrence of a shingle is an element of its own, so the sum of smaller weights is a weighted count of common elements."""
    n = len(docs)
    keys, units, owners = [], [], []
    for i, (h, unit, count) in enumerate(docs):
        at = np.repeat(np.arange(len(h)), count)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        with np.errstate(over="ignore"):
            keys.append(h[at] + nth.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9))
        units.append(unit[at])
        owners.append(np.full(len(at), i))
    key, unit, owner = map(np.concatenate, (keys, units, owners))
    total = np.bincount(owner, unit, n)
    _, element, count = np.unique(key, return_inverse=True, return_counts=True)
    shared = count[element.reshape(-1)] > 1
    _, element = np.unique(element.reshape(-1)[shared], return_inverse=True)
    element, unit, owner = element.reshape(-1), unit[shared], owner[shared]
    order = np.argsort(element, kind="stable")
    element, unit, owner = element[order], unit[order], owner[order]
    common = np.zeros((n, n))
    last = int(element[-1]) + 1 if len(element) else 0
    for low in range(0, last, columns):
        a, b = np.searchsorted(element, [low, low + columns])
        m = np.zeros((n, min(columns, last - low)))
        m[owner[a:b], element[a:b] - low] = np.sqrt(unit[a:b])
        common += m @ m.T
    high = total[:, None] + total[None, :] - common
    return np.divide(common, high, out=np.zeros_like(common), where=high > 0)


def grouped(linked: np.ndarray) -> np.ndarray:
    """For each node of a symmetric boolean matrix, the smallest node that it is connected with."""
    label = np.arange(len(linked))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(label)).min(1, initial=len(label)))
        new = new[new]
        if (new == label).all():
            return label
        label = new


class Sampler:
    """k consistent weighted samples. The gamma and uniform numbers of a shingle and sample come from tables that its hash points into."""

    def __init__(self, k: int, seed: int = 17):
        rng = np.random.default_rng(seed)
        self.k = k
        self.r = rng.gamma(2.0, 1.0, _TABLE)
        self.log_c = np.log(rng.gamma(2.0, 1.0, _TABLE))
        self.beta = rng.random(_TABLE)
        self.turn = rng.integers(1, 2**63, (3, k), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def samples(self, hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One row of k numbers for each text; text i has the shingles from starts[i] up to the next. No text is empty."""
        out = np.empty((len(starts), self.k), np.int32)
        log_w, shift = np.log(weights), np.uint64(48)
        owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(hashes))))
        with np.errstate(over="ignore"):
            for i in range(self.k):
                r = self.r[(hashes * self.turn[0, i]) >> shift]
                b = self.beta[(hashes * self.turn[1, i]) >> shift]
                t = np.floor(log_w / r + b)
                a = self.log_c[(hashes * self.turn[2, i]) >> shift] - r * (t - b) - r
                low = np.minimum.reduceat(a, starts)
                at = np.flatnonzero(a == low[owner])
                first = at[np.searchsorted(owner[at], np.arange(len(starts)))]
                # a sample is the shingle and the quantised weight
                s = (hashes[first] + t[first].astype(np.int64).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
                out[:, i] = (s >> np.uint64(32)).astype(np.uint32).view(np.int32)
        return out
