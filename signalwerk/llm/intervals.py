"""Repeated strings of a bounded block of texts: suffix array, Burrows-Wheeler transform and interval expansion, in numpy.

Every string of the block is an interval of its sorted suffixes. Putting a byte in front of all strings of length l gives the intervals of
length l + 1 from the transform alone. Going through lengths in increasing order, a border between suffixes that no shorter string has
set is a longest common prefix of l. Expansion stops at the length asked for: the borders left unset lie between suffixes that share more.
"""

from __future__ import annotations

import numpy as np

UNSET = np.iinfo(np.int32).max


class Block:
    """Texts (bytes, not empty) one after another, each with an end mark of its own; `order` sorts their suffixes by the first `depth` bytes or more."""

    def __init__(self, texts: list[bytes], depth: int):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(sizes + 1) - 1  # where the end marks are
        self.starts = self.ends - sizes
        raw = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
        used = np.zeros(256, bool)
        used[raw] = True
        if used.all():
            raise ValueError("texts use all 256 byte values, so they are not UTF-8")
        code = np.cumsum(used).astype(np.uint8)  # from 1 on, as 0 marks an end
        self.symbols = code[raw]
        self.symbols[self.ends] = 0
        self.left = np.repeat(self.ends, sizes + 1) - np.arange(len(raw))  # bytes before the own end mark
        self.order = self.sorted(depth)

    def sorted(self, depth: int) -> np.ndarray:
        """Prefix doubling from 8 bytes on. Only suffixes in groups of two or more are sorted again."""
        n = len(self.symbols)
        padded = np.concatenate((self.symbols, np.zeros(8, np.uint8)))
        packed = np.ndarray((n,), ">u8", padded.tobytes(), strides=(1,)).astype(np.uint64)
        mask = np.array([0, *(((1 << 8 * k) - 1) << (64 - 8 * k) for k in range(1, 9))], np.uint64)
        packed &= mask[np.minimum(self.left, 8)]
        order = np.argsort(packed, kind="stable")
        head = np.ones(n, bool)  # no two suffixes that reach their end marks are equal
        same = packed[order]
        head[1:] = (same[1:] != same[:-1]) | (self.left[order[1:]] < 8)
        rank = np.empty(n, np.int64)
        rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        have = 8
        while have < depth:
            open_at = np.flatnonzero(~(head & np.append(head[1:], True)))
            if not len(open_at):
                break
            suffixes = order[open_at]
            key = (rank[suffixes] << 32) | rank[suffixes + have]
            by = np.argsort(key)
            key = key[by]
            order[open_at] = suffixes = suffixes[by]
            head[open_at[1:]] = key[1:] != key[:-1]
            head[open_at[0]] = True
            rank[suffixes] = np.maximum.accumulate(np.where(head[open_at], open_at, 0))
            have *= 2
        return order

    def common_prefixes(self, least: int) -> np.ndarray:
        """For each border between neighbouring suffixes (and both outer ones) how many bytes they share, UNSET where `least` or more."""
        n, ends = len(self.symbols), len(self.ends)
        before = self.symbols[self.order - 1]  # the transform; an end mark stands before each first byte
        by = np.argsort(before, kind="stable")
        mapped = np.empty(n, np.int64)  # of suffix i, the place of the suffix with one byte more in front
        mapped[by] = np.arange(n)
        letter = before[by]
        following, preceding = np.full(n, n, np.int64), np.full(n, -1, np.int64)  # the next and last suffix with the same byte in front
        same = letter[1:] == letter[:-1]
        following[by[:-1][same]] = by[1:][same]
        preceding[by[1:][same]] = by[:-1][same]
        shared = np.full(n + 1, UNSET, np.int32)
        # strings of length 1: each end mark, and each byte value
        firsts = np.flatnonzero(np.append(True, letter[1:] != letter[:-1]))
        low = np.concatenate((np.arange(ends), firsts[letter[firsts] > 0]))
        high = np.append(low[1:], n)
        shared[0] = shared[high] = 0
        for length in range(1, least):
            if not len(low):
                break
            size = high - low
            at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
            real = before[at] > 0
            last = at[real & (following[at] >= np.repeat(high, size))]
            first = at[real & (preceding[at] < np.repeat(low, size))]
            # the new intervals are disjoint, so sorted starts and ends belong together
            low, high = np.sort(mapped[first]), np.sort(mapped[last]) + 1
            new = shared[high] == UNSET
            low, high = low[new], high[new]
            shared[high] = length
        return shared


def repeated(texts: list[bytes], weights: np.ndarray, least: int) -> list[list[tuple[int, int]]]:
    """Of each text, the maximal ranges covered by strings of `least` bytes that start at another place of the block, too.

    A text with a weight above 1 stands for as many equal ones, so all its strings start elsewhere."""
    block = Block(texts, least)
    shared = block.common_prefixes(least)
    twin = (shared[:-1] == UNSET) | (shared[1:] == UNSET)
    hit = np.zeros(len(block.symbols), bool)
    hit[block.order[twin]] = True
    hit |= (np.repeat(weights, block.ends - block.starts + 1) > 1) & (block.left >= least)
    at = np.flatnonzero(hit)
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    if len(at):
        new = np.flatnonzero(np.append(True, at[1:] > at[:-1] + least))
        low, high = at[new], at[np.append(new[1:], len(at)) - 1] + least
        owner = np.searchsorted(block.ends, low)
        for i, a, b in zip(owner.tolist(), (low - block.starts[owner]).tolist(), (high - block.starts[owner]).tolist(), strict=True):
            found[i].append((a, b))
    return found
