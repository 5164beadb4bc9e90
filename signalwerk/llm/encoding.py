"""Whole texts to token ids, exactly as the tokenizers library gives them, a batch of texts at a time in Arrow and numpy.

A text is cut in front of each space and line end. Neither of the two public vocabularies lets a token reach over such a place, unless white
space lies on both sides of it, so the ids of a text are those of its stretches, one after another. A batch's distinct stretches are looked
up once. New ones that are a Latin word, with a line end before or a full stop or comma after it or not, are merged by the vocabulary's
rules, many words at a time; all others go to the library. Texts with wide white space are cut with care, those with rare white space not
at all.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
STRETCH = re.compile(rf"[ \t\r\n]*(?:[{LATIN}]+(?=[.,]|[ \t\r\n]|$)|[^ \t\r\n]+)|[ \t\r\n]+")
FORM = re.compile(rf"(\n?)( ?[{LATIN}]{{1,64}})([.,]?)")
RARE = "[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]"
RARE_SPACE = re.compile(RARE)
NONE = np.int32(2**31 - 1)


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves, the others follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    more = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(more)) for b in range(256)]


class PairTable:
    """From pairs of ids to ranks, for whole arrays: a hash table, and a sorted table for pairs that share a place in it."""

    BITS = 18

    def __init__(self, pairs: np.ndarray, width: int):
        self.width = np.uint64(width)
        keys = pairs[:, 0].astype(np.uint64) * self.width + pairs[:, 1].astype(np.uint64)
        places = self.place(keys)
        self.keys, self.ranks = np.full(1 << self.BITS, 2**64 - 1, np.uint64), np.full(1 << self.BITS, NONE, np.int32)
        self.keys[places], self.ranks[places] = keys, np.arange(len(keys), dtype=np.int32)
        self.shared = np.bincount(places, minlength=1 << self.BITS) > 1
        order = np.argsort(keys)
        self.sorted, self.order = keys[order], order.astype(np.int32)

    def place(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.uint64) * self.width + right.astype(np.uint64)
        places = self.place(keys)
        out = np.where(self.keys[places] == keys, self.ranks[places], NONE)
        again = np.flatnonzero((out == NONE) & self.shared[places])
        if len(again):
            at = np.minimum(np.searchsorted(self.sorted, keys[again]), len(self.sorted) - 1)
            out[again] = np.where(self.sorted[at] == keys[again], self.order[at], NONE)
        return out


class Merges:
    """The merge rules of a byte-level vocabulary, applied to many words at once."""

    def __init__(self, model: dict, lower: bool):
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        self.table = PairTable(np.array([[vocab[a], vocab[b]] for a, b in pairs], np.int64), len(vocab))
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.inner = np.array([vocab[x] for x in byte_letters()], np.int32)
        self.last = np.array([vocab[x + suffix] for x in byte_letters()], np.int32)
        self.lower = lower

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after another, and how many each has. No word is empty."""
        raw = [x.encode() for x in ((w.strip().lower() for w in words) if self.lower else words)]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        letters = np.frombuffer(b"".join(raw), np.uint8)
        end = np.cumsum(size)
        parts = self.inner[letters]
        parts[end - 1] = self.last[letters[end - 1]]
        which, done = np.arange(len(raw)), []
        while len(which):
            start = end - size
            rank = np.full(len(parts), NONE, np.int32)
            if len(parts) > 1:
                rank[:-1] = self.table.ranks_of(parts[:-1], parts[1:])
            rank[end - 1] = NONE
            low = np.minimum.reduceat(rank, start)
            over = low == NONE
            if over.any():
                gone = np.repeat(over, size)
                done.append((which[over], size[over], parts[gone]))
                parts, rank, which, size, low = parts[~gone], rank[~gone], which[~over], size[~over], low[~over]
            if not len(which):
                break
            word = np.repeat(np.arange(len(which)), size)
            at = np.flatnonzero(rank == low[word])
            if len(at) > 1:  # of overlapping equal pairs, every other one is joined, from the left
                begins = np.concatenate([[True], np.diff(at) != 1])
                nth = np.arange(len(at)) - np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
                at = at[nth % 2 == 0]
            parts[at] = self.made[rank[at]]
            keep = np.ones(len(parts), bool)
            keep[at + 1] = False
            size = size - np.bincount(word[at], minlength=len(which))
            parts, end = parts[keep], np.cumsum(size)
        if not done:
            return np.zeros(0, np.uint32), size
        which, size, parts = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(which)
        return ragged(parts, np.cumsum(size)[order] - size[order], size[order]).astype(np.uint32), size[order]


def ragged(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, some: int = 1 << 20) -> np.ndarray:
    """values[start : start + size] of all starts and sizes, one after another; index arrays stay small, whatever the length."""
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]) if len(ends) else 0, values.dtype)
    for low in range(0, len(starts), some):
        s, n = starts[low : low + some], sizes[low : low + some]
        first, last = int(ends[low] - sizes[low]), int(ends[min(low + some, len(ends)) - 1])
        out[first:last] = values[np.repeat(s - (np.cumsum(n) - n), n) + np.arange(last - first)]
    return out


class StretchEncoder:
    """Keeps the ids of about `limit` stretches of up to `longest` characters."""

    def __init__(self, path: str, limit: int = 300_000, longest: int = 48):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.limit, self.longest = Tokenizer.from_file(path), limit, longest
        told = json.loads(self.tokenizer.to_str())
        lower = "Lowercase" in json.dumps(told["normalizer"])
        self.merges = Merges(told["model"], lower)
        special = "".join(f"|{re.escape(x['content'])}" for x in told["added_tokens"])
        self.careful = rf"[ \t\r\n][ \n](?:[ \t\r\n]|\z)|{RARE}{special}"
        self.marks = {x: np.array(self.tokenizer.encode(x, add_special_tokens=False).ids, np.uint32) for x in ("\n", ".", ",")}
        self.clear()

    def narrow(self, end: int) -> bool:
        """Whether all ids, and the end id, fit in 16 bits."""
        return max(end, self.tokenizer.get_vocab_size(with_added_tokens=True) - 1) < 1 << 16

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.start, self.size, self.ids = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(8192, np.uint32)
        self.held = self.used = 0

    def store(self, ids: np.ndarray, size: np.ndarray) -> None:
        """Keep the ids of further stretches."""
        n, m = self.held + len(size), self.used + len(ids)
        if n > len(self.start):
            self.start, self.size = np.resize(self.start, 2 * n), np.resize(self.size, 2 * n)
        if m > len(self.ids):
            self.ids = np.resize(self.ids, 2 * m)
        self.start[self.held : n], self.size[self.held : n] = self.used + np.cumsum(size) - size, size
        self.ids[self.used : m] = ids
        self.held, self.used = n, m

    def learn(self, new: list[str]) -> None:
        forms = list(map(FORM.fullmatch, new))
        easy = [x for x, m in zip(new, forms, strict=True) if m]
        if easy:
            ids, size = self.merges.ids([m[2] for m in forms if m])
            line, ends = np.array([x[0] == "\n" for x in easy]), [x[-1] for x in easy]
            stop = {x: np.array([y == x for y in ends]) for x in ".,"}
            before = line * len(self.marks["\n"])
            after = sum(stop[x] * len(self.marks[x]) for x in ".,")
            whole = before + size + after
            start = np.cumsum(whole) - whole
            out = np.empty(int(whole.sum()), np.uint32)
            out[ragged_places(start + before, size)] = ids
            for mark, at in (("\n", start[line]), *((x, (start + before + size)[stop[x]]) for x in ".,")):
                for k, i in enumerate(self.marks[mark]):
                    out[at + k] = i
            self.number.update(zip(easy, range(self.held, self.held + len(easy)), strict=True))
            self.store(out, whole)
        rest = [x for x, m in zip(new, forms, strict=True) if not m]
        if rest:
            got = [x.ids for x in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
            self.number.update(zip(rest, range(self.held, self.held + len(rest)), strict=True))
            self.store(np.array([i for x in got for i in x], np.uint32), np.fromiter(map(len, got), np.int64, len(got)))

    def stretches(self, texts):
        """A list of stretches for each text, as an Arrow list array."""
        import pyarrow as pa
        import pyarrow.compute as pc

        careful = pc.match_substring_regex(texts, self.careful)
        plain = texts.filter(pc.invert(careful)) if pc.any(careful).as_py() else texts
        for x in " \n":
            plain = pc.replace_substring(plain, x, f"\x1f{x}")
        cut = pc.split_pattern(plain, "\x1f")
        if plain is texts or len(cut) == len(texts):
            return cut
        odd = [[x] if RARE_SPACE.search(x) else STRETCH.findall(x) for x in texts.filter(careful).to_pylist()]
        mask = np.asarray(careful)
        order = np.empty(len(mask), np.int64)
        order[~mask], order[mask] = np.arange(len(cut)), len(cut) + np.arange(len(odd))
        return pa.concat_arrays([cut, pa.array(odd, cut.type)]).take(pa.array(order))

    def encode_flat(self, texts, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of an Arrow array, one after another, each followed by `end` if given, and len(texts) + 1 offsets."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts.cast(pa.string()), "")
        if len(self.number) > self.limit or self.used > 16 * self.limit:
            self.clear()
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        cut = self.stretches(texts)
        coded = cut.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # much faster than to_pylist()
        found = list(map(self.number.get, distinct))
        new = [x for x, n in zip(distinct, found, strict=True) if n is None]
        if new:
            self.learn(new)
            found = map(self.number.__getitem__, distinct)
        numbers = np.fromiter(found, np.int64, len(distinct))[np.asarray(coded.indices)]
        offsets = np.asarray(cut.offsets, np.int64)
        offsets = offsets - offsets[0]
        if end is not None:
            self.store(np.array([end], np.uint32), np.ones(1, np.int64))
            numbers = np.insert(numbers, offsets[1:], self.held - 1)
            offsets = offsets + np.arange(len(offsets))
        for x in new:
            if len(x) > self.longest:
                del self.number[x]
        size = self.size[numbers]
        ends = np.concatenate([[0], np.cumsum(size)])
        return ragged(self.ids, self.start[numbers], size), ends[offsets]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        import pyarrow as pa

        ids, at = self.encode_flat(pa.array(texts, pa.string()))
        return [ids[a:b].astype("<u4").tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]


def ragged_places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


_encoders: dict[str, StretchEncoder] = {}


def encoder(path: str) -> StretchEncoder:
    """One for each file and Python worker; a worker keeps it from task to task."""
    if path not in _encoders:
        _encoders[path] = StretchEncoder(path)
    return _encoders[path]
