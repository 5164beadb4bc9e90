"""Best-fit packing by bin completion.

Only the histogram of piece lengths (at most `capacity` rows, however many documents there are) is gathered. Best-fit
decreasing on it is the first incumbent. Unless it meets the lower bound, bin completion goes on: around the largest length left it
enumerates the undominated fillings, those with least waste first, and prunes a branch whose bins so far plus a lower bound on the rest
reach the incumbent. A filling is used as often as its lengths last, then less often, so a plan has a few thousand rows. Each piece then
finds its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import stored
from .common import slices, text_or_empty, tokenizer_path

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
Pattern = tuple[tuple[int, ...], int]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: for each threshold, pieces too large to share a bin, and room left for the smaller ones."""
    best = -(-sum(n * c for n, c in counts.items()) // capacity)
    large = {n: c for n, c in counts.items() if 2 * n > capacity}
    for k in {0, *(n for n in counts if 2 * n <= capacity)}:
        alone = sum(c for n, c in large.items() if n > capacity - k)
        shared = [(n, c) for n, c in large.items() if n <= capacity - k]
        small = sum(n * c for n, c in counts.items() if k <= n and 2 * n <= capacity)
        room = sum((capacity - n) * c for n, c in shared)
        best = max(best, alone + sum(c for _, c in shared) + max(0, -(-(small - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on the histogram: a piece goes into the fullest bin that has room for it, the largest pieces first."""
    rooms: list[int] = []  # of open bins, sorted
    bins: dict[int, list[Pattern]] = {}  # by room
    for x in sorted(counts, reverse=True):
        c = counts[x]
        while c:
            i = bisect_left(rooms, x)
            room = rooms[i] if i < len(rooms) else capacity
            taken, n = bins[room].pop() if i < len(rooms) else ((), c)
            each = min(room // x, c)
            times = min(n, c // each)
            c -= times * each
            if i < len(rooms) and times < n:
                bins[room].append((taken, n - times))
            if i < len(rooms) and not bins[room]:
                del rooms[i], bins[room]
            rest = room - each * x
            if rest not in bins:
                insort(rooms, rest)
            bins.setdefault(rest, []).append((taken + (x,) * each, times))
    return [p for found in bins.values() for p in found]


class Search:
    """The pieces left, and the fillings used so far, of one branch; steps are taken and taken back in place."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left, self.capacity = dict(counts), capacity
        self.lengths = sorted(counts)  # those that are left
        self.total, self.bins, self.key = sum(n * c for n, c in counts.items()), 0, 0
        rnd = random.Random(7)
        self.turn = {n: rnd.getrandbits(128) for n in self.lengths}  # `key` tells multisets of pieces apart

    def step(self, whole: tuple[int, ...], times: int) -> None:
        """Fills `times` bins; less than none empties them again."""
        for x in set(whole):
            before, n = self.left[x], times * whole.count(x)
            self.left[x] = before - n
            if not before:
                insort(self.lengths, x)
            elif before == n:
                del self.lengths[bisect_left(self.lengths, x)]
            self.total -= n * x
            self.key -= n * self.turn[x]
        self.bins += times

    def dominated(self, largest: int, taken: tuple[int, ...], waste: int) -> bool:
        """Whether a filling can take one piece more, or a piece left over for a smaller one or for two: then that filling is as good."""
        used = Counter((largest, *taken))

        def any_left(low: int, high: int) -> bool:
            i = bisect_left(self.lengths, low)
            while i < len(self.lengths) and self.lengths[i] <= high:
                if self.left[self.lengths[i]] > used[self.lengths[i]]:
                    return True
                i += 1
            return False

        if any_left(1, waste):
            return True
        sizes = sorted(set(taken))
        if any(any_left(x + 1, x + waste) for x in sizes):
            return True
        pairs = {x + y for i, x in enumerate(sizes) for y in sizes[i:] if x != y or taken.count(x) > 1}
        return any(any_left(s, s + waste) for s in pairs)

    def likely(self, largest: int, room: int, width: int = 4) -> list[tuple[int, ...]]:
        """Some fillings beside `largest` of large pieces, least waste first: what is tried first."""
        out: set[tuple[int, ...]] = set()
        lengths = self.lengths

        def spare(x: int, taken: tuple[int, ...]) -> int:
            return self.left[x] - taken.count(x) - (x == largest)

        def extend(taken: tuple[int, ...], room: int, most: int, depth: int) -> None:
            i, tried = bisect_right(lengths, min(room, most)) - 1, 0
            while i >= 0 and tried < (width if depth < 2 else 1):
                x = lengths[i]
                if n := min(spare(x, taken), room // x if depth >= 2 else 1):
                    tried += 1
                    extend(taken + (x,) * n, room - n * x, x, depth + 1)
                i -= 1
            if not tried:
                out.add(taken)

        extend((), room, room, 0)
        for x in reversed(lengths[: bisect_right(lengths, room)]):  # two pieces that fill the room exactly
            y = room - x
            if y > x:
                break
            if self.left.get(y, 0) and spare(x, ()) > 0 and spare(y, (x,)) > 0:
                out.add((x, y))
                break
        return sorted(out, key=lambda t: (room - sum(t), len(t), t))

    def every(self, lengths: list[int], largest: int, room: int) -> Iterator[tuple[int, ...]]:
        """Every filling beside `largest` that has no room for a smaller piece, those of large pieces first."""

        def extend(taken: tuple[int, ...], room: int, end: int) -> Iterator[tuple[int, ...]]:
            i, full = bisect_right(lengths, room, 0, end) - 1, True
            while i >= 0:
                x = lengths[i]
                for n in range(min(self.left[x] - (x == largest), room // x), 0, -1):
                    full = False
                    yield from extend(taken + (x,) * n, room - n * x, i)
                i -= 1
            if full:
                yield taken

        yield from extend((), room, len(lengths))

    def options(self) -> Iterator[Pattern | None]:
        """All steps around the largest piece left: the undominated fillings, each as often as pieces last, and less often.

        None stands for a dominated filling, which costs time as well. The search is as it was whenever it asks for the next option."""
        largest = self.lengths[-1]
        room = self.capacity - largest

        def most(taken: tuple[int, ...]) -> int:
            whole = (largest, *taken)
            return min(self.left[x] // whole.count(x) for x in set(whole))

        def fewer(taken: tuple[int, ...]) -> Iterator[Pattern]:
            n = most(taken) // 2
            while n:
                yield (largest, *taken), n
                n //= 2

        first = [t for t in self.likely(largest, room) if not self.dominated(largest, t, room - sum(t))]
        for t in first:
            yield (largest, *t), most(t)
        for t in first:
            yield from fewer(t)
        known = set(first)
        for t in self.every(list(self.lengths), largest, room):
            if t in known:
                continue
            if self.dominated(largest, t, room - sum(t)):
                yield None
            else:
                yield (largest, *t), most(t)
                yield from fewer(t)


def plan(counts: dict[int, int], capacity: int, nodes: int = 4000) -> list[Pattern]:
    """Fillings and how many bins have each, for all pieces of a histogram {length: pieces}. It is optimal if it meets lower_bound or the
    search ends; the search ends early after `nodes` nodes, or 16 times as many options looked at, from the first
    incumbent on, which best_fit gives."""
    counts = {n: c for n, c in counts.items() if c > 0}
    best = best_fit(counts, capacity)
    bound, best_bins, seen, asked = lower_bound(counts, capacity), sum(n for _, n in best), 0, 0
    if best_bins <= bound:
        return best
    limit, cut = 1, True
    while cut and best_bins > bound and seen < nodes and asked < 16 * nodes:
        # a pass leaves a branch that departs more than `limit` times from what is tried first, so the nodes are spread over all depths
        cut, at, so_far = False, Search(counts, capacity), []
        reached: dict[int, tuple[int, int]] = {}  # bins and departures left with which a multiset of pieces left was reached
        stack = [[at.options(), limit, 0]]
        while stack and best_bins > bound and seen < nodes and asked < 16 * nodes:
            options, spare, tried = stack[-1]
            option = next(options, stack) if tried == 0 or spare else None
            if option is stack or (option is None and not spare):
                cut |= option is None
                stack.pop()
                if so_far:
                    whole, times = so_far.pop()
                    at.step(whole, -times)
                continue
            asked += 1
            if option is None:
                continue
            spare -= tried > 0
            stack[-1][2] += 1
            at.step(*option)
            if not at.lengths and at.bins < best_bins:
                best, best_bins = [*so_far, option], at.bins
            before = reached.get(at.key, (best_bins, 0))
            if at.bins + -(-at.total // capacity) >= best_bins or (before[0] <= at.bins and before[1] >= spare):
                at.step(option[0], -option[1])
                continue
            reached[at.key] = at.bins, spare
            seen += 1
            so_far.append(option)
            stack.append([at.options(), spare, 0])
        limit *= 2
    return best


def pieces(docs: DataFrame, capacity: int, vocabulary: str, end_id: int) -> DataFrame:
    """Token counts and checksums of each document's pieces; a document is its ids and then end_id."""

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from .encoding import encoder

        enc = encoder(tokenizer_path(vocabulary))
        for batch in batches:
            for part in slices(batch, rows=8192, size=2_000_000):
                ids, at = enc.encode_flat(part.column("text"), end_id)
                raw, size = memoryview(ids.astype("<u4", copy=False)).cast("B"), np.diff(at)
                n = -(-size // capacity)
                which = np.repeat(np.arange(len(size)), n)
                piece = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(capacity, size[which] - start)
                first = 4 * (at[which] + start)
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(first.tolist(), (first + 4 * length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(which)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(cut, PIECES)


def pack(docs: DataFrame, capacity: int = 2048, vocabulary: str = "word_bpe_49k.json", end_id: int = 0, nodes: int = 4000) -> DataFrame:
    """Documents (doc_id, text) packed into sequences of at most `capacity` tokens.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null text is empty: one piece that holds
    end_id. Null and repeated doc_ids are packed row by row. An empty table gives no rows. Extra columns are ignored.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, capacity, vocabulary, end_id), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    rows, first, used = [], 0, dict.fromkeys(counts, 0)
    for whole, times in plan(counts, capacity, nodes):
        offset = 0
        for x in whole:
            rows.append((x, used[x], used[x] + times, first - used[x], offset))
            used[x] += times
            offset += x
        first += times
    # for each length, ranks lie in as many steps as fillings have it, so a step meets few of them
    step = {x: max(1, -(-counts[x] // n)) for x, n in Counter(r[0] for r in rows).items()}
    places = spark.createDataFrame([(x, step[x], *r) for x, *r in rows], "length long, step long, rank_from long, rank_to long, sequence_shift long, offset long")
    places = places.withColumn("nth", F.explode(F.sequence(F.floor(F.col("rank_from") / F.col("step")), F.floor((F.col("rank_to") - 1) / F.col("step")))))
    steps = F.broadcast(spark.createDataFrame(list(step.items()), "length long, step long"))  # at most `capacity` rows
    salts = max(1, min(4096, sum(counts.values()) // 2000 + 1))
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = before.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1
    ranked = salted.withColumn("within", within).join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("within"))
    ranked = ranked.join(steps, "length").withColumn("nth", F.floor(F.col("rank") / F.col("step")))
    p, r = places.drop("step").alias("p"), ranked.alias("r")
    # a plan has a row per filling and length, however many documents there are; a long one is joined by a shuffle
    p = F.broadcast(p) if len(rows) <= 200_000 else p
    placed = r.join(p, (F.col("r.length") == F.col("p.length")) & (F.col("r.nth") == F.col("p.nth")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")))
    return placed.select("doc_id", "piece", "start", "r.length", "ids_crc32", (F.col("rank") + F.col("sequence_shift")).alias("sequence_id"), "p.offset")
