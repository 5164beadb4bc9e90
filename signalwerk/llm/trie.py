"""The prefix trie of conversations, from sorted sequences of turns.

Conversations are sorted over all partitions by the hashes of their turns and cut into blocks of bounded size. In a block, a sparse table
over the common prefixes of neighbours answers range minima, and every candidate prefix searches its left and right extent by halving, each
by itself: that is the interval of its members in the block. Whatever a node needs is a sum or a minimum over blocks, so nodes that span
blocks meet by aggregation. What blocks cannot see, the common prefix of one's last and the next one's first sequence, is put right from a
row per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import stored
from .common import dealt_join

TURN = "struct<h1:long,h2:long,chars:long>"
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
EMPTY = hashlib.sha256().hexdigest()


def rebuilt(conversations: DataFrame, group: int = 100, shared: int = 6) -> DataFrame:
    """conv_id and turns: the first h turns of the conversation that begins its group, then its own after its first h; h = crc32(conv_id) % shared.

    A turn is two hashes of role and text and the text's code points. Turns are ordered by (turn, role, text), null first; null role and text
    are empty; equal rows are two turns. Rows without conv_id belong to no conversation. A conversation is one row of 24 bytes a turn.
    """
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    turn = F.struct(F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("second"), "role", "text").alias("h2"), F.length("text").cast("long").alias("chars"))
    own = rows.select("conv_id", place.alias("place"), turn.alias("turn"))
    each = own.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "turn"))), lambda x: x["turn"]).alias("own"))
    each = stored(each, "turns").withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % shared).cast("int")).withColumn("of", F.col("conv_id") - F.col("conv_id") % group)
    first = each.filter(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("of"), F.slice("own", 1, shared - 1).alias("first"))
    none = F.array().cast(f"array<{TURN}>")
    # at most 2 * group conversations have the same first one
    lead = F.coalesce(F.when(F.col("h") > 0, F.slice("first", 1, F.col("h"))), none)
    rest = F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0)))
    return each.join(first, "of", "left").select("conv_id", F.concat(lead, rest).alias("turns"))


class Minima:
    """Range minima in constant time: of each power of two, the minimum of as many entries from each place on."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 2 ** len(self.rows) <= len(values):
            half, last = 2 ** (len(self.rows) - 1), self.rows[-1]
            self.rows.append(np.minimum(last[:-half], last[half:]))

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """For each place the first place from which on all entries up to it are at least `depth`; the place after it if its own is not."""
        at = at + 1
        for k in range(len(self.rows) - 1, -1, -1):
            row, start = self.rows[k], at - 2**k
            go = (start >= 0) & (row[np.maximum(start, 0)] >= depth)
            at = np.where(go, start, at)
        return at

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """For each place the place after the last one up to which all entries from it on are at least `depth`."""
        at = at.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            row = self.rows[k]
            go = (at < len(row)) & (row[np.minimum(at, len(row) - 1)] >= depth)
            at = np.where(go, at + 2**k, at)
        return at


def keys_of(h: np.ndarray, start: np.ndarray, which: int) -> np.ndarray:
    """Keys of all prefixes of sequences that follow each other in h, from the one without turns on: sequence i has its len + 1 from start[i] + i on."""
    n = len(start) - 1
    size = np.diff(start)
    depth = np.arange(len(h)) - np.repeat(start[:-1], size)
    power = np.ones(int(size.max(initial=0)) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.multiply.accumulate(np.append(np.uint64(1), np.repeat(_MIX[which], len(power) - 1)), out=power)
        total = np.append(np.uint64(0), np.cumsum(h * power[depth + 1]))
        at = np.arange(len(h) + n) - np.repeat(np.arange(n), size + 1)  # in total
        return (total[at] - np.repeat(total[start[:-1]], size + 1)).view(np.int64)


def block(convs: np.ndarray, start: np.ndarray, h1: np.ndarray, h2: np.ndarray, chars: np.ndarray) -> tuple[list[np.ndarray], list[tuple]]:
    """What sorted conversations tell of their nodes, as if no other block were; conversation i has the turns from start[i] to start[i + 1].

    Columns depth, k1, k2, p1, p2 (keys of the node and its parent), n_convs, conv_id, n_children, n_leaves, saved_tokens, in the order of the
    nodes' first members; and depth, k1, k2 and conversations of each distinct sequence."""
    n, size = len(convs), np.diff(start)
    # common prefix of each sequence with the one before it; -1 at the first
    shared = np.full(n, -1)
    reach = np.minimum(size[1:], size[:-1])
    begin = np.cumsum(reach) - reach
    at = np.repeat(start[1:-1] - begin, reach) + np.arange(reach.sum())
    before = at - np.repeat(size[:-1], reach)
    differ = np.append(np.flatnonzero((h1[at] != h1[before]) | (h2[at] != h2[before])), len(at))
    shared[1:] = np.minimum(differ[np.searchsorted(differ, begin)] - begin, reach)
    new = np.flatnonzero((shared < size) | (np.append(-1, size[:-1]) != size))  # sequences that differ from the one before
    # each prefix of each distinct sequence searches its extents
    own = np.repeat(new, size[new] + 1)
    depth = np.arange(len(own)) - np.repeat(np.cumsum(size[new] + 1) - size[new] - 1, size[new] + 1)
    minima = Minima(shared)
    left, right = minima.left(own, depth) - 1, minima.right(own + 1, depth)  # members from left up to before right
    first = left == own  # a node once, in the order of (left, depth)
    left, right, depth = left[first], right[first], depth[first]
    members = right - left
    keys = [keys_of(h, start, i) for i, h in enumerate((h1.view(np.uint64), h2.view(np.uint64)))]
    at = start[left] + left + depth
    parent = np.maximum(at - 1, 0)
    # texts from the node's own turn on: of all members, less those of distinct nodes
    text = np.append(0, np.cumsum(chars))
    whole = text[start[1:]] - text[start[:-1]]
    ahead = text[start[left] + np.maximum(depth - 1, 0)] - text[start[left]]
    all_texts, fresh = np.append(0, np.cumsum(whole)), np.append(0, np.cumsum(text[start[1:]] - text[start[:-1] + np.maximum(shared, 0)]))
    saved = all_texts[right] - all_texts[left] - members * ahead - (fresh[right] - fresh[left + 1] + whole[left] - ahead)
    # children: the nodes one turn deeper
    wide = int(size.max(initial=0)) + 1
    below = depth > 0
    up = (minima.left(left[below], depth[below] - 1) - 1) * wide + depth[below] - 1
    children = np.bincount(np.searchsorted(left * wide + depth, up), minlength=len(left))
    # leaves: sequences that the next one does not go on
    last = np.append(new[1:], n) - 1
    leaf = np.zeros(n + 1, np.int64)
    leaf[new + 1] = np.append(shared[last[:-1] + 1], -1) < size[new]
    leaves = np.cumsum(leaf)
    least, power = Minima(convs), np.log2(members).astype(np.int64)
    smallest = np.zeros(len(left), np.int64)
    for k in np.unique(power):
        of = power == k
        smallest[of] = np.minimum(least.rows[k][left[of]], least.rows[k][right[of] - 2**k])
    nodes = [depth, keys[0][at], keys[1][at], keys[0][parent], keys[1][parent], members, smallest, children, leaves[right] - leaves[left], saved]
    end = start[new] + new + size[new]
    ends = [(d, a, b, convs[i:k]) for d, a, b, i, k in zip(size[new].tolist(), keys[0][end].tolist(), keys[1][end].tolist(), new.tolist(), (last + 1).tolist(), strict=True)]
    return nodes, ends


SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
NODE = "depth long, k1 long, k2 long, p1 long, p2 long, n_convs long, conv_id long, n_children long, n_leaves long, saved_tokens long"
PARTS = f"{NODE}, part int, block int, ends binary, first array<{TURN}>, last array<{TURN}>"


def blocks(sequences: DataFrame, most_convs: int, most_turns: int) -> DataFrame:
    """Rows of three kinds from conversations sorted over all partitions: sums of a block's nodes; with `ends`, the conversations that
    end at a node, as decimals with commas; with part and block alone, a block's first and last sequence."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        turn = pa.struct([("h1", pa.int64()), ("h2", pa.int64()), ("chars", pa.int64())])
        names = [x.split()[0] for x in NODE.split(", ")]
        kinds = {**dict.fromkeys(names, pa.int64()), "part": pa.int32(), "block": pa.int32(), "ends": pa.binary(), "first": pa.list_(turn), "last": pa.list_(turn)}
        part, number = TaskContext.get().partitionId(), 0

        def table(n: int, **some):
            return pa.RecordBatch.from_arrays([pa.array(some[c], t) if c in some else pa.nulls(n, t) for c, t in kinds.items()], names=list(kinds))

        def done(held: list):
            both = pa.Table.from_batches(held).combine_chunks()
            convs, turns = both.column("conv_id").chunk(0).to_numpy(), both.column("turns").chunk(0)
            start, flat = turns.offsets.to_numpy().astype(np.int64), turns.flatten()
            nodes, ends = block(convs, start - start[0], *(flat.field(c).to_numpy() for c in ("h1", "h2", "chars")))
            yield table(len(nodes[0]), **dict(zip(names, nodes, strict=True)))
            for i in range(0, len(ends), 10_000):
                some = ends[i : i + 10_000]
                yield table(len(some), depth=[x[0] for x in some], k1=[x[1] for x in some], k2=[x[2] for x in some], conv_id=[int(x[3][0]) for x in some], ends=[",".join(map(str, x[3].tolist())).encode() for x in some])
            yield table(1, part=[part], block=[number], first=turns.slice(0, 1).to_pylist(), last=turns.slice(len(turns) - 1).to_pylist())

        held, n_convs, n_turns, step = [], 0, 0, min(2048, most_convs)
        for batch in batches:
            for i in range(0, batch.num_rows, step):
                some = batch.slice(i, step)
                if n_convs >= most_convs or n_turns >= most_turns:
                    yield from done(held)
                    held, n_convs, n_turns, number = [], 0, 0, number + 1
                held.append(some)
                n_convs, n_turns = n_convs + some.num_rows, n_turns + len(some.column("turns").flatten())
        if held:
            yield from done(held)

    # the first turns and the whole sequence's order deal out what is sorted; equal sequences may span partitions, by conv_id
    return sequences.repartitionByRange("turns", "conv_id").sortWithinPartitions("turns", "conv_id").mapInArrow(run, PARTS)


def corrections(parts: DataFrame) -> DataFrame:
    """What neighbouring blocks have counted twice, from their last and first sequences: rows like those of nodes."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = [x.split()[0] for x in NODE.split(", ")]
        for batch in batches:
            out: list[tuple] = []
            for ended, begun in zip(batch.column("ended").to_pylist(), batch.column("first").to_pylist(), strict=True):
                common = next((i for i, (a, b) in enumerate(zip(ended, begun, strict=False)) if a != b), min(len(ended), len(begun)))
                k1, k2 = (keys_of(np.array([x[h] for x in ended], np.int64).view(np.uint64), np.array([0, len(ended)]), i).tolist() for i, h in enumerate(("h1", "h2")))
                over = common == len(ended)  # it goes on, so it is no leaf
                texts = sum(x["chars"] for x in ended[:common])  # of nodes from this depth on that both blocks have
                for d in range(common + 1):
                    out.append((d, k1[d], k2[d], k1[max(d - 1, 0)], k2[max(d - 1, 0)], 0, None, -(d < common), -over, texts))
                    texts -= ended[d - 1]["chars"] if d else 0
            cols = zip(*out, strict=True) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

    edges = parts.filter("part is not null").select("first", F.lag("last").over(Window.orderBy("part", "block")).alias("ended"))  # a row for each block
    return edges.filter("ended is not null").mapInArrow(run, NODE)


def hashed_ends(parts: DataFrame) -> DataFrame:
    """depth, k1, k2, ends_sha256 of nodes at which conversations end: their pieces pass in order, one at a time."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        key, live = None, None

        def rows(out: list):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["depth", "k1", "k2", "ends_sha256"])

        for batch in batches:
            out = []
            for *own, ends in zip(*(batch.column(c).to_pylist() for c in ("depth", "k1", "k2", "ends")), strict=True):
                if own == key:
                    live.update(b"," + ends)
                    continue
                if live:
                    out.append((*key, live.hexdigest()))
                key, live = own, hashlib.sha256(ends)
            if out:
                yield rows(out)
        if live:
            yield rows([(*key, live.hexdigest())])

    ends = parts.filter("ends is not null").select("depth", "k1", "k2", "conv_id", "ends")
    return ends.repartition("depth", "k1", "k2").sortWithinPartitions("depth", "k1", "k2", "conv_id").drop("conv_id").mapInArrow(run, "depth long, k1 long, k2 long, ends_sha256 string")


def nodes(conversations: DataFrame, group: int = 100, shared: int = 6, most_convs: int = 50_000, most_turns: int = 500_000) -> DataFrame:
    """A row per node of the trie of rebuilt() conversations: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    saved_tokens sums (members - 1) times the code points of the last text over a node's subtree. The root (depth 0) has no text and no parent;
    a table without a conv_id has no node at all. Sequences are known by 128 bits. Other columns are ignored; what rebuilt() says of nulls,
    ties and repeated rows holds here.
    """
    parts = stored(blocks(stored(rebuilt(conversations, group, shared), "conversations"), most_convs, most_turns), "trie-blocks")
    key = ["depth", "k1", "k2"]
    rows = parts.filter("n_convs is not null").select(*[x.split()[0] for x in NODE.split(", ")]).unionByName(corrections(parts))
    found = rows.groupBy(*key).agg(F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in SUMS))
    found = stored(found.join(hashed_ends(parts), key, "left"), "trie-nodes")
    of = F.struct("depth", "k1", "k2").alias("of")
    parents = found.filter("n_children > 0").select(of, F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n_rows"))
    below = found.filter("depth > 0").withColumn("of", F.struct((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")))
    placed = dealt_join(below, parents, "of", "k2", found.count()).drop("of")
    root = found.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return placed.unionByName(root).select("conv_id", "depth", "parent_conv_id", *SUMS, F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


ORACLE = """
WITH crc AS (SELECT list_transform(range(0, 256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END)) AS t),
convs AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (
  SELECT conv_id, own, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii((conv_id::VARCHAR)[i]))),
    lambda a, x: xor(t[(xor(a, x) & 255) + 1], a >> 8))) % 6 AS h FROM convs, crc),
built AS (
  SELECT c.conv_id, list_concat(coalesce(b.own, [])[1:c.h], c.own[c.h + 1:]) AS turns FROM heads c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 100),
prefixes AS (SELECT conv_id, d AS depth, turns[1:d] AS prefix, len(turns) = d AS ends FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM built)),
nodes AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ids,
    (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE length(prefix[depth].text) END AS own_saved
  FROM prefixes GROUP BY depth, prefix),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.prefix[1:n.depth] = n.prefix) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]),
above AS (SELECT own_saved, n_children = 0 AS leaf, a AS depth, prefix[1:a] AS prefix FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM linked)),
sums AS (SELECT depth, prefix, count(*) FILTER (leaf) AS n_leaves, sum(own_saved)::BIGINT AS saved_tokens FROM above GROUP BY depth, prefix)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ids) AS ends_sha256 FROM linked JOIN sums USING (depth, prefix)
"""
