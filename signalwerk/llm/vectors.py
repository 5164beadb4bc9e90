"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, table-lookup distances, exact cosine rerank.

Equal vectors are one node. The lists are two levels of centers, the second shared by all of the first, so both levels are learned from one
bounded sample and there are as many lists as the nodes need for lists of the same length. A node enters its nearest lists, as many as
synthetic pairs at the threshold need to share one; a pair is judged in each list that both have and counted in the first that finds it. A
list is dealt out in blocks of bounded size, compared block by block, so a list that holds a third of all nodes is many tasks. A task
returns a row per node, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import graph
from ..scratch import stored
from .common import dealt_join


def k_means(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centers = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = nearest(x, centers)
        total = np.zeros_like(centers)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=k)
        centers[n > 0] = total[n > 0] / n[n > 0, None]
    return centers


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    half = (centers**2).sum(1) / 2
    return np.concatenate([(x[i : i + 4096] @ centers.T - half).argmax(1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, int)


@dataclass
class Index:
    """Two levels of centers, a codebook for each subspace, how many lists of each level a vector enters, and the slack of looked-up distances."""

    coarse: np.ndarray
    fine: np.ndarray
    books: list[np.ndarray]
    probes: tuple[int, int]
    slack: float

    @property
    def parts(self) -> list[slice]:
        ends = np.cumsum([b.shape[1] for b in self.books])
        return [slice(e - b.shape[1], e) for e, b in zip(ends, self.books, strict=True)]

    def centers(self, lists: np.ndarray) -> np.ndarray:
        return self.coarse[lists // len(self.fine)] + self.fine[lists % len(self.fine)]

    def lists(self, x: np.ndarray, probes: tuple[int, int] | None = None) -> np.ndarray:
        """The nearest first-level centers, and the nearest second-level ones of each, as list numbers; a row per vector."""
        p, q = probes or self.probes
        first = top(x @ self.coarse.T - (self.coarse**2).sum(1) / 2, p)
        out = []
        for k in range(first.shape[1]):
            rest = x - self.coarse[first[:, k]]
            out.append(first[:, k, None] * len(self.fine) + top(rest @ self.fine.T - (self.fine**2).sum(1) / 2, q))
        return np.concatenate(out, 1)

    def codes(self, residual: np.ndarray) -> np.ndarray:
        return np.column_stack([nearest(residual[:, p], b) for p, b in zip(self.parts, self.books, strict=True)]).astype(np.uint8)

    def distances(self, residual: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Squared distances of each residual to each coded one, by lookups in a table per residual and subspace."""
        out = np.zeros((len(residual), len(codes)), np.float32)
        for m, (p, b) in enumerate(zip(self.parts, self.books, strict=True)):
            table = ((residual[:, None, p] - b[None]) ** 2).sum(2).astype(np.float32)
            out += table[:, codes[:, m]]
        return out

    def pair_distances(self, lists: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The lesser looked-up distance of each pair of rows in a list: x to the code of y, or y to the code of x."""
        center = self.centers(lists)
        x, y = x - center, y - center
        one = lambda a, codes: sum((((a[:, p] - b[codes[:, m]]) ** 2).sum(1) for m, (p, b) in enumerate(zip(self.parts, self.books, strict=True))), np.zeros(len(a)))
        return np.minimum(one(x, self.codes(y)), one(y, self.codes(x)))


def top(score: np.ndarray, k: int) -> np.ndarray:
    return np.argsort(-score, axis=1, kind="stable")[:, :k]


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def train(sample: np.ndarray, n_nodes: int, threshold: float, per_list: int, subspaces: int, seed: int = 5, share: float = 0.995) -> Index:
    """An index from a bounded sample of unit vectors."""
    rng = np.random.default_rng(seed)
    dim, most = sample.shape[1], max(1, len(sample) // 16)
    n_first = int(np.clip(n_nodes // per_list, 1, most))
    n_second = int(np.clip(-(-n_nodes // (per_list * n_first)), 1, most))
    coarse = k_means(sample, n_first, 8, rng)
    residual = sample - coarse[nearest(sample, coarse)]
    fine = k_means(residual, n_second, 8, rng) if n_second > 1 else np.zeros((1, dim))
    residual -= fine[nearest(residual, fine)]
    words = min(256, max(1, len(sample)))
    books = [k_means(residual[:, p], words, 5, rng).reshape(words, -1) for p in np.array_split(np.arange(dim), min(subspaces, dim))]
    index = Index(coarse, fine, books, (1, 1), 0.0)
    # pairs exactly at the threshold, in random directions
    x = sample[:2000]
    u = rng.normal(size=x.shape)
    u -= (u * x).sum(1, keepdims=True) * x
    u /= np.maximum(np.linalg.norm(u, axis=1, keepdims=True), 1e-12)
    y = threshold * x + np.sqrt(1 - threshold**2) * u
    steps = [1, 2, 3, 4, 5, 6, 8, 10, 12, 16, 20, 24, 32, 40, 48, 64]
    tried = sorted({(min(p, n_first), min(q, n_second)) for p in steps for q in steps if p * q <= 64}, key=lambda t: (t[0] * t[1], t))
    for index.probes in tried:
        a, b = index.lists(x), index.lists(y)
        both = (a[:, :, None] == b[:, None, :]).any(2)
        if both.any(1).mean() >= share:
            break
    at, p = np.nonzero(both)
    told = index.pair_distances(a[at, p], x[at], y[at])
    index.slack = max(float(np.quantile(told - 2 * (1 - threshold), 0.999)), 0.0) + 1e-6
    return index


def valid(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def compared(rows: DataFrame, shared, threshold: float) -> DataFrame:
    """For each group of rows (list, block_a, block_b): node, root (smallest node linked to it in the group), degree (copies of the nodes linked to it, counting a pair in its first list)."""

    def judge(index: Index, lst: int, diagonal: bool, side: list[list]) -> tuple | None:
        (ia, xa, la, ca, ma), (ib, xb, lb, cb, mb) = side
        limit, center = 2 * (1 - threshold) + index.slack, index.centers(np.array([lst]))
        near = index.distances(xa - center, cb) <= limit
        if diagonal:
            near = np.triu(near | near.T, 1)
        else:  # either side may find the other
            near |= index.distances(xb - center, ca).T <= limit
        i, k = np.nonzero(near)
        keep = np.concatenate([np.einsum("ij,ij->i", xa[i[s : s + 65536]], xb[k[s : s + 65536]]) >= threshold for s in range(0, len(i), 65536)]) if len(i) else np.zeros(0, bool)
        i, k = i[keep], k[keep]
        if not len(i):
            return None
        count = np.ones(len(i), bool)  # whether no smaller list that both have finds the pair
        for other in np.intersect1d(la[i], lb[k]):
            if other >= lst:
                break
            a, b = np.flatnonzero((la == other).any(1)), np.flatnonzero((lb == other).any(1))
            a, b = np.intersect1d(a, i), np.intersect1d(b, k)
            at, to = np.full(len(la), -1), np.full(len(lb), -1)
            at[a], to[b] = np.arange(len(a)), np.arange(len(b))
            both = np.flatnonzero((at[i] >= 0) & (to[k] >= 0))
            if len(both):
                x, y = xa[a] - index.centers(np.array([other])), xb[b] - index.centers(np.array([other]))
                seen = (index.distances(x, index.codes(y)) <= limit) | (index.distances(y, index.codes(x)).T <= limit)
                count[both] &= ~seen[at[i[both]], to[k[both]]]
        nodes = np.unique(np.concatenate([ia[i], ib[k]]))
        a, b = np.searchsorted(nodes, ia[i]), np.searchsorted(nodes, ib[k])
        degree = np.bincount(a[count], mb[k][count], len(nodes)) + np.bincount(b[count], ma[i][count], len(nodes))
        label = np.arange(len(nodes))
        while True:
            new = label.copy()
            low = np.minimum(label[a], label[b])
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == label).all():
                return nodes, nodes[label], degree.astype(np.int64)
            label = new

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        index, key, held = shared.value, None, []

        def close():
            lst, a, b = key
            table = pa.Table.from_batches(held)
            block = np.array(table.column("block"))
            whole = [np.array(table.column("node")), unit(np.stack(table.column("v").to_numpy())), np.stack(table.column("lists").to_numpy()), np.stack([np.frombuffer(x, np.uint8) for x in table.column("code").to_pylist()]), np.array(table.column("copies"))]
            found = judge(index, lst, a == b, [[c[block == x] for c in whole] for x in (a, b)]) if (block == a).any() and (block == b).any() else None
            if found:
                return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["node", "root", "degree"])
            return None

        for batch in batches:
            keys = np.column_stack([np.array(batch.column(c)) for c in ("list", "block_a", "block_b")])
            ends = [*(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            start = 0
            for end in ends:
                if start < end:
                    k = tuple(keys[start].tolist())
                    if k != key and held:
                        if out := close():
                            yield out
                        held = []
                    key = k
                    held.append(batch.slice(start, end - start))
                start = end
        if held and (out := close()):
            yield out

    group = ["list", "block_a", "block_b"]
    return rows.repartition(*group).sortWithinPartitions(*group).mapInArrow(run, "node long, root long, degree long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, sample: int = 20_000, per_list: int = 256, subspaces: int = 8, block_rows: int = 1024) -> DataFrame:
    """A row per vector: vec_id, n_links, component_id, kept, and is_valid.

    Two vectors are linked if the index finds the pair and their cosine in double precision is at least `threshold`. Vectors of one length
    are compared, with an index for each length, so lengths should be few. An index learns from at most `sample` different vectors and holds
    all. A vector is valid if it has no null or non-finite component and one that isn't 0; others, null and empty ones among them, link with
    nothing. Copies link with each other. A component of null vec_ids only has a null component_id; repeated vec_ids have a row each. kept
    is vec_id = component_id, true for rows of which neither is null. An empty table gives no rows. Other columns are ignored.
    """
    kind = vectors.schema["embedding"].dataType
    kind = "array<float>" if kind.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("v")).withColumn("uid", F.monotonically_increasing_id())
    rows = stored(rows.withColumn("is_valid", valid(F.col("v"))), "vectors")
    sizes = [r["dim"] for r in rows.filter("is_valid").groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").collect()]
    out = rows.filter("not is_valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"), "is_valid")
    for dim in sizes:
        own = rows.filter(F.col("is_valid") & (F.size("v") == dim)).drop("is_valid")
        out = out.unionByName(linked(own, kind, threshold, sample, per_list, subspaces, block_rows))
    return out


def linked(rows: DataFrame, kind: str, threshold: float, sample: int, per_list: int, subspaces: int, block_rows: int) -> DataFrame:
    """near_duplicates() of valid vectors of one length (uid, vec_id, v)."""
    spark = rows.sparkSession
    nodes = stored(rows.groupBy("v").agg(F.min("uid").alias("node"), F.min("vec_id").alias("least_id"), F.count("*").alias("copies")), "vector-nodes")
    n_nodes, n_rows = nodes.agg(F.count("*"), F.sum("copies")).first()
    some = np.array([r["v"] for r in nodes.orderBy(F.xxhash64("v")).limit(sample).select("v").collect()])
    shared = spark.sparkContext.broadcast(train(unit(some), n_nodes, threshold, per_list, subspaces))

    def assign(batches: Iterator) -> Iterator:
        import pyarrow as pa

        index = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                some = batch.slice(start, 2048)
                x = unit(np.stack(some.column("v").to_numpy(zero_copy_only=False)))
                lists = index.lists(x)
                n, p = lists.shape
                which, flat = np.repeat(np.arange(n), p), lists.ravel()
                codes = index.codes(x[which] - index.centers(flat))
                cols = some.select(["node", "copies", "v"]).take(pa.array(which))
                yield pa.RecordBatch.from_arrays([pa.array(flat, pa.int32()), *cols.columns, pa.array(list(lists[which].astype("i4")), pa.list_(pa.int32())), pa.array([c.tobytes() for c in codes], pa.binary())], names=["list", "node", "copies", "v", "lists", "code"])

    entries = stored(nodes.select("node", "copies", "v").mapInArrow(assign, f"list int, node long, copies long, v {kind}, lists array<int>, code binary"), "list-entries")
    blocks = entries.groupBy("list").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("n_blocks"), F.count("*").alias("n_rows"))
    n_entries = n_nodes * len(shared.value.lists(unit(some[:1]))[0])
    dealt = dealt_join(entries, blocks, "list", "node", n_entries).withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    dealt = dealt.select("list", F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b"), "block", "node", "copies", "v", "lists", "code")
    found = stored(compared(dealt, shared, threshold), "vector-links")
    degree = found.groupBy("node").agg(F.sum("degree").alias("degree"))
    component = graph.components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "node")
    # components' smallest vec_id by node, then by row; large components and hot vectors are dealt over parts
    per_node = nodes.drop("v").join(degree, "node", "left").join(component, "node", "left").select("node", "least_id", "copies", F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("component", "node").alias("component"))
    per_node = stored(per_node, "vector-components")
    heads = per_node.groupBy("component").agg(F.min("least_id").alias("component_id"), F.count("*").alias("n_rows"))
    told = dealt_join(per_node, heads, "component", "node", n_nodes).select("node", "component_id", (F.col("degree") + F.col("copies") - 1).alias("n_links"))
    by_vector = stored(nodes.select("v", "node", F.col("copies").alias("n_rows")).join(told, "node").drop("node"), "vector-results")
    own = dealt_join(rows, by_vector, "v", "uid", n_rows)
    return own.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"), F.lit(True).alias("is_valid"))
