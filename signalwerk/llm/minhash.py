"""Near-duplicate documents by weighted MinHash: consistent weighted samples of TF-IDF shingles, banded, verified exactly.

Exact copies become one node first. Nodes that share a band meet in a bucket. A bucket is dealt out in blocks of bounded size; a block
compares all its texts, and the bucket's first text, by matrix products. Where a bucket of several blocks still holds more than one
class, the texts outside its largest class are compared with all others of the bucket, again in blocks. Links between the same class need
no comparison, so a huge group of copies costs about its size. Only links that span a block's classes leave a task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import graph
from ..scratch import stored
from .common import dealt_join, slices, text_or_empty
from .weighted import Sampler, Weigher, grouped, similarities, text_key, word_hash

BANDS, ROWS = 10, 3
SLACK = 1e-9


def idf(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.clip(1 + np.log(max(n_docs, 2) / np.maximum(df, 1)) / np.log(max(n_docs, 2)), 1, 2)


def word_weights(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and weights of the words that most documents have, at most `words`. That bounds the table, whatever the corpus."""
    return word_table(docs, words)[0]


def word_table(docs: DataFrame, words: int) -> tuple[tuple[np.ndarray, np.ndarray], DataFrame, int]:
    """word_weights(); the counts (word, n) of all other words that two or more documents have, as a table; the number of documents."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: Counter = Counter()

        def out():
            keys = np.fromiter(map(word_hash, held), np.uint64, len(held)).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for part in slices(batch):
                for text in part.column("text").to_pylist():
                    held.update(set(text.lower().split()))
                if len(held) > 1_000_000:
                    yield out()
                    held.clear()
        if held:
            yield out()

    n_docs = docs.count()
    counts = stored(docs.select(text_or_empty().alias("text")).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    # the lowest power of two that at most `words` words reach: a histogram of at most 63 rows, then no more rows than that
    left, edge = words, None
    for r in counts.groupBy(F.floor(F.log2("n")).alias("power")).agg(F.count("*").alias("n")).orderBy(F.desc("power")).collect():
        left -= r["n"]
        edge = 2 ** r["power"] if left >= 0 else edge
    top = counts.filter(F.col("n") >= edge).collect() if edge else []
    weights = idf(np.array([r["n"] for r in top], float), n_docs)
    others = counts.filter("n > 1" if edge is None else (F.col("n") > 1) & (F.col("n") < edge))
    return (np.array([r["word"] for r in top], np.int64).view(np.uint64), weights), others, n_docs


_latest: dict[str, list] = {}


def weigher(shared, use: str) -> Weigher:
    """The weigher of a broadcast table for a use; a Python worker keeps the latest, and the table with it, so that no other can take its place.

    A weigher keeps the words that it has met with their weights, so sampling, which knows no rare words, has one of its own."""
    held = _latest.get(use)
    if held is None or held[0] is not shared.value:
        held = _latest[use] = [shared.value, Weigher(dict(zip(*(x.tolist() for x in shared.value), strict=True)))]
    return held[1]


def signatures(docs: DataFrame, shared) -> DataFrame:
    """uid, doc_id, text_hash, node (of the word sequence), n_chars, samples (null without words), a row per document.

    Words outside the broadcast table are sampled with a weight of 2, which most of them nearly have; what is linked is decided by exact weights.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        weigh, sampler = weigher(shared, "sample"), Sampler(BANDS * ROWS)
        for batch in batches:
            for part in slices(batch, size=600_000):
                texts = part.column("text").to_pylist()
                found = list(map(weigh.shingles, texts))
                size = np.array([len(x[0]) for x in found])
                some = np.flatnonzero(size)
                samples: list = [None] * len(texts)
                if len(some):
                    own = size[some]
                    got = sampler.samples(np.concatenate([x[0] for x in found]), np.concatenate([x[1] * x[2] for x in found]), np.cumsum(own) - own)
                    for i, x in zip(some.tolist(), got, strict=True):
                        samples[i] = x
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(map(text_key, texts), pa.int64()), pa.array(map(len, texts), pa.int64()), pa.array(samples, pa.list_(pa.int32()))], names=["doc_id", "text_hash", "node", "n_chars", "samples"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), text_or_empty().alias("text"))
    found = rows.mapInArrow(run, "doc_id long, text_hash long, node long, n_chars long, samples array<int>")
    return found.withColumn("uid", F.monotonically_increasing_id())


def rare_weights(words: list[int] | None, dfs: list[int] | None, n_docs: int) -> dict[int, float]:
    """Weights by hash of a text's words outside the broadcast table; those not among `words` have a df of 1 and weigh 2."""
    if not words:
        return {}
    return dict(zip(np.array(words, np.int64).view(np.uint64).tolist(), idf(np.array(dfs, float), n_docs).tolist(), strict=True))


def with_rare_words(texts: DataFrame, shared) -> DataFrame:
    """Texts (node, text) and `others`, the hashes of their distinct words outside the broadcast table."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        weigh = weigher(shared, "sample")
        for batch in batches:
            for part in slices(batch, size=600_000):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(map(weigh.others, part.column("text").to_pylist()), pa.list_(pa.int64()))], names=[*part.schema.names, "others"])

    return texts.mapInArrow(run, "node long, text string, others array<long>")


def compared(rows: DataFrame, shared, n_docs: int, threshold: float) -> DataFrame:
    """Links (a, b) that join the classes of each group of rows (bucket, block_a, block_b, node, text, words, dfs, side).

    Rows of side 1 are compared with all, those of side 0 only with side 1. The rows of a group are bounded by whoever made the blocks.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        weigh = weigher(shared, "exact")

        def links(held: dict) -> list[tuple[int, int]]:
            nodes = sorted(held)
            if len(nodes) < 2:
                return []
            side = np.array([held[x][-1] for x in nodes], bool)
            linked = similarities([weigh.shingles(held[x][0], rare_weights(*held[x][1:3], n_docs)) for x in nodes]) >= threshold - SLACK
            linked &= side[:, None] | side[None, :]
            return [(nodes[i], nodes[k]) for i, k in enumerate(grouped(linked)) if i != k]

        key, held = None, {}
        for batch in batches:
            out = []
            for *k, node, text, words, dfs, side in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block_a", "block_b", "node", "text", "words", "dfs", "side")), strict=True):
                if k != key:
                    out += links(held)
                    key, held = k, {}
                held[node] = (text, words, dfs, side or held.get(node, (False,))[-1])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])
        if out := links(held):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])

    group = ["bucket", "block_a", "block_b"]
    return rows.repartition(*group).sortWithinPartitions(*group).select(*group, "node", "text", "words", "dfs", "side").mapInArrow(run, "a long, b long")


def blocks(n, chars, block_rows: int, block_chars: int):
    return F.greatest(F.ceil(n / block_rows), F.ceil(chars / block_chars)).cast("int")


def salt(count):
    return F.pmod(F.xxhash64("node", "bucket"), count).cast("int")


def classes(docs: DataFrame, threshold: float = 0.8, words: int = 65_536, block_rows: int = 512, block_chars: int = 16_000_000) -> DataFrame:
    """A row per document: doc_id, class_id (the smallest doc_id of its class), kept (true for one row of each class), text_hash.

    Two texts are linked if they share a band and their weighted Jaccard similarity is at least `threshold`; a class is what links connect.
    Texts are compared by their lower-case words, five at a time; one to four words are one shingle; texts without words, null among them,
    are one class. Equal rows are one class. A class with null doc_ids only has a null class_id. Other columns are ignored.
    """
    spark = docs.sparkSession
    frequent, counts, n_docs = word_table(docs, words)
    shared = spark.sparkContext.broadcast(frequent)
    found = stored(signatures(docs, shared), "signatures")
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "uid"))
    nodes = stored(found.groupBy("node").agg(F.first("samples", ignorenulls=True).alias("samples"), F.max("n_chars").alias("n_chars"), rep.alias("rep"), F.count("*").alias("n_rows")), "nodes")
    n_nodes = nodes.count()
    bands = F.array(*(F.xxhash64(F.lit(b), *(F.col("samples")[b * ROWS + i] for i in range(ROWS))) for b in range(BANDS)))
    in_bands = nodes.filter("samples is not null").select("node", "n_chars", F.explode(bands).alias("bucket"))
    full = in_bands.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.min("node").alias("center")).filter("n > 1")
    full = full.select("bucket", "center", blocks(F.col("n"), F.col("chars"), block_rows, block_chars).alias("n_blocks"), F.col("n").alias("n_rows"))
    full = stored(full, "buckets")
    rows = stored(dealt_join(in_bands.drop("n_chars"), full, "bucket", "node", BANDS * n_nodes).select("bucket", "node", "center", "n_blocks"), "bucket-rows")
    # texts that share a bucket, with the df of their words outside the broadcast table; such a word is in few documents, so none is hot here
    reps = rows.select("node").distinct().join(nodes, "node").select("node", F.col("rep.doc_id").alias("rep_doc"), F.col("rep.text_hash").alias("rep_hash"))
    texts = docs.select(F.col("doc_id").cast("long").alias("rep_doc_2"), F.xxhash64("text").alias("rep_hash_2"), text_or_empty().alias("text"))
    texts = texts.join(reps, F.col("rep_doc").eqNullSafe(F.col("rep_doc_2")) & (F.col("rep_hash") == F.col("rep_hash_2"))).select("node", "text")
    texts = stored(with_rare_words(texts, shared), "texts")
    rare = texts.select("node", F.explode("others").alias("word")).join(counts, "word").groupBy("node").agg(F.collect_list(F.struct("word", "n")).alias("rare"))
    rare = stored(rare.select("node", F.col("rare.word").alias("words"), F.col("rare.n").alias("dfs")), "rare-words")
    texts = texts.drop("others").join(rare, "node", "left")
    # blocks of each bucket, and the bucket's first text in each
    own = rows.select("bucket", salt(F.col("n_blocks")).alias("block_a"), "node")
    first = rows.filter("node = center and n_blocks > 1").select("bucket", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block_a"), "node")
    within = own.unionByName(first).join(texts, "node").withColumn("block_b", F.lit(0)).withColumn("side", F.lit(True))
    links = stored(compared(within, shared, n_docs, threshold), "links-within")
    label = graph.components(links)
    # what is left: buckets of several blocks and classes
    wide = rows.filter("n_blocks > 1").join(nodes.select("node", F.col("n_chars").alias("chars")), "node")
    wide = stored(wide.join(label.withColumnRenamed("id", "node"), "node", "left").select("bucket", "node", "chars", "n_blocks", F.coalesce("component", "node").alias("label")), "wide-rows")
    n_wide = wide.count()
    if n_wide:
        sizes = wide.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))
        # the largest class of each bucket, what the others have, and all of it
        largest = sizes.groupBy("bucket").agg(F.max(F.struct("n", "label", "chars")).alias("main"), F.sum("n").alias("n_rows"), F.sum("chars").alias("chars"))
        few = largest.filter("n_rows > main.n").select("bucket", F.col("main.label").alias("main"), blocks(F.col("n_rows") - F.col("main.n"), F.col("chars") - F.col("main.chars"), block_rows, block_chars).alias("few_blocks"), "n_rows")
        left = stored(dealt_join(wide, few, "bucket", "node", n_wide), "wide-classes")
        a = left.filter("label <> main").select("bucket", "node", salt(F.col("few_blocks")).alias("block_a"), F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block_b"), F.lit(True).alias("side"))
        b = left.select("bucket", "node", F.explode(F.sequence(F.lit(0), F.col("few_blocks") - 1)).alias("block_a"), salt(F.col("n_blocks")).alias("block_b"), F.lit(False).alias("side"))
        across = compared(a.unionByName(b).join(texts, "node"), shared, n_docs, threshold)
        label = graph.components(links.unionByName(across))
    # heads by class, then by node, then by row; a class of many nodes and a node of many copies are dealt over parts
    classed = stored(nodes.select("node", "rep", "n_rows").join(label.withColumnRenamed("id", "node"), "node", "left").withColumn("class", F.coalesce("component", "node")).drop("component"), "classes")
    heads = classed.groupBy("class").agg(F.min("rep").alias("head"), F.count("*").alias("n_rows"))
    of_node = dealt_join(classed.withColumnRenamed("n_rows", "copies"), heads, "class", "node", n_nodes).select("node", "head", F.col("copies").alias("n_rows"))
    both = dealt_join(found.select("uid", "doc_id", "text_hash", "node"), stored(of_node, "heads"), "node", "uid", n_docs)
    return both.select("doc_id", F.col("head.doc_id").alias("class_id"), (F.col("uid") == F.col("head.uid")).alias("kept"), "text_hash")


def distinct_documents(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One document of each class, with its columns: the first row of classes(), which tells how nulls, ties and repeated rows are taken.
    A text of any length is compared whole. An empty table stays empty."""
    kept = classes(docs, threshold).filter("kept").select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"))
    # in structs, no column of the documents can clash with those of the classes
    rows, one = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row")), kept.select(F.struct("_doc", "_hash").alias("one"))
    both = rows.join(one, F.col("row.doc_id").cast("long").eqNullSafe(F.col("one._doc")) & (F.xxhash64("row.text") == F.col("one._hash")))
    # a class is kept by one row, but rows may be equal in doc_id and text
    return both.dropDuplicates(["one"]).select("row.*")
