"""Resampling of documents towards a target distribution by hashed n-gram features.

Newlines are separators, so a text's n-grams are those of its lines and those that cross lines. Equal lines are one row with a number of
occurrences: their words are cut and hashed once, for the corpus counts as for the documents' gains. N-grams that cross lines are added to
each document by themselves; runs of one word cross none.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import stored
from .common import dealt_join, slices

# letters A-Z small, all other ASCII but letters and digits a space
PLAIN = bytes(x + 32 if 65 <= x <= 90 else x if x >= 128 or chr(x).isalnum() else 32 for x in range(256))


class Buckets:
    """Bucket numbers of features; keeps those it has met, up to a bound."""

    def __init__(self, buckets: int, keep: int = 300_000):
        self.buckets, self.keep, self.known = buckets, keep, {}

    def of(self, features: list[bytes]) -> list[int]:
        known = self.known
        if len(known) > self.keep:
            known.clear()
        for f in set(features).difference(known):
            known[f] = zlib.crc32(f) % self.buckets
        return list(map(known.__getitem__, features))


def in_line(words: list[bytes], longest: int) -> list[bytes]:
    """All runs of 1 to `longest` words, joined by a space."""
    return words if longest == 1 else [b" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def across(lines: list[list[bytes]], longest: int) -> list[bytes]:
    """The runs of up to `longest` words that do not lie in one line."""
    words = [w for line in lines for w in line]
    found, begin, end = [], 0, 0
    for line in lines:
        begin, end = end, end + len(line)
        for i in range(max(begin, end - longest + 1), end):
            found += [b" ".join(words[i : i + k]) for k in range(end - i + 1, longest + 1) if i + k <= len(words)]
    return found


def line_id(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("second"), line).alias("h2"))


def line_features(texts: DataFrame, longest: int, buckets: int) -> DataFrame:
    """A row per distinct line of column text: line (its id), n_rows (occurrences), n_words, features (buckets, repeats counted). Lines without a word have none."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = Buckets(buckets)
        for batch in batches:
            for part in slices(batch, rows=8192, by="said"):
                n, size, flat = [], [], []
                for said in part.column("said").to_pylist():
                    words = said.translate(PLAIN).split()
                    found = own.of(in_line(words, longest))
                    n.append(len(words))
                    size.append(len(found))
                    flat.append(np.array(found, np.int32))
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(np.concatenate(flat)))
                yield pa.RecordBatch.from_arrays([part.column("line"), part.column("n_rows"), pa.array(n, pa.int64()), lists], names=["line", "n_rows", "n_words", "features"])

    lines = texts.select(F.explode(F.split("text", "\n")).alias("said")).filter("said <> ''")
    distinct = lines.groupBy("said").agg(F.count("*").alias("n_rows")).select(line_id(F.col("said")).alias("line"), "n_rows", F.col("said").cast("binary").alias("said"))
    return distinct.mapInArrow(run, "line struct<h1:long,h2:long>, n_rows long, n_words long, features array<int>")


def counted(rows: DataFrame, buckets: int, together: int = 100) -> DataFrame:
    """Features of each bucket over rows (n_rows, features): bucket, n. A task sends a row for every `together` buckets."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(-(-buckets // together) * together, np.int64)
        for batch in batches:
            held = batch.column("features")
            size = np.diff(held.offsets.to_numpy()) if batch.num_rows else np.zeros(0, np.int64)
            # weights as whole numbers below 2**53
            total += np.bincount(held.flatten().to_numpy(zero_copy_only=False), np.repeat(batch.column("n_rows").to_numpy(zero_copy_only=False).astype(float), size), len(total)).astype(np.int64)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total) // together), pa.int32()), pa.FixedSizeListArray.from_arrays(pa.array(total), together).cast(pa.list_(pa.int64()))], names=["part", "counts"])

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict[int, np.ndarray] = {}
        for batch in batches:
            counts = batch.column("counts").flatten().to_numpy().reshape(-1, together)
            for part, own in zip(batch.column("part").to_pylist(), counts, strict=True):
                held[part] = held.get(part, 0) + own
        for part, own in held.items():
            some = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array(some + part * together), pa.array(own[some])], names=["bucket", "n"])

    return rows.select("n_rows", "features").mapInArrow(count, "part int, counts array<long>").repartition("part").mapInArrow(add, "bucket long, n long")


def gains(corpus: DataFrame, target: DataFrame, spark, buckets: int) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of each bucket, from counts (bucket, n). As many numbers as buckets."""
    both = spark.range(buckets).withColumnRenamed("id", "bucket").join(corpus.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0)
    rows = both.select("bucket", F.col("s").cast("double"), F.col("t").cast("double")).collect()
    s, t = np.zeros(buckets), np.zeros(buckets)
    for r in rows:
        s[r["bucket"]], t[r["bucket"]] = r["s"], r["t"]
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def summed(rows: DataFrame, shared, column: str, names: tuple[str, str]) -> DataFrame:
    """rows with their list of buckets replaced by its length and its sum of gains."""
    kept = [f for f in rows.schema.fields if f.name != column]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        gain = shared.value
        for batch in batches:
            held = batch.column(column)
            edges = held.offsets.to_numpy().astype(np.int64) if batch.num_rows else np.zeros(1, np.int64)
            total = np.append(0, np.cumsum(gain[held.flatten().to_numpy(zero_copy_only=False)]))[edges - edges[0]]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(np.diff(edges)), pa.array(np.diff(total))], names=[*(f.name for f in kept), *names])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(run, f"{schema}, {names[0]} long, {names[1]} long")


def document_lines(docs: DataFrame, longest: int, buckets: int) -> DataFrame:
    """uid, doc_id, lines (ids of lines that are not empty) and crossing (buckets of n-grams that cross lines)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lines = F.coalesce(F.transform(F.filter(F.split("text", "\n"), lambda x: x != ""), line_id), F.array().cast("array<struct<h1:long,h2:long>>")).alias("lines")
    if longest == 1:
        return rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", lines, F.array().cast("array<int>").alias("crossing"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = Buckets(buckets)
        for batch in batches:
            for part in slices(batch):
                found = [own.of(across([x.translate(PLAIN).split() for x in (text or b"").split(b"\n")], longest)) for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lines"), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "lines", "crossing"])

    return rows.select("doc_id", lines, F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, lines array<struct<h1:long,h2:long>>, crossing array<int>").withColumn("uid", F.monotonically_increasing_id())


def noise(doc_id: Column, seed: int) -> Column:
    """A Gumbel number in thousandths that the id and seed alone determine."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resampled(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024) -> DataFrame:
    """A row per document: doc_id, n_features, weight, score, rank (1, 2, ... of those drawn, else null), n_words.

    Features are all runs of 1 to `longest` words. weight is the floored mean of their gains, 0 without any; score is weight plus Gumbel noise
    of the id. Of the documents with `least_words` words or more, floor(percent of them) are drawn: highest scores first, ties to the smaller
    doc_id, null last. Null and empty texts have no features. Rows that are there twice are two documents, with equal scores. A null doc_id
    has the noise of an empty id. Texts and lines of any length are read whole. Empty tables give empty tables; an empty target gives all buckets
    what they are short of the mean. Other columns are ignored.
    """
    spark = docs.sparkSession
    lines = stored(line_features(docs.select(F.col("text").cast("string").alias("text")), longest, buckets), "line-features")
    rows = stored(document_lines(docs, longest, buckets), "document-lines")
    corpus = counted(lines, buckets)
    wanted = counted(line_features(target.select(F.col("text").cast("string").alias("text")), longest, buckets), buckets)
    if longest > 1:  # n-grams that cross lines, each text's by itself
        one = F.lit(1).cast("long").alias("n_rows")
        corpus = corpus.unionByName(counted(rows.select(one, F.col("crossing").alias("features")), buckets)).groupBy("bucket").agg(F.sum("n").alias("n"))
        their = document_lines(target.select(F.lit(None).alias("doc_id"), "text"), longest, buckets).select(one, F.col("crossing").alias("features"))
        wanted = wanted.unionByName(counted(their, buckets)).groupBy("bucket").agg(F.sum("n").alias("n"))
    shared = spark.sparkContext.broadcast(gains(corpus, wanted, spark, buckets))
    per_line = summed(lines, shared, "features", ("n", "gain")).filter("n > 0")
    total = lines.agg(F.sum("n_rows")).first()[0] or 0
    found = dealt_join(rows.select("uid", F.explode("lines").alias("line")), per_line, "line", "uid", total)
    per_doc = found.groupBy("uid").agg(F.sum("n").alias("n"), F.sum("gain").alias("gain"), F.sum("n_words").alias("n_words"))
    crossing = summed(rows.select("uid", "doc_id", "crossing"), shared, "crossing", ("n_crossing", "gain_crossing"))
    scored = crossing.join(per_doc, "uid", "left").na.fill(0, ["n", "gain", "n_words"])
    scored = scored.select("uid", "doc_id", (F.col("n") + F.col("n_crossing")).alias("n_features"), (F.col("gain") + F.col("gain_crossing")).alias("gain"), "n_words")
    weight = F.when(F.col("n_features") == 0, 0).otherwise(F.expr("(gain - pmod(gain, n_features)) div n_features")).cast("long")
    scored = scored.withColumn("weight", weight).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = stored(scored.drop("gain"), "scored")
    return drawn(scored, percent, least_words)


def drawn(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """Ranks of scored documents (uid, doc_id, n_features, n_words, weight, score).

    Scores are whole numbers from a few ten thousand values, whatever the number of documents, and noise spreads them; so a histogram tells
    the rank that each value begins with, and only documents of equal score are sorted."""
    fit = scored.filter(F.col("n_words") >= least_words)
    n_drawn = fit.count() * percent // 100
    higher = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    values = fit.groupBy("score").agg(F.count("*").alias("n")).select("score", F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("above")).filter(F.col("above") < n_drawn)
    in_value = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "uid")
    ranks = fit.select("uid", "doc_id", "score").join(values, "score").select("uid", (F.col("above") + F.row_number().over(in_value)).alias("rank")).filter(F.col("rank") <= n_drawn)
    return scored.join(ranks, "uid", "left").select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"), "n_words")


ORACLE = r"""
WITH crc AS (SELECT list_transform(range(0, 256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, x: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END)) AS t),
docs AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
goal AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
per_doc AS (SELECT row, unnest(words) AS word FROM docs),
spelled AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM per_doc UNION SELECT word FROM goal)),
bytes AS (SELECT word, list_transform(range(0, len(h) // 2), lambda i: 16 * (position(h[2 * i + 1] IN '0123456789ABCDEF') - 1) + position(h[2 * i + 2] IN '0123456789ABCDEF') - 1) AS b FROM spelled),
known AS (SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda a, x: xor(t[(xor(a, x) & 255) + 1], a >> 8))) % 10000 AS bucket FROM bytes, crc),
s AS (SELECT bucket, count(*) AS s FROM per_doc JOIN known USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM goal JOIN known USING (word) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS all_s, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS all_t),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000) / ((coalesce(s, 0) + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS gain FROM (SELECT unnest(range(0, 10000)) AS bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), sums),
mean AS (SELECT row, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM per_doc JOIN known USING (word) JOIN gain USING (bucket) GROUP BY row),
scored AS (
  SELECT row, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5) / 4294967296.0)))::BIGINT AS score
  FROM docs LEFT JOIN mean USING (row)),
ranked AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank, n_features AS n_words FROM scored LEFT JOIN ranked USING (row)
"""
