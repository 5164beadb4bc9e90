"""Removal of byte strings that start more than once in a corpus, by suffix arrays of blocks that miss no repeat.

Equal strings of 400 bytes have the same smallest hash of 32 bytes in a row. Windows with the same smallest hash belong to one group, and
neighbouring windows of a group are one segment of text. Only groups of two or more segments are fetched, equal segments once with their
number, and each group is in one block, whose suffix array tells the repeats. Groups too large for a block are dealt again by what windows
with the hash at about the same offset have in common, at last by whole windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stored
from .common import dealt_join, slices, text_or_empty
from .intervals import repeated

SPANS = "array<struct<a:long,b:long>>"
STEPS = (None, 40, 1)  # by how many offsets of the smallest hash a group too large for a block is dealt again
CHUNK = 1 << 17
_rng = np.random.default_rng(11)
_BYTE = _rng.integers(0, 2**64, 256, np.uint64)
_TURN = _rng.integers(0, 2**64, 8, np.uint64) | np.uint64(1)


def gram(least: int) -> int:
    """How many bytes are hashed: a power of two, a quarter of the window or less, 32 at most."""
    return 1 << min(5, max(0, (least // 4).bit_length() - 1))


def hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of the `width` bytes from each place on; width is a power of two."""
    h, step = _BYTE[data], 1
    with np.errstate(over="ignore"):
        for turn in _TURN:
            if step == width:
                break
            h = h[:-step] * turn + h[step:]
            h ^= h >> np.uint64(31)
            step *= 2
        h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def least_in_windows(h: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` neighbours."""
    have = 1
    while 2 * have <= width:
        h = np.minimum(h[:-have], h[have:])
        have *= 2
    return np.minimum(h[: len(h) - (width - have)], h[width - have :]) if have < width else h


def segments(data: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of texts that follow each other in `data`, each up to its entry of `ends`: starts, numbers of windows, groups, and
    whether a segment may repeat a string in itself, for which its smallest hash would have to come twice."""
    width = gram(least)
    out = []
    for a in range(0, len(data) - least + 1, CHUNK):
        n = min(CHUNK, len(data) - least + 1 - a)
        h = hashes(data[a : a + n + least - 1], width)
        key = least_in_windows(h, least - width + 1)
        at = np.arange(a, a + n)
        inside = at + least <= ends[np.searchsorted(ends, at, "right")]
        change = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (inside[1:] != inside[:-1])))
        size = np.diff(np.append(change, n))
        keep = inside[change]
        own = key[change[keep]]
        low = np.sort(h[h <= own.max(initial=0)])
        out.append((change[keep] + a, size[keep], own, np.searchsorted(low, own, "right") - np.searchsorted(low, own) > 1))
    return tuple(map(np.concatenate, zip(*out, strict=True))) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool))


def parts(text: bytes, least: int, step: int) -> list[tuple[int, int, int]]:
    """Segments of a group, dealt again: start, number of windows, and a hash of the bytes that all windows with the smallest hash
    (its first place in the window) at one of the same `step` offsets have in common."""
    width = gram(least)
    h = hashes(np.frombuffer(text, np.uint8), width)
    at = np.flatnonzero(h == h[: least - width + 1].min())
    start = np.arange(len(text) - least + 1)
    place = at[np.searchsorted(at, start)]
    part = (place - start) // step
    first = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (part[1:] != part[:-1])))
    found = []
    for s, n, p, o in zip(first.tolist(), np.diff(np.append(first, len(start))).tolist(), place[first].tolist(), part[first].tolist(), strict=True):
        last = p - o * step  # where the last such window begins; the first ends `step` - 1 before the last does
        core = text[last : last + max(0, least - step + 1)]
        found.append((s, n, xxhash.xxh3_64_intdigest(core, seed=o * 64 + step)))
    return found


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def places(texts: DataFrame, least: int, step: int | None) -> DataFrame:
    """A row per segment of texts (k1, k2, weight, text as binary): k1, k2, weight, start, n (windows), grp, content (a hash of its bytes), again (it may repeat itself)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                held = [x or b"" for x in part.column("text").to_pylist()]
                ends = np.cumsum(np.fromiter(map(len, held), np.int64, len(held)))
                data = b"".join(held)
                if step is None:
                    start, n, grp, again = segments(np.frombuffer(data, np.uint8), ends, least)
                    owner = np.searchsorted(ends, start, "right")
                else:
                    each = [parts(x, least, step) if len(x) >= least else [] for x in held]
                    owner = np.repeat(np.arange(len(held)), list(map(len, each)))
                    flat = np.array([(a, b) for x in each for a, b, _ in x], np.int64).reshape(-1, 2)
                    start, n = flat[:, 0] + (ends - list(map(len, held)))[owner], flat[:, 1]
                    grp = np.array([c for x in each for *_, c in x], np.uint64)
                    again = np.zeros(len(grp), bool)  # each has but one place of the hash
                view = memoryview(data)
                content = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(start.tolist(), (start + n + least - 1).tolist(), strict=True)), np.uint64, len(start))
                begin = np.append(0, ends[:-1])
                keys = [part.column(c).take(pa.array(owner)) for c in ("k1", "k2", "weight")]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(start - begin[owner]), pa.array(n), pa.array(signed(grp)), pa.array(signed(content)), pa.array(again)], names=["k1", "k2", "weight", "start", "n", "grp", "content", "again"])

    return texts.mapInArrow(run, "k1 long, k2 long, weight long, start long, n long, grp long, content long, again boolean")


def fetched(texts: DataFrame, kinds: DataFrame, least: int) -> DataFrame:
    """The bytes of kinds of segments (grp, content, weight, n_rows, large, at): grp, content, weight, n_rows, large, text. A row of texts that is there twice gives its segments twice."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["grp", "content", "weight", "n_rows", "large"]
        for batch in batches:
            for part in slices(batch, rows=64):
                wanted = part.column("wanted")
                owner = np.repeat(np.arange(part.num_rows), wanted.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
                flat, held = wanted.flatten(), part.column("text").to_pylist()
                cut = [held[i][a : a + n + least - 1] for i, a, n in zip(owner.tolist(), flat.field("start").to_pylist(), flat.field("n").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(flat.field(c) for c in names), pa.array(cut, pa.binary())], names=[*names, "text"])

    wanted = kinds.groupBy("at.k1", "at.k2").agg(F.collect_list(F.struct("grp", "content", "weight", "n_rows", "large", F.col("at.start").alias("start"), F.col("at.n").alias("n"))).alias("wanted"))
    return texts.join(wanted, ["k1", "k2"]).select("text", "wanted").mapInArrow(run, "grp long, content long, weight long, n_rows long, large boolean, text binary")


def told(pieces: DataFrame, least: int, block_bytes: int) -> DataFrame:
    """Covered ranges of segments: grp, content, weight, n_rows, spans, text; only of those that have any. Groups stay whole; a block holds several.

    Segments of large groups are not judged but handed on with their text and no spans, each once; they are dealt one by one."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.int64()] * 4 + [pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])), pa.binary()]
        names = ["grp", "content", "weight", "n_rows", "spans", "text"]

        def record(rows: list[tuple]):
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

        def judged(keys: list, texts: list[bytes]):
            spans = repeated(texts, np.array([k[2] for k in keys]), least)
            return record([(*k, [{"a": a, "b": b} for a, b in s], None) for k, s in zip(keys, spans, strict=True) if s])

        keys, texts, size, last = [], [], 0, None
        for batch in batches:
            for part in slices(batch, rows=4096):
                passed = []
                for *key, large, text in zip(*(part.column(c).to_pylist() for c in ("grp", "content", "weight", "n_rows", "large", "text")), strict=True):
                    if key[:2] == last:
                        continue  # the same segment of a row that is there twice
                    last = key[:2]
                    if large:
                        passed.append((*key, None, text))
                        continue
                    if size > block_bytes and key[0] != keys[-1][0]:
                        yield judged(keys, texts)
                        keys, texts, size = [], [], 0
                    keys.append(key)
                    texts.append(text)
                    size += len(text)
                if passed:
                    yield record(passed)
        if keys:
            yield judged(keys, texts)

    dealt = pieces.repartition("grp", F.when(F.col("large"), F.col("content")).otherwise(0))
    return dealt.sortWithinPartitions("grp", "content").mapInArrow(run, f"grp long, content long, weight long, n_rows long, spans {SPANS}, text binary")


def covered(texts: DataFrame, least: int, block_bytes: int = 1_000_000, level: int = 0) -> DataFrame:
    """Ranges of texts (k1, k2, weight, text as binary) that strings of `least` bytes cover which start at another place, too: k1, k2, spans.

    weight tells for how many equal texts a row stands. Ranges may overlap and come in any order; texts without any have no row."""
    found = stored(places(texts, least, STEPS[level]), "segments")
    kinds = found.groupBy("grp", "content").agg(F.sum("weight").alias("weight"), F.count("*").alias("n_places"), F.min(F.struct("k1", "k2", "start", "n")).alias("at"), F.max("again").alias("again"))
    kinds = stored(kinds, "segment-kinds")
    groups = kinds.groupBy("grp").agg(F.sum("weight").alias("of_group"), F.max("again").alias("again"), F.sum(F.col("at.n") + least - 1).alias("bytes"), F.count("*").alias("n_rows"))
    groups = stored(groups.filter("of_group > 1 or again").drop("of_group", "again"), "segment-groups")
    large = F.col("bytes") > block_bytes if level + 1 < len(STEPS) else F.lit(False)
    own = dealt_join(kinds, groups.select("grp", "n_rows", large.alias("large")), "grp", "content", kinds.count())
    # texts are fetched once for all groups, as moving them is what costs most
    spans = judged = stored(told(fetched(texts, own.withColumnRenamed("n_places", "n_rows"), least), least, block_bytes), "spans")
    if level + 1 < len(STEPS) and not groups.filter(large).isEmpty():
        spans, again = judged.filter("text is null"), judged.filter("text is not null")
        ranges = covered(again.select(F.col("grp").alias("k1"), F.col("content").alias("k2"), "weight", "text"), least, block_bytes, level + 1)
        back = again.select(F.col("grp").alias("k1"), F.col("content").alias("k2"), "n_rows").join(ranges, ["k1", "k2"])
        spans = stored(spans.select("grp", "content", "n_rows", "spans").unionByName(back.select(F.col("k1").alias("grp"), F.col("k2").alias("content"), "n_rows", "spans")), "all-spans")
    kind = F.struct("grp", "content").alias("kind")
    rows = dealt_join(found.select(kind, "k1", "k2", "start"), spans.select(kind, "n_rows", "spans"), "kind", "k2", found.count())
    moved = F.transform("spans", lambda x: F.struct((x["a"] + F.col("start")).alias("a"), (x["b"] + F.col("start")).alias("b")))
    return rows.groupBy("k1", "k2").agg(F.flatten(F.collect_list(moved)).alias("spans"))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text as binary and k1, k2, which know a row by its doc_id and text; equal rows share them."""
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", text).alias("k1"), F.xxhash64(F.lit("second"), text, "doc_id").alias("k2"), text.cast("binary").alias("text"))


def without_repeats(docs: DataFrame, least: int = 400, block_bytes: int = 1_000_000) -> DataFrame:
    """A row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, and `kept`, the bytes that remain.

    Every byte goes that a string of `least` bytes covers which starts at another place of the table, too, in the same document or another;
    strings are looked for in the texts as they came. Null text is empty; texts shorter than `least` stay whole. Rows that are there twice,
    with equal or null doc_ids, are repeats of each other. A text of any length is taken whole. An empty table gives an empty table; other columns are ignored.
    """

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        for batch in batches:
            for part in slices(batch):
                out = []
                for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist(), strict=True):
                    last, runs, kept = 0, 0, []
                    end = -1
                    for a, b in sorted((x["a"], x["b"]) for x in spans or ()):
                        if a > end:
                            runs += 1
                            kept.append(text[last:a])
                        end = last = max(end, b)
                    kept.append(text[last:])
                    left = b"".join(kept)
                    out.append((len(text), len(text) - len(left), runs, hashlib.sha256(left).hexdigest(), left))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    rows = keyed(docs)
    spans = stored(covered(rows.withColumn("weight", F.lit(1).cast("long")), least, block_bytes), "covered")
    return rows.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


ORACLE = """
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, encode(coalesce(text, '')) AS bytes FROM documents),
hexed AS (SELECT row, doc_id, bytes, hex(bytes) AS h, octet_length(bytes) AS n FROM docs),
windows AS (SELECT row, i, hash(bytes[i + 1 : i + 400]) AS w FROM (SELECT row, bytes, unnest(range(0, n - 399)) AS i FROM hexed WHERE n >= 400)),
twice AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
hits AS (SELECT row, i, lag(i) OVER (PARTITION BY row ORDER BY i) AS before FROM windows SEMI JOIN twice USING (w)),
runs AS (SELECT row, i, sum(CASE WHEN before IS NULL OR i > before + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY row ORDER BY i) AS run FROM hits),
spans AS (SELECT row, run, min(i) AS a, max(i) + 400 AS b FROM runs GROUP BY row, run),
per AS (SELECT row, count(*) AS n_spans, sum(b - a) AS n_removed, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b FROM spans GROUP BY row)
SELECT doc_id, n AS n_bytes, coalesce(per.n_removed, 0)::BIGINT AS n_removed, coalesce(per.n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN per.row IS NULL THEN h ELSE
    list_reduce(list_transform(range(0, len(per.a) + 1), lambda k: h[2 * (CASE WHEN k = 0 THEN 0 ELSE per.b[k] END) + 1 : 2 * (CASE WHEN k = len(per.a) THEN n ELSE per.a[k + 1] END)]), lambda x, y: x || y) END)) AS kept_sha256
FROM hexed LEFT JOIN per USING (row)
"""
