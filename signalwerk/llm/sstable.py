"""Token ids in sorted-string-table shards, and their lookup.

A shard is one file: data blocks, then one row that holds index, Bloom filter and footer. Spark's text sink writes the files, a row for
each block, through whatever file system the folder is in; the line end it adds after a row is part of the format. Shards lie in folders
manifest=0/range_no=R/shard=S, whose numbers, not names of files, tell their order. Lines of JSON below manifest=1 tell each shard's
smallest and largest identifier, so a lookup opens only the shards that may have one.

data block   zstd of entries: shared, fresh and value lengths (varints), the key's fresh bytes, the ids (2 or 4 bytes each, little-endian)
key          00 for a null identifier; else 01 and the identifier as 8 big-endian bytes, sign bit flipped
index        for each block: last key length (1 byte), last key, offset (8), length (4), entries (4)
footer       index offset, Bloom offset, documents, tokens (8 each), ids' width, hash functions (4 each), magic (8); then the line end
"""

from __future__ import annotations

import json
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import folder
from .common import slices, text_or_empty, tokenizer_path

MAGIC = b"TOKSST01"
FOOTER = struct.Struct("<QQQQII8s")
HASHES = 7
LEAST = -(1 << 63)


def key_of(ident: int | None) -> bytes:
    return b"\0" if ident is None else b"\1" + ((ident + (1 << 63)) & (2**64 - 1)).to_bytes(8, "big")


def ident_of(key: bytes) -> int | None:
    return None if key == b"\0" else int.from_bytes(key[1:], "big") - (1 << 63)


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(raw: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = raw[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def bloom_places(key: bytes, bits: int) -> list[int]:
    a, b = zlib.crc32(key), zlib.crc32(key, 0x9E3779B9) | 1
    return [(a + i * b) % bits for i in range(HASHES)]


class ShardWriter:
    """Blocks of a shard from entries in key order. Holds one block, the index and the keys' Bloom places."""

    def __init__(self, width: int, block: int = 1 << 16):
        import zstandard

        self.pack, self.width, self.block = zstandard.ZstdCompressor(level=1).compress, width, block
        self.raw, self.last, self.entries, self.offset = bytearray(), b"", 0, 0
        self.index, self.keys, self.tokens = bytearray(), [], 0

    def add(self, key: bytes, ids: bytes) -> Iterator[bytes]:
        shared = 0
        if self.entries:
            while shared < min(len(key), len(self.last)) and key[shared] == self.last[shared]:
                shared += 1
        self.raw += varint(shared) + varint(len(key) - shared) + varint(len(ids)) + key[shared:] + ids
        self.last, self.entries, self.tokens = key, self.entries + 1, self.tokens + len(ids) // self.width
        self.keys.append(key)
        if len(self.raw) >= self.block:
            yield self.flush()

    def flush(self) -> bytes:
        out = self.pack(bytes(self.raw))
        self.index += bytes([len(self.last)]) + self.last + struct.pack("<QII", self.offset, len(out), self.entries)
        self.offset += len(out) + 1
        self.raw, self.entries = bytearray(), 0
        return out

    def close(self) -> Iterator[bytes]:
        if self.entries:
            yield self.flush()
        if self.keys:
            bits = max(64, 10 * len(self.keys))
            bloom = bytearray((bits + 7) // 8)
            for key in self.keys:
                for x in bloom_places(key, 8 * len(bloom)):
                    bloom[x >> 3] |= 1 << (x & 7)
            yield bytes(self.index + bloom) + FOOTER.pack(self.offset, self.offset + len(self.index), len(self.keys), self.tokens, self.width, HASHES, MAGIC)


class Shard:
    def __init__(self, raw: bytes):
        import zstandard

        self.raw, self.unpack = raw, zstandard.ZstdDecompressor().decompress
        at = len(raw) - FOOTER.size - 1
        index, bloom, self.docs, self.tokens, self.width, _, magic = FOOTER.unpack_from(raw, at)
        assert magic == MAGIC, "not a shard"
        self.bloom, self.blocks = raw[bloom:at], []
        while index < bloom:
            n = raw[index]
            self.blocks.append((raw[index + 1 : index + 1 + n], *struct.unpack_from("<QII", raw, index + 1 + n)))
            index += n + 17

    def entries(self, k: int) -> Iterator[tuple[bytes, bytes]]:
        _, offset, size, n = self.blocks[k]
        raw, at, key = self.unpack(self.raw[offset : offset + size]), 0, b""
        for _ in range(n):
            shared, at = read_varint(raw, at)
            fresh, at = read_varint(raw, at)
            size, at = read_varint(raw, at)
            key = key[:shared] + raw[at : at + fresh]
            at += fresh
            yield key, raw[at : at + size]
            at += size

    def scan(self) -> Iterator[tuple[bytes, bytes]]:
        for k in range(len(self.blocks)):
            yield from self.entries(k)

    def find(self, ident: int | None) -> list[bytes]:
        """The ids of each document of that identifier: Bloom filter, binary search in the index, then one block or its neighbours."""
        key, bits = key_of(ident), 8 * len(self.bloom)
        if not all(self.bloom[x >> 3] >> (x & 7) & 1 for x in bloom_places(key, bits)):
            return []
        k, out = bisect_left([b[0] for b in self.blocks], key), []
        while k < len(self.blocks):
            got = list(self.entries(k))
            out += [v for x, v in got if x == key]
            if got[-1][0] > key:
                break
            k += 1
        return out


def range_edges(docs: DataFrame, range_chars: int, most_ranges: int) -> list[int]:
    """doc_ids that part the documents into ranges of about range_chars characters, at most `most_ranges` of them. A doc_id that
    many rows have may come more than once; a hash of the text then parts its rows."""
    told = docs.select(F.coalesce(F.sum(F.coalesce(F.length("text"), F.lit(0)) + 16), F.lit(0)).alias("n")).first()["n"]
    n = min(max(1, -(-told // range_chars)), most_ranges)
    if n == 1:
        return []
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST))
    return docs.select(F.percentile_approx(key, [i / n for i in range(1, n)], max(10_000, 20 * n)).alias("e")).first()["e"]


def write(docs: DataFrame, path: str, vocabulary: str = "byte_bpe_50k.json", end_id: int = 0, range_chars: int = 32_000_000, shard_ids: int = 16_000_000, most_ranges: int = 100_000) -> None:
    """Encode documents (doc_id, text) and write shards below `path`, one after another in ascending doc_id order (null first, then equal ids by a hash of the text).

    A task writes a range of about range_chars characters, in shards of about shard_ids ids, and at least one document each. Texts are
    encoded where they are read; only ids are shuffled.
    """
    edges = range_edges(docs, range_chars, most_ranges)
    shared = docs.sparkSession.sparkContext.broadcast(edges)  # at most most_ranges numbers

    def encode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from .encoding import encoder

        enc, ends = encoder(tokenizer_path(vocabulary)), np.array(shared.value, np.int64)
        for batch in batches:
            for part in slices(batch, rows=8192, size=2_000_000):
                ids, at = enc.encode_flat(part.column("text"), end_id)
                key, tie = np.asarray(part.column("doc_id").fill_null(LEAST)), np.asarray(part.column("tie"))
                low, high = np.searchsorted(ends, key, "left"), np.searchsorted(ends, key, "right")
                share = tie / 2.0**64 + 0.5
                ranges = low + np.minimum(np.floor(share * (high - low + 1)), high - low).astype(np.int64)
                raw = ids.astype("<u2" if enc.narrow(end_id) else "<u4").tobytes()
                at = at * (2 if enc.narrow(end_id) else 4)
                kept = pa.array([raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(ranges, pa.int32()), part.column("doc_id"), part.column("tie"), kept], names=["range_no", "doc_id", "tie", "ids"])

    def shards(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from .encoding import encoder

        width = 2 if encoder(tokenizer_path(vocabulary)).narrow(end_id) else 4
        out, where, number, known, seq = None, -1, 0, None, 0

        def close() -> list[tuple]:
            first, last, nulls = known
            rows = [(0, where, number, x) for x in out.close()]
            told = {"r": where, "s": number, "first_id": first, "last_id": last, "nulls": nulls, "docs": len(out.keys), "ids": out.tokens}
            return [*rows, (1, -1, -1, json.dumps(told).encode())]

        for batch in batches:
            rows = []
            for at, doc, ids in zip(batch.column("range_no").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                if out is not None and (at != where or out.tokens >= shard_ids):
                    rows += close()
                    number = number + 1 if at == where else 0
                    out = None
                if out is None:
                    out, known = ShardWriter(width), [None, None, 0]
                where = at
                known = [known[0] if known[0] is not None else doc, doc if doc is not None else known[1], known[2] + (doc is None)]
                rows += [(0, where, number, x) for x in out.add(key_of(doc), ids.as_py())]
            if rows:
                yield as_batch(pa, rows, seq)
                seq += len(rows)
        if out is not None:
            yield as_batch(pa, close(), seq)

    def as_batch(pa, rows: list[tuple], seq: int):
        manifest, where, number, value = zip(*rows, strict=True)
        kinds = pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()
        cols = manifest, where, number, range(seq, seq + len(rows)), value
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["manifest", "range_no", "shard", "seq", "value"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), text_or_empty().alias("text"))
    coded = rows.mapInArrow(encode, "range_no int, doc_id long, tie long, ids binary")
    dealt = coded.repartitionById(len(edges) + 1, F.col("range_no")).sortWithinPartitions("range_no", F.col("doc_id").asc_nulls_first(), "tie", "ids")
    blocks = dealt.mapInArrow(shards, "manifest int, range_no int, shard int, seq long, value binary").sortWithinPartitions("manifest", "range_no", "shard", "seq")
    blocks.select("manifest", "range_no", "shard", F.col("value").cast("string").alias("value")).write.partitionBy("manifest", "range_no", "shard").text(path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A row per shard: range_no, shard, first_id, last_id (null if all its identifiers are), nulls, docs, ids. Opens no shard."""
    told = spark.read.schema("r int, s int, first_id long, last_id long, nulls long, docs long, ids long, manifest int").json(path).filter("manifest = 1")
    return told.select(F.col("r").alias("range_no"), F.col("s").alias("shard"), "first_id", "last_id", "nulls", "docs", "ids")


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).filter("manifest = 0 and length > 0").select("range_no", "shard", "content")


def starts(shards: DataFrame) -> DataFrame:
    """The ids in all shards before each of a manifest: range_no, shard, before. The window over ranges has a row for each, and their number is bounded."""
    by_range = shards.groupBy("range_no").agg(F.sum("ids").alias("n"))
    by_range = by_range.select("range_no", (F.sum("n").over(Window.orderBy("range_no")) - F.col("n")).alias("ranges_before"))
    within = F.sum("ids").over(Window.partitionBy("range_no").orderBy("shard")) - F.col("ids")
    return shards.select("range_no", "shard", within.alias("within")).join(by_range, "range_no").select("range_no", "shard", (F.col("ranges_before") + F.col("within")).alias("before"))


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read(spark: SparkSession, path: str) -> DataFrame:
    """The documents of all shards: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the ids as 32-bit integers)."""

    def scan(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for where, number, raw in zip(batch.column("range_no").to_pylist(), batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                cols: list[list] = [[], [], [], []]
                shard, at = Shard(raw.as_py()), 0
                for key, ids in shard.scan():
                    n = len(ids) // shard.width
                    for c, x in zip(cols, (ident_of(key), at, n, zlib.crc32(np.frombuffer(ids, "<u2").astype("<u4").tobytes() if shard.width == 2 else ids)), strict=True):
                        c.append(x)
                    at += n
                names = pa.array([where] * len(cols[0]), pa.int32()), pa.array([number] * len(cols[0]), pa.int32())
                yield pa.RecordBatch.from_arrays([*names, *(pa.array(c, pa.int64()) for c in cols)], names=["range_no", "shard", "doc_id", "local_start", "n_tokens", "ids_crc32"])

    shards = manifest(spark, path)
    if shards.isEmpty():
        return spark.createDataFrame([], READ)
    found = shard_files(spark, path).mapInArrow(scan, "range_no int, shard int, doc_id long, local_start long, n_tokens long, ids_crc32 long")
    return found.join(starts(shards), ["range_no", "shard"]).select("doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def candidates(spark: SparkSession, path: str, idents: list[int | None]) -> list[tuple[int, int]]:
    """The shards (range_no, shard) whose range of identifiers holds one of `idents`, by the manifest alone."""
    wanted = F.broadcast(spark.createDataFrame([(i,) for i in idents], "want long"))  # as many as the caller asks for
    holds = F.col("want").between(F.col("first_id"), F.col("last_id")) | (F.col("want").isNull() & (F.col("nulls") > 0))
    return [tuple(r) for r in manifest(spark, path).join(wanted, holds).select("range_no", "shard").distinct().orderBy("range_no", "shard").collect()]


def lookup(spark: SparkSession, path: str, idents: list[int | None]) -> DataFrame:
    """The ids of some documents: doc_id, ids. Only candidate shards are opened, each is asked through its Bloom filter and index, and other blocks stay packed."""

    def ask(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for raw in batch.column("content"):
                shard = Shard(raw.as_py())
                got = [(i, np.frombuffer(v, f"<u{shard.width}").astype("i8").tolist()) for i in idents for v in shard.find(i)]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in got], pa.int64()), pa.array([v for _, v in got], pa.list_(pa.int64()))], names=["doc_id", "ids"])

    where = candidates(spark, path, idents)
    if not where:
        return spark.createDataFrame([], "doc_id long, ids array<long>")
    asked = F.concat_ws("/", "range_no", "shard").isin([f"{r}/{s}" for r, s in where])  # one set, however many shards
    return shard_files(spark, path).filter(asked).select("content").mapInArrow(ask, "doc_id long, ids array<long>")


def token_shards(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write documents to shards and read them back: doc_id, start, n_tokens, ids_crc32.

    Null text is empty and gives one id, the end id. Null doc_ids come first; repeated doc_ids keep a row each. An empty table gives no rows.
    A text of any length is one entry. Other columns are ignored.
    """
    path = path or folder(docs.sparkSession, "token-shards")
    write(docs, path, **options)
    return read(docs.sparkSession, path)
