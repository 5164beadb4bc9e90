"""WARC archives from a table of pages, and back, with payloads as rows of (record, chunk number, bytes).

No step holds a whole payload besides the row that the page came in, which is cut into chunks where it is read: digests are updated chunk by
chunk, chunks are what is shuffled and sorted, and a chunk is a row of the file. Bodies use HTTP's chunked coding, so every row of the file ends in a line end, which Spark's text sink adds. Files are gzip, so
a task reads each as one stream.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import folder, stored
from .common import dealt_join

HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
CHUNKED = "Transfer-Encoding: chunked\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload() -> Column:
    return F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")


def chunks(n_bytes: Column, size: int) -> Column:
    """Numbers of a payload's chunks; an empty payload has one empty chunk."""
    return F.sequence(F.lit(0), F.greatest(F.ceil(n_bytes / size), F.lit(1)).cast("int") - 1)


def chunk_table(pages: DataFrame, size: int, *keep: str) -> DataFrame:
    """A row per record and chunk, those of a record in order and in one task."""
    rows = pages.select(*keep, payload().alias("body")).withColumn("payload_bytes", F.octet_length("body").cast("long"))
    rows = rows.select("*", F.explode(chunks(F.col("payload_bytes"), size)).alias("chunk_no"))
    return rows.select(*keep, "payload_bytes", "chunk_no", F.substring(F.col("body"), F.col("chunk_no") * size + 1, F.lit(size)).alias("data"))


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def digests(table: DataFrame) -> DataFrame:
    """payload_digest of each record of a chunk table; a digest's state is carried from chunk to chunk."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        state = hashlib.sha1(usedforsecurity=False)
        held = 0
        for batch in batches:
            done, found = [], []
            for k, (n, data) in enumerate(zip(batch.column("payload_bytes").to_pylist(), batch.column("data"), strict=True)):
                state.update(data.as_buffer())
                held += len(data.as_buffer())
                if held == n:
                    done.append(k)
                    found.append(base32_sha1(state.digest()))
                    state, held = hashlib.sha1(usedforsecurity=False), 0
            rows = batch.select(["page_id", "row_key", "payload_bytes"]).take(pa.array(done, pa.int64()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(found, pa.string())], names=["page_id", "row_key", "payload_bytes", "payload_digest"])

    return table.select("page_id", "row_key", "payload_bytes", "data").mapInArrow(run, "page_id long, row_key long, payload_bytes long, payload_digest string")


def record_id(page: Column, key: Column) -> Column:
    """A URI of the registered form urn:uuid, from a hash of page_id and content."""
    h = F.lower(F.concat(F.lpad(F.hex(F.xxhash64(page, key)), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit("second"), page, key)), 16, "0")))
    part = lambda at, n: F.substring(h, at, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-8"), part(14, 3), F.lit("-8"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))


def decide(found: DataFrame, least: int) -> DataFrame:
    """response or revisit for each record: the smallest page_id of equal payloads of at least `least` bytes is the response."""
    key = F.concat_ws(":", "payload_digest", F.when(F.col("payload_bytes") >= least, F.lit("")).otherwise(F.concat_ws(":", F.col("page_id").cast("string"), F.col("row_key").cast("string"))))
    rows = stored(found.withColumn("same", key), "warc-payloads")
    first = rows.groupBy("same").agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row_key")).alias("first"), F.count("*").alias("n_rows"))
    both = dealt_join(rows, first, "same", "row_key", rows.count()).dropDuplicates(["page_id", "row_key"])
    revisit = ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    target = F.when(revisit, record_id(F.col("first.page_id"), F.col("first.row_key")))
    return both.select("page_id", "row_key", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first.page_id")).alias("refers_to"), target.alias("target"))


def record_rows(pages: DataFrame, decided: DataFrame, size: int, date: str) -> DataFrame:
    """The rows of the archive files, without the line end that the sink adds: a record's head, its chunks, its end."""
    body = pages.select("page_id", "row_key", "url", payload().alias("body")).withColumn("n", F.octet_length("body").cast("long"))
    n_chunks = F.ceil(F.col("n") / size).cast("int")
    body = body.select("page_id", "row_key", "url", "n", "body", F.explode(F.sequence(F.lit(-1), n_chunks)).alias("k"), n_chunks.alias("n_chunks"))
    piece = F.when((F.col("k") >= 0) & (F.col("k") < F.col("n_chunks")), F.substring(F.col("body"), F.col("k") * size + 1, F.lit(size)))
    key = lambda: F.coalesce("page_id", F.lit(-(1 << 63))).alias("key")
    c = body.select("page_id", "row_key", key(), F.when(F.col("k") < 0, F.col("url")).alias("url"), "n", "k", piece.alias("piece"))
    rows = c.join(decided.select(key(), "row_key", "payload_digest", "record_type", "refers_to", "target"), ["key", "row_key"])
    # a revisit has no body in the file
    is_response = F.col("record_type") == "response"
    rows = rows.filter(is_response | (F.col("k") < 0))
    # equal rows are records one after another; the window's partitioning, the join's as well, keeps all chunks of a record in one task
    w = Window.partitionBy("key", "row_key").orderBy("k")
    rows = rows.withColumn("copy", F.row_number().over(w) - F.rank().over(w)).sortWithinPartitions("key", "row_key", "copy", "k")
    number = lambda x: F.coalesce(F.col(x).cast("string"), F.lit("none"))
    full, rest = F.floor(F.col("n") / size), F.col("n") % size
    coded = full * (len(f"{size:x}") + size + 4) + F.when(rest > 0, F.length(F.hex(rest)) + rest + 4).otherwise(0) + 5
    block = F.when(is_response, F.lit(len(HTTP) + len(CHUNKED)) + coded).otherwise(len(HTTP) + 2)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    none = F.lit("")
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", record_id(F.col("page_id"), F.col("row_key"))),
        line("WARC-Date", F.lit(date)),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", ""))).otherwise(none),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(is_response, none).otherwise(F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)), line("WARC-Refers-To", F.col("target")), line("X-Refers-To-Page", number("refers_to")))),
        line("X-Page", number("page_id")),
        line("X-Payload-Length", F.col("n").cast("string")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", block.cast("long").cast("string")),
        F.lit("\r\n" + HTTP),
        F.when(is_response, F.lit(CHUNKED[:-1])).otherwise(F.lit("\r\n\r\n\r")),
    )
    chunk = F.concat(F.encode(F.lower(F.hex(F.octet_length("piece"))), "UTF-8"), F.lit(b"\r\n"), F.col("piece"), F.lit(b"\r"))
    return rows.select(F.when(F.col("k") < 0, F.encode(head, "UTF-8")).when(F.col("piece").isNotNull(), chunk).otherwise(F.lit(b"0\r\n\r\n\r\n\r")).alias("value"))


def write(pages: DataFrame, path: str, size: int = 1 << 18, least: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write pages (page_id, url, html) as WARC files below `path`.

    Null html is an empty payload, a null url has no WARC-Target-URI. Rows with the page_id of the response are responses too, as a
    record can't revisit its own page. A null page_id is never the smallest. Equal rows are equal records and share a record id. A payload
    of any length is written in chunks of `size` bytes. Other columns are ignored.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").withColumn("row_key", F.xxhash64("url", "html"))
    found = digests(chunk_table(rows, size, "page_id", "row_key"))
    record_rows(rows, decide(found, least), size, date).select(F.col("value").cast("string").alias("value")).write.option("compression", "gzip").text(path)


class Reader:
    """Records from the lines of archive files, one line or part of a line at a time. Keeps a header and a digest state."""

    def __init__(self):
        self.state, self.head, self.sha, self.got, self.want, self.next = "head", {}, None, 0, 0, None

    def line(self, raw: bytes) -> dict | None:
        if self.state == "data":
            raw_end = raw + b"\r\n"
            part = raw_end[: self.want]
            self.sha.update(part)
            self.got += len(part)
            self.want -= len(part)
            if not self.want:
                self.state = "chunk"
            return None
        if self.state == "chunk":
            if raw == b"":  # the end of a chunk's data, if a line end inside it has closed it
                return None
            self.want = int(raw, 16)
            self.state = "data" if self.want else "close"
            if self.state == "close":
                return self.done()
            return None
        if self.state == "head":
            if raw == b"":
                if self.head:
                    self.state = "http"
            elif b": " in raw:
                k, v = raw.split(b": ", 1)
                self.head[k.decode().lower()] = v.decode()
            return None
        if self.state == "http" and raw == b"":
            self.sha, self.got = hashlib.sha1(usedforsecurity=False), 0
            if self.head["warc-type"] == "revisit":
                return self.done()
            self.state = "chunk"
        return None

    def done(self) -> dict:
        h, number = self.head, lambda x: None if x in (None, "none") else int(x)
        told = h["warc-payload-digest"].removeprefix("sha1:")
        if h["warc-type"] == "response":
            assert told == base32_sha1(self.sha.digest()) and self.got == int(h["x-payload-length"]), f"a payload of {h['x-page']} isn't what its header says"
        self.state, self.head = "head", {}
        return {"page_id": number(h["x-page"]), "payload_bytes": int(h["x-payload-length"]), "payload_digest": told, "record_type": h["warc-type"], "refers_to": number(h.get("x-refers-to-page")), "record_id": h["warc-record-id"], "target": h.get("warc-refers-to")}


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row per record: page_id, payload_bytes, payload_digest (of the bytes read, for a response), record_type, refers_to, record_id, target (the record id of the response that a revisit refers to)."""
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, target string"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        reader = Reader()
        kinds = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()), ("target", pa.string())])
        for batch in batches:
            found = [x for raw in batch.column("value").to_pylist() if (x := reader.line(raw))]
            if found:
                yield pa.RecordBatch.from_pylist(found, kinds)

    lines = spark.read.option("lineSep", "\r\n").text(path)
    return lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(run, schema)


def archive(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write pages as WARC files and read them back, a row per page. An empty table gives no rows."""
    path = path or folder(pages.sparkSession, "warc")
    write(pages, path, **options)
    return read(pages.sparkSession, path)
