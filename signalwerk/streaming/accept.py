"""Streams: accepting contents as versions, and windows over event time."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def versioned(stream: DataFrame, key: str, content: str, time: str) -> DataFrame:
    """A row per new or revised content of a key: key, revision, change, content hash, time. A key's state is its last hash and revision.

    Rows of a key within a micro-batch are taken in time order."""
    import pandas as pd

    def accept(ident: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, revision = state.get if state.exists else (None, 0)
        rows = pd.concat(parts).sort_values(["t", "sha"])
        out = []
        for sha, t in zip(rows["sha"], rows["t"], strict=True):
            if sha != last:
                revision += 1
                out.append((ident[0], revision, "new" if revision == 1 else "revised", sha, t))
                last = sha
        state.update((last, revision))
        yield pd.DataFrame(out, columns=["id", "revision", "change", "sha", "t"])

    rows = stream.select(F.col(key).cast("long").alias("id"), F.sha2(F.col(content).cast("string"), 256).alias("sha"), F.col(time).alias("t"))
    return rows.groupBy("id").applyInPandasWithState(accept, "id long, revision long, change string, sha string, t timestamp", "sha string, revision long", "append", "NoTimeout")


def windows(stream: DataFrame, time: str, by: str, width: str, late: str) -> DataFrame:
    """Counts in tumbling windows of event time; rows later than `late` behind the newest are left out once a window is closed."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def drained(out: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run an append stream over what is there now into a table, and read it."""
    out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return out.sparkSession.read.schema(out.schema).parquet(path)


def closed(out: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run windowed counts over what is there now and read them: each batch replaces the counts of the windows that it touched.

    Windows that no later row closes come out as they stand, as each batch's changes are written with its number and the latest count of a
    window is read."""

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(path)

    out.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    keys = [c for c in out.columns if c != "n"]
    return out.sparkSession.read.parquet(path).groupBy(*keys).agg(F.max_by("n", "batch").alias("n"))
