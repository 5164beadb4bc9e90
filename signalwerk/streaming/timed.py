"""Streams over event time: sessions, sliding windows, repeats within a watermark, joins of two streams, and a loop of due checks with timers."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sessions(stream: DataFrame, time: str, by: str, gap: str, late: str) -> DataFrame:
    """Runs of a key's rows that follow each other within a gap: by, start, end (of the last row, plus the gap), n. A session comes out once the watermark has passed it."""
    return stream.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count("*").alias("n")).select(by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def sliding(stream: DataFrame, time: str, by: str, width: str, slide: str, late: str) -> DataFrame:
    """Counts in windows of a width that begin every `slide`: start, by, n, once the watermark has passed them."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width, slide).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def once(stream: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """Rows whose keys no row of the last `late` had; state goes with the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def joined(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, most: str, late: str) -> DataFrame:
    """Pairs of rows with a key, the right one not before the left one and at most `most` later. Both sides' rows are kept only as long as a partner may come."""
    a, b = left.withWatermark(left_time, late).alias("a"), right.withWatermark(right_time, late).alias("b")
    soon = (F.col(f"b.{right_time}") >= F.col(f"a.{left_time}")) & (F.col(f"b.{right_time}") <= F.col(f"a.{left_time}") + F.expr(f"INTERVAL {most}"))
    return a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & soon)


DUE = "id long, due timestamp, reason string, failures long"
RECENT_S, RECENT_EVERY_S, REVISIT_S, LEAST_WAIT_S, MOST_WAIT_S, FORGET_S = 2 * 86400, 3600, 7 * 86400, 60, 86400, 30 * 86400


def loop_class():
    """A class, made late so that this module can be imported without the package that stateful processors need."""
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    class Loop(StatefulProcessor):
        """Due checks of one source: a failed fetch is tried again after a wait that doubles, a source that is new is checked hourly for two days, all others every seven days. A source without a fetch in thirty days is forgotten."""

        def init(self, handle) -> None:
            self.handle = handle
            self.state = handle.getValueState("state", "first_ms long, last_ms long, failures long")

        def close(self) -> None:
            pass

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            first, last, failures = self.state.get() if self.state.exists() else (None, None, 0)
            fetched = pd.concat(list(rows)).sort_values(["t_ms", "ok"])
            for t, ok in zip(fetched["t_ms"], fetched["ok"], strict=True):
                first, last, failures = t if first is None else min(first, t), t if last is None else max(last, t), 0 if ok else failures + 1
            self.state.update((int(first), int(last), int(failures)))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
            wait, reason = self.wait(first, last, failures)
            self.handle.registerTimer(int(last + wait * 1000))
            yield pd.DataFrame([(key[0], pd.Timestamp(int(last + wait * 1000), unit="ms"), reason, int(failures))], columns=["id", "due", "reason", "failures"])

        def wait(self, first, last, failures) -> tuple[int, str]:
            if failures:
                return min(LEAST_WAIT_S * 2 ** min(int(failures) - 1, 30), MOST_WAIT_S), "retry"
            return (RECENT_EVERY_S, "recent") if last - first < RECENT_S * 1000 else (REVISIT_S, "revisit")

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            first, last, failures = self.state.get()
            at = expiredTimerInfo.getExpiryTimeInMs()
            if at - last >= FORGET_S * 1000:
                self.state.clear()
                yield pd.DataFrame([(key[0], pd.Timestamp(at, unit="ms"), "forgotten", int(failures))], columns=["id", "due", "reason", "failures"])
                return
            self.handle.registerTimer(int(min(at + REVISIT_S * 1000, last + FORGET_S * 1000)))
            yield pd.DataFrame([(key[0], pd.Timestamp(at, unit="ms"), "overdue", int(failures))], columns=["id", "due", "reason", "failures"])

    return Loop


def due_checks(stream: DataFrame, key: str, ok: str, time: str, late: str) -> DataFrame:
    """When each source is to be checked next, from a stream of fetches (key, ok, time): id, due, reason (retry, recent, revisit; overdue when a check has not come; forgotten), failures.

    A row for each batch that has fetches of a source, and one when a timer passes without any. Needs the RocksDB state store."""
    rows = stream.withWatermark(time, late).select(F.col(key).cast("long").alias("id"), F.unix_millis(time).alias("t_ms"), F.col(ok).alias("ok"), time)
    return rows.groupBy("id").transformWithStateInPandas(loop_class()(), DUE, "append", "eventTime")


def fed(rows: DataFrame, part: str, parts: int, path: str) -> DataFrame:
    """A stream that reads rows in as many batches as parts, in their order; the column part is left out."""
    for i in range(parts):
        rows.filter(F.col(part) == i).drop(part).coalesce(1).write.mode("append").parquet(path)
    return rows.sparkSession.readStream.schema(rows.drop(part).schema).option("maxFilesPerTrigger", 1).parquet(path)
