"""Queries over streams in event time. Events come in batches of some days each, some rows late or twice; the SQL tells the same from the whole table."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from ..scratch import folder
from ..streaming import accept, timed
from .catalog import query, table

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# batches of ten days; of some rows of the first five days, and some of days 12 to 18, the last batch has those that it should not have waited for
ARRIVES = "CASE WHEN event_id % 97 = 0 AND (day(ts) <= 5 OR day(ts) BETWEEN 12 AND 18) THEN 2 ELSE least((day(ts) - 1) // 10, 2) END"
SEEN = f"arrived AS (SELECT event_id, user_id, event_type, ts, {ARRIVES} AS part FROM events), seen AS (SELECT * FROM arrived WHERE NOT (part = 2 AND day(ts) <= 5)), last AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM events)"


def arriving(spark, sf_dir):
    ts, e = F.col("ts"), table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    day = F.dayofmonth(ts)
    late = (F.col("event_id") % 97 == 0) & ((day <= 5) | day.between(12, 18))
    rows = e.withColumn("part", F.when(late, 2).otherwise(F.least(F.floor((day - 1) / 10), F.lit(2))).cast("int"))
    return timed.fed(rows, "part", 3, folder(spark, "arriving"))


def drained(out):
    return accept.drained(out, folder(out.sparkSession, "stream"), folder(out.sparkSession, "stream-state"))


@contextmanager
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, was)


@query(f"""WITH {SEEN}, gaps AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 3 HOUR THEN 0 ELSE 1 END AS new FROM seen WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM gaps)
SELECT user_id, epoch_us(min(ts)) // 1000 AS start_ms, epoch_us(max(ts)) // 1000 + 10800000 AS end_ms, count(*) AS n FROM runs GROUP BY user_id, run HAVING max(ts) + INTERVAL 3 HOUR <= (SELECT mark FROM last)""")
def stream_sessions(spark, sf_dir):
    """Sessions of users with a gap of three hours; rows that come five days late are left out, sessions that may go on are not there yet."""
    found = drained(timed.sessions(arriving(spark, sf_dir), "ts", "user_id", "3 hours", "1 hour"))
    return found.select("user_id", F.unix_millis("start").alias("start_ms"), F.unix_millis("end").alias("end_ms"), "n")


@query(f"""WITH {SEEN}, w AS (SELECT event_type, unnest([0, 1, 2]) * 7200000 AS back, epoch_us(ts) // 1000 AS ms FROM seen), s AS (SELECT event_type, ms - ms % 7200000 - back AS start_ms FROM w)
SELECT start_ms, event_type, count(*) AS n FROM s WHERE start_ms + 21600000 <= (SELECT epoch_us(mark) // 1000 FROM last) GROUP BY 1, 2""")
def stream_sliding(spark, sf_dir):
    """Counts of six hours, every two hours, without the late rows."""
    found = drained(timed.sliding(arriving(spark, sf_dir), "ts", "event_type", "6 hours", "2 hours", "1 hour"))
    return found.select(F.unix_millis("start").alias("start_ms"), "event_type", "n")


@query("SELECT event_id, CASE WHEN day(ts) <= 6 AND event_id % 30 = 0 THEN 2 ELSE 1 END AS n FROM events")
def stream_once(spark, sf_dir):
    """Events by batches of six days. Every tenth comes again with the next batch and is left out; every thirtieth of the first six days comes with the last, when nobody knows it any more."""
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    rows = e.withColumn("part", F.least(F.floor((F.dayofmonth("ts") - 1) / 6), F.lit(4)).cast("int"))
    again = rows.filter("event_id % 10 = 0 and part < 4").select("event_id", (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("ts"), (F.col("part") + 1).alias("part"))
    later = rows.filter("event_id % 30 = 0 and part = 0").select("event_id", (F.col("ts") + F.expr("INTERVAL 23 DAYS")).alias("ts"), F.lit(4).alias("part"))
    stream = timed.fed(rows.unionByName(again).unionByName(later), "part", 5, folder(spark, "arriving"))
    return drained(timed.once(stream, ["event_id"], "ts", "2 days")).groupBy("event_id").agg(F.count("*").cast("int").alias("n"))


@query("SELECT a.event_id AS view_id, b.event_id AS purchase_id FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 90 MINUTE WHERE a.event_type = 'view' AND b.event_type = 'purchase'")
def stream_pairs(spark, sf_dir):
    """Views and the purchases of the same user in the next ninety minutes, from two streams."""
    both = arriving_in_order(spark, sf_dir), arriving_in_order(spark, sf_dir)
    view = both[0].filter("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    purchase = both[1].filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"))
    return drained(timed.joined(view, purchase, "user_id", "view_ts", "purchase_ts", "90 MINUTES", "1 hour").select("view_id", "purchase_id"))


def arriving_in_order(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    return timed.fed(e.withColumn("part", F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)).cast("int")), "part", 3, folder(spark, "arriving"))


@query("""WITH e AS (SELECT user_id AS id, epoch_us(ts) // 1000 AS ms, event_id % 4 <> 0 AS ok, least((day(ts) - 1) // 10, 2) AS part FROM events), parts AS (SELECT DISTINCT id, part FROM e),
known AS (SELECT p.id, p.part, min(ms) AS first, max(ms) AS last, max(CASE WHEN ok THEN ms END) AS last_ok FROM parts p JOIN e ON e.id = p.id AND e.part <= p.part GROUP BY 1, 2),
failed AS (SELECT k.*, (SELECT count(*) FROM e WHERE e.id = k.id AND e.part <= k.part AND NOT e.ok AND (k.last_ok IS NULL OR e.ms > k.last_ok)) AS failures FROM known k),
due AS (SELECT id, part, failures, last + 1000 * CASE WHEN failures > 0 THEN least(60 * 2 ** (failures - 1), 86400) WHEN last - first < 172800000 THEN 3600 ELSE 604800 END::BIGINT AS due_ms, CASE WHEN failures > 0 THEN 'retry' WHEN last - first < 172800000 THEN 'recent' ELSE 'revisit' END AS reason FROM failed)
SELECT id, due_ms, reason, failures FROM due UNION ALL SELECT id, due_ms, 'overdue', failures FROM due WHERE part = 2 AND due_ms <= (SELECT max(ms) - 3600000 FROM e)""")
def stream_due_checks(spark, sf_dir):
    """When each user's source is to be checked next, after each of three batches of fetches, of which every fourth failed; checks that the last batch's watermark finds overdue."""
    e = table(spark, sf_dir, "events").select(F.col("user_id"), (F.col("event_id") % 4 != 0).alias("ok"), F.col("ts").cast("timestamp").alias("ts"))
    rows = e.withColumn("part", F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)).cast("int"))
    with rocksdb(spark):
        found = drained(timed.due_checks(timed.fed(rows, "part", 3, folder(spark, "fetches")), "user_id", "ok", "ts", "1 hour"))
    return found.select("id", F.unix_millis("due").alias("due_ms"), "reason", "failures")
