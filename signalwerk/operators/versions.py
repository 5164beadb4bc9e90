"""Versions of records by content: revisions, latest rows, fetch queue, snapshot differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The last row of each key in an order that must be total; aggregation combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def revisions(df: DataFrame, key: str, content: str, *order: str) -> DataFrame:
    """df with `revision`, which starts at 1 and grows when a key's content changes, and `change` (new, revised, unchanged)."""
    w = Window.partitionBy(key).orderBy(*order)
    before = F.lag(content).over(w)
    first = F.row_number().over(w) == 1
    change = F.when(first, "new").when(before.eqNullSafe(F.col(content)), "unchanged").otherwise("revised")
    rows = df.withColumn("change", change)
    return rows.withColumn("revision", F.sum(F.when(F.col("change") != "unchanged", 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))


def due(df: DataFrame, now: float, limit: int) -> DataFrame:
    """Reports to fetch: never fetched first, then the longest unchecked, then the newest. `limit` is the size of a fetch run."""
    open_ = (F.col("retry_after") <= now) & (F.col("body").isNull() | F.col("checked").isNull() | (F.col("checked") < now - 7 * 86400) | (F.col("published_s") >= now - 2 * 86400))
    return df.filter(open_).orderBy(F.col("body").isNotNull(), F.coalesce("checked", F.lit(0.0)), F.desc("published_s"), "id").limit(limit)


def snapshot_merged(old: DataFrame, new: DataFrame, key: str, content: str) -> DataFrame:
    """A complete new scan over an old one: key, content, active (in the new scan), status (added, removed, changed, same)."""
    o, n = old.select(F.col(key), F.col(content).alias("_old"), F.lit(True).alias("_in_old")), new.select(F.col(key), F.col(content).alias("_new"), F.lit(True).alias("_in_new"))
    both = o.join(n, key, "full_outer")
    status = F.when(F.col("_in_old").isNull(), "added").when(F.col("_in_new").isNull(), "removed").when(F.col("_old").eqNullSafe(F.col("_new")), "same").otherwise("changed")
    return both.select(key, F.when(F.col("_in_new").isNull(), F.col("_old")).otherwise(F.col("_new")).alias(content), F.col("_in_new").isNotNull().alias("active"), status.alias("status"))


def earlier_references(df: DataFrame, key: str, refers: str, time: str) -> DataFrame:
    """Pairs (key, earlier) where a row refers to exactly one other row, which came before it."""
    links = df.select(F.col(key).alias("_id"), F.col(time).alias("_time"), F.explode(F.array_distinct(refers)).alias("_ref"))
    found = links.join(df.select(F.col(key).alias("_ref"), F.col(time).alias("_then")), "_ref").filter((F.col("_then") < F.col("_time")) & (F.col("_ref") != F.col("_id")))
    return found.groupBy(F.col("_id").alias(key)).agg(F.count("*").alias("_n"), F.min("_ref").alias("earlier")).filter("_n = 1").drop("_n")
