"""Connected components of a table of links, without a graph on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import stored


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """For links (a, b) of long ids: id, component (the smallest id that can be reached), for ids in any link.

    Alternates two star contractions until nothing changes. A round aggregates minima, which combines before the shuffle, and joins them
    back, where a hub's rows can be split; no neighbourhood is gathered. Each round is a table in the scratch folder.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))

    def state(e: DataFrame):
        return e.agg(F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).first()

    now = state(edges)
    for _ in range(rounds):
        # large star: every neighbour above a node moves to the node's smallest neighbour or itself
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours move to the smallest
        large = stored(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").filter("u <> v").distinct()
        edges = stored(small, "small-star")
        before, now = now, state(edges)
        if before == now and stars(edges):
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def stars(edges: DataFrame) -> bool:
    """Whether every node points to one root and no root points on."""
    twice = edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1")
    onward = edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi")
    return twice.isEmpty() and onward.isEmpty()
