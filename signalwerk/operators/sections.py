"""The piece of a street between two of its points: the shortest way along the street's own lines.

Lines are joined to chains first, so a round of the search crosses a whole chain. All asks go on at once: a round joins the places reached
last with the chains that begin there and keeps the shorter ways; it ends when no way gets shorter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import shapes
from ..scratch import stored
from . import chains


def between(lines: DataFrame, asks: DataFrame, rounds: int = 200) -> DataFrame:
    """For asks (id, street, start, end: ends of lines) the shortest way along the street's lines (line_id, street, line): id, length, line; length and line
    are null where no way leads there, and the line is one point where start is end. Of ways of equal length the one with the smaller chain ids is taken."""
    points = asks.select(F.col("street").alias("group"), F.explode(F.array("start", "end")).alias("place"))
    roads = stored(chains.merged(lines.withColumnRenamed("street", "group"), points).select(F.col("group").alias("street"), "chain_id", "line", shapes.length(F.col("line")).alias("metres")), "street-chains")
    way = lambda a, b, back: F.struct(F.element_at("line", a).alias("from"), F.element_at("line", b).alias("to"), F.lit(back).alias("back"))
    arcs = stored(roads.select("street", "chain_id", "metres", F.inline(F.array(way(1, -1, False), way(-1, 1, True)))), "street-arcs")
    none = F.array().cast("array<struct<chain_id:bigint,back:boolean>>")
    state = stored(asks.select("id", "street", F.col("start").alias("at"), F.lit(0.0).alias("metres"), none.alias("way"), F.lit(True).alias("new")), "ways")
    for _ in range(rounds):
        step = state.filter("new").join(arcs.withColumnRenamed("metres", "_metres"), (F.col("at") == F.col("from")) & (state["street"] == arcs["street"])).select("id", state["street"], F.col("to").alias("at"), (F.col("metres") + F.col("_metres")).alias("metres"), F.concat("way", F.array(F.struct("chain_id", "back"))).alias("way"))
        both = state.select("id", "street", "at", "metres", "way", F.lit(False).alias("new")).unionByName(step.withColumn("new", F.lit(True)))
        # a place that is not reached on a shorter way stays as it was
        state = stored(both.groupBy("id", "street", "at").agg(F.min(F.struct("metres", "new", "way")).alias("b")).select("id", "street", "at", "b.metres", "b.way", "b.new"), "ways")
        if state.filter("new").isEmpty():
            break
    else:
        raise RuntimeError(f"sections did not settle in {rounds} rounds")
    found = state.select("id", F.col("at").alias("end"), "metres", "way").join(asks.select("id", "end"), ["id", "end"])
    parts = found.select("id", F.posexplode("way").alias("no", "w")).select("id", "no", "w.chain_id", "w.back").join(roads.select("chain_id", "line"), "chain_id")
    turned = F.when(F.col("back"), F.reverse("line")).otherwise(F.col("line"))
    pieces = parts.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("no", F.when(F.col("no") == 0, turned).otherwise(F.slice(turned, 2, F.size("line"))).alias("line")))).alias("p"))
    line = pieces.select("id", F.flatten(F.transform("p", lambda x: x["line"])).alias("line"))
    every = asks.select("id", F.col("start").alias("_start")).join(found.select("id", F.col("metres").alias("length")), "id", "left").join(line, "id", "left")
    return every.select("id", "length", F.when(F.col("length").isNotNull(), F.coalesce("line", F.array("_start"))).alias("line"))
