"""Lines joined at places where just two ends meet: list ranking by pointer doubling over all lines at once.

A line is walked in two directions, each a dart. After a dart comes the one that leaves the place where it arrives, if only one other end
lies there. Doubling tells in logarithmically many rounds how far each dart's chain goes on and which chains are rings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import shapes
from ..scratch import stored
from . import spatial


def shuffled(rows: DataFrame) -> DataFrame:
    """For joins of tables that grow with the lines: their files look small enough to be sent to all tasks, but their rows fill the driver's memory."""
    return rows.hint("merge")


def chained(lines: DataFrame, stops: DataFrame | None = None, rounds: int = 40) -> DataFrame:
    """Places of lines (line_id, group, start, end) in chains: line_id, group, chain_id (the smallest line_id), position from 0, back (walked from end to start), ring.

    start and end name places, of any type; ends meet only within a group. line_ids are unique, whole and not negative. A chain is walked from the end
    whose line_id is smaller; a ring from its smallest line, forward; of one line, forward. At stops (group, place) no lines are joined."""
    lines = lines.select(F.col("line_id").cast("long").alias("line_id"), "group", "start", "end")
    ends = lines.select("line_id", "group", F.inline(F.array(F.struct(F.col("start").alias("place"), F.lit(0).alias("side")), F.struct(F.col("end").alias("place"), F.lit(1).alias("side")))))
    # a place with two ends; busy places are counted before they would be joined
    two = ends.groupBy("group", "place").agg(F.count("*").alias("n"), F.min(F.struct("line_id", "side")).alias("a"), F.max(F.struct("line_id", "side")).alias("b")).filter("n = 2")
    two = two if stops is None else two.join(stops.select("group", "place").distinct(), ["group", "place"], "left_anti")
    # a dart that arrives at side s of a line goes on with the dart that leaves from the other end there: darts are 2 * line_id + (0: forward, 1: back)
    arrives, leaves = lambda e: F.col(f"{e}.line_id") * 2 + (1 - F.col(f"{e}.side")), lambda e: F.col(f"{e}.line_id") * 2 + F.col(f"{e}.side")
    follow = two.select(F.inline(F.array(F.struct(arrives("a").alias("dart"), leaves("b").alias("next")), F.struct(arrives("b").alias("dart"), leaves("a").alias("next")))))
    darts = lines.select("line_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("way")).select((F.col("line_id") * 2 + F.col("way")).alias("dart"))
    first = stored(darts.join(shuffled(follow), "dart", "left"), "darts")
    rank, low = ranked(first, rounds)
    # rings: cut before the dart of their smallest line that the ring of forward walks holds
    open_ = rank.filter("next is not null").select("dart").join(shuffled(low), "dart")
    cut = first.join(shuffled(open_), "dart").withColumn("next", F.when(F.col("next") != F.col("low"), F.col("next")))
    of_ring, _ = ranked(stored(cut.select("dart", "next"), "rings"), rounds)
    ring = of_ring.select("dart", "left").join(shuffled(open_.filter("low % 2 = 0")), "dart").select("dart", "left", F.col("low").alias("head"), F.lit(True).alias("ring"))
    path = rank.filter("next is null").select("dart", "left", F.col("last"), F.lit(False).alias("ring"))
    # both directions of a path: the one that ends with the larger line stays; the last dart of the other is the first of this, turned
    path = path.join(shuffled(low), "dart").select("dart", "left", "last", "ring", F.floor(F.col("low") / 2).alias("chain"))
    best = path.groupBy("chain", "last").agg(F.max("left").alias("most"))
    keep = best.groupBy("chain").agg(F.max_by("last", F.struct(F.floor(F.col("last") / 2), -F.col("last"))).alias("last"))
    path = path.join(shuffled(best), ["chain", "last"]).join(shuffled(keep), ["chain", "last"]).select("dart", F.col("chain").alias("chain_id"), (F.col("most") - F.col("left")).alias("position"), "ring")
    long = ring.groupBy("head").agg(F.max("left").alias("most"))
    ring = ring.join(shuffled(long), "head").select("dart", F.floor(F.col("head") / 2).alias("chain_id"), (F.col("most") - F.col("left")).alias("position"), "ring")
    found = path.unionByName(ring).select(F.floor(F.col("dart") / 2).alias("line_id"), "chain_id", "position", (F.col("dart") % 2 == 1).alias("back"), "ring")
    return found.join(shuffled(lines.select("line_id", "group")), "line_id").select("line_id", "group", "chain_id", "position", "back", "ring")


def ranked(first: DataFrame, rounds: int) -> tuple[DataFrame, DataFrame]:
    """For darts (dart, next): rank (dart, next: null where the chain ends, left: steps to its last dart, last) and low (dart, low: the smallest dart of its
    chain up to the end, of a path both directions of a line counting, of a ring all of it)."""
    state = first.select("dart", "next", F.when(F.col("next").isNull(), 0).otherwise(1).cast("long").alias("left"), F.coalesce("next", "dart").alias("last"), F.least("dart", F.coalesce("next", "dart")).alias("low"))
    state = stored(state, "ranks")
    was = None
    for _ in range(rounds):
        now = state.agg(F.count("next").alias("open"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).first()
        if now["open"] == 0 or now == was:  # what is open now are rings, whose smallest dart is known when a round changes none
            break
        was = now
        to = state.select(F.col("dart").alias("next"), F.col("next").alias("_next"), F.col("left").alias("_left"), F.col("last").alias("_last"), F.col("low").alias("_low"))
        both = state.join(shuffled(to), "next", "left")
        state = stored(both.select("dart", F.col("_next").alias("next"), (F.col("left") + F.coalesce("_left", F.lit(0))).alias("left"), F.coalesce("_last", "last").alias("last"), F.least("low", F.coalesce("_low", "low")).alias("low")), "ranks")
    else:
        raise RuntimeError(f"chains did not settle in {rounds} rounds")
    ends = state.filter("next is null")
    # a path's smallest line: what its first dart has seen
    whole = ends.groupBy("last").agg(F.min("low").alias("low"))
    low = ends.join(shuffled(whole.withColumnRenamed("low", "_low")), "last").select("dart", (F.floor(F.col("_low") / 2) * 2).alias("low"))
    return state, low.unionByName(state.filter("next is not null").select("dart", "low"))


def merged(lines: DataFrame, stops: DataFrame | None = None) -> DataFrame:
    """Lines (line_id, group, line) joined to chains by their end points: group, chain_id, n_lines, ring, line. Lines of under two points are left out; at stops (group, place: a point) none are joined."""
    rows = lines.filter(F.size("line") >= 2)
    found = chained(rows.select("line_id", "group", F.element_at("line", 1).alias("start"), F.element_at("line", -1).alias("end")), stops)
    both = rows.select("line_id", "line").join(shuffled(found), "line_id")
    turned = F.when(F.col("back"), F.reverse("line")).otherwise(F.col("line"))
    parts = both.select("group", "chain_id", "ring", F.struct("position", F.when(F.col("position") == 0, turned).otherwise(F.slice(turned, 2, F.size("line"))).alias("line")).alias("p"))
    whole = parts.groupBy("group", "chain_id", "ring").agg(F.array_sort(F.collect_list("p")).alias("p"))  # a chain is one line
    return whole.select("group", "chain_id", F.size("p").alias("n_lines"), "ring", F.flatten(F.transform("p", lambda x: x["line"])).alias("line"))


def multipolygons(members: DataFrame) -> DataFrame:
    """Areas of relations from their ways (relation_id, way_id, role, line): relation_id, shape, n_outer, n_inner, problem (shape is null with one).

    Ways of a role are joined to rings, whatever their order and direction; a role other than inner is outer. A hole goes to the smallest outer ring around
    it. Problems: `open ring` (ways that don't close, or of which three ends meet), `no outer ring`, `hole outside`."""
    rows = members.withColumn("role", F.when(F.col("role") == "inner", "inner").otherwise("outer")).select("relation_id", "role", "line")
    rows = stored(rows.withColumn("line_id", F.monotonically_increasing_id()), "ways")
    found = stored(merged(rows.withColumn("group", F.struct("relation_id", "role"))).select("group.*", "chain_id", (F.col("ring") & (F.size("line") >= 4)).alias("ring"), "line"), "ways-joined")
    rings = found.filter("ring")
    outer = rings.filter("role = 'outer'").select("relation_id", F.col("chain_id").alias("outer_id"), F.col("line").alias("outer_ring"))
    inner = rings.filter("role = 'inner'").select("relation_id", F.col("chain_id").alias("inner_id"), F.col("line").alias("inner_ring"))
    spots = inner.select("relation_id", "inner_id", F.explode_outer(F.array(spatial.inner_point(F.col("inner_ring")))).alias("p")).select("relation_id", "inner_id", "p.x", "p.y")
    span = outer.select(F.max(shapes.span(shapes.bounds(F.col("outer_ring"))))).first()[0] or 1.0
    around = spatial.points_in_areas(spots, outer.select("relation_id", "outer_id", spatial.polygon(F.col("outer_ring")).alias("shape")), "outer_id", max(span / 16, 1e-9), ("relation_id",))
    size = outer.select("outer_id", shapes.area(F.col("outer_ring")).alias("area"))
    of = around.select("inner_id", "outer_id").join(shuffled(size), "outer_id").groupBy("inner_id").agg(F.min_by("outer_id", F.struct("area", "outer_id")).alias("outer_id"))
    placed = stored(inner.join(shuffled(of), "inner_id", "left"), "holes")
    holes = placed.groupBy("outer_id").agg(F.sort_array(F.collect_list(F.struct("inner_id", "inner_ring"))).alias("h"))
    parts = outer.join(shuffled(holes), "outer_id", "left").select("relation_id", "outer_id", F.concat(F.array("outer_ring"), F.coalesce(F.transform("h", lambda x: x["inner_ring"]), F.array().cast(f"array<{shapes.LINE.simpleString()}>"))).alias("part"))
    whole = parts.groupBy("relation_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("outer_id", "part"))), lambda x: x["part"]).alias("shape"), F.count("*").alias("n_outer"))
    told = found.groupBy("relation_id").agg(F.bool_or(~F.col("ring")).alias("open"), F.count_if(F.col("ring") & (F.col("role") == "inner")).alias("n_inner"))
    lost = placed.filter("outer_id is null").select("relation_id").distinct().withColumn("lost", F.lit(True))
    every = members.select("relation_id").distinct().join(shuffled(told), "relation_id", "left").join(shuffled(whole), "relation_id", "left").join(shuffled(lost), "relation_id", "left").na.fill(0, ["n_outer", "n_inner"])
    problem = F.when(F.coalesce("open", F.lit(False)), "open ring").when(F.col("n_outer") == 0, "no outer ring").when(F.col("lost"), "hole outside")
    return every.withColumn("problem", problem).select("relation_id", F.when(F.col("problem").isNull(), F.col("shape")).alias("shape"), "n_outer", "n_inner", "problem")
