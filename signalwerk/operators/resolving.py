"""Which of the places with a report's name is meant: those in its scope and near its roads, if they are one complex."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import shapes
from ..scratch import stored
from . import graph, spatial

IN_SCOPE, NEAR_ROAD, CONNECTED, WIDEST = 30.0, 100.0, 150.0, 1100.0


def resolved(asks: DataFrame, named: DataFrame, on_roads: DataFrame, places: DataFrame, scopes: DataFrame, roads: DataFrame) -> DataFrame:
    """For asks (id, scope_id or null) a row each: id, method, place_ids, point, extent.

    named (id, place_id) has the places of an ask's name and on_roads (id, road_id) the roads that it names, none or more; places (place_id, dimension, shape),
    scopes and roads alike, in metres. A place counts if it is at most 30 m from the scope and at most 100 m from one of the roads, where an ask has any.
    Without one: locality_conflict_review; in parts more than 150 m apart: ambiguous_place_review; wider than 1,100 m: wide_place_review; else
    named_place_representative at a point inside the largest place."""
    name = lambda rows, key, side: rows.select(F.col(key).alias(f"{side}_id"), "dimension", "shape")
    right = name(places, "place_id", "right")
    in_scope = spatial.within(name(scopes, "scope_id", "left"), right, IN_SCOPE).withColumnsRenamed({"left_id": "scope_id", "right_id": "place_id"})
    near = spatial.within(name(roads, "road_id", "left"), right, NEAR_ROAD).withColumnsRenamed({"left_id": "road_id", "right_id": "place_id"})
    rows = named.join(asks.select("id", "scope_id"), "id").distinct()
    fine = rows.filter("scope_id is null").unionByName(rows.filter("scope_id is not null").join(in_scope, ["scope_id", "place_id"]).select(rows.columns))
    bound = on_roads.select("id").distinct().withColumn("_bound", F.lit(True))
    by_road = on_roads.join(near, "road_id").select("id", "place_id").distinct().withColumn("_near", F.lit(True))
    kept = fine.join(bound, "id", "left").join(by_road, ["id", "place_id"], "left").filter(F.col("_bound").isNull() | F.col("_near")).select("id", "place_id")
    kept = stored(kept.withColumn("node", F.monotonically_increasing_id()), "places-kept")
    # parts of a complex: places close to each other that the same ask names
    pairs = spatial.within(name(places, "place_id", "left"), right, CONNECTED).filter("left_id < right_id")
    a, b = kept.select("id", F.col("place_id").alias("left_id"), F.col("node").alias("a")), kept.select("id", F.col("place_id").alias("right_id"), F.col("node").alias("b"))
    part = graph.components(a.join(pairs, "left_id").join(b, ["id", "right_id"]).select("a", "b"))
    known = kept.join(part.withColumnRenamed("id", "node"), "node", "left").withColumn("part", F.coalesce("component", "node")).join(places, "place_id")
    points = F.flatten(F.flatten("shape"))
    box, size = shapes.bounds(points), F.when(F.col("dimension") == 2, shapes.area(F.col("shape")[0][0])).otherwise(0.0)
    spot = F.when(F.col("dimension") == 2, spatial.inner_point(F.col("shape")[0][0])).otherwise(points[0])
    each = known.select("id", "place_id", "part", box.alias("box"), size.alias("size"), spot.alias("spot"))
    whole = F.struct(F.min("box.x_min").alias("x_min"), F.min("box.y_min").alias("y_min"), F.max("box.x_max").alias("x_max"), F.max("box.y_max").alias("y_max"))
    found = each.groupBy("id").agg(F.count_distinct("part").alias("parts"), F.array_sort(F.collect_list("place_id")).alias("place_ids"), whole.alias("box"), F.min_by("spot", F.struct(-F.col("size"), "place_id")).alias("point"))
    found = asks.select("id").join(found.withColumn("extent", shapes.span(F.col("box"))), "id", "left")
    method = F.when(F.col("parts").isNull(), "locality_conflict_review").when(F.col("parts") > 1, "ambiguous_place_review").when(F.col("extent") > WIDEST, "wide_place_review").otherwise("named_place_representative")
    one = lambda c: F.when(F.col("method") == "named_place_representative", F.col(c)).alias(c)
    return found.withColumn("method", method).select("id", "method", one("place_ids"), one("point"), one("extent"))
