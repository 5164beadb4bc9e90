"""Geometry that reviewers chose objects for. A decision names a method and objects; the method's family says what is derived from them, and nothing else is guessed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import shapes
from . import overlays, spatial

# The methods, by what is derived.
FAMILIES = {
    "point": ("source_coordinate", "osm_point"),
    "points": ("osm_platform_point_collection_reference", "osm_place_native_collection_reference", "osm_native_facility_reference"),
    "polygons": (
        "osm_park_footprint_reference",
        "osm_station_platform_footprint_reference",
        "official_district_footprint_reference",
        "osm_footprint",
        "osm_non_transit_footprint_reference",
        "osm_named_footprint_reference",
        "osm_place_footprint_reference",
        "osm_station_footprint_reference",
        "osm_water_footprint_reference",
        "osm_polygon",
    ),
    "lines": ("osm_line", "osm_non_transit_route", "osm_non_transit_road_reference", "osm_transit_route", "osm_transit_road_reference", "osm_transit_line_reference"),
    "segment": (
        "osm_static_road_reference_segment",
        "osm_road_segment",
        "osm_non_transit_road_reference_segment",
        "osm_transit_road_reference_segment",
        "osm_unidentified_transit_segment",
        "osm_transit_segment",
        "osm_transit_road_segment",
    ),
    "clip": ("osm_district_road_reference", "osm_district_highway_reference", "osm_road_under_bridge_reference"),
    "crossing": ("osm_rail_crossing_area_reference", "osm_intersection", "osm_junction_reference"),
    "circle": ("official_pdf_horizontal_circle_reference",),
    "none": ("none",),
}
METHODS = tuple(m for methods in FAMILIES.values() for m in methods)
#: Dimensions of a family's objects: 0 points, 1 lines, 2 rings.
DIMENSIONS = {"point": (0,), "points": (0,), "polygons": (2,), "lines": (1,), "segment": (1,), "clip": (1, 2), "crossing": (1,), "circle": (0,), "none": ()}
MOST_SPREAD = 150.0


def family(method: Column) -> Column:
    return F.coalesce(*(F.when(method.isin(*methods), name) for name, methods in FAMILIES.items()))


def is_reference_only(method: Column) -> Column:
    """Whether what a method derives shows where something is, and never counts as a place of an incident."""
    return method.contains("_reference")


def crossings(lines: Column) -> Column:
    """Where the steps of different lines of a few (array of arrays of points) cross."""
    each = F.flatten(F.transform(lines, lambda line, i: F.transform(shapes.steps(line), lambda s: F.struct(i.alias("i"), s["a"].alias("a"), s["b"].alias("b")))))
    of = lambda ss: F.flatten(F.transform(ss, lambda s: F.array_compact(F.transform(F.filter(ss, lambda t: t["i"] > s["i"]), lambda t: shapes.crossing(s["a"], s["b"], t["a"], t["b"])))))
    return shapes.let(each, of)


def united(rows: DataFrame) -> DataFrame:
    """id, _union of decisions (id, family, o) on two areas or lines or more: rings or lines of their union; of none whose objects don't fit."""
    shape = F.transform("o", lambda x: F.array(F.array(x["points"])))
    each = rows.filter(F.size("o") > 1).select("id", "family", "o", shape.alias("shapes"))
    fit = lambda name, dimension: each.filter((F.col("family") == name) & F.forall("o", lambda x: x["points"].isNotNull() & (x["dimension"] == dimension)))
    both = overlays.combined(fit("polygons", 2), ["id"], "union").unionByName(overlays.combined(fit("lines", 1), ["id"], "lines"))
    return both.select("id", F.flatten("shape").alias("_union"))


def compiled(decisions: DataFrame, objects: DataFrame) -> DataFrame:
    """Decisions (id, method, object_ids, start, end, radius) on objects (object_id, dimension, points): id, method, family, parts, usage, counts, problem.

    parts is an array of arrays of points: a point or ring or line each; of several areas or lines, those of their union. start and end are vertices
    of a segment's line. Points of circles are longitude and latitude. A decision has few objects, so they meet in its row; ids are unique. With a
    problem there are no parts.
    """
    asked = decisions.select("id", F.explode_outer(F.array_distinct("object_ids")).alias("object_id"))
    found = asked.join(objects, "object_id", "left").filter("object_id is not null")
    own = found.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("object_id", "dimension", "points"))).alias("o"))
    rows = decisions.join(own, "id", "left").withColumn("family", family(F.col("method")))
    none = F.array().cast(f"array<struct<object_id:bigint,dimension:int,points:{shapes.LINE.simpleString()}>>")
    rows = rows.withColumn("o", F.coalesce(F.transform("o", lambda x: F.struct(x["object_id"].cast("long").alias("object_id"), x["dimension"].cast("int").alias("dimension"), x["points"].alias("points"))), none))
    o, fam = F.col("o"), F.col("family")
    fits = F.coalesce(*(F.when(fam == name, F.forall(o, lambda x: x["dimension"].isin(*dims) if dims else F.lit(False))) for name, dims in DIMENSIONS.items()))
    n = lambda d: F.size(F.filter(o, lambda x: x["dimension"] == d))  # noqa: B023, E731
    points = lambda d: F.transform(F.filter(o, lambda x: x["dimension"] == d), lambda x: x["points"])  # noqa: B023, E731
    # a generator computes crossings once a row, and only where the method asks for them
    rows = rows.withColumn("_f", F.col("family"))
    rows = rows.select("*", F.explode_outer(F.array(F.when(F.col("_f") == "crossing", crossings(points(1))))).alias("_crossed")).drop("_f")
    crossed = F.coalesce("_crossed", F.array().cast(shapes.LINE))
    centre = F.when((fam == "circle") & (n(0) == 1), points(0)[0][0])
    rows = rows.withColumn("_circle", shapes.geodesic_circle(centre["x"], centre["y"], F.col("radius"))).join(united(rows), "id", "left")
    spread = lambda ps: shapes.span(shapes.bounds(ps))
    clip = F.flatten(F.transform(points(1), lambda line: F.flatten(F.transform(shapes.steps(line), lambda s: F.transform(spatial.pieces(s["a"], s["b"], points(2)[0]), lambda e: F.array(e["a"], e["b"]))))))
    parts = (
        F.when(fam.isin("point", "points"), points(0))
        .when(fam.isin("polygons", "lines"), F.coalesce("_union", F.when(fam == "polygons", points(2)).otherwise(points(1))))
        .when(fam == "segment", F.filter(F.array(shapes.cut(points(1)[0], F.col("start"), F.col("end"))), lambda x: x.isNotNull()))
        .when(fam == "clip", clip)
        .when(fam == "crossing", F.when(F.size(crossed) > 0, F.array(F.array(shapes.medoid(crossed)))))
        .when(fam == "circle", F.array(F.col("_circle")))
    )
    whole = F.size(o) == F.size(F.array_distinct("object_ids"))
    single = ((fam.isin("point", "circle")) & (n(0) != 1)) | ((fam == "segment") & (n(1) != 1)) | ((fam == "clip") & ((n(2) != 1) | (n(1) == 0))) | ((fam == "crossing") & (n(1) < 2))
    problem = (
        F.when(fam.isNull(), "unknown method")
        .when((fam == "none") & (F.size("object_ids") > 0), "objects without a method")
        .when(F.exists(o, lambda x: x["points"].isNull()) | ~whole, "missing object")
        .when((fam != "none") & (F.size(o) == 0), "no objects")
        .when(~fits, "wrong dimension")
        .when(single, "wrong number of objects")
        .when((fam == "circle") & ~F.coalesce(F.col("radius") > 0, F.lit(False)), "no radius")
    )
    # parts only where the objects are right, so no kernel meets what it is not made for
    rows = rows.withColumn("problem", problem).withColumn("parts", F.when(F.col("problem").isNull(), parts))
    empty = fam.isin("segment", "clip", "crossing") & F.col("problem").isNull() & (F.coalesce(F.size("parts"), F.lit(0)) == 0)
    wide = (fam == "crossing") & F.col("problem").isNull() & (F.size(crossed) > 1) & (spread(crossed) > MOST_SPREAD)
    rows = rows.withColumn("problem", F.coalesce("problem", F.when(wide, "crossings too far apart").when(empty, "nothing derived")))
    reference = is_reference_only(F.col("method"))
    return rows.select("id", "method", "family", F.when(F.col("problem").isNull(), F.col("parts")).alias("parts"), F.when(reference, "reference_only").otherwise("reported").alias("usage"), (F.col("problem").isNull() & ~reference & (fam != "none")).alias("counts"), "problem")
