"""Scenes of announcements: what counts, what is drawn, what stays uncertain, and how places are styled by their links.

An event has `scenes`, an array of structs label, role, precision, method, usage, primary, lon, lat, verdict, incidents. Null scenes are those
of an older snapshot, an empty array says that there are none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo

# Precisions that count, methods whose results are references only, and kinds of uncertainty with the precisions that show them.
COUNTABLE = ("street", "point", "place", "address")
REFERENCE_METHODS = (
    "official_district_footprint_reference",
    "osm_junction_reference",
    "osm_named_footprint_reference",
    "osm_non_transit_footprint_reference",
    "osm_place_footprint_reference",
    "osm_rail_crossing_area_reference",
    "osm_road_under_bridge_reference",
    "osm_station_footprint_reference",
    "osm_water_footprint_reference",
)
UNCERTAIN_KINDS = {
    "district": ("district", "borough", "city", "city_only"),
    "street": ("street", "route", "road", "line", "street_only"),
    "area": ("area", "region", "neighbourhood", "neighborhood", "area_only"),
    "venue_reference": ("point", "address", "exact", "place", "venue", "poi"),
}
STREET_USAGES = ("source_road_reference_only", "carrier_line_reference_only", "source_transit_corridor_reference_only")
ROAD_REVIEWS = ("long_or_ambiguous_street_review", "disconnected_street_review")


def role_group(role: Column) -> Column:
    return F.when(role.isin("incident", "accident"), "incident").when(role == "discovery", "discovery").when(role.isin("operation", "arrest", "search"), "operation").otherwise("context")


def is_reference(scene: Column) -> Column:
    """Whether a scene shows where something is and not where it happened."""
    return F.coalesce(scene["usage"].endswith("reference_only"), F.lit(False)) | F.coalesce(scene["method"].isin(*REFERENCE_METHODS), F.lit(False))


def counts(scenes: Column) -> Column:
    """Whether an event counts by its scenes: one is the primary one, no reference, of a precision that counts and with a valid point. Without scenes it is left to the event."""
    fine = lambda s: F.coalesce(s["primary"], F.lit(False)) & ~is_reference(s) & F.coalesce(s["precision"].isin(*COUNTABLE), F.lit(False)) & F.coalesce(geo.valid_point(s["lon"], s["lat"]), F.lit(False))
    return F.exists(scenes, fine)


def countable(events: DataFrame) -> DataFrame:
    """Events that a client counts; others are left out and never an error."""
    return events.filter(F.col("scenes").isNull() | counts(F.col("scenes")))


def candidate_road(event_lon: Column, method: Column, lines: Column) -> Column:
    """The lines of a road that a review left as candidate: only of events without a point, and only if each line has two valid points."""
    valid = F.forall(lines, lambda line: (F.size(line) >= 2) & F.forall(line, lambda p: F.coalesce(geo.valid_point(p["x"], p["y"]), F.lit(False))))
    return F.when(event_lon.isNull() & method.isin(*ROAD_REVIEWS) & (F.size(lines) > 0) & valid, lines)


def coverage(events: DataFrame) -> DataFrame:
    """One row for events (scenes, lon, lat, precision, method, lines): countable, without_point, without_point_displayed."""
    own = F.coalesce(F.col("precision").isin(*COUNTABLE), F.lit(False)) & F.col("lon").isNotNull() & F.col("lat").isNotNull()
    fine = F.when(F.col("scenes").isNotNull(), counts(F.col("scenes"))).otherwise(own)
    drawn = F.exists("scenes", lambda s: F.coalesce(geo.valid_point(s["lon"], s["lat"]), F.lit(False)) & ~is_reference(s))
    shown = F.coalesce(drawn, F.lit(False)) | candidate_road(F.col("lon"), F.col("method"), F.col("lines")).isNotNull()
    return events.agg(F.count_if(fine).alias("countable"), F.count_if(~fine).alias("without_point"), F.count_if(~fine & shown).alias("without_point_displayed"))


def unplaced(events: DataFrame) -> DataFrame:
    """Incidents of events (id, incidents, scenes) that no scene shows: id, incident_id."""
    shown = F.flatten(F.transform(F.coalesce("scenes", F.array().cast(events.schema["scenes"].dataType)), lambda s: F.coalesce(s["incidents"], F.array().cast("array<string>"))))
    return events.select("id", F.explode(F.array_except("incidents", shown)).alias("incident_id"))


def is_precise(s: Column) -> Column:
    open_ = F.coalesce(s["verdict"].isin("unresolved", "needs_correction"), F.lit(False))
    return F.coalesce(s["precision"].isin("point", "address", "exact"), F.lit(False)) & s["usage"].isNull() & ~open_ & F.coalesce(geo.valid_point(s["lon"], s["lat"]), F.lit(False))


def uncertain_kind(s: Column) -> Column:
    found = [F.when(s["precision"].isin(*values), kind) for kind, values in UNCERTAIN_KINDS.items()]
    return F.coalesce(*found, F.when(s["usage"].isin(*STREET_USAGES), "street"), F.lit("no_location"))


def uncertain(events: DataFrame) -> DataFrame:
    """Scenes of events (id, scope, scenes, own) without an exact place, or the event itself, `own`, where it has no scenes: key, id, kind, status.

    Events outside the city are left out; keys that come again, too."""
    rows = events.filter(F.coalesce(F.col("scope") != "out_of_city", F.lit(True)))
    fields = lambda s: F.struct(*(s[k].cast(t).alias(k) for k, t in (("precision", "string"), ("usage", "string"), ("lon", "double"), ("lat", "double"), ("verdict", "string"))))
    listed = F.when(F.size("scenes") > 0, F.transform("scenes", fields)).otherwise(F.array(fields(F.col("own"))))
    rows = rows.select("id", F.posexplode(listed).alias("i", "s")).filter(~is_precise(F.col("s")))
    s = F.col("s")
    status = F.when(s["verdict"] == "unresolved", "unresolved").when(s["usage"].isNotNull() & F.coalesce(s["verdict"] != "needs_correction", F.lit(True)), "reference_only").otherwise("insufficient_precision")
    return rows.select(F.concat_ws("/", F.col("id").cast("string"), F.col("i").cast("string")).alias("key"), "id", uncertain_kind(s).alias("kind"), status.alias("status")).dropDuplicates(["key"])


def uncertainty(rows: DataFrame) -> DataFrame:
    """Announcements and scenes of uncertain() by kind, and of all kinds: kind, announcements, scenes."""
    each = rows.groupBy("kind").agg(F.countDistinct("id").alias("announcements"), F.count("*").alias("scenes"))
    return each.unionByName(rows.agg(F.lit("all").alias("kind"), F.countDistinct("id").alias("announcements"), F.count("*").alias("scenes")))


def link_class(status: Column) -> Column:
    return F.when(status.startswith("context_"), "context").when(status.isin("approximate_candidate", "named_place_candidate"), "candidate").otherwise("count")


def styled(places: DataFrame, links: DataFrame, events: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Places (place_id, kind, scope, contexts) of the chosen kinds, with how many selected events (id) link to them (event_id, place_id, status) by class, and their opacity.

    A place with a scope is chosen by that, others by any of their contexts, or their kind without any."""
    chosen, contexts = F.array(*map(F.lit, kinds)), F.coalesce("contexts", F.array("kind"))
    rows = places.filter(F.when(F.col("scope").isNotNull(), F.col("scope").isin(*kinds)).otherwise(F.arrays_overlap(contexts, chosen)))
    shown = F.when(F.col("scope").isNotNull(), F.col("kind")).otherwise(F.coalesce(F.get(F.filter(contexts, lambda k: k.isin(*kinds)), F.lit(0)), F.col("kind")))
    own = links.join(events.select(F.col("id").alias("event_id")).distinct(), "event_id", "left_semi").select("place_id", "event_id", link_class(F.col("status")).alias("class")).distinct()
    n = own.groupBy("place_id").agg(*(F.count_if(F.col("class") == c).alias(f"n_{c}") for c in ("count", "candidate", "context")))
    out = rows.join(n, "place_id", "left").na.fill(0, ["n_count", "n_candidate", "n_context"])
    total = F.col("n_count") + F.col("n_candidate") + F.col("n_context")
    return out.select("place_id", shown.alias("display_kind"), "n_count", "n_candidate", "n_context", total.alias("n"), F.least(F.lit(0.78), F.lit(0.12) + F.lit(0.16) * F.log2(total + 1)).alias("opacity"))
