"""Lookups of addresses, localities, routes, sites and translations, and counts before and after a change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, shapes, tags
from ..functions.text import content_hash, street_name
from .places import inside


def house_number(text: Column) -> Column:
    """A house number for comparison: no spaces, lower case."""
    return F.lower(F.regexp_replace(text, r"\s", ""))


def addressed(asked: DataFrame, addresses: DataFrame, most: float = 50.0) -> DataFrame:
    """The point of each asked address (id, street, number) among addresses (street, number, x, y), by exact street and number.

    Of several points within `most` metres the smallest by (x, y) is taken; points further apart give none, and problem says so."""
    key = lambda c: (street_name(F.col("street")).alias("_s"), house_number(F.col("number")).alias("_n"))
    found = addresses.select(*key(0), "x", "y").groupBy("_s", "_n").agg(F.min(F.struct("x", "y")).alias("_p"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("_span"))
    rows = asked.select("id", *key(0)).join(found, ["_s", "_n"], "left")
    return rows.select("id", F.when(F.col("_span") <= most, F.col("_p")).alias("p"), F.when(F.col("_p").isNull(), "unknown").when(F.col("_span") > most, "apart").alias("problem"))


def scopes(headings: DataFrame, localities: DataFrame) -> DataFrame:
    """The narrowest locality that each heading (id, district, intro) names: id, locality_id, level.

    localities (locality_id, name, level, x, y, ring) has districts (9) and neighbourhoods (10). A neighbourhood counts if its place lies in the
    named district; without one, if just one bears the name. Else the district counts."""
    low = lambda c: F.lower(F.trim(F.col(c)))
    nine = localities.filter("level = 9").select(low("name").alias("_d"), F.col("locality_id").alias("_did"), F.col("ring").alias("_ring"))
    ten = localities.filter("level = 10").select(low("name").alias("_i"), F.col("locality_id").alias("_nid"), "x", "y")
    rows = headings.select("id", low("district").alias("_d"), low("intro").alias("_i")).join(nine, "_d", "left").join(ten, "_i", "left")
    own = F.col("_nid").isNotNull() & F.coalesce(inside(F.col("x"), F.col("y"), F.col("_ring")), F.lit(True))
    picked = rows.groupBy("id").agg(F.min("_did").alias("_did"), F.count_if(own).alias("_n"), F.min(F.when(own, F.col("_nid"))).alias("_nid"))
    narrow = F.col("_n") == 1
    return picked.select("id", F.when(narrow, F.col("_nid")).otherwise(F.col("_did")).alias("locality_id"), F.when(narrow, 10).when(F.col("_did").isNotNull(), 9).alias("level"))


def routes(relations: DataFrame, ways: DataFrame, mode: str) -> DataFrame:
    """Routes (route_id, ref, members: array of way ids) on ways (way_id, tags): route_id, ref, n, members in order, operational (all ways are there and may be used by the mode)."""
    each = relations.select("route_id", "ref", F.posexplode("members").alias("pos", "way_id"))
    both = each.join(ways.select("way_id", tags.operational(F.col("tags"), mode).alias("_runs")), "way_id", "left")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("pos", "way_id"))), lambda m: m["way_id"])
    return both.groupBy("route_id", "ref").agg(F.count("*").alias("n"), listed.alias("members"), F.bool_and(F.coalesce("_runs", F.lit(False))).alias("operational"))


def way_lines(routed: DataFrame) -> DataFrame:
    """The lines that use each way of operational routes(): way_id, refs sorted."""
    each = routed.filter("operational").select(F.explode("members").alias("way_id"), "ref")
    return each.groupBy("way_id").agg(F.array_sort(F.collect_set("ref")).alias("refs"))


def market_parking(relations: DataFrame, places: DataFrame) -> DataFrame:
    """Car parks of markets: pairs that are members (relation_id, members) of one site with a market, by places (place_id, kind): parking_id, market_id."""
    each = relations.select("relation_id", F.explode(F.array_distinct("members")).alias("place_id")).join(places, "place_id")
    park = each.filter("kind = 'parking'").select("relation_id", F.col("place_id").alias("parking_id"))
    market = each.filter("kind = 'marketplace'").select("relation_id", F.col("place_id").alias("market_id"))
    return park.join(market, "relation_id").select("parking_id", "market_id").distinct()


def names_place(context: Column, name: Column) -> Column:
    """Whether a text has a name as whole words, in any case."""
    quoted = F.concat(F.lit("\\Q"), F.replace(name, F.lit("\\E"), F.lit("")), F.lit("\\E"))
    return F.regexp_like(context, F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])"), quoted, F.lit(r"(?![\p{L}\p{N}])")))


def translated(rows: DataFrame, translations: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Fields of rows (id, *fields) with their translation (path, hash, text) by field and hash of the very text: id, path, text, translation (null if none or of another text)."""
    each = rows.select("id", F.explode(F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f))])).alias("path", "text")).filter("text is not null")
    return each.withColumn("hash", content_hash(F.col("text"))).join(translations.withColumnRenamed("text", "translation"), ["path", "hash"], "left").select("id", "path", "text", "translation")


def histograms(rows: DataFrame, *cols: str) -> DataFrame:
    """Counts of the values of several columns: field, value, n."""
    each = rows.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in cols))).alias("e"))
    return each.groupBy("e.field", "e.value").agg(F.count("*").alias("n"))


def transitions(before: DataFrame, after: DataFrame, moved: float = 275.0) -> DataFrame:
    """What a change does to reports (id, method, lon, lat): one row with newly_mapped, lost, moved (further than so many metres), same."""
    b = before.select("id", F.col("lon").alias("_lon"), F.col("lat").alias("_lat"))
    both = b.join(after, "id")
    was, now = F.col("_lon").isNotNull(), F.col("lon").isNotNull()
    far = was & now & (geo.haversine(F.col("_lon"), F.col("_lat"), F.col("lon"), F.col("lat")) > moved)
    n = lambda c, name: F.count_if(F.coalesce(c, F.lit(False))).alias(name)
    return both.agg(n(~was & now, "newly_mapped"), n(was & ~now, "lost"), n(far, "moved"), F.count_if(~F.coalesce(far, F.lit(False)) & (was == now)).alias("same"))


def in_periods(rows: DataFrame, time: str, end: str, periods: dict[str, int], zone: str = "Europe/Berlin") -> DataFrame:
    """rows with each of the periods that they fall in, by the local day of a time in a zone: so many days up to `end`, which counts. Unknown times fall in none."""
    day, last = F.to_date(F.from_utc_timestamp(F.col(time), zone)), F.lit(end).cast("date")
    held = F.array_compact(F.array(*(F.when(day.between(F.date_sub(last, n - 1), last), name) for name, n in periods.items())))
    return rows.withColumn("period", F.explode(held))


def found_names(rows: DataFrame, said: str, top: int = 8) -> DataFrame:
    """The first names (id, name) that hold what was typed, in any case: earlier in the name first, then by id. A list for people, so it is short."""
    at = F.instr(F.lower("name"), said.lower())
    return rows.filter(at > 0).orderBy(at, "id").limit(top).select("id", "name")


def inventory(rows: DataFrame, states: tuple[str, ...], column: str = "state") -> DataFrame:
    """One row with how many rows are in each state, and all of them."""
    return rows.agg(F.count("*").alias("discovered"), *(F.count_if(F.col(column) == s).alias(s) for s in states))


def line_box(lines: Column) -> Column:
    """The bounding box of several lines."""
    return shapes.bounds(F.flatten(lines))
