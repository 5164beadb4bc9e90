"""Decisions of reviewers: what is wrong with them, how they join records and each other, and what they add up to. Problems are arrays of texts, empty where nothing is wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.text import collapsed

# What scenes, cases and categories may be.
SCENE_ROLES = ("incident", "accident", "discovery", "operation", "arrest", "search", "background", "unknown")
SCENE_PRECISIONS = ("point", "street", "place", "address", "area", "district", "route", "unknown")
CASE_RELATIONS = ("independent_case", "same_case_phase", "search_arrest_operation", "background_reference", "unresolved_relation")
CATEGORIES = ("Betrug", "Betäubungsmittel", "Diebstahl", "Eigentumsdelikt", "Gewalt", "Raub", "Sachbeschädigung", "Sexualdelikt", "Unklassifiziert", "Verkehr / sonstige Meldung", "Waffendelikt")
TRANSIT_MODES = ("bus", "tram", "subway", "train", "ferry", "other")
TRANSIT_EXTENTS = ("full_line", "source_segment")
CONTEXT_SCOPES = ("along_geometry", "near_geometry", "named_object")


def problems(rules: tuple[tuple[Column, str], ...]) -> Column:
    """The texts of the rules that hold, or are null."""
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(True)), what) for c, what in rules)))


def quoted(quote: Column, body: Column, least: int = 15) -> Column:
    said = collapsed(F.coalesce(quote, F.lit("")))
    return (F.length(said) >= least) & F.coalesce(body.contains(said), F.lit(False))


def scene_problems(s: Column, body: Column) -> Column:
    """Of one scene (role, precision, relation, quote, lon, lat, primary)."""
    place = s["lon"].isNotNull() | s["lat"].isNotNull()
    rules = (
        (~s["role"].isin(*SCENE_ROLES), "role"),
        (~s["precision"].isin(*SCENE_PRECISIONS), "precision"),
        (~s["relation"].isin(*CASE_RELATIONS), "relation"),
        (~quoted(s["quote"], body), "quote"),
        (place & ~F.coalesce(geo.valid_point(s["lon"], s["lat"]), F.lit(False)), "place"),
        (s["primary"] & ~place, "primary without place"),
    )
    return problems(rules)


def scene_decisions(decisions: DataFrame) -> DataFrame:
    """Decisions (id, sha, source_sha, body, scenes) with problems: of their scenes, one primary scene at most, and the text that they were made on."""
    each = F.flatten(F.transform("scenes", lambda s: scene_problems(s, F.col("body"))))
    whole = problems(((F.col("sha") != F.col("source_sha"), "stale"), (F.size("scenes") == 0, "no scenes"), (F.size(F.filter("scenes", lambda s: s["primary"])) > 1, "several primary scenes")))
    return decisions.withColumn("problems", F.array_sort(F.array_distinct(F.concat(each, whole))))


def context_problems(kind: Column, scope: Column, radius: Column, quote: Column, body: Column) -> Column:
    """Of a place context: only near_geometry has a radius, up to a kilometre."""
    near = scope == "near_geometry"
    return problems(((~kind.rlike("^[a-z][a-z0-9_:-]*$"), "kind"), (~scope.isin(*CONTEXT_SCOPES), "scope"), (F.when(near, F.coalesce(~radius.between(0.001, 1000), F.lit(True))).otherwise(radius.isNotNull()), "radius"), (~quoted(quote, body), "quote")))


def transit_problems(mode: Column, extent: Column, line: Column) -> Column:
    return problems(((~mode.isin(*TRANSIT_MODES), "mode"), (~extent.isin(*TRANSIT_EXTENTS), "extent"), (F.coalesce(F.trim(line), F.lit("")) == "", "line")))


def attached(events: DataFrame, decisions: DataFrame) -> DataFrame:
    """Events (id, sha, lon, lat, precision) with the scenes of the decision on the same text: the primary scene's place is the event's, without one it has none.

    Events without such a decision stay as they are."""
    d = decisions.select("id", "sha", "scenes", F.get(F.filter("scenes", lambda s: s["primary"]), F.lit(0)).alias("_p"))
    rows = events.join(d, ["id", "sha"], "left")
    of = lambda c: F.when(F.col("scenes").isNull(), F.col(c)).otherwise(F.col("_p")[c]).alias(c)
    return rows.select("id", "sha", of("lon"), of("lat"), F.when(F.col("scenes").isNull(), F.col("precision")).otherwise(F.coalesce(F.col("_p.precision"), F.lit("unknown"))).alias("precision"), "scenes")


def scoped(reports: DataFrame, decisions: DataFrame) -> DataFrame:
    """Reports (id, sha, body) with the verdict on their municipality: in_city, out_of_city, or deferred where none is bound to the same text by its hash and a literal quote."""
    d = decisions.select("id", "sha", "verdict", "quote")
    rows = reports.join(d, ["id", "sha"], "left")
    fine = F.coalesce(F.contains(F.lower("body"), F.lower("quote")), F.lit(False)) & F.col("verdict").isin("in_city", "out_of_city")
    return rows.select("id", "sha", F.when(fine, F.col("verdict")).otherwise("deferred").alias("scope"))


def item_scope(title: Column, city: tuple[str, ...], outside: tuple[str, ...]) -> Column:
    """struct(locality, scope) from the place at the end of a title, `... – Place`: city_candidate, outside or unverified."""
    place = F.regexp_extract(title, r"[–-]\s+([^–]+?)[\s.]*$", 1)
    return F.struct(place.alias("locality"), F.when(place.isin(*city), "city_candidate").when(place.isin(*outside), "outside").otherwise("unverified").alias("scope"))


def source_problems(url: Column, ident: Column, host: str, path: str, published: Column, checked: Column) -> Column:
    """Of a record's source: https, the host, a path that names the record, no user, and dates in order."""
    rules = ((~url.startswith("https://"), "protocol"), (F.regexp_extract(url, "^[a-z]+://([^/?#]*)", 1) != host, "host"), (F.regexp_extract(url, path, 1) != ident, "identity"), (published > checked, "published after the check"))
    return problems(rules)


def covered(inventory: DataFrame, ledgers: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """Keys that a ledger lacks, or has without being in the inventory: ledger, key, fault. No rows: all have the same keys."""
    out = None
    for name, rows in ledgers.items():
        only = lambda a, b, fault: a.select(key).distinct().join(b.select(key), key, "left_anti").select(F.lit(name).alias("ledger"), F.col(key).cast("string").alias("key"), F.lit(fault).alias("fault"))  # noqa: B023, E731
        found = only(inventory, rows, "missing").unionByName(only(rows, inventory, "unknown"))
        out = found if out is None else out.unionByName(found)
    return out


def members(incidents: DataFrame, locations: DataFrame) -> DataFrame:
    """Locations (location_id) with the incidents (incident_id, location_ids) that name them: location_id, n, incident_ids sorted. Those that none names have none."""
    each = incidents.select("incident_id", F.explode(F.array_distinct("location_ids")).alias("location_id"))
    n = each.groupBy("location_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("incident_id")).alias("incident_ids"))  # a location has few incidents
    return locations.join(n, "location_id", "left").na.fill(0, ["n"])


def with_units(reports: DataFrame, units: DataFrame, evidence: DataFrame) -> DataFrame:
    """Reports (id) with their offline unit (id, unit) and their online evidence (id, proof), either of which may be missing, and problem where a report has both or neither."""
    rows = reports.join(units, "id", "left").join(evidence, "id", "left")
    return rows.withColumn("problem", F.when(F.col("unit").isNotNull() & F.col("proof").isNotNull(), "both").when(F.col("unit").isNull() & F.col("proof").isNull(), "neither"))


def references(events: DataFrame, features: DataFrame) -> DataFrame:
    """Features (source_id, ...) of loaded events (id, source_id): with the event's id. An event without a source id has what follows the last colon of its id."""
    known = events.select(F.col("id").alias("event_id"), F.coalesce(F.col("source_id"), F.element_at(F.split("id", ":"), -1)).alias("source_id"))
    return features.join(known, "source_id")


def enriched(places: DataFrame, metadata: DataFrame) -> DataFrame:
    """Places (place_id, digest, tags) with the tags of metadata on the same object and digest added; tags that a place has stay. applied tells where."""
    m = metadata.select("place_id", "digest", F.col("tags").alias("_more"))
    rows = places.join(m, ["place_id", "digest"], "left")
    more = F.map_filter("_more", lambda k, _: ~F.map_contains_key("tags", k))
    return rows.select("place_id", "digest", F.when(F.col("_more").isNull(), F.col("tags")).otherwise(F.map_concat("tags", more)).alias("tags"), F.col("_more").isNotNull().alias("applied"))


def identified(contexts: DataFrame, identities: DataFrame) -> DataFrame:
    """Contexts (context_id, place_ids) with the reviewed places instead of the found ones: context_id, place_ids, problem where a context was reviewed twice."""
    d = identities.groupBy("context_id").agg(F.count("*").alias("_n"), F.min_by("place_ids", "reviewed").alias("_ids"))
    rows = contexts.join(d, "context_id", "left")
    return rows.select("context_id", F.coalesce("_ids", "place_ids").alias("place_ids"), F.when(F.col("_n") > 1, "reviewed twice").alias("problem"))


def verdicts(records: DataFrame, decisions: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Counts by verdict of records and of all together, by decisions on the same keys: verdict, n. A record without one is pending; the sum is the number of records."""
    d = decisions.select(*keys, F.col("verdict").alias("_v"))
    each = records.join(d, list(keys), "left").groupBy(F.coalesce("_v", F.lit("pending")).alias("verdict")).agg(F.count("*").alias("n"))
    return each.unionByName(records.agg(F.lit("total").alias("verdict"), F.count("*").alias("n")))


def inventory_totals(articles: DataFrame) -> DataFrame:
    """One row for articles (id, incidents of struct locations): articles, incidents, locations, tasks (locations of articles that have any)."""
    i = F.size("incidents")
    n = F.aggregate("incidents", F.lit(0), lambda a, x: a + F.size(x["locations"]))
    return articles.agg(F.count("*").alias("articles"), F.sum(i).cast("long").alias("incidents"), F.sum(n).cast("long").alias("locations"), F.count_if(n > 0).alias("tasks"))


def repeated(rows: DataFrame, *cols: str) -> DataFrame:
    """Fingerprints of the columns that more than one row has: fingerprint, n."""
    return rows.groupBy(F.sha2(F.concat_ws("\u001f", *cols), 256).alias("fingerprint")).agg(F.count("*").alias("n")).filter("n > 1")


def unresolved(protected: DataFrame, resolved: DataFrame, key: str) -> DataFrame:
    """Protected keys that nothing resolves."""
    return protected.select(key).distinct().join(resolved.select(key), key, "left_anti")


def united(by_rank: tuple[DataFrame, ...], keys: list[str]) -> DataFrame:
    """Rows of several tables with the same columns, one for each key: that of the first table that has it, with `source`, its number from 0. A table has a key once."""
    all_ = by_rank[0].withColumn("source", F.lit(0))
    for i, rows in enumerate(by_rank[1:], 1):
        all_ = all_.unionByName(rows.withColumn("source", F.lit(i)))
    rest = [c for c in all_.columns if c not in keys]
    return all_.groupBy(*keys).agg(F.min_by(F.struct(*rest), "source").alias("_r")).select(*keys, "_r.*")


def positions(coordinates: Column) -> Column:
    """All positions of the coordinates of a geometry of any type, as JSON: points, lines, rings or polygons; array of [x, y, ...]."""
    one = F.from_json(coordinates, "array<double>")
    lists = [F.from_json(coordinates, f"{'array<' * d}double{'>' * d}") for d in (2, 3, 4)]
    depth = F.length(F.regexp_extract(F.regexp_replace(coordinates, r"\s", ""), r"^(\[+)", 1))
    return F.when(depth == 1, F.array(one)).when(depth == 2, lists[0]).when(depth == 3, F.flatten(lists[1])).when(depth == 4, F.flatten(F.flatten(lists[2])))


def largest(rows: DataFrame, by: str, size: str, ident: str) -> DataFrame:
    """The row of the largest size of each group, of equal ones that of the smallest ident."""
    rest = [c for c in rows.columns if c != by]
    return rows.groupBy(by).agg(F.max_by(F.struct(*rest), F.struct(F.col(size), -F.col(ident))).alias("_r")).select(by, "_r.*")


def neighbours(sentences: DataFrame) -> DataFrame:
    """Sentences (id, sentence_no, sentence) with the one before them: previous, null for the first."""
    return sentences.withColumn("previous", F.lag("sentence").over(Window.partitionBy("id").orderBy("sentence_no")))
