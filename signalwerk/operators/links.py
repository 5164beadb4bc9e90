"""Links of events and places: one row per pair with all its evidence, and links by month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merged_links(links: DataFrame) -> DataFrame:
    """Links (event_id, place_id, place_no, status, scene_id, kind, scope, radius, quote) as one row per pair: event_id, place_id, status and scene_id of the link
    with the smallest place_no, kinds and evidence (kind, scene_id, scope, radius, quote) each once, in the order of their first link.

    Equal evidence is one row before a pair's rows meet, so a pair that a third of all rows name stays small. Null kinds are not listed."""
    pair = ["event_id", "place_id"]
    evidence = F.struct("kind", "scene_id", "scope", "radius", "quote")
    each = links.groupBy(*pair, evidence.alias("evidence")).agg(F.min("place_no").alias("place_no"), F.min_by("status", "place_no").alias("status"))
    listed = F.array_sort(F.collect_list(F.struct("place_no", "evidence", "status")))
    rows = each.groupBy(*pair).agg(listed.alias("r"))
    first = F.col("r")[0]
    kinds = F.array_compact(F.array_distinct(F.transform("r", lambda x: x["evidence"]["kind"])))
    return rows.select(*pair, first["status"].alias("status"), first["evidence"]["scene_id"].alias("scene_id"), kinds.alias("kinds"), F.transform("r", lambda x: x["evidence"]).alias("evidence"))


def by_month(links: DataFrame, events: DataFrame) -> DataFrame:
    """Merged links with the month of their event (event_id, month); links of unknown events are left out."""
    return links.join(events.select("event_id", "month"), "event_id")


def month_places(links: DataFrame) -> DataFrame:
    """Per month and place its links: month, place_id, events, evidence (how many pieces)."""
    return links.groupBy("month", "place_id").agg(F.count("*").alias("events"), F.sum(F.size("evidence")).alias("evidence"))
