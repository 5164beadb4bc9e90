"""Ledgers of records: upserts, imports of decisions, deltas, rule violations, count points, links by name, statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import nested

PRECISIONS = ("point", "street", "place", "address")


def upserted(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old with the rows of new: a new value that is null or blank never erases an old one. Both have the same columns and unique keys."""
    cols = [c for c in old.columns if c != key]
    o, n = old.alias("o"), new.alias("n")
    kept = lambda c: F.coalesce(F.when(F.trim(F.col(f"n.{c}").cast("string")) != "", F.col(f"n.{c}")), F.col(f"o.{c}")).alias(c)
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer").select(F.coalesce(f"o.{key}", f"n.{key}").alias(key), *map(kept, cols))


def imported(current: DataFrame, decisions: DataFrame, key: str, content: str) -> DataFrame:
    """What an import does to each key: key, content after it, change (inserted, changed, unchanged, kept where the import lacks it)."""
    c, d = current.select(key, F.col(content).alias("_was"), F.lit(True).alias("_old")), decisions.select(key, F.col(content).alias("_now"), F.lit(True).alias("_new"))
    both = c.join(d, key, "full_outer")
    change = F.when(F.col("_old").isNull(), "inserted").when(F.col("_new").isNull(), "kept").when(F.col("_was").eqNullSafe(F.col("_now")), "unchanged").otherwise("changed")
    return both.select(key, F.when(F.col("_new").isNull(), F.col("_was")).otherwise(F.col("_now")).alias(content), change.alias("change"))


def delta(base: DataFrame, current: DataFrame, key: str, content: str) -> DataFrame:
    """The rows of current that base lacks, and the base's keys whose content no longer holds: key, side (added, stale)."""
    b, c = base.select(key, content), current.select(key, content)
    return c.join(b, key, "left_anti").select(key, F.lit("added").alias("side")).unionByName(b.join(c, [key, content], "left_anti").select(key, F.lit("stale").alias("side")))


def violations(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """rows with `violations`, the names of the rules that don't hold; a rule that is null doesn't."""
    return rows.withColumn("violations", F.array_compact(F.array(*(F.when(~F.coalesce(rule, F.lit(False)), name) for name, rule in rules.items()))))


def count_point(scenes: Column) -> Column:
    """struct(scene, problem) of an array of scenes (label, precision, primary, usage, lon, lat): the one scene that counts, or what forbids it."""
    primary = F.filter(scenes, lambda s: s["primary"])
    one = F.get(primary, F.lit(0))
    no_point = one["lon"].isNull() | one["lat"].isNull() | (F.abs(one["lon"]) > 180) | (F.abs(one["lat"]) >= 90)
    problem = (
        F.when(F.exists(scenes, lambda s: s["primary"].isNull()), "missing primary marker")
        .when(F.size(primary) > 1, "several count scenes")
        .when(F.coalesce(one["usage"].endswith("reference_only"), F.lit(False)), "reference as count scene")
        .when((F.size(primary) == 1) & (~one["precision"].isin(*PRECISIONS) | no_point), "no valid count point")
    )
    return F.struct(F.when(problem.isNull(), one).alias("scene"), problem.alias("problem"))


def scene_parts(events: DataFrame) -> DataFrame:
    """A row per scene of events (id, scenes): id, scene_index, scene_id, group (by role), kind (what is drawn), counted."""
    rows = events.select("id", F.posexplode("scenes").alias("scene_index", "s"))
    reference = F.coalesce(F.col("s.usage").endswith("reference_only"), F.lit(False))
    kind = F.when(reference, "reference").when(F.col("s.lon").isNotNull(), "representative_point").otherwise("not_displayed")
    return rows.select("id", "scene_index", F.concat_ws("/", F.col("id").cast("string"), F.col("scene_index").cast("string")).alias("scene_id"), F.col("s.label").alias("label"), kind.alias("kind"), (F.col("s.primary") & ~reference).alias("counted"))


def refiltered(members: DataFrame, ids: DataFrame) -> DataFrame:
    """Counts of cells, from members (cell_id, id), under a filter (id): an id counts in its first cell only."""
    each = members.join(ids.select("id").distinct(), "id", "left_semi")
    return each.groupBy("id").agg(F.min("cell_id").alias("cell_id")).groupBy("cell_id").agg(F.count("*").alias("n"))


def links_by_name(events: DataFrame, places: DataFrame) -> DataFrame:
    """Links of events (id, object_ids) to places (place_id, aliases), a row per pair."""
    known = places.select("place_id", F.explode(F.array_distinct(F.concat(F.array("place_id"), F.coalesce("aliases", F.array().cast("array<bigint>"))))).alias("object_id"))
    return events.select("id", F.explode(F.array_distinct("object_ids")).alias("object_id")).join(known, "object_id").select("id", "place_id").distinct()


def opacity(n: Column) -> Column:
    return F.least(F.lit(0.78), F.lit(0.12) + F.lit(0.16) * F.log2(n + 1))


def announcement_statistics(rows: DataFrame) -> DataFrame:
    """One row for announcements (id, category, month, event_date): distinct ones, exact duplicates, conflicting ids, and shares that are null without rows."""
    cols = ["id", "category", "month", "event_date"]
    same = rows.groupBy(*cols).agg(F.count("*").alias("_n"))
    per = same.groupBy("id").agg(F.count("*").alias("_versions"), F.sum(F.col("_n") - 1).alias("_copies"), *(F.min(c).alias(c) for c in cols[1:]))
    n = lambda c: F.count_if(c).alias
    out = per.agg(F.count("*").alias("announcements"), F.coalesce(F.sum("_copies"), F.lit(0)).alias("duplicate_rows"), n(F.col("_versions") > 1)("conflicts"), n(F.coalesce(F.trim("category"), F.lit("")).isin("", "Unklassifiziert"))("unclassified"), n(F.col("event_date").isNull())("without_date"), n(F.col("month").isNull())("without_month"))
    return out.withColumn("unclassified_share", F.try_divide(F.col("unclassified") * 1.0, F.col("announcements")))


def category_shares(rows: DataFrame) -> DataFrame:
    """Per category (blank and unclassified apart): n and its share of all classified announcements."""
    own = rows.filter(~F.coalesce(F.trim("category"), F.lit("")).isin("", "Unklassifiziert")).groupBy("category").agg(F.countDistinct("id").alias("n"))
    return own.crossJoin(F.broadcast(own.agg(F.sum("n").alias("_all")))).select("category", "n", F.try_divide(F.col("n") * 1.0, F.col("_all")).alias("share"))  # one row on the right


def composite(indices: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Weighted mean of the indices (by, tag, index_pct) of the tags in `weights`; null if one of them is null or missing."""
    weight = reduce(lambda acc, e: acc.when(F.col("tag") == e[0], e[1]), list(weights.items())[1:], F.when(F.col("tag") == next(iter(weights)), next(iter(weights.values()))))
    own = indices.withColumn("_w", weight).filter("_w is not null")
    full = (F.count("index_pct") == len(weights))
    return own.groupBy("by").agg(F.when(full, F.sum(F.col("_w") * F.col("index_pct")) / F.sum("_w")).alias("composite"))


def failing(fetches: DataFrame, key: str, time: list[str], failed: Column, wait: Column) -> DataFrame:
    """Keys whose last attempts failed: key, failures (since the last success), retry_after (seconds, `wait` after the last attempt). `wait` may use failures."""
    last = fetches.groupBy(key).agg(F.max(F.when(~failed, F.struct(*time))).alias("_good"))
    rows = fetches.join(last, key).filter(failed & (F.col("_good").isNull() | (F.struct(*time) > F.col("_good"))))
    return rows.groupBy(key).agg(F.count("*").alias("failures"), F.max(time[0]).alias("_at")).select(key, "failures", (F.unix_timestamp("_at") + wait).alias("retry_after"))


def complete(scans: DataFrame, rows: DataFrame, by: str) -> DataFrame:
    """Per scan (by, checked): whether no row (by, first_seen) came later: by, is_complete, late."""
    late = rows.join(scans, by).filter(F.col("first_seen") > F.col("checked")).groupBy(by).agg(F.count("*").alias("late"))
    return scans.join(late, by, "left").select(by, F.col("late").isNull().alias("is_complete"), F.coalesce("late", F.lit(0)).alias("late"))


def declared(totals: DataFrame, rows: DataFrame, by: str) -> DataFrame:
    """Declared totals (by, declared) against rows: by, declared, found, holds."""
    found = rows.groupBy(by).agg(F.count("*").alias("found"))
    return totals.join(found, by, "full_outer").select(by, "declared", F.coalesce("found", F.lit(0)).alias("found"), F.coalesce("declared", F.lit(0)).eqNullSafe(F.coalesce("found", F.lit(0))).alias("holds"))


def matched(audit: DataFrame, official: DataFrame) -> DataFrame:
    """Entries (id, url, article) against official reports (report_id, url, article): by URL, else by an article number that one report has."""
    by_url = official.groupBy("url").agg(F.min("report_id").alias("_u"))
    by_article = official.filter("article is not null").groupBy("article").agg(F.min("report_id").alias("_a"), F.count("*").alias("_n")).filter("_n = 1")
    both = audit.join(by_url, "url", "left").join(by_article, "article", "left")
    return both.select("id", F.coalesce("_u", "_a").alias("report_id"), F.when(F.col("_u").isNotNull(), "url").when(F.col("_a").isNotNull(), "article").otherwise("unmatched").alias("basis"))


def page(rows: DataFrame, *order: Column, offset: int, size: int) -> DataFrame:
    """One page of a listing for people, 1 to 200 rows."""
    return rows.orderBy(*order).offset(offset).limit(min(max(size, 1), 200))


def exact_keys(text: Column, required: tuple[str, ...], optional: tuple[str, ...] = ()) -> Column:
    """struct(missing, unknown): which keys a JSON object lacks, and which it must not have."""
    keys, lit = F.coalesce(F.json_object_keys(text), F.array().cast("array<string>")), lambda xs: F.array(*map(F.lit, xs)).cast("array<string>")
    return F.struct(F.array_except(lit(required), keys).alias("missing"), F.array_except(keys, lit(required + optional)).alias("unknown"))


def leaves(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Paths and scalar values of JSON documents of any depth: key, path, value."""
    return rows.select(key, F.inline(nested.leaves(F.col(text))))


def first_seen(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows with what came before them of the same key: n_before."""
    return rows.withColumn("n_before", (F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1).cast("long"))
