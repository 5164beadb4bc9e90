"""Later reports of a case: the one earlier report that a text links to, what kind of follow-up it is, and the first report of each chain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import reports
from ..functions.rules import FLAGS
from ..functions.text import street_name
from ..scratch import stored

# What titles and bodies of follow-ups say, over normalized text.
SEARCH_ENDED = r"\berledigung der vermisstenfahndung\b"
SEARCH = r"\bvermisstenfahndung\b"
NO_OFFENCE = r"\bhinweise auf straftaten liegen nicht vor\b"
DIES_AFTER_ACCIDENT = r"\bverstirbt nach (?:verkehrs)?unfall\b"
ACCIDENT = r"\b(?:verkehrs)?unf(?:all|äll)\w*\b"
DIED = r"\b(?:verstarb|starb|erlag)\b"
CASE_UPDATE = r"\b(?:tataufklärung|festnahm\w*|verhaft\w*|zuführung\w*|haftbefehl\w*|öffentlichkeitsfahndung|ermittelt\w*\s+tatverdächtig\w*|tatverdächtig\w*\s+stellt\s+sich|veröffentlicht\s+foto)\b|\bnimmt\b.{0,80}\bfest\b"
OTHER_OFFENCE = r"\bverstoss(?:es)? gegen das waffengesetz\b|\bverdacht\w*\b.{0,80}\billegal\w*\s+aufenthalt\w*\b"
TIME_KEY = r"\b(?:unfallzeit|tatzeit)\s*:\s*(\d{2}\.\d{2}\.\d{4},?\s*\d{1,2}:\d{2})"


def told(rows: DataFrame) -> DataFrame:
    """What a report tells of its case, once: id, published, said (struct)."""
    title, body = street_name(F.coalesce("title", F.lit(""))), street_name(F.coalesce("body", F.lit("")))
    plain = rows.select("id", "published", title.alias("title"), body.alias("body"), street_name(F.coalesce("district", F.lit(""))).alias("district"))
    time = F.nullif(F.regexp_extract("body", FLAGS + TIME_KEY, 1), F.lit(""))
    return plain.select("id", "published", F.struct("title", "body", "district", reports.signatures(F.col("title")).alias("signatures"), reports.header_times(F.col("body")).alias("times"), time.alias("time")).alias("said"))


def kind(now: Column, before: Column) -> Column:
    """missing_search, traffic_death, case_update or null for a report and the earlier one that it links to (both as told())."""
    has = lambda text, pattern: text.rlike(FLAGS + pattern)
    more_times = (F.size(before["times"]) > 0) & (F.size(now["times"]) > F.size(before["times"])) & (F.size(F.array_except(now["times"], before["times"])) > 0)
    same_time = now["time"].isNotNull() & (now["time"].eqNullSafe(before["time"]) | F.array_contains(before["times"], now["time"]))
    same_place = (now["district"] != "") & (now["district"] == before["district"])
    case = F.arrays_overlap(now["signatures"], before["signatures"]) & has(now["title"], CASE_UPDATE) & ~has(now["body"], OTHER_OFFENCE) & ~more_times & (same_time | same_place)
    return (
        F.when(has(now["title"], SEARCH_ENDED) & has(before["title"], SEARCH) & has(now["body"], NO_OFFENCE), "missing_search")
        .when(has(now["title"], DIES_AFTER_ACCIDENT) & has(before["title"], ACCIDENT) & has(now["body"], DIED), "traffic_death")
        .when(F.coalesce(case, F.lit(False)), "case_update")
    )


def followups(rows: DataFrame, link: str) -> DataFrame:
    """For reports (id, published, title, body, district) that link to just one earlier report, by (published, id): id, earlier, kind (null if it is no follow-up).

    link is the pattern of links in bodies; its group is the id. Unknown ids and links to later reports count for nothing."""
    said = stored(told(rows), "told")
    links = rows.select("id", "published", F.explode(F.array_distinct(F.regexp_extract_all("body", F.lit(link), F.lit(1)))).alias("ref"))
    ids = rows.select(F.col("id").cast("string").alias("ref"), F.col("id").alias("earlier"), F.col("published").alias("then"))
    found = links.join(ids, "ref").filter(F.struct("then", "earlier") < F.struct("published", "id"))
    one = found.groupBy("id").agg(F.count("*").alias("n"), F.min("earlier").alias("earlier")).filter("n = 1").drop("n")
    both = one.join(said.select("id", F.col("said").alias("now")), "id").join(said.select(F.col("id").alias("earlier"), F.col("said").alias("before")), "earlier")
    return both.select("id", "earlier", kind(F.col("now"), F.col("before")).alias("kind"))


def resolved(links: DataFrame, rounds: int = 40) -> DataFrame:
    """For links (id, earlier), at most one of an id: id, root (where its chain ends), hops; both null for ids whose chain runs into a circle.

    Each round doubles how far an id sees. A chain holds all shorter ones, so a round that leaves as many ids open as the one before has circles only."""
    state = stored(links.select("id", F.col("earlier").alias("root"), F.lit(1).cast("long").alias("hops")), "chains")
    was = None
    for _ in range(rounds):
        onward = state.select(F.col("id").alias("root"), F.col("root").alias("_root"), F.col("hops").alias("_hops"))
        both = state.join(onward, "root", "left")
        state = stored(both.select("id", F.coalesce("_root", "root").alias("root"), (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops"), F.col("_root").isNotNull().alias("open")), "chains")
        now = state.filter("open").count()
        if now in (0, was):
            shown = lambda c: F.when(~F.col("open"), F.col(c)).alias(c)
            return state.select("id", shown("root"), shown("hops"))
        was = now
        state = state.drop("open")
    raise RuntimeError(f"chains did not settle in {rounds} rounds")
