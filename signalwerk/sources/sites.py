"""Newsrooms by description: listings, articles, next pages; payloads of map pages; resumable ingest; documents of several kinds; page-view exports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nested import objects, values_after
from ..functions.text import collapsed, content_hash, unescaped
from .mails import mail_text


@dataclass(frozen=True)
class Site:
    """How a newsroom writes. Patterns have one group each."""

    origin: str
    block: str  # an entry of a listing, the whole of it in the group
    link: str
    title: str
    published: str
    published_format: str
    identity: str  # of the link
    publisher: str  # where an article names its publisher
    publisher_name: str
    text: str  # a block of an article's text
    stop: str = "$^"  # where the text ends
    skip: str = ""  # what text blocks that don't count begin with
    next_link: str = "$^"
    least: int = 30


PRESS_PORTAL = Site(
    origin="https://www.presseportal.example",
    block=r"(?s)<article class=\"news[^>]*>(.*?)</article>",
    link=r"href=\"([^\"]+)\"",
    title=r"(?s)<h3[^>]*>(.*?)</h3>",
    published=r"(?s)<div class=\"date\">(.*?)</div>",
    published_format="dd.MM.yyyy HH:mm",
    identity=r"/pm/\d+/(\d+)$",
    publisher=r"(?s)<p class=\"customer\">(.*?)</p>",
    publisher_name="Polizei Beispiel",
    text=r"(?s)<(?:p|li|pre)>(.*?)</(?:p|li|pre)>",
    stop=r"(?s)<[^>]*class=\"(?:contact-headline|originator)\".*$",
    skip="Schneller informiert:",
    next_link=r"<a class=\"next\" href=\"([^\"]+)\"",
)


def tagless(html: Column) -> Column:
    return collapsed(F.regexp_replace(html, "(?s)<[^>]*>", " "))


def visible(html: Column) -> Column:
    return collapsed(unescaped(tagless(html)))


def absolute(url: Column, origin: str) -> Column:
    """A link as it stands, or below the origin if it begins with a slash; null if it leads elsewhere."""
    whole = F.when(url.startswith("/"), F.concat(F.lit(origin), url)).otherwise(url)
    return F.when(whole.startswith(origin + "/"), whole)


def listing_rows(pages: DataFrame, site: Site) -> DataFrame:
    """Entries of listings (page_id, html): page_id, ident, url, title, published; of equal idents on a page the last wins, links elsewhere are left out."""
    rows = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(site.block), F.lit(1))).alias("pos", "b"))
    part = lambda p: F.regexp_extract("b", p, 1)
    url = absolute(part(site.link), site.origin)
    rows = rows.select("page_id", "pos", F.regexp_extract(url, site.identity, 1).alias("ident"), url.alias("url"), visible(part(site.title)).alias("title"), F.try_to_timestamp(collapsed(F.translate(part(site.published), "–", " ")), F.lit(site.published_format)).alias("published"))
    rows = rows.filter((F.col("ident") != "") & (F.col("title") != "") & F.col("published").isNotNull())
    return rows.groupBy("page_id", "ident").agg(F.max(F.struct("pos", "url", "title", "published")).alias("r")).select("page_id", "ident", "r.url", "r.title", "r.published")


def listing_faults(pages: DataFrame, site: Site) -> DataFrame:
    """Listings with entries that listing_rows() can't read: page_id, entries, read."""
    entries = pages.select("page_id", F.size(F.regexp_extract_all("html", F.lit(site.block), F.lit(1))).alias("entries"))
    read = listing_rows(pages, site).groupBy("page_id").agg(F.count("*").alias("read"))
    return entries.join(read, "page_id", "left").na.fill(0, ["read"]).filter("read < entries or entries = 0")


def articles(pages: DataFrame, site: Site) -> DataFrame:
    """Articles (page_id, html): page_id, body, problem (null if publisher and length are right)."""
    text = F.transform(F.regexp_extract_all(F.regexp_replace(F.regexp_extract("html", "(?s)<h1.*", 0), site.stop, ""), F.lit(site.text), F.lit(1)), tagless)
    kept = F.filter(text, lambda t: (t != "") & ~(t.startswith(site.skip) if site.skip else F.lit(False)))
    rows = pages.select("page_id", collapsed(unescaped(F.array_join(kept, " "))).alias("body"), visible(F.regexp_extract("html", site.publisher, 1)).alias("by"))
    problem = F.when(F.col("by") != site.publisher_name, "publisher").when(F.length("body") < site.least, "too short")
    return rows.select("page_id", "body", problem.alias("problem"))


def next_page(html: Column, site: Site) -> Column:
    """The link to the next page, null if there is none or it leads elsewhere."""
    found = F.regexp_extract(html, site.next_link, 1)
    return F.when(found != "", absolute(found, site.origin))


def json_objects(rows: DataFrame, key: str, text: str) -> DataFrame:
    """All objects inside JSON documents, themselves too, at any depth: key, object (as JSON), a row each."""
    return rows.select(key, F.explode(objects(F.col(text))).alias("object"))


def flight_events(html: Column, event: str) -> Column:
    """struct(events, problem) from a page whose scripts push pieces of one text: the array after "events": in the joined pieces whose
    items are all objects with the keys of `event`, if just one array is not empty. Arrays may hold others and strings any bracket or quote."""
    pushed = F.regexp_extract_all(html, F.lit(r"(?s)<script>\s*self\.__next_f\.push\((\[1,.*?\])\)\s*</script>"), F.lit(1))
    text = F.array_join(F.transform(pushed, lambda p: F.coalesce(F.get(F.from_json(p, "array<string>"), F.lit(1)), F.lit(""))), "")
    keys = F.array(*(F.lit(x.split(":")[0].strip()) for x in event.split(",")))
    whole = lambda o: F.size(F.array_except(keys, F.coalesce(F.json_object_keys(o), F.array().cast("array<string>")))) == 0
    found = F.filter(values_after(text, '"events":'), lambda a: F.coalesce((F.size(F.from_json(a, "array<string>")) > 0) & F.forall(F.from_json(a, "array<string>"), whole), F.lit(False)))
    events = F.when(F.size(found) == 1, F.from_json(F.get(found, F.lit(0)), f"array<struct<{event}>>"))
    return F.struct(events.alias("events"), F.when(F.size(found) == 0, "no events").when(F.size(found) > 1, "ambiguous").alias("problem"))


def entry_faults(entries: DataFrame, declared: DataFrame) -> DataFrame:
    """Entries (category, id, lon, lat) against declared counts (category, declared): fault, value. No rows: all agrees.

    Each category has as many as declared, no id comes twice, in one category or in two, and coordinates come in pairs."""
    n = entries.groupBy("category").agg(F.count("*").alias("n"))
    counts = declared.join(n, "category", "full_outer").filter(F.coalesce("declared", F.lit(0)) != F.coalesce("n", F.lit(0))).select(F.lit("count").alias("fault"), F.col("category").cast("string").alias("value"))
    twice = entries.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select(F.lit("repeated id").alias("fault"), F.col("id").cast("string").alias("value"))
    half = entries.filter(F.col("lon").isNull() != F.col("lat").isNull()).select(F.lit("half a place").alias("fault"), F.col("id").cast("string").alias("value"))
    return counts.unionByName(twice).unionByName(half)


def resumed(lines: DataFrame, cursors: DataFrame, limit: int = 100) -> DataFrame:
    """Lines (file, sha, line_no from 1, value) that come next, at most `limit` of a file: after the cursor (file, sha, done), or from the start if the file is another.

    Blank lines are skipped. The limit, 1 to 100, is the size of a run, not of the data: the next run goes on behind it."""
    if not 1 <= limit <= 100:
        raise ValueError(f"a run takes 1 to 100 lines, not {limit}")
    c = cursors.select("file", F.col("sha").alias("_sha"), "done")
    rows = lines.filter(F.trim("value") != "").join(c, "file", "left")
    rows = rows.filter(F.col("line_no") > F.when(F.col("sha") == F.col("_sha"), F.col("done")).otherwise(0))
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy("file").orderBy("line_no"))).filter(F.col("_r") <= limit).select("file", "sha", "line_no", "value")


def cursors_after(taken: DataFrame) -> DataFrame:
    """Cursors behind the lines of resumed(): file, sha, done."""
    return taken.groupBy("file", "sha").agg(F.max("line_no").alias("done"))


def document_text(kind: Column, content: Column) -> Column:
    """Visible text of a local document: html without tags, the titles and descriptions of rss, the readable parts of an e-mail, plain text; null for other kinds and mails that can't be read."""
    items = F.regexp_extract_all(content, F.lit(r"(?s)<(?:title|description)>(.*?)</(?:title|description)>"), F.lit(1))
    html = F.regexp_replace(content, r"(?s)<(script|style)\b.*?</\1>", " ")
    return F.when(kind == "html", visible(html)).when(kind == "rss", visible(F.array_join(items, " "))).when(kind == "eml", collapsed(mail_text(F.when(kind == "eml", content)))).when(kind == "txt", collapsed(content))


def checkpoint(rows: DataFrame) -> DataFrame:
    """Reports of any checkpoint as id, url, body, sha, body_holds: columns may be id or source_id, url or source_url; body_holds says whether the hash is the body's."""
    name = lambda *names: next(F.col(n) for n in names if n in rows.columns)
    return rows.select(name("id", "source_id").cast("string").alias("id"), name("url", "source_url").alias("url"), "body", F.col("sha256").alias("sha"), F.coalesce(content_hash(F.col("body")) == F.col("sha256"), F.lit(False)).alias("body_holds"))


def page_views(paths: DataFrame, locations: DataFrame, location_stats: DataFrame, path: str) -> DataFrame:
    """Views by country of one path, from paths (path_id, path, event), locations (country, region), location_stats (path_id, day, location, count): country, pv.

    A location without a country is ZZ. Days of a location that come twice count once less than they come: overlaps() tells them."""
    one = paths.filter((F.col("path") == path) & ~F.col("event")).select("path_id")
    key = F.concat("country", F.when(F.col("region") != "", F.concat(F.lit("-"), F.col("region"))).otherwise(""))
    places = locations.select(key.alias("location"), F.when(F.col("country") == "", "ZZ").otherwise(F.col("country")).alias("country")).distinct()
    return location_stats.join(F.broadcast(one), "path_id").join(places, "location").groupBy("country").agg(F.sum("count").alias("pv"))  # one path


def view_faults(location_stats: DataFrame, hit_stats: DataFrame) -> DataFrame:
    """Paths whose views by country and by hour differ, or of which a day and location comes twice: path_id, by_country, by_hour, overlaps."""
    each = location_stats.groupBy("path_id", "day", "location").agg(F.sum("count").alias("c"), (F.count("*") - 1).alias("o"))
    a = each.groupBy("path_id").agg(F.sum("c").alias("by_country"), F.sum("o").alias("overlaps"))
    b = hit_stats.groupBy("path_id").agg(F.sum("count").alias("by_hour"))
    both = a.join(b, "path_id", "full_outer").na.fill(0)
    return both.filter("by_country <> by_hour or overlaps > 0").select("path_id", "by_country", "by_hour", "overlaps")


def ranked(views: DataFrame, colours: int = 5) -> DataFrame:
    """Countries (country, pv) with rank, largest first and equal ones by name, and shade, from 1 on, by the share of the largest."""
    most = views.agg(F.max("pv").alias("_most"))
    rows = views.crossJoin(F.broadcast(most))  # one row
    shade = F.least(F.floor(F.log2(1 + F.col("pv")) / F.log2(1 + F.col("_most")) * colours) + 1, F.lit(colours)).cast("int")
    return rows.select("country", "pv", F.row_number().over(Window.orderBy(F.desc("pv"), "country")).alias("rank"), shade.alias("shade"))  # a row for each country
