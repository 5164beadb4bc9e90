"""Newsrooms, payloads, exports and documents. Their pages are made from rows of the given tables, so the SQL can tell what must be read from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import content_hash
from ..scratch import folder
from ..sources import sites
from . import publish
from .catalog import query, table
from .function_queries import pick

SITE = sites.PRESS_PORTAL


def listings(spark, sf_dir):
    """A page for each customer with an entry for each order; an order's entry comes twice if its number is odd, and every seventh leads to another site."""
    at = F.date_format(F.col("o_orderdate"), "dd.MM.yyyy – HH:mm")
    link = F.concat(F.when(F.col("o_orderkey") % 7 == 0, "https://elsewhere.example").otherwise(""), F.lit("/blaulicht/pm/1/"), F.col("o_orderkey"))
    entry = lambda t: F.concat(F.lit('<article class="news x"><a href="'), link, F.lit('">more</a><h3>'), F.lit(t), F.col("o_orderkey"), F.lit(' &amp; <b>on</b></h3>\n<div class="date">'), at, F.lit("</div></article>"))
    rows = table(spark, sf_dir, "orders").withColumn("e", F.concat(F.when(F.col("o_orderkey") % 2 == 1, entry("old ")).otherwise(""), entry("new ")))
    return rows.groupBy(F.col("o_custkey").alias("page_id")).agg(F.array_join(F.array_sort(F.collect_list(F.struct("o_orderkey", "e")))["e"], "\n").alias("html"))  # a page's entries


@query("SELECT o_custkey AS page_id, o_orderkey::VARCHAR AS ident, 'https://www.presseportal.example/blaulicht/pm/1/' || o_orderkey AS url, 'new ' || o_orderkey || ' & on' AS title, epoch(o_orderdate)::BIGINT AS published FROM orders WHERE o_orderkey % 7 <> 0")
def newsroom_listings(spark, sf_dir):
    return sites.listing_rows(listings(spark, sf_dir), SITE).withColumn("published", F.unix_timestamp("published"))


@query("SELECT o_custkey AS page_id, sum(1 + o_orderkey % 2)::BIGINT AS entries, count_if(o_orderkey % 7 <> 0)::BIGINT AS read FROM orders GROUP BY 1 HAVING entries > read")
def newsroom_faults(spark, sf_dir):
    return sites.listing_faults(listings(spark, sf_dir), SITE).withColumn("entries", F.col("entries").cast("long"))


@query(r"""SELECT item_id AS page_id, CASE WHEN item_id % 3 = 0 THEN 'Kurz.' ELSE trim(regexp_replace(text, '\s+', ' ', 'g')) || ' Zweiter Absatz & Küste ä – Schluss.' END AS body, CASE WHEN item_id % 5 = 0 THEN 'publisher' WHEN item_id % 3 = 0 THEN 'too short' END AS problem, CASE WHEN item_id % 2 = 0 THEN 'https://www.presseportal.example/blaulicht/r/' || item_id END AS next FROM benchmark""")
def newsroom_articles(spark, sf_dir):
    """Articles with a teaser before the heading, contacts after the text, and a next page, which leads elsewhere from odd ones."""
    i = F.col("item_id")
    text = F.when(i % 3 == 0, F.lit("<p>Kurz.</p>")).otherwise(F.concat(F.lit("<p>"), F.col("text"), F.lit("</p><p>Schneller informiert: hier</p><li>Zweiter <b>Absatz</b> &amp; K&uuml;ste &#228; &ndash; Schluss.</li>")))
    html = F.concat(F.lit('<article class="story"><p>Vorab</p><p class="customer">'), F.when(i % 5 == 0, "Jemand").otherwise("Polizei Beispiel"), F.lit("</p><h1>Titel</h1>"), text, F.lit('<p class="contact-headline">Kontakt</p><p>Telefon</p></article><a class="next" href="'), F.when(i % 2 == 0, "").otherwise("https://elsewhere.example"), F.lit("/blaulicht/r/"), i, F.lit('">'))
    pages = table(spark, sf_dir, "benchmark").select(i.alias("page_id"), html.alias("html"))
    return sites.articles(pages, SITE).join(pages.select("page_id", sites.next_page(F.col("html"), SITE).alias("next")), "page_id")


@query("""SELECT event_id AS id, event_id % 14 + 3 AS n, 'Article,' || repeat('Part,', (event_id % 14)::INT) || 'Person,Thing' AS types, event_id % 14 AS deepest FROM events""")
def linked_data(spark, sf_dir):
    """Objects at all depths of embedded documents, whose parts lie up to 13 objects and arrays deep."""
    e = F.col("event_id")
    d = (e % 14).cast("int")
    parts = F.concat(F.array_join(F.transform(F.when(d > 0, F.sequence(F.lit(1), d)).otherwise(F.array().cast("array<int>")), lambda i: F.concat(F.lit('[{"@type":"Part","n":'), i, F.lit(',"has":'))), ""), F.lit('"]}"'), F.repeat(F.lit("}]"), d))
    doc = F.concat(F.lit('{"@type":"Article","author":[{"@type":"Person","n":'), e, F.lit('}],"about":{"@type":"Thing"},"parts":'), parts, F.lit("}"))
    found = sites.json_objects(table(spark, sf_dir, "events").select(e.alias("id"), doc.alias("doc")), "id", "doc")
    kind, n = F.get_json_object("object", "$['@type']"), F.when(F.get_json_object("object", "$['@type']") == "Part", F.get_json_object("object", "$.n").cast("int"))
    return found.groupBy("id").agg(F.count("*").cast("int").alias("n"), F.array_join(F.array_sort(F.collect_list(kind)), ",").alias("types"), F.coalesce(F.max(n), F.lit(0)).alias("deepest"))


@query("""WITH o AS (SELECT o_orderkey AS id, o_orderkey % 3 = 2 AS two, (o_orderkey % 12 + 1)::INT AS d, o_clerk AS clerk FROM orders)
SELECT id, CASE WHEN two THEN -1 ELSE 2 END AS n, CASE WHEN two THEN -1 ELSE id + 1 END AS last, CASE WHEN two THEN 'ambiguous' END AS problem, CASE WHEN NOT two THEN repeat('[', d) || '1' || repeat(']', d) END AS tags, CASE WHEN NOT two THEN clerk || '] } " "events": [ {' END AS s FROM o""".replace("o_clerk", "o_orderpriority"))
def flight_payloads(spark, sf_dir):
    """Events in a text that scripts push in two pieces: arrays inside of growing depth, brackets, quotes and marks in strings. Every third page has two arrays of events, one of other objects follows on others, and some end in the middle of one."""
    k = F.col("o_orderkey")
    tags = F.concat(F.repeat(F.lit("["), (k % 12 + 1).cast("int")), F.lit("1"), F.repeat(F.lit("]"), (k % 12 + 1).cast("int")))
    event = lambda ident: F.concat(F.lit('{"id":'), ident, F.lit(',"category":"x","tags":'), tags, F.lit(',"s":"'), F.col("o_orderpriority"), F.lit('] } \\" \\"events\\": [ {"}'))
    more = F.when(k % 3 == 2, ',{"events":[{"id":1,"category":"z","tags":0,"s":""}]}').when(k % 3 == 1, ',{"events":[{"id":9}]},{"events":[]}').otherwise("")
    flight = F.concat(F.lit('{"a":1,"events": ['), event(k), F.lit(","), event(k + 1), F.lit("]}"), more, F.when(k % 5 == 0, ',{"events":[{"id":1').otherwise(""))
    quoted = lambda x: F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    cut = (k % 90 + 5).cast("int")
    push = lambda x: F.concat(F.lit('<script> self.__next_f.push([1,"'), quoted(x), F.lit('"])</script>'))
    html = F.concat(F.lit("<script>other()</script><script>self.__next_f.push([0])</script>"), push(F.substr(flight, F.lit(1), cut)), push(F.substr(flight, cut + 1, F.length(flight))))
    rows = table(spark, sf_dir, "orders").select(k.alias("id"), sites.flight_events(html, "id:long,category:string,tags:string,s:string").alias("f"))
    last = F.element_at("f.events", -1)
    return rows.select("id", F.when(F.col("f.events").isNotNull(), F.size("f.events")).otherwise(-1).alias("n"), F.coalesce(last["id"], F.lit(-1)).alias("last"), "f.problem", last["tags"].alias("tags"), last["s"].alias("s"))


@query("SELECT 'count' AS fault, event_type AS value FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1) WHERE n % 2 = 1 UNION ALL SELECT 'half a place', event_id::VARCHAR FROM events WHERE event_id % 17 = 0 UNION ALL SELECT 'repeated id', event_id::VARCHAR FROM events WHERE event_id % 50 = 1")
def snapshot_faults(spark, sf_dir):
    """All categories of a snapshot: some declared one too many, some ids in two, some places without a latitude."""
    e = F.col("event_id")
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("category"), e.alias("id"), F.lit(13.4).alias("lon"), F.when(e % 17 != 0, 52.5).alias("lat"))
    n = rows.groupBy("category").agg(F.count("*").alias("n")).select("category", (F.col("n") + F.col("n") % 2).alias("declared"))
    again = rows.filter("id % 50 = 1").withColumn("category", F.lit("again")).withColumn("lat", F.lit(52.5))
    more = again.groupBy("category").agg(F.count("*").alias("declared"))
    return sites.entry_faults(rows.unionByName(again), n.unionByName(more))


@query("""WITH l AS (SELECT o_custkey AS file, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS line_no FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY line_no) AS r FROM l WHERE o_orderkey % 4 <> 0 AND line_no > CASE WHEN file % 3 = 0 THEN 2 ELSE 0 END)
SELECT file, max(line_no) AS done, count(*) AS n FROM r WHERE r <= 5 GROUP BY 1""")
def resumed_ingest(spark, sf_dir):
    """Five lines of each file behind its cursor; cursors of two files in three are of other contents."""
    from pyspark.sql import Window

    no = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    lines = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("file"), F.lit("a").alias("sha"), no.alias("line_no"), F.when(F.col("o_orderkey") % 4 == 0, "  ").otherwise(F.concat(F.lit('{"k":'), F.col("o_orderkey"), F.lit("}"))).alias("value"))
    cursors = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("file"), F.when(F.col("c_custkey") % 3 == 0, "a").otherwise("b").alias("sha"), F.lit(2).alias("done"))
    taken = sites.resumed(lines, cursors, 5)
    return sites.cursors_after(taken).join(taken.groupBy("file").agg(F.count("*").alias("n")), "file").select("file", "done", "n")


@query(r"""WITH d AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS t FROM documents)
SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN trim('Kopf – a < b ' || t) WHEN 1 THEN trim('T1 D & ' || t) WHEN 2 THEN trim('Guten Tag ' || t) WHEN 3 THEN t WHEN 4 THEN t WHEN 5 THEN trim('Grüße ' || trim(t || ' und dies')) WHEN 7 THEN trim('x ' || t) END AS text, doc_id % 8 <> 6 AS readable FROM d""")
def document_texts(spark, sf_dir):
    """Texts as pages, feeds, mails in four encodings, one mail without a date, and plain files."""
    i, t = F.col("doc_id"), F.coalesce("text", F.lit(""))
    marked = F.replace(F.replace(F.replace(t, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("ü"), F.lit("&uuml;"))
    head, kind = "From: a@x.example\nDate: Mon, 1 Jan 2024 10:00:00 +0100\n", "Content-Type: text/plain; charset=utf-8\n"
    base64 = F.concat(F.lit(f"{kind}Content-Transfer-Encoding: base64\n\n"), F.base64(F.encode(t, "utf-8")), F.lit("\n"))
    printable = F.concat(F.lit(f"{kind}Content-Transfer-Encoding: quoted-printable\n\n"), F.regexp_replace(F.hex(F.encode(t, "utf-8")), "(..)", "=$1"), F.lit("\n"))
    part = "--cut\n"
    parts = F.concat(F.lit(f'{head}Content-Type: multipart/mixed; boundary="cut"\n\n{part}Content-Type: text/plain; charset=iso-8859-1\nContent-Transfer-Encoding: quoted-printable\n\nGr=FC=DFe\n{part}'), base64, F.lit(f"{part}Content-Type: text/html\n\n<style>b</style><p>und&nbsp;<b>dies</b>\n{part}Content-Disposition: attachment; filename=a.txt\n{kind}\nnicht dies\n--cut--\n"))
    content = pick((F.concat(F.lit("<h1>Kopf</h1><script>no()</script> &ndash; a &lt; b "), marked), F.concat(F.lit("<rss><title>T1</title><link>l</link><description>D &amp; "), marked, F.lit("</description></rss>")), F.concat(F.lit(f"{head}{kind}\nGuten\n  Tag\n"), t), F.concat(F.lit(head), base64), F.concat(F.lit(head), printable), parts, F.concat(F.lit("From: a\n\n"), t), F.concat(F.lit(" x \n"), t)), i)
    text = sites.document_text(pick(("html", "rss", "eml", "eml", "eml", "eml", "eml", "txt"), i), content)
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"), text.isNotNull().alias("readable"))


@query("SELECT doc_id::VARCHAR AS id, 'https://x.example/' || doc_id AS url, text IS NOT NULL AND doc_id % 9 <> 0 AS body_holds FROM documents")
def checkpoint_rows(spark, sf_dir):
    d = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select(d.alias("source_id"), F.concat(F.lit("https://x.example/"), d).alias("source_url"), F.col("text").alias("body"), F.when(d % 9 == 0, "0").otherwise(content_hash(F.col("text"))).alias("sha256"))
    return sites.checkpoint(rows).select("id", "url", "body_holds")


VIEWS_SQL = "SELECT o_custkey % 10 AS path_id, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 6 = 0 THEN '' WHEN o_orderkey % 6 = 1 THEN 'DE-BE' ELSE (['AT', 'DE', 'FR'])[o_orderkey % 3 + 1] END AS location, count(*) AS c FROM orders GROUP BY ALL"


def exported(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 10).alias("path_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.when(F.col("o_orderkey") % 6 == 0, "").when(F.col("o_orderkey") % 6 == 1, "DE-BE").otherwise(pick(("AT", "DE", "FR"), F.col("o_orderkey"))).alias("location"), F.col("o_orderdate").alias("hour"))
    stats = o.groupBy("path_id", "day", "location").agg(F.count("*").alias("count"))
    hits = o.groupBy("path_id", "hour").agg(F.count("*").alias("count"))
    paths = o.select("path_id").distinct().select("path_id", F.concat(F.lit("/city/"), F.col("path_id")).alias("path"), (F.col("path_id") > 5).alias("event"))
    places = o.select(F.regexp_extract("location", "^[A-Z]*", 0).alias("country"), F.regexp_extract("location", "-(.*)$", 1).alias("region")).distinct()
    return paths, places, stats, hits


@query(f"WITH v AS ({VIEWS_SQL}), p AS (SELECT CASE location WHEN '' THEN 'ZZ' WHEN 'DE-BE' THEN 'DE' ELSE location END AS country, sum(c)::BIGINT AS pv FROM v WHERE path_id = 3 GROUP BY 1) SELECT country, pv, row_number() OVER (ORDER BY pv DESC, country)::INT AS rank, least(floor(log2(1 + pv) / log2(1 + max(pv) OVER ()) * 5) + 1, 5)::INT AS shade FROM p")
def exported_views(spark, sf_dir):
    """Views of one path by country, ranked and shaded."""
    paths, places, stats, _ = exported(spark, sf_dir)
    return sites.ranked(sites.page_views(paths, places, stats, "/city/3"))


@query(f"WITH v AS ({VIEWS_SQL}) SELECT path_id, sum(c)::BIGINT AS by_country, (sum(c) - 1)::BIGINT AS by_hour, 0::BIGINT AS overlaps FROM v WHERE path_id % 4 = 0 GROUP BY 1")
def exported_view_faults(spark, sf_dir):
    """Paths of which an hour's view is missing."""
    _, _, stats, hits = exported(spark, sf_dir)
    less = hits.unionByName(hits.filter("path_id % 4 = 0").select("path_id").distinct().select("path_id", F.lit(None).cast(hits.schema["hour"].dataType).alias("hour"), F.lit(-1).cast("long").alias("count")))
    return sites.view_faults(stats, less)


@query("SELECT count(*) AS n, 1 AS refused FROM customer")
def guarded_snapshots(spark, sf_dir):
    """A newer snapshot is written, an older one is refused."""
    root, rows = folder(spark, "snapshots"), table(spark, sf_dir, "customer")
    written = [publish.guarded(root, rows.filter("c_custkey < 5"), 100), publish.guarded(root, rows, 200), publish.guarded(root, rows.limit(1), 150)]
    return publish.current(spark, root, "snapshot").agg(F.count("*").alias("n")).withColumn("refused", F.lit(written.count(False)))
