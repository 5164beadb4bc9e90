"""Queries over the given tables. An event is an announcement: its user's number gives it a place, its type a category."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, geo, rules, text
from ..operators import places, reviews, versions
from ..sources import listing
from ..streaming import accept
from . import publish
from ..scratch import folder

ZONE = 33
LON, LAT = "(13.1 + (event_id * 7919 % 60000) / 100000.0)", "(52.35 + (user_id * 104729 % 30000) / 100000.0)"
# the same in Spark, whose decimals would round once and not twice: places on a tile's edge would fall on its other side
LON_DOUBLE, LAT_DOUBLE = "(13.1D + cast(event_id * 7919 % 60000 as double) / 100000.0D)", "(52.35D + cast(user_id * 104729 % 30000 as double) / 100000.0D)"
EAST, NORTH = geo.utm_sql("lon", "lat", ZONE)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
POINTS_SQL = f"located AS (SELECT event_id AS id, user_id, ts, event_type AS category, value, CAST({LON} AS DOUBLE) AS lon, CAST({LAT} AS DOUBLE) AS lat, strftime(ts, '%Y-%m') AS month FROM events), points AS (SELECT *, {EAST} AS x, {NORTH} AS y FROM located)"


def query(sql: str | None = None):
    """Register a query under its function's name, with SQL that has the same result."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    e = e.select(F.col("event_id").alias("id"), "user_id", "ts", F.col("event_type").alias("category"), "value", F.expr(LON_DOUBLE).alias("lon"), F.expr(LAT_DOUBLE).alias("lat"), dates.month(F.col("ts")).alias("month"))
    # a generator computes the projection once a row; a projection would repeat it wherever x and y are used
    e = e.select("*", F.inline(F.array(F.struct(F.expr(EAST).alias("x"), F.expr(NORTH).alias("y")))))
    return e.withColumn("precision", F.when(F.col("value") > 10, "street").otherwise("point"))


@query(f"""WITH {POINTS_SQL},
sized AS (SELECT *, unnest([1100.0, 275.0]::DOUBLE[]) AS size FROM points),
cols AS (SELECT *, round_even(x / (size * 1.5), 0) + unnest([-1, 0, 1]) AS i FROM sized),
rows_ AS (SELECT *, round_even(y / (size * sqrt(3.0)) - (((i % 2) + 2) % 2) / 2, 0) + unnest([-1, 0, 1]) AS j FROM cols),
best AS (SELECT id, month, category, value, size, min(((x - size * 1.5 * i) * (x - size * 1.5 * i) + (y - size * sqrt(3.0) * (j + (((i % 2) + 2) % 2) / 2)) * (y - size * sqrt(3.0) * (j + (((i % 2) + 2) % 2) / 2)), i, j)) AS b FROM rows_ GROUP BY ALL)
SELECT month, concat(size::INT, ':', b[2]::BIGINT, ':', b[3]::BIGINT) AS cell_id, count(*) AS n, sum(CASE WHEN value > 10 THEN 1 ELSE 0 END)::BIGINT AS n_approximate, sum(id)::BIGINT AS id_sum, count(DISTINCT category) AS n_categories
FROM best GROUP BY month, cell_id""".replace("b[2]", "struct_extract(b, 2)").replace("b[3]", "struct_extract(b, 3)"))
def hex_month(spark, sf_dir):
    cells = places.hexagons(announcements(spark, sf_dir).withColumn("id_sum", F.col("id")), sums=("id_sum",))
    return cells.select("month", "cell_id", "n", "n_approximate", "id_sum", F.size("categories").cast("long").alias("n_categories"))


@query(f"WITH {POINTS_SQL} SELECT concat(floor(lon / 0.04)::BIGINT, '_', floor(lat / 0.025)::BIGINT) AS tile_key, count(*) AS n, min(id) AS first_id FROM points GROUP BY 1")
def tiles(spark, sf_dir):
    a = announcements(spark, sf_dir).withColumn("tile_key", F.explode(geo.tile_keys(F.col("lon"), F.col("lat"), F.col("lon"), F.col("lat"))))
    return a.groupBy("tile_key").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


@query(f"WITH {POINTS_SQL} SELECT DISTINCT id FROM points WHERE concat(floor(lon / 0.04)::BIGINT, '_', floor(lat / 0.025)::BIGINT) IN ('335_2100', '334_2100', '335_2101')")
def viewport(spark, sf_dir):
    a = announcements(spark, sf_dir).select("id", F.explode(geo.tile_keys(F.col("lon"), F.col("lat"), F.col("lon"), F.col("lat"))).alias("tile_key"))
    return places.viewport(a, ["335_2100", "334_2100", "335_2101"]).select("id")


@query(f"""WITH {POINTS_SQL}, stops AS (SELECT id AS place_id, x AS px, y AS py FROM points WHERE category = 'signup')
SELECT place_id, count(*) AS n, min(id) AS first_id FROM points JOIN stops ON sqrt((x - px) * (x - px) + (y - py) * (y - py)) <= 250 GROUP BY place_id""")
def near_places(spark, sf_dir):
    a = announcements(spark, sf_dir)
    stops = a.filter("category = 'signup'").select(F.col("id").alias("place_id"), F.col("x").alias("px"), F.col("y").alias("py"))
    return places.within(a.select("id", "x", "y"), stops, 250.0).groupBy("place_id").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


@query(f"WITH {POINTS_SQL} SELECT category, count(*) AS n FROM points WHERE lon > 13.3 AND lat > 52.4 AND lon + lat < 66.0 GROUP BY category")
def in_area(spark, sf_dir):
    """Events inside an area; those on its edges are not."""
    ring = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((13.3, 52.4), (13.6, 52.4), (13.3, 52.7), (13.3, 52.4))))
    lon, lat = F.col("lon"), F.col("lat")
    return announcements(spark, sf_dir).filter(places.inside(lon, lat, ring) & ~places.on_rim(lon, lat, ring)).groupBy("category").agg(F.count("*").alias("n"))


@query("SELECT user_id, event_id, rev AS revision, change FROM (SELECT *, sum(CASE WHEN change = 'unchanged' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS rev FROM (SELECT *, CASE WHEN row_number() OVER w = 1 THEN 'new' WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type THEN 'unchanged' ELSE 'revised' END AS change FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)))")
def revisions(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return versions.revisions(e, "user_id", "event_type", "ts", "event_id").select("user_id", "event_id", "revision", "change")


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def latest_report(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return versions.latest(e, ["user_id"], F.col("ts"), F.col("event_id")).select("user_id", "event_id", "event_type")


@query("""SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'F' OR epoch(o_orderdate) < 915148800 - 604800 OR epoch(o_orderdate) >= 915148800 - 172800
ORDER BY o_orderstatus = 'F', CASE WHEN o_orderstatus = 'F' THEN epoch(o_orderdate) ELSE 0 END, epoch(o_orderdate) DESC, o_orderkey LIMIT 1500""")
def fetch_queue(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    s, done = F.unix_timestamp("o_orderdate").cast("double"), F.col("o_orderstatus") == "F"
    rows = o.select(F.col("o_orderkey").alias("id"), F.lit(0.0).alias("retry_after"), F.when(done, "x").alias("body"), F.when(done, s).alias("checked"), s.alias("published_s"))
    return versions.due(rows, 915148800.0, 1500).select("id")


@query("SELECT coalesce(a.user_id, b.user_id) AS id, coalesce(b.t, a.t) AS content, b.user_id IS NOT NULL AS active, CASE WHEN a.user_id IS NULL THEN 'added' WHEN b.user_id IS NULL THEN 'removed' WHEN a.t = b.t THEN 'same' ELSE 'changed' END AS status FROM (SELECT user_id, max(event_type) AS t FROM events WHERE day(ts) <= 15 GROUP BY 1) a FULL JOIN (SELECT user_id, max(event_type) AS t FROM events WHERE day(ts) > 15 GROUP BY 1) b ON a.user_id = b.user_id")
def snapshot_diff(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    at = lambda c: e.filter(c).groupBy(F.col("user_id").alias("id")).agg(F.max("event_type").alias("content"))
    return versions.snapshot_merged(at(F.dayofmonth("ts") <= 15), at(F.dayofmonth("ts") > 15), "id", "content")


@query("SELECT a.event_id, b.event_id AS earlier FROM events a JOIN events b ON b.event_id = CAST(json_extract_string(a.props, '$.k') AS BIGINT) WHERE b.ts < a.ts AND a.event_id <> b.event_id")
def earlier_report(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "ts", F.array(F.get_json_object("props", "$.k").cast("long")).alias("refers"))
    return versions.earlier_references(e, "event_id", "refers", "ts")


LINKS_SQL = """tags AS (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<a href="([^"]*)">(.*?)</a>')) AS tag, generate_subscripts(regexp_extract_all(html, '(?s)<a href="([^"]*)">(.*?)</a>'), 1) - 1 AS pos FROM pages),
links AS (SELECT page_id, pos, regexp_extract(tag, 'href="([^"]*)"', 1) AS href, regexp_replace(regexp_extract(tag, '(?s)">(.*)</a>', 1), '<[^>]*>', ' ', 'g') AS raw FROM tags)"""


@query(f"WITH {LINKS_SQL} SELECT page_id, href, max(pos)::BIGINT AS pos FROM links GROUP BY 1, 2")
def listing_links(spark, sf_dir):
    return listing.links(table(spark, sf_dir, "pages")).select("page_id", "href", F.col("pos").cast("long").alias("pos"))


@query("SELECT page_id, greatest(1, coalesce(list_max(list_transform(regexp_extract_all(url, 'page=([0-9]+)', 1), lambda x: x::INT)), 1)) AS pages FROM pages")
def page_numbers(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", listing.page_count(F.col("url"), r"page=([0-9]+)").alias("pages"))


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '(?s)<script\b.*?</script>|<style\b.*?</style>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g')) AS body FROM pages""")
def article_bodies(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", listing.between(F.col("html"), "<article>", "</article>").alias("body"))


@query("SELECT page_id, CASE WHEN regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1) <> '' THEN 'https://' || lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1)) || regexp_replace(regexp_extract(url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1), '/+$', '') END AS canonical FROM pages")
def canonical_urls(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.canonical_url(F.col("url")).alias("canonical"))


@query(r"SELECT doc_id, sha256(text) AS sha, trim(regexp_replace(text, '\s+', ' ', 'g')) AS clean FROM documents")
def clean_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.content_hash(F.col("text")).alias("sha"), text.collapsed(F.col("text")).alias("clean"))


@query("SELECT sha256(text) AS sha, min(doc_id) AS first_id, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_copies(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(text.content_hash(F.col("text")).alias("sha"), "doc_id")
    return d.groupBy("sha").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1")


@query("SELECT lang, label, count(*) AS n FROM (SELECT lang, CASE WHEN regexp_matches(text, '(?i)license|lizenz') THEN 'license' WHEN regexp_matches(text, '(?i)[A-Za-z0-9.]+@[a-z]+') THEN 'contact' WHEN length(text) < 100 THEN 'short' ELSE 'other' END AS label FROM documents) GROUP BY 1, 2")
def ordered_rules(spark, sf_dir):
    t = F.col("text")
    said = (rules.Rule("license", (("text", "license|lizenz"),)), rules.Rule("contact", (("text", "[A-Za-z0-9.]+@[a-z]+"),)), rules.Rule("short", (("size", "^s$"),)))
    label = rules.first_match(said, {"text": t, "size": F.when(F.length(t) < 100, "s").otherwise("")}, "other")
    return table(spark, sf_dir, "documents").groupBy("lang", label.alias("label")).agg(F.count("*").alias("n"))


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'pending' WHEN l.n_chars <> d.n_chars THEN 'stale' ELSE l.verdict END AS verdict FROM documents d LEFT JOIN (SELECT x.doc_id, n_chars - (x.doc_id % 7 = 0)::INT AS n_chars, CASE quality WHEN 1 THEN 'accepted' ELSE 'needs_correction' END AS verdict FROM labels x JOIN documents USING (doc_id)) l ON l.doc_id = d.doc_id")
def review_status(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    decided = table(spark, sf_dir, "labels").join(docs, "doc_id").select("doc_id", (F.col("n_chars") - (F.col("doc_id") % 7 == 0).cast("int")).alias("n_chars"), F.when(F.col("quality") == 1, "accepted").otherwise("needs_correction").alias("verdict"))
    return reviews.status(docs, decided, "doc_id", "n_chars").select("doc_id", "verdict")


STATES_SQL = "long AS (SELECT d.doc_id, t.tag, CASE WHEN l.doc_id IS NULL THEN 'not_evaluated' WHEN CASE t.tag WHEN 'quality' THEN quality ELSE toxic END = 1 THEN 'supported' WHEN d.doc_id % 11 = 0 THEN 'uncertain' ELSE 'no_support' END AS state, source FROM documents d LEFT JOIN labels l USING (doc_id), (VALUES ('quality'), ('toxic')) t(tag))"


def tagged(spark, sf_dir):
    tags = F.explode(F.create_map(F.lit("quality"), F.col("quality"), F.lit("toxic"), F.col("toxic"))).alias("tag", "v")
    rows = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").withColumn("seen", F.lit(True)), "doc_id", "left").select("doc_id", "source", "seen", tags)
    return rows.withColumn("state", F.when(F.col("seen").isNull(), "not_evaluated").when(F.col("v") == 1, "supported").when(F.col("doc_id") % 11 == 0, "uncertain").otherwise("no_support"))


@query(f"WITH {STATES_SQL} SELECT tag, count(*) AS records, count_if(state = 'supported')::BIGINT AS supported, count_if(state = 'no_support')::BIGINT AS no_support, count_if(state = 'uncertain')::BIGINT AS uncertain, count_if(state = 'not_evaluated')::BIGINT AS not_evaluated, 100.0::DOUBLE * supported / count(*) AS index_pct, (count(*) - count_if(state = 'not_evaluated'))::DOUBLE / count(*) AS coverage FROM long GROUP BY tag")
def label_states(spark, sf_dir):
    return reviews.label_states(tagged(spark, sf_dir))


@query(f"WITH {STATES_SQL} SELECT coalesce(source, 'ALL') AS source, tag, state, count(*) AS n FROM long GROUP BY GROUPING SETS ((source, tag, state), (tag, state))")
def label_rollup(spark, sf_dir):
    rows = tagged(spark, sf_dir)
    each = rows.groupBy("source", "tag", "state").agg(F.count("*").alias("n"))
    return each.unionByName(each.groupBy("tag", "state").agg(F.sum("n").alias("n")).withColumn("source", F.lit("ALL")))


@query("SELECT lang AS by_lang, count_if(quality = 1 AND g = 1)::BIGINT AS tp, count_if(quality = 0 AND g = 1)::BIGINT AS fp, count_if(quality = 1 AND g = 0)::BIGINT AS fn, count_if(quality = 0 AND g = 0)::BIGINT AS tn, count_if(quality = 1 AND g = 1)::DOUBLE / nullif(count_if(g = 1), 0) AS precision_, count_if(quality = 1 AND g = 1)::DOUBLE / nullif(count_if(quality = 1), 0) AS recall_ FROM (SELECT lang, quality, (n_chars > 500)::INT AS g FROM labels JOIN documents USING (doc_id)) GROUP BY lang")
def label_agreement(spark, sf_dir):
    both = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("by_lang"), (F.col("n_chars") > 500).cast("int").alias("g")), "doc_id")
    return reviews.agreement(both, F.col("quality"), F.col("g"), "by_lang")


@query("WITH s AS (SELECT n_name AS country, count(*) AS pv FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1), shown AS (SELECT * FROM s WHERE country <> 'ZZ' AND pv >= 20 ORDER BY pv DESC, country LIMIT 8), all_ AS (SELECT * FROM shown UNION ALL SELECT 'OTHER', sum(pv) FROM s WHERE country NOT IN (SELECT country FROM shown) HAVING sum(pv) >= 20 UNION ALL SELECT 'TOTAL', sum(pv) FROM s HAVING sum(pv) >= 20) SELECT country, (floor(pv / 10) * 10)::BIGINT AS pv FROM all_")
def public_views(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("pv"))
    by = o.join(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey")), "c_custkey").join(table(spark, sf_dir, "nation"), "n_nationkey")
    return reviews.public_counts(by.select(F.col("n_name").alias("country"), "pv"))


PERIODS = (("last7", 7), ("last30", 30), ("last90", 90), ("ytd", 364))


@query("SELECT period, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders, (VALUES ('last7', 7), ('last30', 30), ('last90', 90), ('ytd', 364)) p(period, days) WHERE o_orderdate::DATE BETWEEN DATE '1997-12-31' - days::INT + 1 AND DATE '1997-12-31' GROUP BY period")
def calendar_windows(spark, sf_dir):
    day, end = F.to_date("o_orderdate"), F.lit("1997-12-31").cast("date")
    in_period = F.filter(F.array(*(F.when(day.between(F.date_sub(end, n - 1), end), name) for name, n in PERIODS)), lambda x: x.isNotNull())
    return table(spark, sf_dir, "orders").select("o_custkey", F.explode(in_period).alias("period")).groupBy("period").agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("customers"))


@query("SELECT event_id, least(86400, 300 * power(2, least(user_id, 8)))::BIGINT AS wait FROM events")
def backoff(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", dates.retry_seconds(F.col("user_id") + 1).alias("wait"))


@query("SELECT CAST(p_partkey AS BIGINT) AS id, p_name AS name FROM part WHERE contains(lower(p_name), 'a') ORDER BY strpos(lower(p_name), 'a'), p_partkey LIMIT 8")
def name_search(spark, sf_dir):
    low = F.lower("p_name")
    return table(spark, sf_dir, "part").filter(low.contains("a")).orderBy(F.instr(low, "a"), "p_partkey").limit(8).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


@query("SELECT x.o_custkey AS id, 'left' AS side FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P') x WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') UNION ALL SELECT x.o_custkey, 'right' FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F') x WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def inventory_difference(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), "o_orderstatus")
    return reviews.set_difference(o.filter("o_orderstatus = 'P'").select("id"), o.filter("o_orderstatus = 'F'").select("id"), "id")


@query("WITH f AS (SELECT count(*) AS discovered, count_if(o_orderstatus <> 'P') AS fetched, count_if(o_orderstatus = 'P') AS pending, count_if(o_totalprice > 1000) AS mapped FROM orders) SELECT unnest(list_filter([CASE WHEN pending > 0 THEN 'source backlog or errors' END, CASE WHEN fetched <> mapped THEN 'mapped and unlocated do not sum to fetched' END, CASE WHEN discovered <> fetched THEN 'months do not sum to fetched' END, CASE WHEN fetched < discovered THEN 'fewer reports than before' END], lambda x: x IS NOT NULL)) AS problem FROM f")
def release_gate(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    n = lambda c: F.count_if(F.expr(c))
    now = o.agg(F.count("*").alias("discovered"), n("o_orderstatus <> 'P'").alias("fetched"), n("o_orderstatus = 'P'").alias("pending"), F.lit(0).alias("failed"), n("o_totalprice > 1000").alias("mapped"), F.lit(0).alias("unlocated"), F.count("*").alias("month_total"))
    before = o.agg(F.count("*").alias("discovered"), F.count("*").alias("fetched"), F.lit(0).alias("mapped"))
    return reviews.release_problems(now, before)


@query("SELECT l_suppkey AS place_id FROM (SELECT l_suppkey, l_partkey, l_quantity, min(l_quantity) OVER (PARTITION BY l_suppkey) AS m FROM lineitem) WHERE l_quantity = m GROUP BY l_suppkey HAVING bool_and(l_partkey % 3 <> 0)")
def nearest_parts(spark, sf_dir):
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("place_id"), F.col("l_partkey").alias("part_id"), F.col("l_quantity").alias("distance"))
    return places.nearest_parts_selected(pairs, table(spark, sf_dir, "part").filter("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("part_id")))


@query("""WITH h AS (SELECT sha256(concat_ws(chr(31), o_orderkey, o_custkey, o_orderstatus)) AS h FROM orders)
SELECT count(*) AS n, CAST(sum(CAST('0x' || h[1:8] AS BIGINT)) AS BIGINT) AS part_0, CAST(sum(CAST('0x' || h[9:16] AS BIGINT)) AS BIGINT) AS part_1, CAST(sum(CAST('0x' || h[17:24] AS BIGINT)) AS BIGINT) AS part_2, CAST(sum(CAST('0x' || h[25:32] AS BIGINT)) AS BIGINT) AS part_3 FROM h""")
def table_digest(spark, sf_dir):
    return reviews.digest(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey", "o_orderstatus").drop("digest")


@query("SELECT user_id AS id, revision, change FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS revision, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 THEN 'new' ELSE 'revised' END AS change FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE p IS DISTINCT FROM event_type)")
def stream_revisions(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return accept.drained(accept.versioned(stream, "user_id", "event_type", "ts"), folder(spark, "stream"), folder(spark, "stream-state")).select("id", "revision", "change")


@query("SELECT strftime(ts, '%Y-%m') AS month, event_type AS category, count(*) AS n FROM events GROUP BY 1, 2")
def published_months(spark, sf_dir):
    root = folder(spark, "published")
    a = announcements(spark, sf_dir).select("id", "category", "month")
    publish.publish(root, "0000000000000001", {"months": (a, ["month"])})
    return publish.current(spark, root, "months").groupBy(F.col("month").cast("string").alias("month"), "category").agg(F.count("*").alias("n"))


@query("SELECT doc_id, list_sort(list_filter([CASE WHEN regexp_matches(text, '(?i)license') THEN 'license' END, CASE WHEN regexp_matches(text, '[|]') THEN 'bar' END, CASE WHEN regexp_matches(text, '@') THEN 'mail' END], lambda x: x IS NOT NULL)) AS kinds FROM documents")
def mention_kinds(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", rules.all_matches({"license": "license", "bar": "[|]", "mail": "@"}, F.col("text")).alias("kinds"))
