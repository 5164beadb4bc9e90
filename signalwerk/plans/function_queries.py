"""Queries over single functions: times, names, quotes, tags, points. Texts and values are made from rows, and the SQL tells from the rows what must come out."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, geo, narrative, reports, shapes, tags, text
from ..scratch import folder
from ..sources import listing
from ..streaming import accept
from . import publish
from .catalog import POINTS_SQL, announcements, query, table


def events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def pick(values, number):
    """The value at a number, from 0, of a short list."""
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


@query("""WITH t AS (SELECT event_id AS id, TIMESTAMP '2025-01-01' + to_minutes(event_id * 37 % 1051200) AS ts FROM events)
SELECT id, epoch(ts)::BIGINT AS seconds, NOT (month(ts) IN (3, 10) AND dayofweek(ts) = 0 AND day(ts) >= 25 AND hour(ts) = 2) AS clear FROM t""")
def wall_clock_times(spark, sf_dir):
    """Times in two years as an archive writes them, and whether they exist once in Berlin."""
    made = F.timestamp_seconds(F.lit(1735689600) + F.col("event_id") * 37 % 1051200 * 60)
    ts = dates.archive_timestamp(F.date_format(made, "dd.MM.yyyy HH:mm"))
    return events(spark, sf_dir).select(F.col("event_id").alias("id"), F.unix_timestamp(ts).alias("seconds"), dates.local_is_clear(ts, "Europe/Berlin").alias("clear"))


@query("SELECT event_id AS id, CASE WHEN event_id % 7 <> 0 THEN strftime(DATE '2020-01-01' + (event_id % 3000)::INT, '%Y-%m-%d') END AS day FROM events")
def german_days(spark, sf_dir):
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("event_id") % 3000).cast("int"))
    month = F.when(F.col("event_id") % 7 == 0, "Brumaire").otherwise(F.element_at(F.array(*map(F.lit, dates.MONTHS)), F.month(day)))
    said = F.concat(F.lit("Montag, "), F.dayofmonth(day), F.lit(". "), month, F.lit(" "), F.year(day))
    return events(spark, sf_dir).select(F.col("event_id").alias("id"), F.date_format(dates.german_day(said), "yyyy-MM-dd").alias("day"))


@query("SELECT event_id AS id, CASE WHEN event_id % 5 = 0 THEN '' ELSE strftime(ts, '%d.%m.%Y, %H:%M') || CASE WHEN event_id % 3 = 0 THEN ';' || strftime(ts + INTERVAL 1 HOUR, '%d.%m.%Y %H:%M') ELSE '' END END AS times FROM events")
def header_times(spark, sf_dir):
    """Times in the first 500 characters of a body, each once; every fifth body names its time later."""
    when = F.date_format("ts", "dd.MM.yyyy, HH:mm")
    body = F.concat(F.when(F.col("event_id") % 5 == 0, F.repeat(F.lit("x "), 300)).otherwise(""), F.lit("Am "), when, F.lit(" Uhr, auch "), when, F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(" und "), F.date_format(F.col("ts") + F.expr("interval 1 hour"), "dd.MM.yyyy HH:mm"))).otherwise(""))
    return events(spark, sf_dir).select(F.col("event_id").alias("id"), F.array_join(reports.header_times(body), ";").alias("times"))


@query("SELECT event_id AS id, CASE WHEN event_id % 4 <> 3 THEN epoch(date_trunc('second', ts))::BIGINT - CASE WHEN event_id % 4 = 2 THEN 7200 ELSE 0 END ELSE -1 END AS seconds, event_id % 4 <> 3 AS zoned FROM events")
def zoned_times(spark, sf_dir):
    """Times with and without `$D` and a zone."""
    said = F.concat(F.when(F.col("event_id") % 4 == 1, "$D").otherwise(""), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), pick(("Z", "Z", "+02:00", ""), F.col("event_id")))
    return events(spark, sf_dir).select(F.col("event_id").alias("id"), F.coalesce(F.unix_timestamp(reports.occurred_at(said)), F.lit(-1)).alias("seconds"), reports.has_zone(said).alias("zoned"))


@query("""WITH t AS (SELECT event_id AS id, ts, ts + to_hours(event_id % 200) AS now FROM events)
SELECT id, id % 11 = 0 OR id % 200 >= 72 AS check_due, id % 13 = 0 OR strftime(ts, '%Y-%m') <> strftime(now + INTERVAL 1 HOUR, '%Y-%m') AS refresh_due FROM t""")
def due_dates(spark, sf_dir):
    """Two separate dates: 72 hours since the last check, and another calendar month in Berlin (in January and February an hour ahead) than that of the last refresh."""
    now = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id") % 200 * 3_600_000_000)
    check = reports.source_check_due(F.when(F.col("event_id") % 11 != 0, F.col("ts").cast("timestamp")), now)
    refresh = reports.refresh_due(F.when(F.col("event_id") % 13 != 0, F.date_format("ts", "yyyy-MM")), now)
    return events(spark, sf_dir).select(F.col("event_id").alias("id"), check.alias("check_due"), refresh.alias("refresh_due"))


@query("""SELECT event_id AS id, concat_ws(',', CASE WHEN event_id % 5 = 0 THEN 'nothing to display' END, CASE WHEN event_id % 7 = 5 THEN 'unknown precision' WHEN event_id % 7 = 6 THEN 'unknown precision' END,
CASE WHEN event_id % 3 = 1 THEN 'no such date' END, CASE WHEN event_id % 2 = 1 THEN 'quote is not in the body' END) AS problems FROM events""")
def reviewed_times(spark, sf_dir):
    """Reviewed times, right and wrong: a precision that does not exist or is missing, 30 February, a quote that is too short."""
    precision = F.when(F.col("event_id") % 7 < 6, pick((*reports.TIME_PRECISIONS, "day"), F.col("event_id") % 7))
    date = pick(("2026-03-01", "2026-02-30", None), F.col("event_id"))
    quote = F.when(F.col("event_id") % 2 == 0, F.lit("gegen  Mitternacht in der Gasse")).otherwise("Mitternacht")
    found = reports.event_time_problems(F.when(F.col("event_id") % 5 == 0, "  ").otherwise("nachts"), date, precision, quote, F.lit("Es geschah gegen Mitternacht in der Gasse."))
    return events(spark, sf_dir).select(F.col("event_id").alias("id"), F.array_join(found, ",").alias("problems"))


@query("SELECT event_id AS id, CASE WHEN event_id % 4 = 0 THEN '2024-01' WHEN event_id % 4 = 1 THEN '2023-12' END AS month FROM events")
def publication_months(spark, sf_dir):
    """A stated month, else that of a time as it is written, else none."""
    stated = pick(("2024-01", None, "2024-13", "1/2024"), F.col("event_id"))
    published = pick(("2023-11-30T10:00:00Z", "2023-12-31 23:59", "2023-12-32", None), F.col("event_id"))
    return events(spark, sf_dir).select(F.col("event_id").alias("id"), dates.publication_month(stated, published).alias("month"))


@query(f"""WITH {POINTS_SQL}, p AS (SELECT id, CASE id % 6 WHEN 0 THEN 181.0 WHEN 1 THEN 'nan'::DOUBLE ELSE lon END AS lon, CASE id % 6 WHEN 2 THEN 90.0 WHEN 3 THEN NULL ELSE lat END AS lat FROM points)
SELECT id, coalesce(NOT isnan(lon) AND abs(lon) <= 180 AND lat > -90 AND lat < 90, false) AS is_valid,
CASE WHEN id % 6 > 3 THEN round(2 * 6371008.8 * asin(sqrt(sin(radians(52.5 - lat) / 2) ^ 2 + cos(radians(lat)) * cos(radians(52.5)) * sin(radians(13.4 - lon) / 2) ^ 2)), 3) END AS metres,
CASE WHEN id % 6 > 3 THEN round(50.0 * 512 / (2 * pi() * 6378137.0 * cos(radians(lat))), 6) END AS pixels,
CASE WHEN id % 6 > 3 THEN round_even(lon / 7, 6) END AS short FROM p""")
def measured_points(spark, sf_dir):
    """Validity, distance to a place, radius in pixels and rounded longitude of points, some of which are none."""
    i = F.col("id") % 6
    lon = F.when(i == 0, 181.0).when(i == 1, float("nan")).otherwise(F.col("lon"))
    lat = F.when(i == 2, 90.0).when(i == 3, None).otherwise(F.col("lat"))
    only = lambda c: F.when(i > 3, c)
    return announcements(spark, sf_dir).select("id", geo.valid_point(lon, lat).alias("is_valid"), only(F.round(geo.haversine(lon, lat, F.lit(13.4), F.lit(52.5)), 3)).alias("metres"), only(F.round(shapes.tile_pixels(lat), 6)).alias("pixels"), only(shapes.rounded(F.array(shapes.point(lon / 7, lat)), 6)[0]["x"]).alias("short"))


@query("""SELECT l_orderkey AS id, CASE WHEN l_orderkey % 3 = 0 THEN CASE WHEN count(*) = 1 THEN 'Point' END WHEN l_orderkey % 3 = 1 AND count(*) >= 3 THEN 'Polygon' WHEN count(DISTINCT (l_linenumber, l_quantity)) >= 2 THEN 'LineString' END AS shape,
CASE WHEN l_orderkey % 3 = 1 AND count(*) >= 3 THEN round(abs(sum(l_linenumber * 10 * (n_y - p_y)) / 2), 4) END AS area
FROM (SELECT *, coalesce(lead(l_quantity) OVER w, first_value(l_quantity) OVER w) AS n_y, coalesce(lag(l_quantity) OVER w, last_value(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS p_y FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity)) GROUP BY 1""")
def element_shapes(spark, sf_dir):
    """Orders as mapped elements: nodes, closed ways that are areas, open ways; the area of what is a polygon."""
    items = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity"))).alias("v"))  # an order has few items
    line = F.transform("v", lambda p: shapes.point(p["l_linenumber"] * 10.0, p["l_quantity"]))
    rows = items.select("id", line.alias("line")).withColumn("line", F.when((F.col("id") % 3 == 1) & (F.size("line") > 1), F.concat("line", F.slice("line", 1, 1))).otherwise(F.col("line")))
    kind = F.when(F.col("id") % 3 == 0, "node").otherwise("way")
    shape = shapes.element_shape(kind, F.col("line"), F.col("id") % 3 == 1)
    return rows.select("id", shape.alias("shape"), F.when(shape == "Polygon", F.round(shapes.area(F.col("line")), 4)).alias("area"))


@query("""SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN 'a b;' || p_brand WHEN 1 THEN p_brand ELSE '' END AS names, CASE WHEN p_partkey % 2 = 0 THEN 'railway' ELSE '' END AS kept, p_partkey % 4 IN (0, 1) AS platform,
concat_ws(',', CASE WHEN p_partkey % 5 = 0 THEN 'address' END, CASE WHEN p_partkey % 3 <> 2 THEN 'named' END, CASE WHEN p_partkey % 4 = 1 THEN 'road' END) AS roles FROM part""")
def tag_values(spark, sf_dir):
    """Names from semicolon lists, a subset of tags, platforms, roles of objects."""
    k = F.col("p_partkey")
    named = pick(("x", "y", None), k)
    t = F.map_filter(F.map_from_arrays(F.array(*map(F.lit, ("name", "alt_name", "railway", "highway", "addr:housenumber"))), F.array(F.when(k % 3 != 2, F.col("p_brand")), F.when(k % 3 == 0, F.concat(F.lit(" a b ;; "), F.col("p_brand"))), F.when(k % 2 == 0, pick(("platform", "x", "rail", "x"), k)), F.when(k % 4 == 1, F.lit("platform")), F.when(k % 5 == 0, F.lit("7")))), lambda _, v: v.isNotNull())
    rows = table(spark, sf_dir, "part").select(k.alias("id"), t.alias("t"), named.alias("named"))
    c = F.col("t")
    # the brand sorts behind "a b" as # and capitals come first
    names = F.sort_array(tags.names(c["name"], c["alt_name"]), asc=False)
    return rows.select("id", F.array_join(names, ";").alias("names"), F.array_join(F.map_keys(tags.subset(c, "railway", "surface")), ",").alias("kept"), tags.platform(c).alias("platform"), F.array_join(tags.roles(c), ",").alias("roles"))


PLANTED = ("Vor der Kneipe am Bahnhof.", "Im laden sie ein.", "Ein Laden neben dem CAFÉ und dem Parkplatz.", "Nichts.", "Am Flughafen im Hotel, im Museum.")


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'bar,station' WHEN 2 THEN 'cafe,parking,shop' WHEN 4 THEN 'airport,attraction,hotel' ELSE '' END AS kinds FROM documents")
def place_mentions(spark, sf_dir):
    """Kinds of places in planted sentences; the document's own text follows a mark and is cut off there."""
    said = F.concat(pick(PLANTED, F.col("doc_id")), F.lit("\u0001"), F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.mentions(F.substring_index(said, "\u0001", 1)), ",").alias("kinds"))


CASES = ("Versuchtes Tötungsdelikt", "Schusswaffe nach Mord gefunden", "Überfall auf Seniorin", "Sachbeschädigung", "Auffinden eines Leichnams", "Körperverletzung mit Todesfolge", "Körperverletzung nach rassistischer Beleidigung", "Sexuelle Belästigung")


@query("SELECT doc_id, (['homicide', 'homicide,shooting', 'senior_robbery', '', 'body_found', 'fatal_assault', 'bias_assault', 'sexual'])[doc_id % 8 + 1] AS signatures FROM documents")
def case_signatures(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(reports.signatures(pick(CASES, F.col("doc_id"))), ",").alias("signatures"))


@query("SELECT doc_id, length(text) >= 45 AND doc_id % 4 <> 3 AND doc_id % 4 <> 2 AS hold FROM documents WHERE text IS NOT NULL")
def evidence_quotes(spark, sf_dir):
    """Two quotes of 20 and 40 characters; every fourth is made up, every other fourth comes twice."""
    d, t = F.col("doc_id"), F.col("text")
    one, two = F.substring(t, 11, 20), F.substring(t, 31, 40)
    quotes = F.array(F.when(d % 4 == 3, F.lit("\u0001 nobody wrote this")).otherwise(one), F.when(d % 4 == 2, one).otherwise(two))
    return table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", text.quotes_hold(quotes, t).alias("hold"))


@query("SELECT item_id, CASE WHEN item_id % 3 = 0 THEN 'weg ' || item_id || '|hof ' || item_id END AS section, 'von weg ' || item_id || ' nach {b}' AS filled, 'grosse strasse ' || item_id || '-weg' AS spelled FROM benchmark")
def names_in_texts(spark, sf_dir):
    """Ends of a section, placeholders of a template, and one spelling of a name."""
    i = F.col("item_id").cast("string")
    said = F.concat(F.lit("Der Unfall war zwischen "), F.lit("der weg "), i, F.when(F.col("item_id") % 3 == 0, F.lit(" und dem hof ")).otherwise(" nahe "), i, F.lit("."))
    s = narrative.section(said)
    name = F.concat(F.lit("Große  Str. "), i, F.lit(" – Ｗeg"))
    return table(spark, sf_dir, "benchmark").select("item_id", F.concat_ws("|", s["a"], s["b"]).alias("section"), text.filled(F.lit("von {a} nach {b}"), F.create_map(F.lit("a"), F.concat(F.lit("weg "), i))).alias("filled"), text.street_name(name).alias("spelled")).withColumn("section", F.nullif("section", F.lit("")))


@query("""SELECT item_id, CASE item_id % 3 WHEN 1 THEN 0 ELSE 3 END AS items, CASE item_id % 3 WHEN 0 THEN 'first ' || item_id || ';second;third' WHEN 2 THEN 'first ' || item_id || ';second;third' ELSE '' END AS titles, CASE item_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'contents and items differ' ELSE 'a number repeats' END AS problem FROM benchmark""")
def bulletins(spark, sf_dir):
    """Bulletins of three numbered items: right ones, some whose contents name another title, some where a number comes twice."""
    i = F.col("item_id")
    first = F.concat(F.lit("first "), i)
    contents = F.concat(F.lit("1. "), F.when(i % 3 == 1, F.lit("other")).otherwise(first), F.lit("\n2. second\n"), F.when(i % 3 == 2, "2").otherwise("3"), F.lit(". third"))
    body = F.concat(F.lit("Head\n1. "), first, F.lit("\n"), F.col("text"), F.lit("\n2. second\nbody\n"), F.when(i % 3 == 2, "2").otherwise("3"), F.lit(". third\nend\n"))
    rows = table(spark, sf_dir, "benchmark").select("item_id", listing.bulletin(contents, body).alias("b"))
    return rows.select("item_id", F.size("b.items").alias("items"), F.array_join(F.transform("b.items", lambda x: x["title"]), ";").alias("titles"), F.array_join("b.problems", ",").alias("problem"))


@query("SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS chars, CAST(ceil(max(doc_id + 1 - doc_id) * 1.0) AS BIGINT) AS one FROM documents GROUP BY lang")
def packed_batches(spark, sf_dir):
    """Records in files of at most 200, read back with a fixed schema."""
    path = folder(spark, "batches")
    publish.batches(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), path)
    back = listing.json_lines(spark, path, "doc_id long, lang string, n_chars long").withColumn("file", F.input_file_name())
    each = back.groupBy("lang", "file").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))
    small = back.groupBy("file").agg(F.count("*").alias("m")).agg(F.when(F.max("m") <= 200, 1).otherwise(0).alias("one"))
    return each.groupBy("lang").agg(F.sum("n").alias("n"), F.sum("chars").alias("chars")).crossJoin(F.broadcast(small.select(F.col("one").cast("long").alias("one"))))  # one row


@query("WITH w AS (SELECT to_timestamp(floor(epoch(ts) / 86400) * 86400)::TIMESTAMP AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2) SELECT epoch(start)::BIGINT AS start, event_type, n FROM w")
def stream_windows(spark, sf_dir):
    """Counts in days on a stream; the data is drained at once, so all windows come out."""
    schema = events(spark, sf_dir).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    found = accept.windows(stream, "ts", "event_type", "1 day", "1 hour")
    done = accept.closed(found, folder(spark, "windows"), folder(spark, "windows-state"))
    return done.select(F.unix_timestamp("start").alias("start"), "event_type", "n")


@query("""WITH p AS (SELECT l_orderkey AS id, l_quantity AS x, l_discount * 100 AS y FROM lineitem), d AS (SELECT a.id, a.x, a.y, sum(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) AS s FROM p a JOIN p b USING (id) GROUP BY ALL),
m AS (SELECT id, round(min(s / c), 4) AS total FROM (SELECT d.*, count(*) OVER (PARTITION BY id) AS k, (SELECT count(*) FROM p WHERE p.id = d.id AND p.x = d.x AND p.y = d.y) AS c FROM d) GROUP BY id) SELECT * FROM m""")
def medoids(spark, sf_dir):
    """The least sum of distances from one of an order's places to all of them."""
    items = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_list(shapes.point(F.col("l_quantity"), F.col("l_discount") * 100)).alias("v"))  # an order has few items
    best = items.select("id", "v", shapes.medoid(F.col("v")).alias("m"))
    return best.select("id", F.round(F.aggregate("v", F.lit(0.0), lambda a, p: a + shapes.between(p, F.col("m"))), 4).alias("total"))
