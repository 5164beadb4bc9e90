"""Queries over unions, holes, joined lines and chains of reports. Shapes are planted so that the SQL has their areas and lengths in closed form."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import shapes
from ..operators import chains, followups, links, overlays, resolving, reviews, roads, sections, spatial, validation
from ..scratch import folder, spread, stored
from .catalog import POINTS_SQL, query, table
from .function_queries import pick
from .spatial_queries import AREAS_SQL, areas

RECT = "(id % 97 - 48 - 100)", "(id % 97 - 48 + 500)", "(id % 89 - 44 - 200)", "(id % 89 - 44 + 450)"


def common(x0, x1, y0, y1):
    """Area that a rectangle shares with RECT."""
    return f"greatest(least({RECT[1]}, {x1}) - greatest({RECT[0]}, {x0}), 0) * greatest(least({RECT[3]}, {y1}) - greatest({RECT[2]}, {y0}), 0)"


SHARED = f"({common(-300, 300, -300, 0)} + {common(-300, 0, 0, 300)} - {common(-170, -130, -170, -130)} + {common(400, 460, 400, 460)})"


@query(f"WITH {POINTS_SQL}, {AREAS_SQL}, a AS (SELECT area_id AS id FROM areas), s AS (SELECT id, {SHARED}::DOUBLE AS shared, 272000.0::DOUBLE AS own, 390000.0::DOUBLE AS other FROM a) SELECT id, round(shared) AS intersection, round(own + other - shared) AS \"union\", round(own - shared) AS difference, round(own + other - 2 * shared) AS symmetric FROM s")
def area_overlays(spark, sf_dir):
    """Areas in the form of an L with a hole and a square beside it, combined with rectangles that lie over them in ever other ways."""
    a = areas(spark, sf_dir).withColumnRenamed("area_id", "id")
    at = lambda x, y: shapes.point(a["ring"][0]["x"] + 300 + x, a["ring"][0]["y"] + 300 + y)
    x0, x1, y0, y1 = (F.expr(e).cast("double") for e in RECT)
    rect = F.array(at(x0, y0), at(x1, y0), at(x1, y1), at(x0, y1), at(x0, y0))
    rows = spread(a.select("id", F.array("shape", spatial.polygon(rect)).alias("shapes")))
    out = None
    for name in ("intersection", "union", "difference", "symmetric"):
        one = overlays.combined(rows, ["id"], name).select("id", F.round(overlays.area()).alias(name))
        out = one if out is None else out.join(one, "id")
    return out


@query("""WITH i AS (SELECT DISTINCT o_custkey AS id, o_orderkey % 50 AS i FROM orders), n AS (SELECT id, i, lead(i) OVER (PARTITION BY id ORDER BY i) AS next FROM i)
SELECT id, sum(CASE WHEN next = i + 1 THEN 10 ELSE 15 END)::DOUBLE AS area, count_if(next IS NULL OR next > i + 1)::BIGINT AS parts FROM n GROUP BY 1""")
def united_areas(spark, sf_dir):
    """Unions of each customer's strips, some of which overlap or come twice."""
    i = (F.col("o_orderkey") % 50 * 10).cast("double")
    ring = F.array(*(shapes.point(i + dx, F.lit(y)) for dx, y in ((0, 0.0), (15, 0.0), (15, 1.0), (0, 1.0), (0, 0.0))))
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), spatial.polygon(ring).alias("shape"))
    return overlays.unions(rows, "id", fan=4).select("id", F.round(overlays.area(), 3).alias("area"), F.size("shape").cast("long").alias("parts"))


@query("""WITH i AS (SELECT DISTINCT o_custkey AS id, o_orderkey % 50 AS i FROM orders), n AS (SELECT id, i, lead(i) OVER (PARTITION BY id ORDER BY i) AS next FROM i)
SELECT id, sum(CASE WHEN next = i + 1 THEN 10 ELSE 15 END)::DOUBLE AS metres, count_if(next IS NULL OR next > i + 1)::BIGINT AS parts FROM n GROUP BY 1""")
def united_lines(spark, sf_dir):
    """Unions of each customer's stretches of one road, some of which overlap or come twice, as whole lines."""
    i = (F.col("o_orderkey") % 50 * 10).cast("double")
    line = F.array(shapes.point(i, F.lit(0.0)), shapes.point(i + 15, F.lit(0.0)))
    turned = F.when(F.col("o_orderkey") % 2 == 1, F.reverse(line)).otherwise(line)
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), spatial.polygon(turned).alias("shape"))
    metres = F.aggregate("shape", F.lit(0.0), lambda acc, p: acc + shapes.length(p[0]))
    return overlays.unions(rows, "id", lines=True, fan=4).select("id", F.round(metres, 3).alias("metres"), F.size("shape").cast("long").alias("parts"))


@query("""SELECT c_custkey AS relation_id, CASE WHEN c_custkey % 7 = 0 THEN 'open ring' WHEN c_custkey % 11 = 0 THEN 'hole outside' END AS problem, CASE WHEN c_custkey % 7 = 0 OR c_custkey % 11 = 0 THEN -1.0 ELSE 10000 + CASE WHEN c_custkey % 2 = 0 THEN 2500 ELSE 0 END - 400 * (c_custkey % 3) END::DOUBLE AS area,
1 + (c_custkey % 2 = 0)::INT - (c_custkey % 7 = 0)::INT AS n_outer, c_custkey % 3 + (c_custkey % 11 = 0)::INT AS n_inner FROM customer""")
def multipolygons(spark, sf_dir):
    """Squares with up to two holes and some with a second part, cut into ways in either direction; of every seventh the last way of the first ring is missing, every eleventh has a hole elsewhere."""
    c = F.col("c_custkey")

    def ring(x, y, side):
        """Twelve vertices and the first again."""
        corner = [(i * side / 3, 0) for i in range(3)] + [(side, i * side / 3) for i in range(3)] + [(side - i * side / 3, side) for i in range(3)] + [(0, side - i * side / 3) for i in range(3)]
        return F.array(*(shapes.point(c * 1000 + (x + dx), F.lit(float(y + dy))) for dx, dy in [*corner, corner[0]]))

    def ways(role, line, n, keep):
        """The ring in n ways, each second one turned round."""
        cut = lambda j: F.slice(line, F.floor(j * 12 / n).cast("int") + 1, (F.floor((j + 1) * 12 / n) - F.floor(j * 12 / n)).cast("int") + 1)
        return F.transform(F.filter(F.sequence(F.lit(0), n - 1), lambda j: keep & ~((c % 7 == 0) & F.lit(line is big) & (j == n - 1))), lambda j: F.struct(F.lit(role).alias("role"), F.when((j + c) % 2 == 1, F.reverse(cut(j))).otherwise(cut(j)).alias("line")))

    big = ring(0, 0, 100)
    every = F.concat(ways("outer", big, (c % 5 + 2).cast("int"), F.lit(True)), ways("", ring(200, 0, 50), (c % 3 + 1).cast("int"), c % 2 == 0), ways("inner", ring(10, 10, 20), (c % 4 + 1).cast("int"), c % 3 > 0), ways("inner", ring(50, 60, 20), F.lit(2), c % 3 == 2), ways("inner", ring(500, 0, 10), F.lit(1), c % 11 == 0))
    members = table(spark, sf_dir, "customer").select(c.alias("relation_id"), F.posexplode(every).alias("way_id", "w")).select("relation_id", "way_id", "w.*")
    found = chains.multipolygons(members)
    return found.select("relation_id", "problem", F.round(F.coalesce(F.when(F.col("shape").isNotNull(), overlays.area()), F.lit(-1.0)), 3).alias("area"), F.col("n_outer").cast("int").alias("n_outer"), F.col("n_inner").alias("n_inner"))


@query("""WITH l AS (SELECT DISTINCT o_custkey AS id, o_orderkey % 40 AS i FROM orders), n AS (SELECT id, i, CASE WHEN lag(i) OVER w = i - 1 AND i % 8 <> 0 THEN 0 ELSE 1 END AS new FROM l WINDOW w AS (PARTITION BY id ORDER BY i)), r AS (SELECT id, i, sum(new) OVER (PARTITION BY id ORDER BY i) AS run FROM n)
SELECT id, min(i) AS first, count(*) AS n_lines, count(*)::DOUBLE AS metres, false AS ring FROM r GROUP BY id, run UNION ALL SELECT DISTINCT o_custkey, 100, 4, 4.0, true FROM orders WHERE o_custkey % 3 = 0""")
def merged_lines(spark, sf_dir):
    """Stretches of each customer's road joined wherever just two ends meet: two side roads meet it at every eighth place; every third customer has a road that is a ring."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), (F.col("o_orderkey") % 40).alias("i")).distinct()
    at = lambda x, y: shapes.point(x, F.lit(float(y)))
    line = F.when(F.col("i") % 3 == 1, F.array(at(F.col("i") + 1, 0), at(F.col("i"), 0))).otherwise(F.array(at(F.col("i"), 0), at(F.col("i") + 0.5, 0), at(F.col("i") + 1, 0)))
    road = o.select("id", F.col("i").alias("first"), line.alias("line"))
    side = o.select("id").distinct().select("id", F.explode(F.sequence(F.lit(0), F.lit(40), F.lit(8))).alias("i")).select("id", F.lit(-1).alias("first"), F.explode(F.array(*(F.array(at(F.col("i"), 0), at(F.col("i"), y)) for y in (1, -1)))).alias("line"))
    corners = ((100, 0), (101, 0), (101, 1), (100, 1), (100, 0))
    ring = o.filter("id % 3 = 0").select("id").distinct().select("id", F.explode(F.array(*(F.array(at(F.lit(a[0]), a[1]), at(F.lit(b[0]), b[1])) for a, b in zip(corners, corners[1:], strict=False)))).alias("line")).select("id", F.lit(100).alias("first"), "line")
    rows = road.unionByName(side).unionByName(ring).withColumn("line_id", F.monotonically_increasing_id())
    found = chains.merged(stored(rows.withColumnRenamed("id", "group"), "stretches"))
    xs, ys = F.transform("line", lambda p: p["x"]), F.transform("line", lambda p: p["y"])
    flat = found.filter((F.array_max(ys) == 0) & (F.array_min(ys) == 0) | F.col("ring"))
    return flat.select(F.col("group").alias("id"), F.array_min(xs).cast("long").alias("first"), F.col("n_lines").cast("long").alias("n_lines"), F.round(shapes.length(F.col("line")), 6).alias("metres"), "ring")


CASES = ("Festnahme nach versuchtem Tötungsdelikt", "Versuchtes Tötungsdelikt in Wohnung", "Erledigung der Vermisstenfahndung", "Vermisstenfahndung nach Kind", "Radfahrer verstirbt nach Verkehrsunfall", "Schwerer Verkehrsunfall", "Markt am Samstag")
BACK = "CASE WHEN id % 50 = 0 THEN 0 ELSE CASE id % 4 WHEN 3 THEN 2 ELSE 1 END END"


@query(f"""WITH e AS (SELECT event_id AS id, event_id % 7 AS c, {BACK.replace('id', 'event_id')} AS back, event_id % 50 <> 0 AS linked FROM events),
l AS (SELECT a.id, b.id AS earlier, CASE WHEN a.c = 2 AND b.c = 3 OR a.c = 2 AND b.c = 2 THEN 'missing_search' WHEN a.c = 4 AND b.c IN (4, 5) THEN 'traffic_death' WHEN a.c = 0 AND b.c IN (0, 1) AND a.id % 3 <> 0 THEN 'case_update' END AS kind FROM e a JOIN e b ON b.id = a.id - a.back AND a.back > 0 AND (a.id % 5 <> 1 OR a.id < 3)) SELECT * FROM l""")
def follow_ups(spark, sf_dir):
    """Reports that link to one or two reports before them, of seven kinds of titles; two links, or one to a later report, count for nothing."""
    i = F.col("event_id")
    back = F.expr(BACK.replace("id", "event_id"))
    ref = lambda n: F.concat(F.lit("https://x.example/pm/1/"), n.cast("string"))
    body = F.concat(F.lit("Es liegen keine Fakten vor. Hinweise auf Straftaten liegen nicht vor. Der Mann verstarb. Siehe "), ref(i - back), F.when(i % 5 == 1, F.concat(F.lit(" und "), ref(i - 3))).otherwise(F.concat(F.lit(" und spaeter "), ref(i + 4))))
    rows = table(spark, sf_dir, "events").select(i.alias("id"), i.alias("published"), pick(CASES, i).alias("title"), body.alias("body"), F.when(i % 3 == 0, "").otherwise("Mitte").alias("district"))
    return followups.followups(rows, r"https://x\.example/pm/\d+/(\d+)")


@query("""WITH e AS (SELECT event_id AS id FROM events), n AS (SELECT id, id % 64 AS k FROM e) SELECT id, CASE WHEN id // 64 % 10 = 3 THEN -1 ELSE id - k END AS root, CASE WHEN id // 64 % 10 = 3 THEN -1 ELSE k END AS hops FROM n WHERE k > 0 OR id // 64 % 10 = 3 AND id + 63 <= (SELECT max(id) FROM e)""")
def case_chains(spark, sf_dir):
    """The first report of chains of up to 64 reports, and circles, which have none (-1)."""
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    most = e.agg(F.max("id")).first()[0]
    circle = (F.col("id") % 64 == 0) & (F.floor(F.col("id") / 64) % 10 == 3) & (F.col("id") + 63 <= most)
    links = e.filter((F.col("id") % 64 > 0) | circle).select("id", F.when(F.col("id") % 64 > 0, F.col("id") - 1).otherwise(F.col("id") + 63).alias("earlier"))
    return followups.resolved(links).na.fill(-1, ["root", "hops"])


SAID = "l_orderkey AS event_id, l_partkey % 20 AS place_id, l_linenumber AS place_no, CASE l_linenumber % 3 WHEN 0 THEN 'named_place_candidate' WHEN 1 THEN 'context_near_geometry' ELSE 'context_along_geometry' END AS status, l_linenumber % 2 AS scene_id, CASE l_linenumber % 4 WHEN 0 THEN 'bar' WHEN 1 THEN 'park' WHEN 2 THEN 'shop' END AS kind"


@query(f"""WITH l AS (SELECT {SAID} FROM lineitem), e AS (SELECT event_id, place_id, kind, scene_id, min(place_no) AS place_no, arg_min(status, place_no) AS status FROM l GROUP BY ALL),
k AS (SELECT event_id, place_id, kind, min(place_no) AS place_no FROM l WHERE kind IS NOT NULL GROUP BY ALL), ks AS (SELECT event_id, place_id, string_agg(kind, ',' ORDER BY place_no) AS kinds FROM k GROUP BY ALL)
SELECT e.event_id, e.place_id, arg_min(status, place_no) AS status, arg_min(scene_id, place_no)::INT AS scene_id, coalesce(any_value(kinds), '') AS kinds, count(*) AS evidence FROM e LEFT JOIN ks USING (event_id, place_id) GROUP BY ALL""")
def pair_evidence(spark, sf_dir):
    """Every order's links to places as one row per pair, with all kinds and pieces of evidence once."""
    found = links.merged_links(said_links(spark, sf_dir))
    return found.select("event_id", "place_id", "status", F.col("scene_id").cast("int").alias("scene_id"), F.array_join("kinds", ",").alias("kinds"), F.size("evidence").cast("long").alias("evidence"))


def said_links(spark, sf_dir):
    n = F.col("l_linenumber")
    status = F.when(n % 3 == 0, "named_place_candidate").when(n % 3 == 1, "context_near_geometry").otherwise("context_along_geometry")
    kind = F.when(n % 4 == 0, "bar").when(n % 4 == 1, "park").when(n % 4 == 2, "shop")
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("event_id"), (F.col("l_partkey") % 20).alias("place_id"), n.alias("place_no"), status.alias("status"), (n % 2).alias("scene_id"), kind.alias("kind"), F.lit("near_geometry").alias("scope"), F.lit(50.0).alias("radius"), F.lit("quote").alias("quote"))


@query(f"""WITH l AS (SELECT {SAID} FROM lineitem), e AS (SELECT DISTINCT event_id, place_id, kind, scene_id FROM l), p AS (SELECT event_id, place_id, count(*) AS n FROM e GROUP BY ALL)
SELECT strftime(o_orderdate, '%Y-%m') AS month, place_id, count(*) AS events, sum(n)::BIGINT AS evidence FROM p JOIN orders ON event_id = o_orderkey GROUP BY 1, 2""")
def month_links(spark, sf_dir):
    """Links by month, written as a generation of month folders and read back."""
    from . import publish

    months = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event_id"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    rows = links.by_month(links.merged_links(said_links(spark, sf_dir)), months)
    root = folder(spark, "links")
    publish.publish(root, "0000000000000001", {"links": (rows.repartition("month"), ["month"])})
    return links.month_places(publish.current(spark, root, "links").withColumn("month", F.col("month").cast("string")))


@query("""SELECT p_partkey AS id, CASE WHEN p_partkey % 101 = 0 THEN 'missing in tiles' WHEN p_partkey % 103 = 0 THEN 'repeated in tiles' WHEN p_partkey % 107 = 0 THEN 'wrong tile' WHEN p_partkey % 113 = 0 THEN 'not searchable' END AS fault FROM part WHERE p_partkey % 101 = 0 OR p_partkey % 103 = 0 OR p_partkey % 107 = 0 OR p_partkey % 113 = 0
UNION ALL SELECT -p_partkey - 1, 'not in index' FROM part WHERE p_partkey % 109 = 0""")
def product_faults(spark, sf_dir):
    """A product of tile files in which some records are missing, twice, in another tile's file, unknown to the index or to the search; each is named once, by what its file's path says."""
    k = F.col("p_partkey")
    parts = stored(table(spark, sf_dir, "part").select(k.alias("id"), (k % 8).cast("int").alias("tile")), "index")
    i = F.col("id")
    tile = F.when((i % 107 == 0) & (i % 103 != 0), (F.col("tile") + 1) % 8).otherwise(F.col("tile"))
    written = parts.filter(i % 101 != 0).select("id", tile.alias("tile"))
    written = written.unionByName(written.filter(i % 103 == 0)).unionByName(parts.filter(i % 109 == 0).select((-i - 1).alias("id"), "tile"))
    path = folder(spark, "tiles")
    written.repartition("tile").write.partitionBy("tile").parquet(path)
    tiles = spark.read.schema("id long").parquet(path).select("id", validation.tile_of_file(r"/tile=(\d+)/").alias("tile"))
    return validation.record_faults(parts, tiles, parts.filter(i % 113 != 0))


@query("""WITH w AS (SELECT o_orderkey % 16 AS tile, count(*) AS n FROM orders WHERE o_orderkey % 16 <> 3 GROUP BY 1) SELECT tile::VARCHAR AS tile, CASE WHEN tile = 5 THEN n + 1 ELSE -1 END AS declared, n AS found FROM w WHERE tile IN (5, 7) UNION ALL SELECT '3', 4, -1""")
def declared_tiles(spark, sf_dir):
    """Tiles whose files hold more or fewer records than declared, or are not there, or are not declared."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") % 16).cast("int").alias("tile")).filter("tile <> 3")
    path = folder(spark, "tiles")
    rows.repartition("tile").write.partitionBy("tile").parquet(path)
    tiles = spark.read.schema("id long").parquet(path).select(validation.tile_of_file(r"/tile=(\d+)/").alias("tile"))
    n = rows.groupBy("tile").agg(F.count("*").alias("n")).filter("tile <> 7").select("tile", (F.col("n") + (F.col("tile") == 5).cast("int")).alias("n"))
    none = spark.createDataFrame([(3, 4)], "tile int, n long")
    return validation.tile_faults(n.unionByName(none), tiles).na.fill(-1, ["declared", "found"])


M = "CASE WHEN {0} <= 8 THEN {0} WHEN {0} < 12 THEN 8 + 3 * ({0} - 8) ELSE {0} + 8 END"


@query(f"""WITH a AS (SELECT c_custkey AS id, {M.format('(c_custkey % 21)')} AS i, {M.format('(c_custkey * 7 % 21)')} AS j FROM customer)
SELECT id, CASE WHEN id % 13 = 0 THEN NULL ELSE least(abs(i - j), abs(i - 8) + 4 + abs(j - 20), abs(i - 20) + 4 + abs(j - 8)) END::DOUBLE AS metres, CASE WHEN id % 13 > 0 THEN id % 21 ELSE -1 END AS first, CASE WHEN id % 13 > 0 THEN id * 7 % 21 ELSE -1 END AS last FROM a""")
def street_sections(spark, sf_dir):
    """Pieces between two places of each customer's street of twenty stretches, four of which go a long way round and have a short line beside them; of every thirteenth street a place is asked for that it does not have."""
    c = F.col("c_custkey")
    at = lambda x, y=0.0: shapes.point(x if hasattr(x, "cast") else F.lit(float(x)), F.lit(float(y)))
    own = table(spark, sf_dir, "customer").select(c.alias("street"))
    i = F.col("i")
    line = F.when(i.between(8, 11), F.array(at(i), at(i, 1), at(i + 1, 1), at(i + 1))).otherwise(F.array(at(i), at(i + 1)))
    stretches = own.select("street", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("i")).select("street", F.when(i % 2 == 0, line).otherwise(F.reverse(line)).alias("line"))
    beside = own.select("street", F.explode(F.array(F.array(at(8), at(12)), F.array(at(3), at(3, -2), at(6, -2), at(6)))).alias("line"))
    rows = stored(stretches.unionByName(beside).withColumn("line_id", F.monotonically_increasing_id()), "streets")
    asks = table(spark, sf_dir, "customer").select(c.alias("id"), c.alias("street"), at(c % 21).alias("start"), F.when(c % 13 == 0, at(99)).otherwise(at(c * 7 % 21)).alias("end"))
    found = sections.between(rows, asks)
    x = lambda p: F.coalesce(p["x"].cast("int"), F.lit(-1))
    return found.select("id", F.round("length", 6).alias("metres"), x(F.col("line")[0]).alias("first"), x(F.element_at("line", -1)).alias("last"))


@query("""WITH c AS (SELECT c_custkey AS id, c_custkey % 400 AS d, CASE WHEN c_custkey % 7 = 0 THEN 1200 ELSE 10 END AS w FROM customer),
k AS (SELECT *, (id % 3 = 0 OR d <= 180) AND (id % 2 = 1 OR d <= 206) AS other FROM c)
SELECT id, CASE WHEN id % 11 = 0 THEN CASE WHEN id % 3 > 0 OR id % 2 = 0 THEN 'locality_conflict_review' ELSE 'named_place_representative' END WHEN other AND d > 150 THEN 'ambiguous_place_review' WHEN other AND d + w > 1100 THEN 'wide_place_review' ELSE 'named_place_representative' END AS method,
CASE WHEN id % 11 = 0 THEN CASE WHEN id % 3 = 0 AND id % 2 = 1 THEN 5000.0 END WHEN other AND (d > 150 OR d + w > 1100) THEN NULL WHEN other THEN 5.0 ELSE 0.0 END::DOUBLE AS y,
CASE WHEN id % 11 = 0 THEN CASE WHEN id % 3 = 0 AND id % 2 = 1 THEN 0.0 END WHEN other AND (d > 150 OR d + w > 1100) THEN NULL WHEN other THEN d + w ELSE 0.0 END::DOUBLE AS extent FROM k""")
def resolved_places(spark, sf_dir):
    """Two places of one name for each customer, a point and a square at a growing distance: in or out of its scope, near its road or not, one complex, two, or too wide; every eleventh has but one far away."""
    c = F.col("c_custkey")
    own = table(spark, sf_dir, "customer").select(c, (c * 3000).cast("double").alias("x0"), (c % 400).cast("double").alias("d"), F.when(c % 7 == 0, 1200.0).otherwise(10.0).alias("w"))
    at = lambda x, y: shapes.point(F.col("x0") + x, F.lit(float(y)))
    box = lambda x0, y0, x1, y1: spatial.polygon(F.array(at(x0, y0), at(x1, y0), at(x1, y1), at(x0, y1), at(x0, y0)))
    far = c % 11 == 0
    spot = own.select((c * 2).alias("place_id"), F.lit(0).alias("dimension"), spatial.polygon(F.array(F.when(far, at(0, 5000)).otherwise(at(0, 0)))).alias("shape"))
    square = own.filter(~far).select((c * 2 + 1).alias("place_id"), F.lit(2).alias("dimension"), box(F.col("d"), 0, F.col("d") + F.col("w"), 10).alias("shape"))
    places = stored(spot.unionByName(square), "places")
    scopes = own.filter(c % 3 > 0).select(c.alias("scope_id"), F.lit(2).alias("dimension"), box(-50, -50, 150, 50).alias("shape"))
    roads = own.filter(c % 2 == 0).select(c.alias("road_id"), F.lit(1).alias("dimension"), spatial.polygon(F.array(at(-20, 60), at(120, 60))).alias("shape"))
    asks = own.select(c.alias("id"), F.when(c % 3 > 0, c).alias("scope_id"))
    named = places.select(F.floor(F.col("place_id") / 2).alias("id"), "place_id")
    found = resolving.resolved(asks, named, roads.select(F.col("road_id").alias("id"), "road_id"), places, scopes, roads)
    return found.select("id", "method", "point.y", "extent")


@query("""WITH g AS (SELECT l.doc_id, lang AS category, [t FOR t IN [CASE WHEN quality = 1 THEN 'good' END, CASE WHEN toxic = 1 THEN 'toxic' END] IF t IS NOT NULL] AS tags, l.doc_id % 5 > 0 AS complete, n_chars FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
p AS (SELECT *, doc_id % 7 > 0 AS returned, CASE WHEN doc_id % 3 = 0 THEN 'en' ELSE category END AS said, n_chars > 500 AS good, n_chars % 2 = 1 AS toxic FROM g),
base AS (SELECT count(*) AS samples, count_if(returned)::BIGINT AS returned, count_if(returned AND said = category)::BIGINT AS agreed, count_if(returned AND complete)::BIGINT AS compared, count_if(NOT complete)::BIGINT AS incomplete FROM p),
t AS (SELECT tag, count_if(h AND s)::BIGINT AS tp, count_if(NOT h AND s)::BIGINT AS fp, count_if(h AND NOT s)::BIGINT AS fn, count_if(NOT h AND NOT s)::BIGINT AS tn FROM (SELECT 'good' AS tag, list_contains(tags, 'good') AS h, good AS s FROM p WHERE returned AND complete UNION ALL SELECT 'toxic', list_contains(tags, 'toxic'), toxic FROM p WHERE returned AND complete) GROUP BY 1 UNION ALL SELECT NULL, -1, -1, -1, -1)
SELECT tag, samples, returned, agreed, compared, incomplete, agreed::DOUBLE / returned AS among_returned, agreed::DOUBLE / samples AS among_all, tp, fp, fn, tn, CASE WHEN tag IS NOT NULL THEN tp::DOUBLE / nullif(tp + fp, 0) END AS precision_, CASE WHEN tag IS NOT NULL THEN tp::DOUBLE / nullif(tp + fn, 0) END AS recall_ FROM t, base""")
def label_scores(spark, sf_dir):
    """Predicted categories and tags against labels, of which some are assessed in part only; every seventh prediction is of an older text."""
    i = F.col("doc_id")
    both = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")
    tag = lambda holds, name: F.when(holds, name)
    gold = both.select(i.alias("id"), F.lit("a").alias("sha"), F.col("lang").alias("category"), F.array_compact(F.array(tag(F.col("quality") == 1, "good"), tag(F.col("toxic") == 1, "toxic"))).alias("tags"), (i % 5 > 0).alias("complete"))
    said = both.select(i.alias("id"), F.when(i % 7 > 0, "a").otherwise("old").alias("sha"), F.when(i % 3 == 0, "en").otherwise(F.col("lang")).alias("category"), F.array_compact(F.array(tag(F.col("n_chars") > 500, "good"), tag(F.col("n_chars") % 2 == 1, "toxic"))).alias("tags"))
    return reviews.scored(gold, said, ("good", "toxic")).na.fill(-1, ["tp", "fp", "fn", "tn"])


@query("""SELECT c_custkey AS id, CASE c_custkey % 8 WHEN 0 THEN 0 WHEN 1 THEN 40 WHEN 2 THEN 0 WHEN 3 THEN -1 WHEN 4 THEN -1 WHEN 5 THEN 53 WHEN 6 THEN -1 WHEN 7 THEN 20 END AS extent, c_custkey % 8 NOT IN (3, 4, 6) AS found FROM customer""")
def common_junctions(spark, sf_dir):
    """Roads of each customer that meet at a place, at two places near each other, all four at a place; that run side by side, too far from each other, too long or not, cross far apart, or three of which form a small triangle."""
    c = F.col("c_custkey")
    at = lambda x, y: shapes.point(c * 5000.0 + x, F.lit(float(y)))
    road = lambda *lines: F.array(*(F.array(*(at(*p) for p in line)) for line in lines))
    flat = road(((-200, 0), (200, 0)))
    up = road(((0, -200), (0, 200)))
    cases = (
        F.array(flat, up),
        F.array(flat, road(((-20, -100), (-20, 100)), ((20, -100), (20, 100)))),
        F.array(flat, up, road(((-50, -50), (50, 50))), road(((-50, 50), (50, -50)))),
        F.array(flat, road(((-200, 25), (200, 25)))),
        F.array(flat, road(((-200, 15), (200, 15)))),
        # stretches of 40 m side by side: half circles add sqrt(10^2 - 7.5^2) at each end
        F.array(road(((-20, 0), (20, 0))), road(((-20, 15), (20, 15)))),
        F.array(flat, road(((-100, -100), (-100, 100)), ((100, -100), (100, 100)))),
        F.array(flat, up, road(((-100, -95), (100, 105)))),
    )
    rows = spread(table(spark, sf_dir, "customer").select(c)).select(c.alias("id"), F.element_at(F.array(*cases), (c % 8 + 1).cast("int")).alias("roads"))
    found = roads.common_junctions(rows)
    # the triangle's common ground is told as 20 if it lies between 10 and 30 m
    extent = F.when(F.col("id") % 8 == 7, F.when(F.col("extent").between(10, 30), 20)).otherwise(F.round("extent").cast("int"))
    return found.select("id", F.coalesce(extent, F.lit(-1)).alias("extent"), F.col("point").isNotNull().alias("found"))
