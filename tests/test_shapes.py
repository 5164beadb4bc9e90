"""Shapes, tags and roads on small cases against plain Python."""

import math
import random

from pyspark.sql import functions as F

from signalwerk.functions import shapes, tags
from signalwerk.operators import graph, roads

LINE = "id long, line array<struct<x:double,y:double>>"


def test_line_functions(spark):
    line = [(0.0, 0.0), (3.0, 4.0), (3.0, 10.0)]
    df = spark.createDataFrame([(1, line), (2, [(1.0, 1.0)]), (3, [])], LINE)
    c = F.col("line")
    got = {r["id"]: r for r in df.select("id", shapes.length(c).alias("n"), shapes.valid_line(c).alias("ok")).collect()}
    assert got[1]["n"] == 11 and got[1]["ok"] and not got[2]["ok"] and not got[3]["ok"] and got[3]["n"] == 0
    p = F.struct(F.lit(5.0).alias("x"), F.lit(7.0).alias("y"))
    one = df.filter("id = 1").select(shapes.at_distance(c, F.lit(8.0)).alias("at"), shapes.part(c, F.lit(2.5), F.lit(6.0)).alias("part"), shapes.cut(c, c[2], c[0]).alias("cut"), shapes.along(c, p).alias("along"), shapes.medoid(c).alias("m")).first()
    assert tuple(one["at"]) == (3, 7) and [tuple(x) for x in one["part"]] == [(1.5, 2), (3, 4), (3, 5)] and [tuple(x) for x in one["cut"]] == line[::-1] and one["along"] == 8 and tuple(one["m"]) == (3, 4)


def test_simplified_and_clipped(spark):
    zigzag = [(float(i), 0.1 * (i % 2)) for i in range(11)]
    df = spark.createDataFrame([(1, zigzag), (2, None)], LINE)
    got = {r["id"]: r["s"] for r in df.select("id", shapes.simplified("line", F.lit(0.5)).alias("s")).collect()}
    assert [tuple(x) for x in got[1]] == [zigzag[0], zigzag[-1]] and got[2] is None
    at = lambda x, y: shapes.point(F.lit(x), F.lit(y))
    ring = F.array(at(0.0, 0.0), at(4.0, 0.0), at(4.0, 4.0), at(0.0, 4.0), at(0.0, 0.0))
    r = df.limit(1).select(shapes.clipped(at(-2.0, 1.0), at(6.0, 1.0), ring).alias("a"), shapes.clipped(at(-2.0, 5.0), at(6.0, 5.0), ring).alias("b"), shapes.area(ring).alias("area")).first()
    assert tuple(r["a"]["a"]) == (0, 1) and tuple(r["a"]["b"]) == (4, 1) and r["b"] is None and r["area"] == 16


def test_geodesic(spark):
    # Published example of the inverse problem, Flinders Peak to Buninyong (GRS80 there; WGS84 differs by less than a millimetre)
    lon1, lat1, lon2, lat2 = 144.42486788, -37.95103341, 143.92649552, -37.65282113
    d = spark.range(1).select(shapes.geodesic(*(F.lit(v) for v in (lon1, lat1, lon2, lat2))), shapes.geodesic(*(F.lit(v) for v in (lon1, lat1, lon1, lat1)))).first()
    assert abs(d[0] - 54972.271) < 0.01 and d[1] == 0


def test_roads_against_all_pairs(spark):
    rnd = random.Random(3)
    segs = [(i, f"r{i % 9}", (rnd.uniform(0, 2000), rnd.uniform(0, 2000))) for i in range(150)]
    segs = [(i, n, a, (a[0] + rnd.uniform(-400, 400), a[1] + rnd.uniform(-400, 400))) for i, n, a in segs]
    df = spark.createDataFrame(segs, "id long, name string, a struct<x:double,y:double>, b struct<x:double,y:double>")

    def cross(a, b, c, d):
        rx, ry, sx, sy = b[0] - a[0], b[1] - a[1], d[0] - c[0], d[1] - c[1]
        den = rx * sy - ry * sx
        if den == 0:
            return False
        t, u = ((c[0] - a[0]) * sy - (c[1] - a[1]) * sx) / den, ((c[0] - a[0]) * ry - (c[1] - a[1]) * rx) / den
        return 0 <= t <= 1 and 0 <= u <= 1

    def gap(p, a, b):
        dx, dy = b[0] - a[0], b[1] - a[1]
        t = min(max(((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy), 0), 1)
        return math.hypot(p[0] - a[0] - dx * t, p[1] - a[1] - dy * t)

    want = sum(cross(x[2], x[3], y[2], y[3]) for x in segs for y in segs if x[0] < y[0] and x[1] != y[1])
    assert roads.crossings(df).count() == want
    part = {i: i for i, *_ in segs}
    for _ in segs:
        for x in segs:
            for y in segs:
                if x[0] < y[0] and x[1] == y[1] and part[x[0]] != part[y[0]] and (cross(x[2], x[3], y[2], y[3]) or min(gap(x[2], y[2], y[3]), gap(x[3], y[2], y[3]), gap(y[2], x[2], x[3]), gap(y[3], x[2], x[3])) <= 60):
                    part[x[0]] = part[y[0]] = min(part[x[0]], part[y[0]])
    assert {r["id"]: r["part"] for r in roads.connected(df, gap=60.0).collect()} == part


def test_components_and_tags(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (7, 9), (9, 8), (5, 5)], "a long, b long")
    assert {r["id"]: r["component"] for r in graph.components(links).collect()} == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7}
    rows = [({"amenity": "school", "isced:level": "2;3"}, None, ["school", "secondary_school"]), ({"shop": "vacant"}, None, []), ({"shop": "books", "office": "tailor"}, "shop", ["office"]), ({"highway": "bus_stop"}, "station", []), ({}, None, [])]
    df = spark.createDataFrame([(t,) for t, _, _ in rows], "tags map<string,string>")
    got = df.select(tags.display_kind(F.col("tags")).alias("k"), tags.context_kinds(F.col("tags")).alias("c")).collect()
    assert [(r["k"], r["c"]) for r in got] == [(k, c) for _, k, c in rows]
    one = lambda t, m: spark.createDataFrame([(t,)], "tags map<string,string>").select(tags.operational(F.col("tags"), m)).first()[0]
    assert one({"railway": "subway", "tunnel": "yes"}, "tram") and not one({"railway": "subway"}, "tram") and not one({"railway": "rail", "disused:railway": "rail"}, "train") and one({"highway": "primary"}, "bus")


def test_geodesic_circle(spark):
    """All places of the ring lie at the distance, by the inverse series."""
    row = spark.range(1).select(shapes.geodesic_circle(F.lit(13.4), F.lit(52.5), F.lit(1852.0)).alias("r"))
    p = row.select(F.posexplode("r").alias("i", "p")).select("i", "p.x", "p.y", shapes.geodesic(F.lit(13.4), F.lit(52.5), F.col("p.x"), F.col("p.y")).alias("d")).collect()
    assert len(p) == 721 and all(abs(r["d"] - 1852.0) < 1e-3 for r in p) and p[0]["x"] == p[720]["x"]
    assert abs(p[0]["x"] - 13.4) < 1e-12 and p[0]["y"] > 52.5 and p[180]["x"] > 13.4


def test_as_circle(spark):
    ring = F.array(*(shapes.point(F.lit(13.4) + 0.000737 * math.sin(k * math.pi / 16), F.lit(52.5) + 0.0004497 * math.cos(k * math.pi / 16)) for k in (*range(32), 0)))
    near, far = (spark.range(1).select(shapes.as_circle(ring, shapes.point(F.lit(13.4 + d), F.lit(52.5)), F.lit(50.0)).alias("c")).first()["c"] for d in (0.0, 0.0001))
    assert near["radius"] == 50 and near["error"] < 0.35 and far is None
