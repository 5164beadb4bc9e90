"""Lines and rings as arrays of points struct<x double, y double>: lengths, cuts, clipping, circles, geodesic distances.

All are column expressions but simplified() and geodesic(), which run in numpy on Arrow batches.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .geo import haversine

LINE = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
# WGS84
AXIS, FLAT = 6378137.0, 1 / 298.257223563
MINOR = AXIS * (1 - FLAT)


def let(value: Column, use) -> Column:
    """use(value) with the value computed once: lambdas would repeat an expression wherever they name it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def between(a: Column, b: Column) -> Column:
    return F.sqrt((a["x"] - b["x"]) * (a["x"] - b["x"]) + (a["y"] - b["y"]) * (a["y"] - b["y"]))


def steps(line: Column) -> Column:
    """The line's segments, an array of structs a, b; empty under two points."""
    n = F.greatest(F.size(line) - 1, F.lit(0))
    return F.zip_with(F.slice(line, F.lit(1), n), F.slice(line, F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def length(line: Column) -> Column:
    return F.aggregate(steps(line), F.lit(0.0), lambda acc, s: acc + between(s["a"], s["b"]))


def bounds(line: Column) -> Column:
    xs, ys = F.transform(line, lambda p: p["x"]), F.transform(line, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x_min"), F.array_min(ys).alias("y_min"), F.array_max(xs).alias("x_max"), F.array_max(ys).alias("y_max"))


def span(box: Column) -> Column:
    """The longer side of a bounding box."""
    return F.greatest(box["x_max"] - box["x_min"], box["y_max"] - box["y_min"])


def at_distance(line: Column, distance: Column) -> Column:
    """The point that lies so far along a line; its ends beyond them."""
    start = F.struct(F.greatest(distance.cast("double"), F.lit(0.0)).alias("left"), F.element_at(line, 1).alias("p"))

    def walk(acc: Column, s: Column) -> Column:
        d = between(s["a"], s["b"])
        part = F.when(d > 0, F.least(acc["left"] / d, F.lit(1.0))).otherwise(0.0)
        moved = point(s["a"]["x"] + (s["b"]["x"] - s["a"]["x"]) * part, s["a"]["y"] + (s["b"]["y"] - s["a"]["y"]) * part)
        return F.struct(F.greatest(acc["left"] - d, F.lit(0.0)).alias("left"), F.when(acc["left"] > 0, moved).otherwise(acc["p"]).alias("p"))

    return F.aggregate(steps(line), start, walk, lambda acc: acc["p"])


def middle(line: Column) -> Column:
    return at_distance(line, length(line) / 2)


def along(line: Column, p: Column) -> Column:
    """How far along a line its closest place to a point lies."""
    first = F.struct(F.lit(0.0).alias("gone"), F.lit(float("inf")).alias("best"), F.lit(0.0).alias("at"))

    def walk(acc: Column, s: Column) -> Column:
        d = between(s["a"], s["b"])
        t = foot(p, s["a"], s["b"])
        off = between(p, point(s["a"]["x"] + (s["b"]["x"] - s["a"]["x"]) * t, s["a"]["y"] + (s["b"]["y"] - s["a"]["y"]) * t))
        return F.struct((acc["gone"] + d).alias("gone"), F.least(off, acc["best"]).alias("best"), F.when(off < acc["best"], acc["gone"] + d * t).otherwise(acc["at"]).alias("at"))

    return F.aggregate(steps(line), first, walk, lambda acc: acc["at"])


def foot(p: Column, a: Column, b: Column) -> Column:
    """Where on a segment, from 0 to 1, its closest place to a point lies."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    d = dx * dx + dy * dy
    return F.when(d > 0, F.least(F.greatest(((p["x"] - a["x"]) * dx + (p["y"] - a["y"]) * dy) / d, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)


def to_segment(p: Column, a: Column, b: Column) -> Column:
    """Distance of a point to a segment."""
    t = foot(p, a, b)
    return between(p, point(a["x"] + (b["x"] - a["x"]) * t, a["y"] + (b["y"] - a["y"]) * t))


def part(line: Column, start: Column, end: Column) -> Column:
    """The piece of a line from one distance along it to another, in the line's direction."""

    def of(v: Column) -> Column:
        sums = F.aggregate(steps(v["line"]), F.array(F.lit(0.0)), lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1) + between(s["a"], s["b"]))))
        inner = F.filter(F.zip_with(v["line"], sums, lambda p, d: F.struct(p.alias("p"), d.alias("d"))), lambda e: (e["d"] > v["low"]) & (e["d"] < v["high"]))
        return F.concat(F.array(at_distance(v["line"], v["low"])), F.transform(inner, lambda e: e["p"]), F.array(at_distance(v["line"], v["high"])))

    return let(F.struct(line.alias("line"), F.least(start, end).alias("low"), F.greatest(start, end).alias("high")), of)


def cut(line: Column, a: Column, b: Column) -> Column:
    """The piece of a line between two of its own vertices, from the first to the second; null where either is missing or both are one."""
    i, j = F.array_position(line, a), F.array_position(line, b)
    low, high = F.least(i, j).cast("int"), F.greatest(i, j).cast("int")
    piece = F.slice(line, F.greatest(low, F.lit(1)), high - low + 1)
    return F.when((i > 0) & (j > 0) & (i != j), F.when(i < j, piece).otherwise(F.reverse(piece)))


def crossing(a: Column, b: Column, c: Column, d: Column) -> Column:
    """The point where segments ab and cd cross or touch; null where they don't or are parallel."""
    rx, ry, sx, sy = b["x"] - a["x"], b["y"] - a["y"], d["x"] - c["x"], d["y"] - c["y"]
    den = rx * sy - ry * sx
    t = ((c["x"] - a["x"]) * sy - (c["y"] - a["y"]) * sx) / F.nullif(den, F.lit(0.0))
    u = ((c["x"] - a["x"]) * ry - (c["y"] - a["y"]) * rx) / F.nullif(den, F.lit(0.0))
    return F.when(t.between(0, 1) & u.between(0, 1), point(a["x"] + rx * t, a["y"] + ry * t))


def clipped(a: Column, b: Column, ring: Column) -> Column:
    """The piece of segment ab inside a convex ring (counter-clockwise, first = last) as a struct a, b; null where nothing longer than a point is left."""
    whole = F.struct(F.lit(0.0).alias("t0"), F.lit(1.0).alias("t1"))

    def piece(s: Column) -> Column:
        a, b = s["a"], s["b"]
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]

        def edge(acc: Column, e: Column) -> Column:
            ex, ey = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
            num = ex * (a["y"] - e["a"]["y"]) - ey * (a["x"] - e["a"]["x"])
            den = ex * dy - ey * dx
            t = -num / F.nullif(den, F.lit(0.0))
            t0 = F.when(den > 0, F.greatest(acc["t0"], t)).when((den == 0) & (num < 0), F.lit(2.0)).otherwise(acc["t0"])
            t1 = F.when(den < 0, F.least(acc["t1"], t)).otherwise(acc["t1"])
            return F.struct(t0.alias("t0"), t1.alias("t1"))

        at = lambda t: point(a["x"] + dx * t, a["y"] + dy * t)
        return let(F.aggregate(steps(ring), whole, edge), lambda t: F.when(t["t0"] < t["t1"], F.struct(at(t["t0"]).alias("a"), at(t["t1"]).alias("b"))))

    return let(F.struct(a.alias("a"), b.alias("b")), piece)


def circle(center: Column, radius: Column, vertices: int = 32) -> Column:
    """A closed ring of vertices + 1 points, from the north clockwise."""
    turn = lambda k: F.pmod(k, F.lit(vertices)) * (2 * math.pi / vertices)
    return let(F.struct(center.alias("c"), radius.cast("double").alias("r")), lambda v: F.transform(F.sequence(F.lit(0), F.lit(vertices)), lambda k: point(v["c"]["x"] + v["r"] * F.sin(turn(k)), v["c"]["y"] + v["r"] * F.cos(turn(k)))))


def as_circle(ring: Column, center: Column, radius: Column, tolerance: float = 0.35, vertices: int = 33) -> Column:
    """Center, radius and error of a closed ring (longitude and latitude, first = last, so many vertices) whose vertices all lie at that radius in metres of
    the given center, within a tolerance; null for other rings, which must stay as they are."""

    def judged(v: Column) -> Column:
        off = F.array_max(F.transform(v["ring"], lambda p: F.abs(haversine(p["x"], p["y"], v["c"]["x"], v["c"]["y"]) - v["r"])))
        return let(off, lambda e: F.when((F.size(v["ring"]) == vertices) & (F.element_at(v["ring"], 1) == F.element_at(v["ring"], -1)) & (e <= tolerance), F.struct(v["c"].alias("center"), v["r"].alias("radius"), e.alias("error"))))

    return let(F.struct(ring.alias("ring"), center.alias("c"), radius.cast("double").alias("r")), judged)


def valid_line(line: Column) -> Column:
    fine = F.forall(line, lambda p: p["x"].isNotNull() & p["y"].isNotNull() & ~F.isnan(p["x"]) & ~F.isnan(p["y"]))
    return F.coalesce((F.size(line) >= 2) & fine & (F.size(F.array_distinct(line)) >= 2), F.lit(False))


def closed(line: Column) -> Column:
    return F.coalesce((F.size(line) >= 4) & (F.element_at(line, 1) == F.element_at(line, -1)), F.lit(False))


def element_shape(kind: Column, line: Column, is_area: Column) -> Column:
    """Point, Polygon, LineString or null for a mapped element: node, or way with its points."""
    return F.when((kind == "node") & (F.size(line) == 1), "Point").when((kind == "way") & closed(line) & is_area, "Polygon").when((kind == "way") & valid_line(line), "LineString")


def area(ring: Column) -> Column:
    """Area of a closed ring, positive for either direction."""
    return F.abs(F.aggregate(steps(ring), F.lit(0.0), lambda acc, s: acc + (s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"]))) / 2


def medoid(points: Column) -> Column:
    """Of a few points the one with the least sum of distances to all, then the smaller x, then y."""
    scored = F.transform(points, lambda p: F.struct(F.aggregate(points, F.lit(0.0), lambda acc, q: acc + between(p, q)).alias("d"), p["x"].alias("x"), p["y"].alias("y")))
    best = F.array_min(scored)
    return point(best["x"], best["y"])


def rounded(line: Column, digits: int = 6) -> Column:
    return F.transform(line, lambda p: F.struct(F.bround(p["x"], digits).alias("x"), F.bround(p["y"], digits).alias("y")))


@F.pandas_udf(T.DoubleType())
def geodesic(lon_a: pd.Series, lat_a: pd.Series, lon_b: pd.Series, lat_b: pd.Series) -> pd.Series:
    """Metres between two places on the ellipsoid, by Vincenty's inverse series. Null where a place is null or it does not settle, as it may for antipodes."""
    u1, u2 = (np.arctan(np.tan(np.radians(x.to_numpy(float))) * (1 - FLAT)) for x in (lat_a, lat_b))
    big = np.radians(lon_b.to_numpy(float) - lon_a.to_numpy(float))
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    lam, was = big, big + 1
    with np.errstate(all="ignore"):
        for _ in range(30):
            s = np.hypot(c2 * np.sin(lam), c1 * s2 - s1 * c2 * np.cos(lam))
            c = s1 * s2 + c1 * c2 * np.cos(lam)
            sigma = np.arctan2(s, c)
            sa = np.where(s == 0, 0.0, c1 * c2 * np.sin(lam) / s)
            c2a = 1 - sa * sa
            m = np.where(c2a <= 1e-15, 0.0, c - 2 * s1 * s2 / c2a)
            k = FLAT / 16 * c2a * (4 + FLAT * (4 - 3 * c2a))
            lam, was = big + (1 - k) * FLAT * sa * (sigma + k * s * (m + k * c * (2 * m * m - 1))), lam
            if not (np.abs(lam - was) > 1e-12).any():
                break
        q = c2a * ((AXIS**2 - MINOR**2) / MINOR**2)
        big_a = 1 + q / 16384 * (4096 + q * (-768 + q * (320 - 175 * q)))
        big_b = q / 1024 * (256 + q * (-128 + q * (74 - 47 * q)))
        d = big_b * s * (m + big_b / 4 * (c * (2 * m * m - 1) - big_b / 6 * m * (4 * s * s - 3) * (4 * m * m - 3)))
        out = np.where(np.abs(lam - was) < 1e-9, MINOR * big_a * (sigma - d), np.nan)
    return pd.Series(out).where(~np.isnan(out), None)


@F.pandas_udf(LINE)
def geodesic_circle(lon: pd.Series, lat: pd.Series, metres: pd.Series) -> pd.Series:
    """A closed ring of 720 places at a geodesic distance around each place, from the north clockwise, by Vincenty's direct series. Null where anything is null."""
    out = pd.Series([None] * len(lon), dtype=object)
    some = (lon.notna() & lat.notna() & metres.notna()).to_numpy()
    if not some.any():
        return out
    whole, lon, lat, metres = out, lon[some], lat[some], metres[some]
    turn = np.radians(np.arange(720) / 2)
    u1 = np.arctan(np.tan(np.radians(lat.to_numpy(float))) * (1 - FLAT))[:, None]
    sin_turn, cos_turn = np.sin(turn)[None], np.cos(turn)[None]
    s1 = np.arctan2(np.tan(u1), cos_turn)
    sa = np.cos(u1) * sin_turn
    c2a = 1 - sa * sa
    q = c2a * ((AXIS**2 - MINOR**2) / MINOR**2)
    big_a = 1 + q / 16384 * (4096 + q * (-768 + q * (320 - 175 * q)))
    big_b = q / 1024 * (256 + q * (-128 + q * (74 - 47 * q)))
    first = metres.to_numpy(float)[:, None] / (MINOR * big_a)
    sigma = first
    for _ in range(20):
        m, s, c = np.cos(2 * s1 + sigma), np.sin(sigma), np.cos(sigma)
        sigma = first + big_b * s * (m + big_b / 4 * (c * (2 * m * m - 1) - big_b / 6 * m * (4 * s * s - 3) * (4 * m * m - 3)))
    m, s, c = np.cos(2 * s1 + sigma), np.sin(sigma), np.cos(sigma)
    y = np.arctan2(np.sin(u1) * c + np.cos(u1) * s * cos_turn, (1 - FLAT) * np.hypot(sa, np.sin(u1) * s - np.cos(u1) * c * cos_turn))
    lam = np.arctan2(s * sin_turn, np.cos(u1) * c - np.sin(u1) * s * cos_turn)
    k = FLAT / 16 * c2a * (4 + FLAT * (4 - 3 * c2a))
    x = lam - (1 - k) * FLAT * sa * (sigma + k * s * (m + k * c * (2 * m * m - 1)))
    xs, ys = lon.to_numpy(float)[:, None] + np.degrees(x), np.degrees(y)
    for i, p, q in zip(np.flatnonzero(some).tolist(), xs.tolist(), ys.tolist(), strict=True):
        whole[i] = [{"x": a, "y": b} for a, b in zip([*p, p[0]], [*q, q[0]], strict=True)]
    return whole


def tile_pixels(lat: Column, metres: float = 50.0) -> Column:
    """A radius in pixels of the world's single tile of 512 pixels at a latitude; null beyond 85 degrees."""
    return F.when(F.abs(lat) < 85, F.lit(metres * 512) / (F.lit(2 * math.pi * AXIS) * F.cos(F.radians(lat))))


@F.pandas_udf(LINE)
def simplified(lines: pd.Series, tolerance: pd.Series) -> pd.Series:
    """Lines without the points that lie within a tolerance of the line through their neighbours (Douglas and Peucker)."""

    def thin(line, limit: float):
        if line is None or len(line) < 3:
            return line
        xy = np.array([(p["x"], p["y"]) for p in line])
        keep, todo = {0, len(line) - 1}, [(0, len(line) - 1)]
        while todo:
            i, j = todo.pop()
            if j - i < 2:
                continue
            d, rest = xy[j] - xy[i], xy[i + 1 : j] - xy[i]
            size = d @ d
            t = np.clip(rest @ d / size, 0.0, 1.0) if size else np.zeros(len(rest))
            off = np.hypot(*(rest - t[:, None] * d).T)
            k = int(off.argmax())  # the first of equals
            if off[k] > limit:
                keep.add(i + 1 + k)
                todo += [(i, i + 1 + k), (i + 1 + k, j)]
        return [line[k] for k in sorted(keep)]

    return pd.Series([thin(a, b) for a, b in zip(lines, tolerance, strict=True)])
