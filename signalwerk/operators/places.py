"""Points, cells, months and places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo

SIZES = (1100, 275)


def celled(points: DataFrame, sizes: tuple[int, ...] = SIZES, by: tuple[str, ...] = ("month",)) -> DataFrame:
    """points (x, y, *by) with cell_id, a row per size. Points without coordinates lie in no cell, nor do rows without a month."""
    placed = points.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    for c in by:
        placed = placed.filter(F.col(c).isNotNull())
    placed = placed.withColumn("size", F.explode(F.array(*(F.lit(float(s)) for s in sizes))))
    return placed.withColumn("cell_id", geo.hex_cell(F.col("x"), F.col("y"), F.col("size")))


def hexagons(points: DataFrame, sizes: tuple[int, ...] = SIZES, by: tuple[str, ...] = ("month",), sums: tuple[str, ...] = ()) -> DataFrame:
    """Counts by cell: points (x, y, category, precision, *by) to by, cell_id, n, categories, n_approximate, and sums of further columns.

    A first aggregation by category combines before the shuffle. Which ids lie in a cell is told by celled(), as rows.
    """
    each = celled(points, sizes, by).groupBy(*by, "cell_id", "category").agg(F.count("*").alias("n"), F.sum(F.when(F.col("precision") != "point", 1).otherwise(0)).alias("approximate"), *(F.sum(c).alias(c) for c in sums))
    return each.groupBy(*by, "cell_id").agg(
        F.sum("n").alias("n"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n")))).alias("categories"),
        F.sum("approximate").alias("n_approximate"),
        *(F.sum(c).alias(c) for c in sums),
    )


def within(points: DataFrame, places: DataFrame, radius: float) -> DataFrame:
    """Pairs of points (id, x, y) and places (place_id, px, py) at most `radius` metres apart: id, place_id, distance.

    Both sides meet on square cells of the radius; a place is copied to nine, so each pair meets once.
    """
    cell = lambda c, d=0: (F.floor(c / radius) + d).cast("long")
    near = places.withColumn("_d", F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))))
    near = near.select("place_id", "px", "py", cell(F.col("px"), F.col("_d.i")).alias("_cx"), cell(F.col("py"), F.col("_d.j")).alias("_cy"))
    own = points.withColumn("_cx", cell(F.col("x"))).withColumn("_cy", cell(F.col("y")))
    distance = F.sqrt((F.col("x") - F.col("px")) ** 2 + (F.col("y") - F.col("py")) ** 2)
    return own.join(near, ["_cx", "_cy"]).withColumn("distance", distance).filter(F.col("distance") <= radius).select("id", "place_id", "distance")


def inside(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point lies in a ring (array of structs x, y, first = last): crossings of a ray, as a fold over edges."""
    edges = F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    def crossed(e: Column) -> Column:
        (ax, ay), (bx, by) = (e["a"]["x"], e["a"]["y"]), (e["b"]["x"], e["b"]["y"])
        return ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / F.when(by == ay, 1.0).otherwise(by - ay) + ax)
    return F.aggregate(edges, F.lit(False), lambda acc, e: acc != crossed(e))


def on_rim(x: Column, y: Column, ring: Column, off: float = 1e-11) -> Column:
    """Whether a point lies on a ring's edges, which inside() counts in on one side and out on the other; `off` is for rounding, in the ring's units."""

    def touched(e: Column) -> Column:
        (ax, ay), (bx, by) = (e["a"]["x"], e["a"]["y"]), (e["b"]["x"], e["b"]["y"])
        # an area of twice the triangle is the distance times the edge's length, which is at most the sum of its sides
        near = F.abs((bx - ax) * (y - ay) - (by - ay) * (x - ax)) <= off * (F.abs(bx - ax) + F.abs(by - ay))
        return near & x.between(F.least(ax, bx) - off, F.greatest(ax, bx) + off) & y.between(F.least(ay, by) - off, F.greatest(ay, by) + off)

    return F.exists(F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), touched)


def nearest_parts_selected(pairs: DataFrame, selected: DataFrame) -> DataFrame:
    """Place ids of which every nearest part is among the selected ones: pairs (place_id, part_id, distance), selected (part_id)."""
    least = pairs.groupBy("place_id").agg(F.min("distance").alias("_least"))
    nearest = pairs.join(least, "place_id").filter(F.col("distance") == F.col("_least"))
    marked = nearest.join(selected.select("part_id", F.lit(True).alias("_sel")), "part_id", "left")
    return marked.groupBy("place_id").agg(F.bool_and(F.col("_sel").isNotNull()).alias("_all")).filter("_all").select("place_id")


def viewport(tiled: DataFrame, keys: list[str], most: int = 64) -> DataFrame:
    """Rows of the tiles of a viewport, each id once; more than `most` tiles give none, as in a map that is zoomed out too far."""
    if len(keys) > most:
        return tiled.limit(0)
    return tiled.filter(F.col("tile_key").isin(keys)).dropDuplicates(["id"])
