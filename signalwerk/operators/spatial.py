"""Points, lines and areas against areas, in metres.

A shape is an array of parts, a part an array of lines: the rings of a polygon (closed, holes among them), a line, or a line of one point;
`dimension` is 0, 1 or 2. Shapes meet on square cells that hold their keys only. A cell that lies inside an area needs no test; for the
others the shapes of a pair are fetched once and looked at exactly, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rings, shapes
from .places import inside
from .roads import covered

SHAPE = f"array<array<{shapes.LINE.simpleString()}>>"


def polygon(*lines: Column) -> Column:
    """A shape of one part: an outer ring and its holes, or a line."""
    return F.array(F.array(*lines))


def schema_of(rows: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns)


def cover(rows: DataFrame, keys: list[str], size: float, margin: float = 0.0) -> DataFrame:
    """Cells within a margin of each shape: keys, _cx, _cy, _inner (the cell lies inside the area, the margin away from its edges), _cells (how many the shape has)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                owner, cx, cy, inner = rings.cells_by_row(rings.edges_by_row(part.column("shape")), part.column("dimension").to_pylist(), size, margin)
                n, take = np.bincount(owner, minlength=part.num_rows), pa.array(owner)
                yield pa.RecordBatch.from_arrays([*(part.column(k).take(take) for k in keys), pa.array(cx), pa.array(cy), pa.array(inner), pa.array(n[owner].astype(np.int64))], names=[*keys, "_cx", "_cy", "_inner", "_cells"])

    return rows.select(*keys, "dimension", "shape").mapInArrow(run, f"{schema_of(rows, keys)}, _cx long, _cy long, _inner boolean, _cells long")


def with_cells(rows: DataFrame, box: Column, size: float, margin: float = 0.0) -> DataFrame:
    """rows with the cells _cx, _cy that a bounding box, wider by a margin, touches."""
    rows = rows.withColumn("_box", box)
    low, high = (lambda k: F.col(f"_box.{k}_min") - margin), (lambda k: F.col(f"_box.{k}_max") + margin)
    return rows.withColumn("_cx", F.explode(covered(low("x"), high("x"), size))).withColumn("_cy", F.explode(covered(low("y"), high("y"), size))).drop("_box")


def points_in_areas(points: DataFrame, areas: DataFrame, key: str, size: float = 500.0, same: tuple[str, ...] = (), radius: float = 0.0) -> DataFrame:
    """Pairs of points (x, y, ...) and areas (key, shape, ...) of which the point lies inside or at most `radius` away, and the columns `same` are equal.

    Each pair comes once, with the columns of both sides, whose names have to be different but for `same`; keys are unique."""
    cell = lambda c: F.floor(F.col(c) / size).cast("long")
    a = areas.withColumn("dimension", F.lit(rings.AREA))
    found = points.withColumn("_cx", cell("x")).withColumn("_cy", cell("y")).join(cover(a, [*same, key], size, radius).drop("_cells").hint("merge"), [*same, "_cx", "_cy"]).drop("_cx", "_cy")  # never sent whole through the driver
    kept = [c for c in found.columns if c != "_inner"]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            # rows of an area follow each other
            names = batch.column(key)
            edge = rings.edges_by_row(batch.column("shape").take(pa.array(first := changes(names))))
            xy = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in "xy"], 1).astype(float)
            hit = np.zeros(batch.num_rows, bool)
            for e, low, high in zip(edge, first, [*first[1:], batch.num_rows], strict=True):
                hit[low:high] = rings.contains(e, xy[low:high])
                if radius:
                    hit[low:high] |= rings.to_edges(xy[low:high], e) <= radius
            yield batch.filter(pa.array(hit)).select(kept)

    exact = found.filter("not _inner").drop("_inner").join(areas.select(key, "shape").hint("merge"), key).sortWithinPartitions(key).mapInArrow(run, schema_of(found, kept))
    both = found.filter("_inner").select(*kept).unionByName(exact)
    rest = [c for c in areas.columns if c not in (key, *same)]
    return both.join(areas.select(key, *rest).hint("merge"), key) if rest else both


def changes(column) -> list[int]:
    """Where a run of equal values begins in an Arrow column."""
    values = column.to_pylist()
    return [i for i, v in enumerate(values) if i == 0 or v != values[i - 1]]


def within(left: DataFrame, right: DataFrame, radius: float = 0.0, size: float = 500.0, same: tuple[str, ...] = ()) -> DataFrame:
    """Pairs left_id, right_id of shapes (left_id or right_id, dimension, shape, columns `same`) at most `radius` apart; radius 0: they meet or one lies in the other.

    Each pair comes once. Only ids pass through the cells; a pair whose left shape touches an inner cell of the right one is sure."""
    a, b = cover(left, ["left_id", *same], size).drop("_inner", "_cells"), cover(right, ["right_id", *same], size, radius).drop("_cells")
    pairs = a.join(b, [*same, "_cx", "_cy"]).groupBy("left_id", "right_id").agg(F.bool_or("_inner").alias("sure"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                near = [
                    rings.distance(e, d, f, g) <= radius
                    for e, d, f, g in zip(rings.edges_by_row(part.column("left_shape")), part.column("left_dimension").to_pylist(), rings.edges_by_row(part.column("right_shape")), part.column("right_dimension").to_pylist(), strict=True)
                ]
                yield part.filter(pa.array(near)).select(["left_id", "right_id"])

    side = lambda rows, name: rows.select(f"{name}_id", F.col("dimension").alias(f"{name}_dimension"), F.col("shape").alias(f"{name}_shape"))
    open_ = pairs.filter("not sure").drop("sure").join(side(left, "left"), "left_id").join(side(right, "right"), "right_id")
    exact = open_.mapInArrow(run, schema_of(pairs, ["left_id", "right_id"]))
    return pairs.filter("sure").drop("sure").unionByName(exact)


def clipped(segments: DataFrame, areas: DataFrame, size: float = 500.0) -> DataFrame:
    """Segments (id, a, b, ...) in areas (area_id, shape): their columns, area_id, inside (the pieces), share (of the segment's length). Pairs without a piece are left out."""
    line = segments.select("id", F.lit(rings.LINE).alias("dimension"), F.array(F.array(F.array("a", "b"))).alias("shape"))
    s = cover(line, ["id"], size).drop("_inner").withColumnRenamed("_cells", "of")
    r = cover(areas.withColumn("dimension", F.lit(rings.AREA)), ["area_id"], size).drop("_cells")
    pairs = s.join(r, ["_cx", "_cy"]).groupBy("id", "area_id").agg((F.count_if("_inner") == F.first("of")).alias("whole"))
    both = pairs.join(segments.select("id", "a", "b"), "id")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                first = changes(part.column("area_id"))
                shape = rings.edges_by_row(part.column("shape").take(pa.array(first)))
                ab = [np.stack([part.column(c).field(k).to_numpy(zero_copy_only=False) for k in "xy"], 1) for c in "ab"]
                inside = []
                for e, low, high in zip(shape, first, [*first[1:], part.num_rows], strict=True):
                    a, b = ab[0][low:high], ab[1][low:high]
                    at = lambda n, t: dict(zip("xy", (a[n] + (b[n] - a[n]) * t).tolist(), strict=True))  # noqa: B023, E731
                    inside += [[{"a": at(n, t), "b": at(n, u)} for t, u in found] for n, found in enumerate(rings.pieces_of_all(a, b, e))]
                point = pa.struct([("x", pa.float64()), ("y", pa.float64())])
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("area_id"), pa.array(inside, pa.list_(pa.struct([("a", point), ("b", point)])))], names=["id", "area_id", "inside"])

    kind = "array<struct<a:struct<x:double,y:double>,b:struct<x:double,y:double>>>"
    whole = both.filter("whole").select("id", "area_id", F.array(F.struct("a", "b")).cast(kind).alias("inside"))
    exact = both.filter("not whole").join(areas.select("area_id", "shape"), "area_id").sortWithinPartitions("area_id").mapInArrow(run, f"{schema_of(pairs, ['id', 'area_id'])}, inside {kind}")
    found = segments.join(whole.unionByName(exact).filter(F.size("inside") > 0), "id")
    total = F.aggregate("inside", F.lit(0.0), lambda acc, e: acc + shapes.between(e["a"], e["b"]))
    return found.withColumn("share", F.try_divide(total, shapes.between(F.col("a"), F.col("b"))))


def cuts(a: Column, b: Column, ring: Column) -> Column:
    """Where segment ab meets a ring, as shares of its length, sorted, with both ends."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]

    def at(e: Column) -> Column:
        sx, sy = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
        den = F.nullif(dx * sy - dy * sx, F.lit(0.0))
        t = ((e["a"]["x"] - a["x"]) * sy - (e["a"]["y"] - a["y"]) * sx) / den
        u = ((e["a"]["x"] - a["x"]) * dy - (e["a"]["y"] - a["y"]) * dx) / den
        return F.when(t.between(0, 1) & u.between(0, 1), t)

    return F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), F.array_compact(F.transform(shapes.steps(ring), at)))))


def pieces(a: Column, b: Column, ring: Column) -> Column:
    """The pieces of segment ab inside a ring, in order: array of structs a, b. What only touches the ring has no piece."""

    def of(s: Column) -> Column:
        p, q = s["a"], s["b"]
        at = lambda t: shapes.point(p["x"] + (q["x"] - p["x"]) * t, p["y"] + (q["y"] - p["y"]) * t)
        spans = shapes.let(cuts(p, q, s["ring"]), lambda ts: F.zip_with(F.slice(ts, F.lit(1), F.size(ts) - 1), F.slice(ts, F.lit(2), F.size(ts) - 1), lambda u, v: F.struct(u.alias("u"), v.alias("v"))))
        held = F.filter(spans, lambda e: shapes.let(at((e["u"] + e["v"]) / 2), lambda m: inside(m["x"], m["y"], s["ring"])))
        return F.transform(held, lambda e: F.struct(at(e["u"]).alias("a"), at(e["v"]).alias("b")))

    return shapes.let(F.struct(a.alias("a"), b.alias("b"), ring.alias("ring")), of)


def is_covered(share: Column) -> Column:
    """Whether a line lies in an area, but for a hundred-millionth of its length."""
    return share >= 1 - 1e-8


def inner_point(ring: Column) -> Column:
    """A point inside a ring: the middle of the widest stretch of a level line that runs halfway between two neighbouring levels of vertices, at mid-height."""

    def of(v: Column) -> Column:
        xs = F.array_sort(F.array_compact(F.transform(shapes.steps(v["ring"]), lambda e: F.when((e["a"]["y"] > v["y"]) != (e["b"]["y"] > v["y"]), e["a"]["x"] + (e["b"]["x"] - e["a"]["x"]) * (v["y"] - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"])))))
        stretch = shapes.let(xs, lambda x: F.transform(F.sequence(F.lit(1), F.size(x) - 1, F.lit(2)), lambda i: F.struct((x[i] - x[i - 1]).alias("w"), ((x[i] + x[i - 1]) / 2).alias("m"))))
        return shapes.point(F.array_max(stretch)["m"], v["y"])

    ys = F.array_sort(F.array_distinct(F.transform(ring, lambda p: p["y"])))
    mid = lambda y: (F.element_at(y, 1) + F.element_at(y, -1)) / 2
    level = shapes.let(ys, lambda y: shapes.let(mid(y), lambda m: (F.array_max(F.filter(y, lambda v: v < m)) + F.array_min(F.filter(y, lambda v: v >= m))) / 2))
    return F.when(F.size(ys) > 1, shapes.let(F.struct(ring.alias("ring"), level.alias("y")), of))


def nearest_same_name(points: DataFrame, segments: DataFrame, radius: float = 500.0) -> DataFrame:
    """For points (id, street, x, y) all segments (part_id, name, a, b) of that name that are nearest within a radius: id, part_id, distance.

    Ties, to a millimetre, all come."""
    s = with_cells(segments.withColumnRenamed("name", "street"), shapes.bounds(F.array("a", "b")), radius, radius)
    cell = lambda c: F.floor(F.col(c) / radius).cast("long")
    both = points.withColumn("_cx", cell("x")).withColumn("_cy", cell("y")).join(s, ["street", "_cx", "_cy"])
    far = both.withColumn("distance", F.round(shapes.to_segment(shapes.point(F.col("x"), F.col("y")), F.col("a"), F.col("b")), 3)).filter(F.col("distance") <= radius)
    least = far.groupBy("id").agg(F.min("distance").alias("distance"))
    return far.join(least, ["id", "distance"]).select("id", "part_id", "distance")


def associated(events: DataFrame, places: DataFrame) -> DataFrame:
    """Links of events (id, x, y, kinds) to places (place_id, kind, shape, mode) in whose shape they lie and whose kind they mention, a row per pair.

    Places whose footprint is missing have no shape."""
    shown = places.filter("mode <> 'footprint_missing'")
    return points_in_areas(events, shown, "place_id").filter(F.array_contains("kinds", F.col("kind"))).select("id", "place_id").distinct()
