"""Union, intersection and difference of areas; union of lines. A group's shapes are combined in a tree, a few at a time, so no task gets a whole group at once."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import overlay, rings
from ..scratch import stored
from .spatial import SHAPE, schema_of


def lists(shape: list | None) -> list:
    """An Arrow shape as lists of pairs."""
    return [[[(p["x"], p["y"]) for p in line] for line in part] for part in shape or ()]


def points(shape: list) -> list:
    return [[[{"x": x, "y": y} for x, y in line] for line in part] for part in shape]


def combined(rows: DataFrame, keys: list[str], operation: str) -> DataFrame:
    """rows (keys, shapes: an array of areas) with their combination as `shape`; operation is union, intersection, difference (the first less the others), symmetric or lines (a union of lines)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        point = pa.struct([("x", pa.float64()), ("y", pa.float64())])
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                if operation == "lines":
                    made = rings.noded_each([[line for s in map(lists, shapes) for p in s for line in p] for shapes in part.column("shapes").to_pylist()])
                    out = [points([[x] for x in found]) for found in made]
                    made = pa.array(out, pa.list_(pa.list_(pa.list_(point))))
                else:
                    made = overlay.nested(part.num_rows, *overlay.overlaid(*overlay.flat(part.column("shapes")), operation))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), made], names=[*keys, "shape"])

    return rows.select(*keys, "shapes").mapInArrow(run, f"{schema_of(rows, keys)}, shape {SHAPE}")


def unions(rows: DataFrame, group: str, lines: bool = False, fan: int = 16) -> DataFrame:
    """The union of each group's shapes (group, shape): group, shape; of areas, or of lines, which are cut where they meet and joined again.

    Neighbours by their left ends are united first, `fan` at a time, until every group is one shape. Null shapes have no part; a group of them has an empty shape."""
    now, kind = rows.select(group, "shape"), "lines" if lines else "union"
    while True:
        first = F.array_min(F.transform(F.flatten(F.flatten("shape")), lambda p: p["x"]))
        place = F.row_number().over(Window.partitionBy(group).orderBy(first, F.xxhash64("shape")))
        # a number of parts, else small tables' costly rows meet in one task
        n = int(now.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = now.withColumn("_part", F.floor((place - 1) / fan)).repartition(n, group, "_part").groupBy(group, "_part").agg(F.collect_list(F.coalesce("shape", F.array().cast(SHAPE))).alias("shapes"))
        now = stored(combined(parts, [group, "_part"], kind), "unions")
        if now.filter("_part > 0").isEmpty():
            return now.drop("_part")


def area() -> object:
    """Area of column shape, holes taken off."""
    from ..functions import shapes

    return F.aggregate("shape", F.lit(0.0), lambda acc, p: acc + 2 * shapes.area(p[0]) - F.aggregate(p, F.lit(0.0), lambda a, r: a + shapes.area(r)))
