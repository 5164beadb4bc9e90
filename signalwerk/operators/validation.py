"""Whether the files of a product agree: index, tiles, search and counts meet in one union and are compared by aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tile_of_file(pattern: str) -> Column:
    """The tile that a row's file belongs to, from the file's own path; the pattern has one group."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


def record_faults(index: DataFrame, tiles: DataFrame, search: DataFrame) -> DataFrame:
    """Records whose files disagree (index: id, tile; tiles: id, tile of the file; search: id): id, fault; a record with several faults has the first of
    `repeated in index`, `not in index`, `missing in tiles`, `repeated in tiles`, `wrong tile`, `not searchable`."""
    none = F.lit(None).cast("string")
    tagged = index.select("id", F.lit("index").alias("of"), F.col("tile").cast("string").alias("tile"))
    tagged = tagged.unionByName(tiles.select("id", F.lit("tile").alias("of"), F.col("tile").cast("string").alias("tile"))).unionByName(search.select("id", F.lit("search").alias("of"), none.alias("tile")))
    n = lambda of: F.count_if(F.col("of") == of)
    least = lambda of: F.min(F.when(F.col("of") == of, F.col("tile")))
    rows = tagged.groupBy("id").agg(n("index").alias("i"), n("tile").alias("t"), n("search").alias("s"), least("index").alias("own"), least("tile").alias("where"))
    fault = (
        F.when(F.col("i") > 1, "repeated in index")
        .when(F.col("i") == 0, "not in index")
        .when(F.col("t") == 0, "missing in tiles")
        .when(F.col("t") > 1, "repeated in tiles")
        .when(F.col("own") != F.col("where"), "wrong tile")
        .when(F.col("s") == 0, "not searchable")
    )
    return rows.select("id", fault.alias("fault")).filter("fault is not null")


def tile_faults(declared: DataFrame, tiles: DataFrame) -> DataFrame:
    """Tiles whose files are not what is declared (tile, n): tile, declared, found; null where one side has none."""
    both = declared.select(F.col("tile").cast("string").alias("tile"), F.col("n").alias("declared"), F.lit(None).cast("long").alias("one")).unionByName(tiles.select(F.col("tile").cast("string").alias("tile"), F.lit(None).cast("long").alias("declared"), F.lit(1).cast("long").alias("one")))
    rows = both.groupBy("tile").agg(F.max("declared").alias("declared"), F.sum("one").alias("found"))
    return rows.filter(~F.col("declared").eqNullSafe(F.col("found")))
