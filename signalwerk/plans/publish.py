"""Publication: an immutable generation of partitioned tables, and a manifest that is written last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def publish(root: str, generation: str, tables: dict[str, tuple[DataFrame, list[str]]]) -> None:
    """Write tables, each with its partition columns, below a new generation's folder, then append the generation to the manifest.

    Readers take the manifest's latest generation, so they never see a part of one. A generation that exists is left as it is."""
    spark = next(iter(tables.values()))[0].sparkSession
    if generation in generations(spark, root):
        return
    for name, (df, by) in tables.items():
        (df.write.mode("overwrite").partitionBy(*by) if by else df.write.mode("overwrite")).parquet(f"{root}/{generation}/{name}")
    spark.range(1).select(F.lit(generation).alias("generation"), F.current_timestamp().alias("published")).write.mode("append").json(f"{root}/manifest")


def generations(spark: SparkSession, root: str) -> list[str]:
    """Published generations, the latest last: as many rows as publications."""
    from pyspark.errors import AnalysisException

    try:
        found = spark.read.schema("generation string, published timestamp").json(f"{root}/manifest")
    except AnalysisException:
        return []
    return [r["generation"] for r in found.orderBy("published", "generation").collect()]


def current(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{generations(spark, root)[-1]}/{name}")


def batches(df: DataFrame, path: str, rows: int = 200) -> None:
    """Line-wise JSON in files of at most `rows` records."""
    df.write.option("maxRecordsPerFile", rows).json(path)


def tile_sizes(tiled: DataFrame, key: str) -> DataFrame:
    """Records and bytes of JSON per tile: key, n, bytes."""
    rest = [c for c in tiled.columns if c != key]
    return tiled.select(key, F.octet_length(F.to_json(F.struct(*rest))).cast("long").alias("_b")).groupBy(key).agg(F.count("*").alias("n"), F.sum("_b").alias("bytes"))


def searchable(places: DataFrame) -> DataFrame:
    """Places (name, kind, ...) whose name is not just their kind."""
    return places.filter(F.col("name").isNotNull() & (F.col("name") != F.col("kind")))


def by_name(objects: DataFrame) -> DataFrame:
    """A row for each object (id, names) and different name in lower case: name, id."""
    low = F.transform("names", lambda n: F.lower(F.trim(n)))
    return objects.select(F.explode(F.array_distinct(F.filter(low, lambda n: n != ""))).alias("name"), "id")


def guarded(root: str, rows: DataFrame, generated: int) -> bool:
    """Write a snapshot with the time (seconds) that it was generated at; one that is older than the latest is refused. Tells whether it was written."""
    spark = rows.sparkSession
    latest = [int(g) for g in generations(spark, root)]
    if latest and generated < max(latest):
        return False
    publish(root, f"{generated:020d}", {"snapshot": (rows, [])})
    return True
