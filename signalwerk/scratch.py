"""The shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []


def folder(spark: SparkSession, name: str) -> str:
    """A new folder name in spark.checkpoint.dir. Only a local session, as in tests, may leave that unset and gets a temp folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='signalwerk-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    _made.append(f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet to the shared folder and read again: cuts the lineage and survives lost executors."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df over all cores before costly work on each row, where it comes in fewer parts than there are, as a small file does; else as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def clear(spark: SparkSession) -> int:
    """Remove the folders that this process has made; for when its results are written, as they read these tables. Returns how many there were."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    done = 0
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        done += bool(path.getFileSystem(conf).delete(path, True))
    return done
