"""Places of events at the edges of tiles and areas, against the queries' SQL."""

import datetime

import duckdb
import pytest

from signalwerk import plans

from .test_queries import rows

TYPES = ("click", "view", "signup", "purchase", "error")


@pytest.fixture(scope="module")
def edges(spark, tmp_path_factory):
    """Events on tiles' edges: their longitudes and latitudes in hundred-thousandths are sums that decimals and doubles round differently."""
    root = tmp_path_factory.mktemp("edges")
    ids = [i * pow(7919, -1, 60000) % 60000 for i in range(2000, 60000, 2000)]
    users = [i * pow(104729, -1, 30000) % 30000 for i in range(0, 30000, 2500)]
    each = [(a + 60000 * (5 * n + k), datetime.datetime(2024, 1, 1 + n % 28), b, kind, 1.0 * (n % 20), "{}") for a in ids for n, b in enumerate(users) for k, kind in enumerate(TYPES)]
    spark.createDataFrame(each, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(f"{root}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{root}/events.parquet/*.parquet'")
    return str(root), con


def same(spark, edges, name):
    root, con = edges
    found, want = rows(plans.QUERIES[name](spark, root).toPandas()), rows(con.execute(plans.ORACLE_SQL[name]).fetchdf())
    assert found == want and len(want[1]) > 0


def test_tiles(spark, edges):
    same(spark, edges, "tiles")


def test_tile_bytes(spark, edges):
    same(spark, edges, "tile_bytes")


def test_tile_reads(spark, edges):
    same(spark, edges, "tile_reads")


def test_viewport(spark, edges):
    same(spark, edges, "viewport")


def test_filtered_cells(spark, edges):
    same(spark, edges, "filtered_cells")


def test_in_area(spark, tmp_path):
    """Events on each of the area's three edges, in it and out of it."""
    at = [(20000, 6000), (20000, 30000 - 1), (30000, 5000), (40000, 15000), (50000, 5000), (30000, 25000), (20001, 5001), (30000, 24999), (30001, 25000), (19999, 6000), (25001, 29999), (31234, 23766), (31234, 23765)]
    each = [(x * pow(7919, -1, 60000) % 60000, datetime.datetime(2024, 1, 1), y * pow(104729, -1, 30000) % 30000, TYPES[i % 5], 1.0, "{}") for i, (x, y) in enumerate(at)]
    spark.createDataFrame(each, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    same(spark, (str(tmp_path), con), "in_area")
