"""Lookups and counts before and after. Customers are addresses, orders routes of items, parts ways and places."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import shapes
from ..functions.text import content_hash
from ..operators import lookups
from .catalog import query, table
from .function_queries import pick


@query("""WITH a AS (SELECT c_nationkey AS s, c_custkey % 40 AS n, min(c_custkey) AS k, max(c_custkey) - min(c_custkey) AS span FROM customer GROUP BY 1, 2)
SELECT o_orderkey AS id, CASE WHEN a.k IS NULL THEN 'unknown' WHEN span > 50 THEN 'apart' END AS problem, CASE WHEN span <= 50 THEN k ELSE -1 END::DOUBLE AS x FROM orders LEFT JOIN a ON s = o_orderkey % 30 AND n = o_orderkey % 45""")
def addresses(spark, sf_dir):
    """House numbers of streets; some are unknown, some have points that lie too far apart."""
    known = table(spark, sf_dir, "customer").select(F.concat(F.lit("Straße "), F.col("c_nationkey")).alias("street"), F.concat(F.col("c_custkey") % 40, F.lit(" A")).alias("number"), F.col("c_custkey").cast("double").alias("x"), F.lit(0.0).alias("y"))
    asked = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("strasse  "), F.col("o_orderkey") % 30).alias("street"), F.concat(F.col("o_orderkey") % 45, F.lit("a")).alias("number"))
    return lookups.addressed(asked, known).select("id", "problem", F.coalesce("p.x", F.lit(-1.0)).alias("x"))


@query("""SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 100 + o_orderkey % 5 WHEN 1 THEN o_orderkey % 5 WHEN 2 THEN o_orderkey % 5 ELSE 200 END AS locality_id, CASE WHEN o_orderkey % 4 IN (0, 3) THEN 10 ELSE 9 END AS level FROM orders""")
def locality_scopes(spark, sf_dir):
    """Headings that name a district and a neighbourhood in it, in another one or none, or a neighbourhood alone."""
    box = lambda x: F.array(*(shapes.point(x + a, F.lit(float(b))) for a, b in ((0.0, 0), (9.0, 0), (9.0, 9), (0.0, 9), (0.0, 0))))
    five = spark.range(5)
    i = F.col("id")
    at = (i * 10).cast("double")
    nine = five.select(i.alias("locality_id"), F.concat(F.lit("District "), i).alias("name"), F.lit(9).alias("level"), at.alias("x"), F.lit(0.0).alias("y"), box(at).alias("ring"))
    ten = five.select((i + 100).alias("locality_id"), F.concat(F.lit("Hood "), i).alias("name"), F.lit(10).alias("level"), (at + 4).alias("x"), F.lit(4.0).alias("y"), box(at).alias("ring"))
    only = spark.range(1).select(F.lit(200).cast("long").alias("locality_id"), F.lit("Alone").alias("name"), F.lit(10).alias("level"), F.lit(99.0).alias("x"), F.lit(4.0).alias("y"), box(F.lit(0.0)).alias("ring"))
    n = F.col("o_orderkey") % 5
    headings = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 4 != 3, F.concat(F.lit("district "), n)).alias("district"), F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("HOOD "), n)).when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit("Hood "), (n + 1) % 5)).when(F.col("o_orderkey") % 4 == 3, "alone").alias("intro"))
    return lookups.scopes(headings, nine.unionByName(ten).unionByName(only))


def railways(spark, sf_dir):
    kinds = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("way_id"), F.create_map(F.lit("railway"), pick(("rail", "rail", "rail", "rail", "tram", "rail", "rail", "rail", "rail", "rail", "rail"), F.col("p_partkey"))).alias("tags"))
    members = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda m: m["l_partkey"])
    relations = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("route_id")).agg(members.alias("members")).withColumn("ref", F.concat(F.lit("R"), F.col("route_id") % 9))  # an order has few items
    return lookups.routes(relations, kinds, "train")


@query("SELECT l_partkey AS way_id, array_to_string(list_sort(list(DISTINCT 'R' || (l_orderkey % 9))), ',') AS refs FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_partkey % 11 = 4) GROUP BY 1")
def way_routes(spark, sf_dir):
    """The lines on each way, of routes whose ways may all be used."""
    return lookups.way_lines(railways(spark, sf_dir)).select("way_id", F.array_join("refs", ",").alias("refs"))


@query("SELECT DISTINCT a.l_partkey AS parking_id, b.l_partkey AS market_id FROM lineitem a JOIN lineitem b USING (l_orderkey) WHERE a.l_partkey % 9 = 0 AND b.l_partkey % 10 = 1 AND b.l_partkey % 9 <> 0")
def market_sites(spark, sf_dir):
    places = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("place_id"), F.when(F.col("p_partkey") % 9 == 0, "parking").when(F.col("p_partkey") % 10 == 1, "marketplace").otherwise("shop").alias("kind"))
    sites = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("relation_id")).agg(F.collect_list("l_partkey").alias("members"))  # an order has few items
    return lookups.market_parking(sites, places)


@query("SELECT p_partkey AS id, p_partkey % 3 = 0 AS named FROM part")
def literal_names(spark, sf_dir):
    """Names as whole words: not inside a longer word, and with marks that patterns would take for others."""
    name = F.concat(F.lit("Haus (Nr. "), F.col("p_partkey"), F.lit(")"))
    said = pick(("Vor dem HAUS (NR. {}) stand er.", "Vor dem Haus (Nr. {})a stand er.", "Vor dem Haus Nr. {} stand er."), F.col("p_partkey"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), lookups.names_place(F.replace(said, F.lit("{}"), F.col("p_partkey").cast("string")), name).alias("named"))


@query("SELECT p_partkey AS id, path, CASE WHEN path = 'title' AND p_partkey % 2 = 0 THEN 'T ' || p_partkey END AS translation FROM part, (VALUES ('title'), ('label')) v(path)")
def translated_fields(spark, sf_dir):
    """Translations belong to a field and the very text; those of changed texts and of other fields are not used."""
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.concat(F.lit("title "), F.col("p_partkey")).alias("title"), F.concat(F.lit("label "), F.col("p_partkey")).alias("label"))
    known = rows.filter("id % 2 = 0").select(F.lit("title").alias("path"), content_hash(F.col("title")).alias("hash"), F.concat(F.lit("T "), F.col("id")).alias("text"))
    wrong = rows.filter("id % 2 = 0").select(F.lit("title").alias("path"), content_hash(F.col("label")).alias("hash"), F.lit("of the label").alias("text"))
    return lookups.translated(rows, known.unionByName(wrong), ("title", "label")).select("id", "path", "translation")


@query("SELECT 'brand' AS field, p_brand AS value, count(*) AS n FROM part GROUP BY 2 UNION ALL SELECT 'type', p_type, count(*) FROM part GROUP BY 2 UNION ALL SELECT 'size', p_size::VARCHAR, count(*) FROM part GROUP BY 2")
def method_histograms(spark, sf_dir):
    return lookups.histograms(table(spark, sf_dir, "part").select(F.col("p_brand").alias("brand"), F.col("p_type").alias("type"), F.col("p_size").alias("size")), "brand", "type", "size")


@query("SELECT count_if(event_id % 5 = 0 AND event_id % 7 <> 0)::BIGINT AS newly_mapped, count_if(event_id % 5 <> 0 AND event_id % 7 = 0)::BIGINT AS lost, count_if(event_id % 5 <> 0 AND event_id % 7 <> 0 AND event_id % 3 = 0)::BIGINT AS moved, count_if((event_id % 5 = 0) = (event_id % 7 = 0) AND NOT (event_id % 5 <> 0 AND event_id % 3 = 0))::BIGINT AS same FROM events")
def geocode_transitions(spark, sf_dir):
    e = F.col("event_id")
    rows = lambda here, step: table(spark, sf_dir, "events").select(e.alias("id"), F.lit("m").alias("method"), F.when(here, F.lit(13.4) + step).alias("lon"), F.when(here, 52.5).alias("lat"))
    return lookups.transitions(rows(e % 5 != 0, F.lit(0.0)), rows(e % 7 != 0, F.when(e % 3 == 0, 0.01).otherwise(0.001)))


@query("SELECT period, count(*) AS n FROM (SELECT (ts + INTERVAL 1 HOUR)::DATE AS day FROM events WHERE event_id % 10 <> 0), (VALUES ('last7', 7), ('last30', 30), ('day', 1)) p(period, days) WHERE day BETWEEN DATE '2024-01-25' - days::INT + 1 AND DATE '2024-01-25' GROUP BY 1")
def local_periods(spark, sf_dir):
    """Days in Berlin, an hour ahead in January; every tenth time is unknown."""
    rows = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 10 != 0, F.col("ts").cast("timestamp")).alias("t"))
    return lookups.in_periods(rows, "t", "2024-01-25", {"last7": 7, "last30": 30, "day": 1}).groupBy("period").agg(F.count("*").alias("n"))


@query("SELECT p_partkey AS id, p_name AS name FROM part WHERE contains(lower(p_name), 'wi') ORDER BY strpos(lower(p_name), 'wi'), p_partkey LIMIT 8")
def typed_names(spark, sf_dir):
    return lookups.found_names(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")), "WI")


@query("SELECT count(*) AS discovered, count_if(o_orderstatus = 'F')::BIGINT AS \"F\", count_if(o_orderstatus = 'O')::BIGINT AS \"O\", count_if(o_orderstatus = 'P')::BIGINT AS \"P\" FROM orders")
def source_states(spark, sf_dir):
    return lookups.inventory(table(spark, sf_dir, "orders"), ("F", "O", "P"), "o_orderstatus")
