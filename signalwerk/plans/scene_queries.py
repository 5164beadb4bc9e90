"""Scenes, places and tags as a map shows them. A user's events of a day are an announcement with scenes; its values follow from numbers, so the SQL can tell what comes out."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import shapes
from ..operators import scenes, tagging
from .catalog import query, table
from .function_queries import pick

ROLES = ("incident", "discovery", "arrest", "background", "accident")
SCENES_SQL = """scenes AS (SELECT event_id, user_id, ts::DATE AS day, (['incident', 'discovery', 'arrest', 'background', 'accident'])[event_id % 5 + 1] AS role, (['point', 'street', 'district', 'place'])[event_id % 4 + 1] AS precision,
CASE WHEN event_id % 6 = 0 THEN 'source_road_reference_only' END AS usage, CASE WHEN event_id % 7 = 0 THEN 'osm_junction_reference' ELSE 'x' END AS method, value > 50 AS counted, event_id % 11 <> 0 AS placed, CASE event_id % 13 WHEN 0 THEN 'unresolved' WHEN 1 THEN 'needs_correction' END AS verdict FROM events),
told AS (SELECT *, usage IS NOT NULL OR method <> 'x' AS ref, counted AND usage IS NULL AND method = 'x' AND precision <> 'district' AND placed AS good FROM scenes),
days AS (SELECT user_id, day, min(event_id) AS id, count(*) AS n, bool_or(good) AS good, bool_or(placed AND NOT ref) AS drawn FROM told GROUP BY 1, 2)"""


def announced(spark, sf_dir):
    """id (the first event's number), scenes, and what the announcement says of itself. One in five has no scenes, as older ones."""
    e = F.col("event_id")
    scene = F.struct(e.alias("event_id"), pick(ROLES, e).alias("role"), pick(("point", "street", "district", "place"), e).alias("precision"), F.when(e % 7 == 0, "osm_junction_reference").otherwise("x").alias("method"), F.when(e % 6 == 0, "source_road_reference_only").alias("usage"), (F.col("value") > 50).alias("primary"), F.when(e % 11 != 0, 13.4).alias("lon"), F.when(e % 11 != 0, 52.5).alias("lat"), F.when(e % 13 == 0, "unresolved").when(e % 13 == 1, "needs_correction").alias("verdict"), F.array(e.cast("string")).alias("incidents"))
    days = table(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.min("event_id").alias("id"), F.sort_array(F.collect_list(scene)).alias("all"))  # a user's events of a day
    i = F.col("id")
    own = F.struct(F.lit("district").alias("precision"), F.lit(None).cast("string").alias("usage"), F.lit("x").alias("method"), F.lit(None).cast("boolean").alias("primary"), F.lit(None).cast("double").alias("lon"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("string").alias("verdict"))
    lines = F.array(F.array(shapes.point(F.lit(13.0), F.lit(52.0)), shapes.point(F.lit(13.1), F.when(i % 10 == 0, 52.1).otherwise(95.0))))
    return days.select("id", "all", F.when(i % 5 != 0, F.col("all")).alias("scenes"), F.lit(None).cast("double").alias("lon"), F.lit(None).cast("double").alias("lat"), F.lit("street").alias("precision"), F.lit("disconnected_street_review").alias("method"), lines.alias("lines"), own.alias("own"), F.when(i % 9 == 0, "out_of_city").alias("scope"))


@query(f"WITH {SCENES_SQL} SELECT CASE role WHEN 'accident' THEN 'incident' WHEN 'arrest' THEN 'operation' WHEN 'background' THEN 'context' ELSE role END AS grp, ref, count(*) AS n FROM told WHERE event_id IS NOT NULL GROUP BY 1, 2")
def role_groups(spark, sf_dir):
    s = announced(spark, sf_dir).select(F.explode("all").alias("s"))
    return s.groupBy(scenes.role_group(F.col("s.role")).alias("grp"), scenes.is_reference(F.col("s")).alias("ref")).agg(F.count("*").alias("n"))


@query(f"WITH {SCENES_SQL} SELECT id FROM days WHERE id % 5 = 0 OR good")
def countable_events(spark, sf_dir):
    return scenes.countable(announced(spark, sf_dir)).select("id")


@query(f"WITH {SCENES_SQL} SELECT count_if(id % 5 <> 0 AND good)::BIGINT AS countable, count_if(id % 5 = 0 OR NOT good)::BIGINT AS without_point, count_if((id % 5 = 0 OR NOT good) AND (id % 10 = 0 OR (id % 5 <> 0 AND drawn)))::BIGINT AS without_point_displayed FROM days")
def location_coverage(spark, sf_dir):
    return scenes.coverage(announced(spark, sf_dir))


@query(f"WITH {SCENES_SQL} SELECT id, event_id::VARCHAR AS incident_id FROM told JOIN days USING (user_id, day) WHERE id % 5 = 0 UNION ALL SELECT id, 'extra' FROM days")
def unplaced_incidents(spark, sf_dir):
    rows = announced(spark, sf_dir).withColumn("incidents", F.concat(F.transform("all", lambda s: s["event_id"].cast("string")), F.array(F.lit("extra"))))
    return scenes.unplaced(rows)


UNCERTAIN_SQL = f"""{SCENES_SQL}, listed AS (SELECT id, precision, usage, placed, verdict FROM told JOIN days USING (user_id, day) WHERE id % 5 <> 0 UNION ALL SELECT id, 'district', NULL, false, NULL FROM days WHERE id % 5 = 0),
open AS (SELECT * FROM listed WHERE id % 9 <> 0 AND NOT (precision = 'point' AND usage IS NULL AND verdict IS NULL AND placed)),
kinds AS (SELECT id, CASE precision WHEN 'point' THEN 'venue_reference' WHEN 'place' THEN 'venue_reference' ELSE precision END AS kind, CASE WHEN verdict = 'unresolved' THEN 'unresolved' WHEN usage IS NOT NULL AND verdict IS NULL THEN 'reference_only' ELSE 'insufficient_precision' END AS status FROM open)"""


@query(f"WITH {UNCERTAIN_SQL} SELECT kind, status, count(*) AS n, sum(id)::BIGINT AS ids FROM kinds GROUP BY 1, 2")
def uncertain_scenes(spark, sf_dir):
    return scenes.uncertain(announced(spark, sf_dir)).groupBy("kind", "status").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query(f"WITH {UNCERTAIN_SQL} SELECT kind, count(DISTINCT id) AS announcements, count(*) AS scenes FROM kinds GROUP BY 1 UNION ALL SELECT 'all', count(DISTINCT id), count(*) FROM kinds")
def uncertainty_counts(spark, sf_dir):
    return scenes.uncertainty(scenes.uncertain(announced(spark, sf_dir)))


@query("""WITH links AS (SELECT DISTINCT l_orderkey AS event_id, l_partkey AS place_id, CASE l_linenumber % 3 WHEN 0 THEN 'context' WHEN 1 THEN 'candidate' ELSE 'count' END AS class FROM lineitem WHERE l_orderkey % 4 <> 0),
places AS (SELECT p_partkey AS place_id, (['bar', 'park', 'shop'])[p_partkey % 3 + 1] AS kind, CASE WHEN p_partkey % 4 = 0 THEN 'core' WHEN p_partkey % 4 = 1 THEN 'other' END AS scope, p_partkey % 4 = 2 AS extra FROM part),
shown AS (SELECT place_id, CASE WHEN scope IS NOT NULL THEN kind WHEN extra THEN 'school' ELSE kind END AS display_kind FROM places WHERE scope = 'core' OR (scope IS NULL AND (extra OR kind = 'bar')))
SELECT place_id, display_kind, count_if(class = 'count')::BIGINT AS n_count, count_if(class = 'candidate')::BIGINT AS n_candidate, count_if(class = 'context')::BIGINT AS n_context, count(class) AS n, round(least(0.78, 0.12 + 0.16 * log2(1 + count(class))), 6)::DOUBLE AS opacity FROM shown LEFT JOIN links USING (place_id) GROUP BY 1, 2""")
def styled_places(spark, sf_dir):
    """Places of the chosen kinds with their links by class; contexts come before the kind where a place has them."""
    k = F.col("p_partkey")
    places = table(spark, sf_dir, "part").select(k.alias("place_id"), pick(("bar", "park", "shop"), k).alias("kind"), pick(("core", "other", None, None), k).alias("scope"), F.when(k % 4 == 2, F.array(F.lit("school"), F.lit("bench"))).alias("contexts"))
    n = F.col("l_linenumber") % 3
    links = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("event_id"), F.col("l_partkey").alias("place_id"), F.when(n == 0, "context_near").when(n == 1, "approximate_candidate").otherwise("inside").alias("status"))
    events = table(spark, sf_dir, "orders").filter("o_orderkey % 4 <> 0").select(F.col("o_orderkey").alias("id"))
    return scenes.styled(places, links, events, ("core", "school", "bar")).withColumn("opacity", F.round("opacity", 6))


RECORDS_SQL = "records AS (SELECT doc_id AS id, source AS city, quality, toxic, quality IS NOT NULL AS seen FROM documents LEFT JOIN labels USING (doc_id))"
DECIDED_SQL = f"""{RECORDS_SQL}, decided AS (SELECT city, id, tag, verdict, CASE WHEN verdict = 'supported' THEN CASE WHEN id % 2 = 0 THEN 'police_category_stated' ELSE 'narrative_lead' END END AS basis FROM (
SELECT city, id, 'community_safety' AS tag, CASE WHEN quality = 1 THEN 'supported' ELSE 'no_support' END AS verdict FROM records WHERE seen UNION ALL SELECT city, id, 'hate_discrimination', CASE WHEN toxic = 1 THEN 'supported' WHEN id % 11 = 0 THEN 'uncertain' ELSE 'no_support' END FROM records WHERE seen UNION ALL SELECT city, id, 'racism', CASE WHEN id % 3 = 0 THEN 'supported' ELSE 'not_evaluated' END FROM records WHERE seen))"""


def records(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("source").alias("city"), F.col("doc_id").alias("id"))


def decided(spark, sf_dir):
    """Decisions on three tags from the labels; support of one facet does not ask for its parent's."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id")
    d = F.col("doc_id")
    verdicts = F.create_map(F.lit("community_safety"), F.when(F.col("quality") == 1, "supported").otherwise("no_support"), F.lit("hate_discrimination"), F.when(F.col("toxic") == 1, "supported").when(d % 11 == 0, "uncertain").otherwise("no_support"), F.lit("racism"), F.when(d % 3 == 0, "supported").otherwise("not_evaluated"))
    long = rows.select(F.col("source").alias("city"), d.alias("id"), F.explode(verdicts).alias("tag", "verdict"))
    i = F.col("id")
    return long.withColumn("basis", F.when(F.col("verdict") == "supported", pick(tagging.BASES, i))).withColumn("quotes", F.when(i % 4 != 0, F.array(F.lit("a quote of fair length"))).otherwise(F.array(F.lit("short")))).withColumn("checked", i % 5 != 0)


@query(f"""WITH {DECIDED_SQL}, n AS (SELECT city, count(*) AS records FROM records GROUP BY 1), tags AS (SELECT unnest(['community_safety', 'hate_discrimination', 'political_motivation', 'extremism_terrorism', 'domestic_partner_violence', 'gender_based_violence', 'organized_crime', 'trafficking_exploitation', 'anti_lgbt', 'racism', 'xenophobia', 'religious_bias']) AS tag),
c AS (SELECT n.city, tags.tag, records, count(*) FILTER (verdict = 'supported') AS supported, count(*) FILTER (verdict = 'no_support') AS no_support, count(*) FILTER (verdict = 'uncertain') AS uncertain, count(*) FILTER (basis = 'police_category_stated') AS stated, count(*) FILTER (basis = 'narrative_lead') AS lead FROM n CROSS JOIN tags LEFT JOIN decided d ON d.city = n.city AND d.tag = tags.tag GROUP BY ALL),
a AS (SELECT * FROM c UNION ALL SELECT 'all', tag, sum(records), sum(supported), sum(no_support), sum(uncertain), sum(stated), sum(lead) FROM c GROUP BY tag)
SELECT city, tag, records::BIGINT AS records, supported::BIGINT AS supported, no_support::BIGINT AS no_support, uncertain::BIGINT AS uncertain, (records - supported - no_support - uncertain)::BIGINT AS not_evaluated, stated::BIGINT AS police_category_stated, lead::BIGINT AS narrative_lead, 100.0::DOUBLE * supported / records AS index_pct, (supported + no_support + uncertain)::DOUBLE / records AS evaluated FROM a""")
def tag_statistics(spark, sf_dir):
    return tagging.statistics(records(spark, sf_dir), decided(spark, sf_dir))


@query(f"WITH {DECIDED_SQL}, n AS (SELECT tag, count_if(verdict = 'supported')::BIGINT AS c FROM decided WHERE city IS NOT NULL GROUP BY 1) SELECT tag, 'supported' AS figure, c + 1 AS total, c AS of_cities FROM n WHERE tag = 'racism'")
def tag_catalogue_faults(spark, sf_dir):
    """A catalogue whose total counts one record of a tag too many."""
    wrong = (F.col("city") == "all") & (F.col("tag") == "racism")
    s = tagging.statistics(records(spark, sf_dir), decided(spark, sf_dir))
    return tagging.catalogue_faults(s.withColumn("supported", F.col("supported") + F.when(wrong, 1).otherwise(0)))


@query(f"""WITH {DECIDED_SQL} SELECT problem, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN verdict <> 'not_evaluated' AND d.id % 5 = 0 THEN 'text is not checked' END, CASE WHEN verdict = 'supported' AND d.id % 4 = 0 THEN 'support without evidence' END,
CASE WHEN d.tag = 'racism' AND verdict = 'supported' AND coalesce(toxic, 0) <> 1 THEN 'facet without parent' END], lambda x: x IS NOT NULL)) AS problem FROM decided d JOIN records r ON r.id = d.id) GROUP BY 1""")
def tag_decision_faults(spark, sf_dir):
    return tagging.decision_faults(decided(spark, sf_dir)).select(F.explode("problems").alias("problem")).groupBy("problem").agg(F.count("*").alias("n"))


@query("""WITH p AS (SELECT doc_id AS id, CASE WHEN quality = 1 THEN 'supported' ELSE 'not_evaluated' END AS v FROM labels), s AS (SELECT doc_id AS id, CASE WHEN toxic = 1 THEN 'uncertain' WHEN doc_id % 2 = 0 THEN 'no_support' ELSE 'not_evaluated' END AS v FROM labels)
SELECT verdict, problem, count(*) AS n FROM (SELECT CASE WHEN p.v = 'supported' OR s.v = 'not_evaluated' OR id % 7 = 0 THEN p.v ELSE s.v END AS verdict, CASE WHEN s.v <> 'not_evaluated' AND id % 7 = 0 THEN 'other text' WHEN p.v = 'supported' AND s.v <> 'not_evaluated' THEN 'already evaluated' ELSE 'none' END AS problem FROM p JOIN s USING (id)) GROUP BY 1, 2""")
def merged_reviews(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select(F.lit("x").alias("city"), F.col("doc_id").alias("id"), F.lit("t").alias("tag"), "quality", "toxic")
    first = rows.select("city", "id", "tag", F.lit("a").alias("sha"), F.when(F.col("quality") == 1, "supported").otherwise("not_evaluated").alias("verdict"))
    second = rows.select("city", "id", "tag", F.when(F.col("id") % 7 == 0, "b").otherwise("a").alias("sha"), F.when(F.col("toxic") == 1, "uncertain").when(F.col("id") % 2 == 0, "no_support").otherwise("not_evaluated").alias("verdict"))
    return tagging.merged(first, second).groupBy("verdict", F.coalesce("problem", F.lit("none")).alias("problem")).agg(F.count("*").alias("n"))
