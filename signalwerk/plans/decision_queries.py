"""Decisions, ledgers and what they join. Decisions follow from the numbers of rows, right and wrong ones, so the SQL can tell what comes out."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import nested
from ..functions.text import content_hash
from ..operators import decisions
from .catalog import query, table
from .function_queries import pick

BODY = "Es geschah gegen Mitternacht in der Gasse am Fluss."
QUOTE = "gegen Mitternacht in der Gasse"


def scene(n):
    """A scene with faults by its number."""
    return F.struct(n.alias("n"), F.when(n % 7 == 0, "guess").otherwise("incident").alias("role"), F.when(n % 5 == 0, None).otherwise("point").alias("precision"), F.lit("independent_case").alias("relation"), F.when(n % 3 == 0, "Gasse").otherwise(QUOTE).alias("quote"), F.when(n % 4 != 1, 13.4).alias("lon"), F.when(n % 4 == 2, 91.0).when(n % 4 != 1, 52.5).alias("lat"), (n % 2 == 1).alias("primary"))


def decided_scenes(spark, sf_dir):
    own = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.sort_array(F.collect_list(scene(F.col("l_partkey")))).alias("scenes"))  # an order has few items
    return own.select("id", F.lit("a").alias("sha"), F.when(F.col("id") % 9 == 0, "b").otherwise("a").alias("source_sha"), F.lit(BODY).alias("body"), "scenes")


@query("""WITH s AS (SELECT l_orderkey AS id, l_partkey AS n FROM lineitem), p AS (SELECT id, n, unnest(list_filter([CASE WHEN n % 7 = 0 THEN 'role' END, CASE WHEN n % 5 = 0 THEN 'precision' END, CASE WHEN n % 3 = 0 THEN 'quote' END, CASE WHEN n % 4 = 2 THEN 'place' END, CASE WHEN n % 4 = 1 AND n % 2 = 1 THEN 'primary without place' END], lambda x: x IS NOT NULL)) AS p FROM s
UNION ALL SELECT id, 0, 'several primary scenes' FROM s GROUP BY id HAVING sum(n % 2) > 1 UNION ALL SELECT DISTINCT id, 0, 'stale' FROM s WHERE id % 9 = 0) SELECT id, string_agg(DISTINCT p, ',' ORDER BY p) AS problems FROM p GROUP BY id""")
def scene_decision_problems(spark, sf_dir):
    return decisions.scene_decisions(decided_scenes(spark, sf_dir)).filter(F.size("problems") > 0).select("id", F.array_join("problems", ",").alias("problems"))


@query("""SELECT event_id AS id, concat_ws(',', CASE WHEN event_id % 5 = 0 THEN 'kind' END, CASE WHEN event_id % 4 = 3 THEN 'scope' END, CASE WHEN event_id % 4 = 1 AND event_id % 3 <> 0 THEN 'radius' WHEN event_id % 4 <> 1 AND event_id % 3 = 0 THEN 'radius' END, CASE WHEN event_id % 2 = 0 THEN 'quote' END) AS context, concat_ws(',', CASE WHEN event_id % 7 = 6 THEN 'mode' END, CASE WHEN event_id % 3 = 2 THEN 'extent' END, CASE WHEN event_id % 6 = 0 THEN 'line' END) AS transit FROM events""")
def context_decision_problems(spark, sf_dir):
    context = decisions.context_problems(F.when(F.col("event_id") % 5 == 0, "Bar!").otherwise("bar"), pick((*decisions.CONTEXT_SCOPES, "around"), F.col("event_id")), F.when(F.col("event_id") % 3 == 0, 50.0), F.when(F.col("event_id") % 2 == 1, QUOTE), F.lit(BODY))
    transit = decisions.transit_problems(pick((*decisions.TRANSIT_MODES, None), F.col("event_id")), pick((*decisions.TRANSIT_EXTENTS, "half"), F.col("event_id")), F.when(F.col("event_id") % 6 == 0, " ").otherwise("M1"))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.array_join(context, ",").alias("context"), F.array_join(transit, ",").alias("transit"))


@query("""WITH s AS (SELECT l_orderkey AS id, arg_min(l_partkey, l_partkey) FILTER (l_partkey % 2 = 1) AS p FROM lineitem GROUP BY 1) SELECT o_orderkey AS id, CASE WHEN s.id IS NULL OR o_orderkey % 9 = 0 THEN 1.0 WHEN p IS NULL OR p % 4 = 1 THEN -1.0 ELSE 13.4 END::DOUBLE AS lon, CASE WHEN s.id IS NULL OR o_orderkey % 9 = 0 THEN 'street' WHEN p IS NULL OR p % 5 = 0 THEN 'unknown' ELSE 'point' END AS precision FROM orders LEFT JOIN s ON s.id = o_orderkey""")
def attached_scenes(spark, sf_dir):
    """Events take the place of their primary scene; those that changed since, or have no decision, keep their own."""
    events = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 9 == 0, "b").otherwise("a").alias("sha"), F.lit(1.0).alias("lon"), F.lit(2.0).alias("lat"), F.lit("street").alias("precision"))
    found = decisions.attached(events, decided_scenes(spark, sf_dir))
    return found.select("id", F.coalesce("lon", F.lit(-1.0)).alias("lon"), "precision")


@query("SELECT doc_id AS id, CASE WHEN doc_id % 4 = 0 OR doc_id % 5 = 0 OR length(text) < 20 THEN 'deferred' WHEN doc_id % 2 = 0 THEN 'in_city' ELSE 'out_of_city' END AS scope FROM documents WHERE text IS NOT NULL AND length(text) >= 20")
def municipal_scopes(spark, sf_dir):
    """Verdicts on another text or with a quote that nobody wrote count for nothing."""
    docs = table(spark, sf_dir, "documents").filter("text is not null and length(text) >= 20").select(F.col("doc_id").alias("id"), F.lit("a").alias("sha"), F.col("text").alias("body"))
    i = F.col("id")
    made = docs.select("id", F.when(i % 4 == 0, "b").otherwise("a").alias("sha"), F.when(i % 2 == 0, "in_city").otherwise("out_of_city").alias("verdict"), F.when(i % 5 == 0, "\u0001no").otherwise(F.substring("body", 3, 10)).alias("quote"))
    return decisions.scoped(docs, made).select("id", "scope")


@query("SELECT p_partkey AS id, (['Stadt', 'Land', 'Anderswo', ''])[p_partkey % 4 + 1] AS locality, (['city_candidate', 'outside', 'unverified', 'unverified'])[p_partkey % 4 + 1] AS scope FROM part")
def item_scopes(spark, sf_dir):
    title = F.concat("p_name", pick((" – Stadt", " – Land. ", " - Anderswo", ""), F.col("p_partkey")))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), decisions.item_scope(title, ("Stadt",), ("Land",)).alias("s")).select("id", "s.locality", "s.scope")


@query("SELECT o_orderkey AS id, concat_ws(',', CASE WHEN o_orderkey % 5 = 0 THEN 'protocol' END, CASE WHEN o_orderkey % 3 = 0 THEN 'host' END, CASE WHEN o_orderkey % 4 = 0 THEN 'identity' END, CASE WHEN o_orderkey % 7 = 0 THEN 'published after the check' END) AS problems FROM orders")
def source_identities(spark, sf_dir):
    url = F.concat(F.when(F.col("o_orderkey") % 5 == 0, "http").otherwise("https"), F.lit("://"), F.when(F.col("o_orderkey") % 3 == 0, "y.example").otherwise("x.example"), F.lit("/pm/"), F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderkey") + 1).otherwise(F.col("o_orderkey")))
    day = F.col("o_orderdate").cast("timestamp")
    found = decisions.source_problems(url, F.col("o_orderkey").cast("string"), "x.example", r"/pm/(\d+)$", F.when(F.col("o_orderkey") % 7 == 0, day + F.expr("interval 1 day")).otherwise(day), day)
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.array_join(found, ",").alias("problems"))


@query("SELECT 'geometry' AS ledger, doc_id::VARCHAR AS key, 'missing' AS fault FROM documents WHERE doc_id % 10 = 0 UNION ALL SELECT 'map', doc_id::VARCHAR, 'missing' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'map', (-doc_id - 1)::VARCHAR, 'unknown' FROM labels WHERE doc_id % 50 = 0")
def ledger_coverage(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id")), table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    extra = labels.filter("id % 50 = 0").select((-F.col("id") - 1).alias("id"))
    return decisions.covered(docs, {"geometry": docs.filter("id % 10 <> 0"), "map": labels.unionByName(extra)})


@query("SELECT p_partkey AS location_id, count(DISTINCT l_orderkey) AS n, coalesce(min(l_orderkey), -1) AS first_id FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY 1")
def incident_members(spark, sf_dir):
    incidents = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("incident_id")).agg(F.collect_list("l_partkey").alias("location_ids"))  # an order has few items
    found = decisions.members(incidents, table(spark, sf_dir, "part").select(F.col("p_partkey").alias("location_id")))
    return found.select("location_id", "n", F.coalesce(F.get("incident_ids", F.lit(0)), F.lit(-1)).alias("first_id"))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 5 = 0 THEN 'both' WHEN o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0 THEN 'neither' END AS problem FROM orders")
def report_units(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return decisions.with_units(o, o.filter("id % 3 = 0").withColumn("unit", F.lit("u")), o.filter("id % 5 = 0").withColumn("proof", F.lit("p"))).select("id", "problem")


@query("SELECT p_partkey AS feature_id, 'x:' || l_orderkey AS event_id FROM part JOIN (SELECT DISTINCT l_orderkey FROM lineitem) ON l_orderkey = p_partkey")
def event_references(spark, sf_dir):
    """Features of events that are loaded; even events tell their source, odd ones by their id."""
    events = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey")).distinct().select(F.concat(F.lit("x:"), F.col("l_orderkey")).alias("id"), F.when(F.col("l_orderkey") % 2 == 0, F.col("l_orderkey").cast("string")).alias("source_id"))
    features = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("source_id"), F.col("p_partkey").alias("feature_id"))
    return decisions.references(events, features).select("feature_id", "event_id")


@query("SELECT p_partkey AS place_id, p_partkey % 3 <> 0 AS applied, CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS brand, p_name AS name FROM part")
def native_metadata(spark, sf_dir):
    """Tags of the same object with the same digest come along, and never replace one."""
    rows = table(spark, sf_dir, "part")
    places = rows.select(F.col("p_partkey").alias("place_id"), F.lit("d").alias("digest"), F.create_map(F.lit("name"), F.col("p_name")).alias("tags"))
    more = rows.select(F.col("p_partkey").alias("place_id"), F.when(F.col("p_partkey") % 3 == 0, "e").otherwise("d").alias("digest"), F.create_map(F.lit("name"), F.lit("other"), F.lit("brand"), F.col("p_brand")).alias("tags"))
    found = decisions.enriched(places, more)
    return found.select("place_id", "applied", F.col("tags")["brand"].alias("brand"), F.col("tags")["name"].alias("name"))


@query("SELECT o_orderkey AS context_id, CASE WHEN o_orderkey % 2 = 0 THEN 'r' || o_orderkey ELSE 'f' END AS places, CASE WHEN o_orderkey % 6 = 0 THEN 'reviewed twice' END AS problem FROM orders")
def reviewed_identities(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    contexts = o.select(F.col("o_orderkey").alias("context_id"), F.array(F.lit("f")).alias("place_ids"))
    made = o.filter(F.col("o_orderkey") % 2 == 0).select(F.col("o_orderkey").alias("context_id"), F.array(F.concat(F.lit("r"), F.col("o_orderkey"))).alias("place_ids"), F.lit(1).alias("reviewed"))
    again = o.filter(F.col("o_orderkey") % 6 == 0).select(F.col("o_orderkey").alias("context_id"), F.array(F.lit("later")).alias("place_ids"), F.lit(2).alias("reviewed"))
    found = decisions.identified(contexts, made.unionByName(again))
    return found.select("context_id", F.array_join("place_ids", ",").alias("places"), "problem")


@query("WITH v AS (SELECT d.doc_id, CASE WHEN l.doc_id IS NULL OR d.doc_id % 7 = 0 THEN 'pending' WHEN quality = 1 THEN 'accepted' ELSE 'rejected' END AS verdict FROM documents d LEFT JOIN labels l USING (doc_id)) SELECT verdict, count(*) AS n FROM v GROUP BY 1 UNION ALL SELECT 'total', count(*) FROM v")
def verdict_totals(spark, sf_dir):
    """Verdicts on five keys, two of which are hashes; what does not match in all of them is pending."""
    keys = ("city", "id", "source_sha", "extraction_sha", "version")
    row = lambda v: (F.lit("x").alias("city"), F.col("doc_id").alias("id"), F.sha2(F.col("doc_id").cast("string"), 256).alias("source_sha"), F.when(F.col("doc_id") % 7 == 0, v).otherwise("same").alias("extraction_sha"), F.lit(1).alias("version"))
    records = table(spark, sf_dir, "documents").select(*row("new"))
    made = table(spark, sf_dir, "labels").select(*row("old"), F.when(F.col("quality") == 1, "accepted").otherwise("rejected").alias("verdict"))
    return decisions.verdicts(records, made, keys)


@query("SELECT count(DISTINCT l_orderkey) AS articles, count(*) AS incidents, sum(l_linenumber % 3)::BIGINT AS locations, (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING sum(l_linenumber % 3) > 0)) AS tasks FROM lineitem")
def inventory_counts(spark, sf_dir):
    n = F.col("l_linenumber") % 3
    incident = F.struct(F.when(n == 0, F.array().cast("array<string>")).when(n == 1, F.array(F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b"))).alias("locations"))
    return decisions.inventory_totals(table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_list(incident).alias("incidents")))  # an order has few items


@query("SELECT sha256(concat_ws(chr(31), o_custkey, o_orderstatus)) AS fingerprint, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def repeated_decisions(spark, sf_dir):
    return decisions.repeated(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus")


@query("SELECT p_partkey AS object_id FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_linenumber = 1)")
def unresolved_objects(spark, sf_dir):
    protected = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("object_id"))
    return decisions.unresolved(protected, table(spark, sf_dir, "lineitem").filter("l_linenumber = 1").select(F.col("l_partkey").alias("object_id")), "object_id")


@query("WITH a AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_linenumber <= 2), b AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) SELECT b.l_orderkey AS event_id, b.l_partkey AS place_id, CASE WHEN a.l_orderkey IS NULL THEN 'street' ELSE 'geometry' END AS basis, CASE WHEN a.l_orderkey IS NULL THEN 1 ELSE 0 END AS source FROM b LEFT JOIN a USING (l_orderkey, l_partkey)")
def united_links(spark, sf_dir):
    """Links by geometry, then those by street for pairs that have none."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    pair = lambda rows, basis: rows.select(F.col("l_orderkey").alias("event_id"), F.col("l_partkey").alias("place_id")).distinct().withColumn("basis", F.lit(basis))
    return decisions.united((pair(l.filter("l_linenumber <= 2"), "geometry"), pair(l, "street")), ["event_id", "place_id"])


@query("""SELECT event_id AS id, '{"a":' || repeat('{"a":', (event_id % 13)::INT) || CASE WHEN event_id % 2 = 0 THEN user_id::VARCHAR ELSE '"' || user_id || '"' END || repeat(',"z":[0.123457,true,null]}', (event_id % 13)::INT) || ',"k":"' || event_type || '"}' AS canonical,
sha256('{"a":' || repeat('{"a":', (event_id % 13)::INT) || CASE WHEN event_id % 2 = 0 THEN user_id::VARCHAR ELSE '"' || user_id || '"' END || repeat(',"z":[0.123457,true,null]}', (event_id % 13)::INT) || ',"k":"' || event_type || '"}') AS digest,
CASE event_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 5 END AS n FROM events""")
def json_values(spark, sf_dir):
    """One form of objects up to 13 deep whose keys come in any order, with fractions rounded and geometries dropped, and its digest; the positions of geometries of four depths."""
    e = F.col("event_id")
    d, u = (e % 13).cast("int"), F.when(e % 2 == 0, F.col("user_id").cast("string")).otherwise(F.concat(F.lit('"'), F.col("user_id"), F.lit('"')))
    begin, end = F.when(e % 3 == 0, '{ "z": [0.12345678, true,null], "a":').otherwise('{"a" :'), F.when(e % 3 == 0, "}").otherwise(',"location_geometry":{"a":[1]},"z":[0.12345678,true, null]}')
    doc = F.concat(F.lit('{"k":"'), F.col("event_type"), F.lit('","a": '), F.repeat(begin, d), u, F.repeat(end, d), F.lit(',"location_geometry":1}'))
    shape = pick(("[1,2]", "[[1,2],[3,4]]", "[[[1,2],[3,4],[5,6],[1,2]]]", "[[[[1,2],[3,4]]], [[[5,6],[7,8],[9,1]]]]"), e)
    found = table(spark, sf_dir, "events").select(e.alias("id"), nested.canonical(doc, 6, ("location_geometry",)).alias("canonical"), F.size(decisions.positions(shape)).alias("n"))
    return found.withColumn("digest", content_hash(F.col("canonical")))


@query("SELECT l_orderkey AS id, arg_max(l_partkey, (l_quantity, -l_partkey)) AS part_id, max(l_quantity) AS size FROM lineitem GROUP BY 1")
def largest_parts(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("part_id"), F.col("l_quantity").alias("size"))
    return decisions.largest(rows, "id", "size", "part_id")


@query("SELECT conv_id AS id, turn AS sentence_no, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS previous FROM conversations")
def previous_sentences(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("id"), F.col("turn").alias("sentence_no"), F.col("text").alias("sentence"))
    return decisions.neighbours(rows).select("id", "sentence_no", "previous")
