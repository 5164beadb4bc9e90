"""Queries over records, reports and their texts. A user's events of a day are an announcement's scenes; a document's first line is its title."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import reports, shapes, text
from ..operators import ledgers, locating, roads
from ..scratch import spread, stored
from .catalog import POINTS_SQL, announcements, query, table


# Titles and bodies with the category that they have, told by hand; only the SQL reads the last two.
ROAD_SAID, NO_CLASS = "Verkehr / sonstige Meldung", "Unklassifiziert"
TOLD = (
    ("Raub auf Spätkauf", "", "Raub", True),
    ("Mann beim Einbruch gestellt", "", "Diebstahl", True),
    ("Radfahrerin bei Unfall verletzt", "", ROAD_SAID, False),
    ("Auto in Brand gesetzt", "", "Sachbeschädigung", True),
    ("Drogen im Park gefunden", "", "Betäubungsmittel", True),
    ("Betrüger am Telefon", "", "Betrug", True),
    ("Frau bedroht", "", "Bedrohung", True),
    ("Versammlung am Samstag", "", NO_CLASS, False),
    ("Sexuelle Belästigung im Zug", "", "Sexualdelikt", True),
    ("Verstoß gegen Waffengesetz", "", "Waffendelikt", True),
    ("Mehrere Autos brennen", "", NO_CLASS, False),
    ("Streit nach Trennen der Paare", "", NO_CLASS, False),
    ("Fährt Fußgänger an und flüchtet", "", ROAD_SAID, True),
    ("Bilanz der Maßnahmen zum Jahreswechsel", "", NO_CLASS, False),
    ("Gesprengter Geldausgabeautomat", "", "Eigentumsdelikt", True),
    ("Polizist bei Überprüfung eines Wagens mitgeschleift", "", "Gewalt", True),
    ("Erkenntnisse zum Zugunfall am Stadtrand", "", ROAD_SAID, False),
    ("Fahnder erkennen Kfz-Aufbrecher wieder", "", "Diebstahl", True),
    ("Durchsuchungen wegen gewerbsmäßigen Waffenhandels", "", "Waffendelikt", True),
    ("Zeugen gesucht nach Verkehrsunfallflucht", "", ROAD_SAID, True),
    ("Illegales Straßenrennen in der Innenstadt", "", ROAD_SAID, True),
    ("Verbotenes Kraftfahrzeugrennen", "", ROAD_SAID, True),
    ("Fahrt ohne Versicherungsschutz", "", ROAD_SAID, True),
    ("Fahren ohne Fahrerlaubnis", "", ROAD_SAID, True),
    ("Betrug bei Fahrerlaubnisprüfungen", "", "Betrug", True),
    ("Verdacht auf Verstoß gegen das Markengesetz", "", NO_CLASS, True),
    ("Aufruf nach möglicher Freiheitsberaubung", "", "Gewalt", True),
    ("Aufruf nach rassistischer Beleidigung", "", NO_CLASS, True),
    ("Aufruf nach tödlicher Auseinandersetzung", "", "Gewalt", True),
    ("Falscher Beamter entwendet Wertsachen", "Tatort: Musterstadt, Ring. Die Frau wurde in ihrer Wohnung beraubt.", "Raub", True),
    ("Aufruf nach Hasskriminalität", "Es geht um ein Körperverletzungsdelikt.", "Gewalt", True),
    ("Entwendete Waren gefunden", "Die Ermittlungen wegen des Verdachts der Hehlerei dauern an.", "Eigentumsdelikt", True),
    ("Fahndung nach einem Verkehrsunfall", "Es besteht der Verdacht der fahrlässigen Körperverletzung.", ROAD_SAID, True),
    ("Aufruf nach Auffinden eines Leichnams", "Die Mordkommission prüft den Fall.", NO_CLASS, True),
    ("Auffinden eines Leichnams am Ufer", "Die Ursache ist offen.", NO_CLASS, False),
    ("Aufruf nach Verkehrsunfall", "Der Fahrer hat sich unerlaubt vom Unfallort entfernt.", ROAD_SAID, True),
    ("Autofahrer gestoppt: Fahrzeug sichergestellt", "Der Pkw wurde ohne Versicherungsschutz gefahren.", ROAD_SAID, True),
    ("Schwerer Verkehrsunfall", "Der Fahrer ist nicht im Besitz einer gültigen Fahrerlaubnis.", ROAD_SAID, True),
    ("Aufruf nach zwei Fällen von Hasskriminalität", "Ein Mann bedrohte den anderen.", NO_CLASS, True),
    ("Festnahmen nach Plagiatsverkauf", "Ermittelt wird wegen des Verdachts des Betrugs.", "Betrug", True),
    ("Produkte sichergestellt", "Es geht um den Verdacht eines Verstoßes gegen das Markengesetz.", NO_CLASS, True),
    ("Metallspäne auf einer Radstrecke", "Räder wurden durch Metallspäne beschädigt.", "Sachbeschädigung", True),
    ("Vermögenswerte beschlagnahmt", "Sie hat sich mittels gefälschter Nachweise einen Kredit rechtswidrig verschafft.", "Betrug", True),
    ("Haftbefehle nach Durchsuchungen", "Sie stehen im Verdacht, mit Waffen gehandelt zu haben, gegen das Waffengesetz.", "Waffendelikt", True),
    ("Medizinischer Notfall nach Drogenkonsum: Mann verstirbt", "Es läuft ein Todesermittlungsverfahren.", NO_CLASS, False),
    ("Bilanz der Drogenerkennung im Straßenverkehr", "Bei der Kontrollaktion überprüften Beamte 200 Fahrzeuge. Strafverfahren folgten.", NO_CLASS, False),
    ("Tödlicher Bahnunfall", "Ein Verfahren wegen des Verdachts des gefährlichen Eingriffs in den Bahnverkehr läuft.", ROAD_SAID, True),
    ("Geldabholer festgenommen", "Er soll als Teil einer Betrügerbande versucht haben, Schmuck zu holen.", "Betrug", True),
    ("Schussabgabe auf Fenster eines Hauses", "Die Fenster wurden beschädigt. Dabei wurde niemand verletzt.", "Sachbeschädigung", True),
    ("Verdacht des illegalen Handels mit Cannabis", "Es geht um das Konsumcannabisgesetz (KCanG).", "Betäubungsmittel", True),
    ("Kriminalstatistik 2025", "Illegaler Handel mit Cannabis floriert weiterhin.", NO_CLASS, False),
    ("Fahrer flüchtet und verursacht einen Verkehrsunfall", "Es läuft ein Strafverfahren wegen des Verdachts mehrerer Verkehrsdelikte.", ROAD_SAID, True),
    ("Fahrer verstirbt im Straßenverkehr", "Es kam zu einem Auffahrunfall zwischen zwei Pkw.", ROAD_SAID, False),
    ("Verkehrssicherheitsbilanz 2025: weniger Menschen verletzt", "", NO_CLASS, False),
    ("Hasskriminalität im Internet - Wohnungen durchsucht", "Grund ist ein Ermittlungsverfahren wegen des Verdachts der Volksverhetzung.", NO_CLASS, True),
    ("Hasskriminalität im Internet - Hinweise", "Die Polizei gibt Hinweise zum Melden.", NO_CLASS, False),
    ("Chemikalien sichergestellt", "Er war nicht im Besitz einer sprengstoffrechtlichen Erlaubnis; selbstgefertigte pyrotechnische Sätze lagen da.", NO_CLASS, True),
    ("Hinweise zu Glücksspiel", "Es wurde ein Ermittlungsverfahren eingeleitet, auch wegen des Verdachts der Geldwäsche.", NO_CLASS, True),
    ("Aufruf nach Schüssen", "Die Ermittlungen zu der Sachbeschädigung führte der Dauerdienst.", "Sachbeschädigung", True),
    ("Eine Person bei Wohnungsbrand verletzt", "Das Feuer entstand aus noch ungeklärter Ursache.", NO_CLASS, False),
    ("Frühjahrstagung der Arbeitsgemeinschaft der Polizeipräsidenten: Bedrohungen", "", NO_CLASS, False),
    ("Ergebnisse einer bundesweiten Verkehrssicherheitsaktion", "Bei Kontrollen wurden 33 Strafverfahren wegen Trunkenheit im Straßenverkehr eingeleitet.", ROAD_SAID, True),
    ("Verbundeinsatz gegen Sozialleistungsbetrug", "Es gab stationäre und mobile Verkehrskontrollen.", NO_CLASS, False),
)


@query(f"""SELECT doc_id, ([{', '.join(f"'{x[2]}'" for x in TOLD)}])[doc_id % {len(TOLD)} + 1] AS label, ([{', '.join(str(x[3]).lower() for x in TOLD)}])[doc_id % {len(TOLD)} + 1] AS crime FROM documents""")
def report_categories(spark, sf_dir):
    """Each document is the body of a report, after a planted title and first line; none of the documents' own words is one of the rules'."""
    planted = F.element_at(F.array(*(F.struct(F.lit(t).alias("title"), F.lit(b).alias("body")) for t, b, *_ in TOLD)), (F.col("doc_id") % len(TOLD) + 1).cast("int"))
    said = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", planted.alias("p"), F.coalesce("text", F.lit("")).alias("text"))
    return said.select("doc_id", reports.category(F.col("p.title"), F.concat_ws("\n", "p.body", "text")).alias("c")).select("doc_id", "c.label", "c.crime")


@query(r"""WITH s AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(text, '(\b(?:St|Dr|Nr|bzw|ca|Str)|[0-9])\.(\s)', '\1' || chr(1) || '\2', 'g'), '([.!?])\s+', '\1' || chr(2), 'g'), chr(2)) AS parts FROM documents)
SELECT doc_id, len(list_filter(parts, lambda x: trim(x) <> '')) AS n FROM s""")
def sentence_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(text.sentences(F.col("text"))).cast("long").alias("n"))


def names(spark, sf_dir):
    """The first two and the first eight words of each benchmark text are names: of a street, a place or a locality."""
    w = F.split(F.lower(F.regexp_replace("text", r"[^\p{L}\s]", " ")), r"\s+")
    found = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("n"), F.explode(F.array(*(F.array_join(F.slice(w, 1, k), " ") for k in (2, 8)))).alias("key"))
    return found.groupBy("key").agg(F.min("n").alias("n")).select("key", F.col("key").alias("name"), F.element_at(F.array(*map(F.lit, ("street", "place", "locality"))), (F.col("n") % 3 + 1).cast("int")).alias("kind"), "n")


def reports_of(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")


@query()
def name_mentions(spark, sf_dir):
    """Mentions of a gazetteer's names in all sentences, with roles; tests hold the join against a scan of each text."""
    found = locating.with_roles(locating.mentions(locating.sentence_table(reports_of(spark, sf_dir)), locating.gazetteer(names(spark, sf_dir))))
    return found.groupBy("key", "kind", "role").agg(F.count("*").alias("n"), F.countDistinct("id").alias("reports"))


@query()
def located_reports(spark, sf_dir):
    """Every report's outcome and point; tests follow each outcome on planted reports."""
    n = names(spark, sf_dir)
    east, north = F.col("n") % 40 * 100.0, F.floor(F.col("n") / 40) * 100.0
    streets = n.filter("kind = 'street'")
    # a street runs east and north from its corner, so neighbours cross
    ends = ((east - 150.0, north, east + 150.0, north), (east, north - 150.0, east, north + 150.0))
    lines = streets.select("n", F.col("key").alias("name"), F.explode(F.array(*(F.struct(shapes.point(a, b).alias("a"), shapes.point(c, d).alias("b")) for a, b, c, d in ends))).alias("s")).select(F.xxhash64("n", "s").alias("id"), "name", "s.a", "s.b")
    found = roads.junctions(roads.crossings(stored(lines, "streets"))).filter("p is not null")
    p = shapes.point(east, north)
    return locating.located(reports_of(spark, sf_dir), n.select("key", "name", "kind"), streets.select("key", (F.col("n") * 20.0).alias("extent"), p.alias("p")), found, n.filter("kind = 'place'").select("key", p.alias("p")))


@query()
def spelling_suggestions(spark, sf_dir):
    """Long words of documents close to a word of the benchmark; tests hold it against all pairs."""
    words = lambda t: spread(table(spark, sf_dir, t)).select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("token")).filter("length(token) >= 10").distinct()
    known = words("benchmark")
    return locating.suggestions(words("documents").join(known, "token", "left_anti"), known.withColumnRenamed("token", "name"))


@query("""SELECT l_orderkey AS id, CASE WHEN count(DISTINCT l_shipdate) = 1 AND count(*) = count(l_shipdate) AND bool_and(l_returnflag <> 'R') THEN strftime(min(l_shipdate), '%Y-%m-%d') END AS event_date,
CASE WHEN count(DISTINCT l_shipdate) = 1 AND bool_and(l_returnflag <> 'R') THEN 'reviewed_incident_time' WHEN count(*) FILTER (l_returnflag <> 'R') > 0 THEN 'mixed_reviewed_event_times_publication_month_filter' ELSE 'event_time_unknown_publication_month_filter' END AS basis
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def time_basis(spark, sf_dir):
    day = F.when(F.col("l_returnflag") != "R", F.date_format("l_shipdate", "yyyy-MM-dd"))
    dates = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(F.struct(day.alias("d"))).alias("d"))  # an order has few items
    both = dates.join(table(spark, sf_dir, "orders"), "o_orderkey").select("o_orderkey", reports.time_basis(F.col("d.d"), F.col("o_orderdate")).alias("t"))
    return both.select(F.col("o_orderkey").alias("id"), "t.event_date", "t.basis")


SCENES_SQL = "scenes AS (SELECT user_id, ts::DATE AS day, event_id, value > 100 AS counts, event_type = 'error' AS ref, value < 5 AS vague FROM events), days AS (SELECT user_id, day, count(*) AS n_scenes, count_if(counts) AS n, bool_or(counts AND ref) AS ref, bool_or(counts AND vague) AS vague FROM scenes GROUP BY 1, 2)"


def announced(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    scene = F.struct("event_id", F.col("event_type").alias("label"), F.when(F.col("value") < 5, "district").otherwise("point").alias("precision"), (F.col("value") > 100).alias("primary"), F.when(F.col("event_type") == "error", "line_reference_only").alias("usage"), F.lit(13.0).alias("lon"), F.lit(52.0).alias("lat"))
    return e.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.sort_array(F.collect_list(scene)).alias("scenes")).withColumn("id", F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("day", "yyyyMMdd")))


@query(f"WITH {SCENES_SQL} SELECT CASE WHEN n > 1 THEN 'several count scenes' WHEN ref THEN 'reference as count scene' WHEN vague THEN 'no valid count point' WHEN n = 0 THEN 'without point' ELSE 'counted' END AS state, count(*) AS n, sum(n_scenes)::BIGINT AS scenes FROM days GROUP BY 1")
def count_points(spark, sf_dir):
    rows = announced(spark, sf_dir).withColumn("c", ledgers.count_point(F.col("scenes")))
    state = F.coalesce(F.col("c.problem"), F.when(F.col("c.scene").isNull(), "without point").otherwise("counted"))
    return rows.groupBy(state.alias("state")).agg(F.count("*").alias("n"), F.sum(F.size("scenes")).alias("scenes"))


@query(f"WITH {SCENES_SQL} SELECT CASE WHEN ref THEN 'reference' ELSE 'representative_point' END AS kind, counts AND NOT ref AS counted, count(*) AS n FROM scenes GROUP BY 1, 2")
def scene_parts(spark, sf_dir):
    return ledgers.scene_parts(announced(spark, sf_dir)).groupBy("kind", "counted").agg(F.count("*").alias("n"))


@query(f"WITH {POINTS_SQL} SELECT concat(floor(lon / 0.04)::BIGINT, '_', floor(lat / 0.025)::BIGINT) AS cell_id, count(*) AS n FROM points WHERE category = 'click' GROUP BY 1")
def filtered_cells(spark, sf_dir):
    a = announcements(spark, sf_dir)
    cell = F.concat_ws("_", F.floor(F.col("lon") / 0.04).cast("string"), F.floor(F.col("lat") / 0.025).cast("string"))
    # every third id lies on a border, and so in the next cell as well
    members = a.select("id", cell.alias("cell_id")).unionByName(a.filter("id % 3 = 0").select("id", F.concat(cell, F.lit("z")).alias("cell_id")))
    return ledgers.refiltered(members, a.filter("category = 'click'").select("id"))


@query("""WITH known AS (SELECT p_partkey AS place_id, p_partkey AS object_id FROM part UNION SELECT p_partkey, p_partkey + 1000000 FROM part WHERE p_partkey % 3 = 0), asked AS (SELECT DISTINCT l_orderkey AS id, l_partkey + CASE WHEN l_linenumber = 1 THEN 1000000 ELSE 0 END AS object_id FROM lineitem),
links AS (SELECT DISTINCT id, place_id FROM asked JOIN known USING (object_id)) SELECT place_id, count(*) AS n, CAST(round(least(0.78, 0.12 + 0.16 * log2(1 + count(*))), 6) AS DOUBLE) AS opacity FROM links GROUP BY 1""")
def named_links(spark, sf_dir):
    known = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("place_id"), F.when(F.col("p_partkey") % 3 == 0, F.array(F.col("p_partkey") + 1000000)).alias("aliases"))
    asked = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_set(F.col("l_partkey") + F.when(F.col("l_linenumber") == 1, 1000000).otherwise(0)).alias("object_ids"))
    return ledgers.links_by_name(asked, known).groupBy("place_id").agg(F.count("*").alias("n")).withColumn("opacity", F.round(ledgers.opacity(F.col("n")), 6))


ROWS_SQL = "rows_ AS (SELECT user_id AS id, event_type AS category, CASE WHEN user_id % 5 <> 0 THEN 'm' END AS month, CASE WHEN user_id % 3 = 0 THEN 'd' END AS event_date FROM events)"


def announcement_rows(spark, sf_dir):
    u = F.col("user_id")
    return table(spark, sf_dir, "events").select(u.alias("id"), F.col("event_type").alias("category"), F.when(u % 5 != 0, "m").alias("month"), F.when(u % 3 == 0, "d").alias("event_date"))


@query(f"WITH {ROWS_SQL}, per AS (SELECT id, count(DISTINCT category) AS v, count(*) - count(DISTINCT category) AS copies, min(category) AS category, min(month) AS month, min(event_date) AS event_date FROM rows_ GROUP BY id) SELECT count(*) AS announcements, sum(copies)::BIGINT AS duplicate_rows, count_if(v > 1)::BIGINT AS conflicts, count_if(category IN ('', 'Unklassifiziert'))::BIGINT AS unclassified, count_if(event_date IS NULL)::BIGINT AS without_date, count_if(month IS NULL)::BIGINT AS without_month, count_if(category IN ('', 'Unklassifiziert'))::DOUBLE / count(*) AS unclassified_share FROM per")
def announcement_statistics(spark, sf_dir):
    return ledgers.announcement_statistics(announcement_rows(spark, sf_dir))


@query(f"WITH {ROWS_SQL}, own AS (SELECT category, count(DISTINCT id) AS n FROM rows_ GROUP BY 1) SELECT category, n, n::DOUBLE / (SELECT sum(n) FROM own) AS share FROM own")
def category_shares(spark, sf_dir):
    return ledgers.category_shares(announcement_rows(spark, sf_dir))


@query("WITH i AS (SELECT source AS by_, 100.0::DOUBLE * sum(quality) / count(*) AS q, 100.0::DOUBLE * sum(toxic) / count(*) AS t FROM documents JOIN labels USING (doc_id) GROUP BY 1) SELECT by_ AS source, round((3 * q + t) / 4, 6) AS composite FROM i")
def composite_index(spark, sf_dir):
    each = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("by")).join(table(spark, sf_dir, "labels"), "doc_id").groupBy("by").agg(F.sum("quality").alias("q"), F.sum("toxic").alias("t"), F.count("*").alias("n"))
    long = each.select("by", F.explode(F.create_map(F.lit("quality"), F.col("q") * 100.0 / F.col("n"), F.lit("toxic"), F.col("t") * 100.0 / F.col("n"))).alias("tag", "index_pct"))
    return ledgers.composite(long, {"quality": 3.0, "toxic": 1.0}).select(F.col("by").alias("source"), F.round("composite", 6).alias("composite"))


@query("SELECT user_id AS id, count(*) AS failures, (floor(epoch(max(ts))) + least(86400, 300 * power(2, least(count(*) - 1, 8))))::BIGINT AS retry_after FROM (SELECT *, max(CASE WHEN event_type <> 'error' THEN (ts, event_id) END) OVER (PARTITION BY user_id) AS good FROM events) WHERE event_type = 'error' AND (good IS NULL OR (ts, event_id) > good) GROUP BY 1")
def failing_fetches(spark, sf_dir):
    from ..functions.dates import retry_seconds

    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "ts", "event_id", "event_type")
    return ledgers.failing(e, "id", ["ts", "event_id"], F.col("event_type") == "error", retry_seconds(F.col("failures")))


@query("WITH s AS (SELECT event_type AS archive, max(ts) - INTERVAL 2 DAY AS checked FROM events WHERE event_type <> 'click' GROUP BY 1 UNION ALL SELECT event_type, max(ts) FROM events WHERE event_type = 'click' GROUP BY 1) SELECT archive, count_if(ts > checked) = 0 AS is_complete, count_if(ts > checked)::BIGINT AS late FROM s JOIN events ON archive = event_type GROUP BY 1")
def archive_completeness(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("archive"), F.col("ts").alias("first_seen"))
    last = F.max("first_seen")
    scans = rows.groupBy("archive").agg(F.when(F.col("archive") == "click", last).otherwise(last - F.expr("interval 2 day")).alias("checked"))
    return ledgers.complete(scans, rows, "archive")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 OR c_custkey % 6 = 0 THEN c_mktsegment ELSE c_name END AS name FROM (SELECT *, CASE WHEN c_custkey % 4 = 0 THEN '' END AS blank FROM customer WHERE c_custkey % 5 <> 0 OR c_custkey % 6 <> 0)")
def listing_upsert(spark, sf_dir):
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").filter((k % 5 != 0) | (k % 6 != 0))
    old = c.select(k.alias("id"), F.when((k % 4 == 0) | (k % 6 == 0), F.col("c_mktsegment")).otherwise("old").alias("name"))
    new = c.filter(k % 6 != 0).select(k.alias("id"), F.when(k % 4 == 0, "  ").otherwise(F.col("c_name")).alias("name"))
    return ledgers.upserted(old, new, "id")


@query("SELECT CASE WHEN c_custkey % 3 = 0 THEN 'inserted' WHEN c_custkey % 5 = 0 THEN 'kept' WHEN c_custkey % 7 = 0 THEN 'changed' ELSE 'unchanged' END AS change, count(*) AS n FROM customer WHERE NOT (c_custkey % 3 = 0 AND c_custkey % 5 = 0) GROUP BY 1")
def decision_import(spark, sf_dir):
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(k, "c_name")
    new = c.filter(k % 5 != 0).select(k, F.when(k % 7 == 0, "x").otherwise(F.col("c_name")).alias("c_name"))
    return ledgers.imported(c.filter(k % 3 != 0), new, "c_custkey", "c_name").groupBy("change").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, 'added' AS side FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, 'stale' FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 7 = 0")
def delta_pack(spark, sf_dir):
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select(k, "c_name")
    return ledgers.delta(c.filter(k % 3 != 0), c.select(k, F.when(k % 7 == 0, "x").otherwise(F.col("c_name")).alias("c_name")), "c_custkey", "c_name")


@query("SELECT rule, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN NOT coalesce(c_acctbal >= 0, false) THEN 'balance' END, CASE WHEN c_nationkey NOT BETWEEN 0 AND 20 THEN 'nation' END, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'FURNITURE') THEN 'segment' END], lambda x: x IS NOT NULL)) AS rule FROM customer) GROUP BY 1")
def rule_violations(spark, sf_dir):
    rules = {"balance": F.col("c_acctbal") >= 0, "nation": F.col("c_nationkey").between(0, 20), "segment": F.col("c_mktsegment").isin("BUILDING", "FURNITURE")}
    return ledgers.violations(table(spark, sf_dir, "customer"), rules).select(F.explode("violations").alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


@query("SELECT l_suppkey AS supplier, any_value(s_nationkey * 100)::BIGINT AS declared, count(*) AS found, any_value(s_nationkey * 100) = count(*) AS holds FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1 UNION ALL SELECT s_suppkey, s_nationkey * 100, 0, s_nationkey = 0 FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem) UNION ALL SELECT l_suppkey, NULL, count(*), false FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1")
def declared_totals(spark, sf_dir):
    totals = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("supplier"), (F.col("s_nationkey") * 100).cast("long").alias("declared"))
    return ledgers.declared(totals, table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("supplier")), "supplier")


@query("WITH one AS (SELECT o_orderdate, min(o_orderkey) AS a FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 HAVING count(*) = 1) SELECT x.o_orderkey AS id, coalesce(y.o_orderkey, a, -1) AS report_id, CASE WHEN y.o_orderkey IS NOT NULL THEN 'url' WHEN a IS NOT NULL THEN 'article' ELSE 'unmatched' END AS basis FROM orders x LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') y ON y.o_orderkey = x.o_orderkey LEFT JOIN one ON one.o_orderdate = x.o_orderdate")
def audit_matches(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").cast("string").alias("url"), F.col("o_orderdate").cast("string").alias("article"), "o_orderstatus")
    return ledgers.matched(o.drop("o_orderstatus"), o.filter("o_orderstatus = 'F'").select(F.col("id").alias("report_id"), "url", "article")).withColumn("report_id", F.coalesce("report_id", F.lit(-1)))


@query("""SELECT event_id, path, value FROM (SELECT event_id, '/p/k' AS path, json_extract_string(props, '$.k') AS value FROM events UNION ALL SELECT event_id, '/n' || repeat('/x/0', (event_id % 13)::INT), event_id::VARCHAR FROM events
UNION ALL SELECT event_id, '/t/0', event_type FROM events UNION ALL SELECT event_id, '/t/1', NULL FROM events UNION ALL SELECT event_id, '/t/2', '{}' FROM events)""")
def json_leaves(spark, sf_dir):
    """Leaves of documents up to 28 levels deep."""
    e, d = F.col("event_id"), (F.col("event_id") % 13).cast("int")
    doc = F.concat(F.lit('{"p":'), "props", F.lit(',"n":'), F.repeat(F.lit('{"x":['), d), e, F.repeat(F.lit("]}"), d), F.lit(',"t":["'), "event_type", F.lit('",null,{}]}'))
    return ledgers.leaves(table(spark, sf_dir, "events").select("event_id", doc.alias("j")), "event_id", "j")


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'k' ELSE '' END AS unknown, 'z' AS missing FROM events")
def json_keys(spark, sf_dir):
    doc = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise('{"a":1}')
    found = table(spark, sf_dir, "events").select("event_id", ledgers.exact_keys(doc, ("z",), ("a",)).alias("k"))
    return found.select("event_id", F.array_join("k.unknown", ",").alias("unknown"), F.array_join("k.missing", ",").alias("missing"))


@query("SELECT o_orderkey AS id FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100")
def review_page(spark, sf_dir):
    return ledgers.page(table(spark, sf_dir, "orders"), F.desc("o_totalprice"), F.col("o_orderkey"), offset=100, size=50).select(F.col("o_orderkey").alias("id"))


@query("WITH RECURSIVE p AS (SELECT a.event_id AS id, b.event_id AS up FROM events a JOIN events b ON b.event_id = CAST(json_extract_string(a.props, '$.k') AS BIGINT) AND b.event_id < a.event_id), r AS (SELECT event_id AS id, event_id AS cur FROM events UNION ALL SELECT r.id, p.up FROM r JOIN p ON r.cur = p.id) SELECT id, min(cur) AS component FROM r GROUP BY id")
def occurrence_groups(spark, sf_dir):
    from ..operators import graph

    e = table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))
    found = graph.components(e.join(e.select(F.col("event_id").alias("k")), "k").filter("k < event_id").select(F.col("event_id").alias("a"), F.col("k").alias("b")))
    return e.select(F.col("event_id").alias("id")).join(found, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
