"""Outcomes of planted reports, told by hand: those that a gate ends, and those whose places are looked for."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gates
from ..scratch import spread
from .catalog import query, table

# title, first lines of the body, district; and, for the SQL alone, the outcome and the point
TOLD = (
    ("Einbruch", "Tatort: Ahrensburg, Schleswig-Holstein. Es fehlt Schmuck.", "", "outside_city_report", None),
    ("Einbruch", "Tatort: Ahrensburg, Schleswig-Holstein. Es fehlt Schmuck.", "Mitte", "unmatched", None),
    ("Verbundeinsatz im Hafen", "Es gab stationäre und mobile Verkehrskontrollen.", "Mitte", "multi_event_summary", None),
    ("Thementag Verkehr", "Bei Kontrollen überprüften Beamte viele Fahrzeuge. Ordnungswidrigkeiten wurden geahndet.", "Mitte", "multi_event_summary", None),
    ("Ergebnisse einer bundesweiten Verkehrssicherheitsaktion", "Bei Kontrollen gab es zwei Strafverfahren.", "Mitte", "multi_event_summary", None),
    ("Einladung zur Pressekonferenz", "Es wird gebeten, pünktlich zu sein.", "Mitte", "non_incident_report", None),
    ("Öffentlichkeitsfahndung nach Mann", "Es gibt keine Hinweise auf Straftaten.", "Mitte", "non_incident_report", None),
    ("Medizinischer Notfall: Mann verstirbt", "Es läuft ein Todesermittlungsverfahren.", "Mitte", "non_incident_report", None),
    ("Bilanz des Wochenendes", "Es blieb ruhig.", "Mitte", "multi_event_summary", None),
    ("Ein ruhiges Fest", "Die Polizei zieht eine positive Bilanz.", "Mitte", "multi_event_summary", None),
    ("Serie aufgeklärt", "Seit Wochen kam es wiederholt zu wiederholten Einbrüchen.", "Mitte", "multi_event_summary", None),
    ("Ware entdeckt", "Sie wurde an einer anderen Örtlichkeit umgepackt.", "Mitte", "multiple_locations_review", None),
    ("Mann verletzt", "Der Einsatzort war nicht der eigentlichen Tatort.", "Mitte", "reported_site_not_scene", None),
    ("Festnahme nach Flucht", "Zeit: 10:00 Uhr. Ort: Neuer Wall. Er wartete dort.", "Mitte", "operation_locations_only", None),
    ("Festnahme nach Flucht", "Zeit: 10:00 Uhr. Ort: Neuer Wall. Tatzeit: 9:00 Uhr. Am Neuer Wall wurde ein Mann geschlagen.", "Mitte", "street_representative", (1.0, 2.0)),
    ("Festnahme nach Tötungsdelikt", "Zeit: 9 Uhr. Ort: Hamburg-Rahlstedt, Stiller Wald. Im Stiller Wald, dort stach er zu.", "Rahlstedt", "unmatched", None),
    ("Festnahme nach Tötungsdelikt", "Zeit: 9 Uhr. Ort: Hamburg-Rahlstedt, Stiller Wald. Im Stiller Wald, dort stach er zu.", "Mitte", "operation_locations_only", None),
    ("Mord an Unbekanntem", "Feststellzeit: 7 Uhr. Eine tödlich verletzte Person wurde aufgefunden.", "Mitte", "discovery_only_scene_review", None),
    ("Zwei Überfälle", "Tatort: Neuer Wall. Tatort: Lange Reihe.", "Mitte", "multiple_official_scenes", None),
    ("Illegales Straßenrennen", "Sie fuhren weit.", "Mitte", "moving_scene_review", None),
    ("Illegales Straßenrennen", "Tatort: Neuer Wall. Am Neuer Wall wurde ein Mann geschlagen.", "Mitte", "street_representative", (1.0, 2.0)),
    ("Durchsuchungen am Morgen", "Orte: Neuer Wall und Lange Reihe.", "Mitte", "operation_locations_only", None),
    ("Durchsuchungen am Morgen", "Tatorte: Hamburg-Altona, Neuer Wall. Zunächst wird auf die Pressemitteilung verwiesen.", "Mitte", "followup_report", None),
    ("Überfälle am Morgen", "Tatorte: Neuer Wall und Lange Reihe.", "Mitte", "multiple_official_scenes", None),
    ("Angriff", "Am Neuer Wall wurde ein Mann geschlagen.", "Mitte", "street_representative", (1.0, 2.0)),
    ("Unfall", "An der Kreuzung Neuer Wall und Lange Reihe kam es zu einem Unfall.", "Mitte", "named_street_intersection", (7.0, 8.0)),
    ("Unfall", "An der Kreuzung Neuer Wall und Elbchaussee kam es zu einem Unfall.", "Mitte", "junction_geometry_review", None),
    ("Einbruch", "Im Alte Post wurde eingebrochen.", "Mitte", "named_place_representative", (9.0, 9.5)),
    ("Einbruch", "Im Alte Post und im Museum Hafen wurde eingebrochen.", "Mitte", "ambiguous_place_review", None),
    ("Sperrung", "Die Lange Reihe war gesperrt.", "Mitte", "only_nonincident_locations", None),
    ("Brand", "In Altona brannte es.", "Mitte", "district_only", None),
    ("Sturz", "Auf der Elbchaussee stürzte er.", "Mitte", "long_or_ambiguous_street_review", None),
    ("Markt", "Nichts davon.", "", "unmatched", None),
)
LIST = lambda i, f: "[" + ", ".join(f(x[i]) for x in TOLD) + f"][doc_id % {len(TOLD)} + 1]"
POINT = "struct<x:double,y:double>"


def planted(spark, sf_dir):
    said = F.element_at(F.array(*(F.struct(*(F.lit(x).alias(c) for x, c in zip(row[:3], ("title", "body", "district"), strict=True))) for row in TOLD)), (F.col("doc_id") % len(TOLD) + 1).cast("int"))
    rows = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumn("p", said)
    return rows.select(F.col("doc_id").alias("id"), "p.title", F.concat_ws("\n", "p.body", "text").alias("body"), "p.district")


def localities(spark):
    return spark.createDataFrame([("Altona", "10"), ("Rahlstedt", "10"), ("Mitte", "9")], "name string, admin_level string")


@query(f"SELECT doc_id AS id, {LIST(3, lambda v: repr(v))} AS method, {LIST(4, lambda v: 'NULL' if v is None else str(v[0]))}::DOUBLE AS x, {LIST(4, lambda v: 'NULL' if v is None else str(v[1]))}::DOUBLE AS y FROM documents")
def report_outcomes(spark, sf_dir):
    """Every document is the rest of a planted report: gates end some, and the others' names give streets, junctions, places and localities."""
    names = spark.createDataFrame([(k, k, kind) for k, kind in (("neuer wall", "street"), ("lange reihe", "street"), ("elbchaussee", "street"), ("alte post", "place"), ("museum hafen", "place"), ("altona", "locality"))], "key string, name string, kind string")
    roads = spark.createDataFrame([("neuer wall", 100.0, (1.0, 2.0)), ("lange reihe", 100.0, (3.0, 4.0)), ("elbchaussee", 9000.0, (5.0, 6.0))], f"key string, extent double, p {POINT}")
    junctions = spark.createDataFrame([("lange reihe", "neuer wall", (7.0, 8.0))], f"name_l string, name_r string, p {POINT}")
    places = spark.createDataFrame([("alte post", (9.0, 9.5)), ("museum hafen", (1.0, 1.0))], f"key string, p {POINT}")
    found = gates.located(planted(spark, sf_dir), localities(spark), names, roads, junctions, places)
    return found.select("id", "method", "point.x", "point.y")


@query(f"SELECT method, count(*) AS n FROM (SELECT {LIST(3, lambda v: repr(v) if v in ('outside_city_report', 'multi_event_summary', 'non_incident_report', 'multiple_locations_review', 'reported_site_not_scene', 'operation_locations_only', 'discovery_only_scene_review', 'multiple_official_scenes', 'moving_scene_review', 'followup_report') else chr(39) + 'goes on' + chr(39))} AS method FROM documents) GROUP BY 1")
def report_gates(spark, sf_dir):
    """How many reports each gate ends, and how many go on."""
    found = gates.gated(planted(spark, sf_dir), localities(spark))
    return found.groupBy(F.coalesce("method", F.lit("goes on")).alias("method")).agg(F.count("*").alias("n"))


@query("SELECT doc_id AS id, CASE doc_id % 5 WHEN 0 THEN 'Altona' WHEN 1 THEN 'Mitte' ELSE '' END AS district FROM documents")
def derived_districts(spark, sf_dir):
    """Districts of neighbourhood headings: known ones, given ones, ones that two localities share, roads behind the name, scenes that nobody knows."""
    i = F.col("doc_id")
    body = F.element_at(F.array(*map(F.lit, ("Tatort: Hamburg-Altona. Er floh.", "Tatort: Hamburg-Altona. Er floh.", "Tatort: Hamburg-Neuhof. Er floh.", "Tatort: Hamburg-Altona, Ring. Er floh.", "Tatort: Hamburg-Altona. Der Ort ist unklar."))), (i % 5 + 1).cast("int"))
    rows = table(spark, sf_dir, "documents").select(i.alias("id"), F.lit("Titel").alias("title"), F.concat_ws("\n", body, "text").alias("body"), F.when(i % 5 == 1, "Mitte").alias("district"))
    known = spark.createDataFrame([("Altona", "10"), ("NeuHof", "10"), ("Neuhof", "10"), ("Mitte", "9")], "name string, admin_level string")
    return gates.with_districts(rows, known).select("id", "district")
