"""Reports that end before their places are looked for: ordered gates, the first that holds gives the outcome, and only the rest goes on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import reports
from ..functions.rules import FLAGS, AllOf, AnyOf, Rule, first_match
from ..functions.text import street_name
from ..scratch import stored
from . import locating

# What titles (normalized), bodies (normalized, and as they came: SAID) of such reports say.
NEIGHBOURHOOD = r"\b(?:tatort|unfallort):\s*hamburg-([\w-]+)\b(?!\s*[,/])"
UNLOCATED = r"\bnicht\b.{0,160}\beindeutigen lokalisierung des tatortes\b|\btatort(?:es)?\b.{0,100}\bnicht eindeutig lokalisiert\b|\beindeutig(?:e|en) lokalisierung(?: des tatortes)?\b.{0,100}\b(?:nicht möglich|unmöglich)\b|\bfundort\b.{0,80}\bnicht\b.{0,40}\beigentlichen tatort\b|\b(?:auffindeort|fundort)\b.{0,80}\b(?:eigentlichen )?tatort\b.{0,40}|\b(?:klären|unklar|fraglich)\b|\bklären\b.{0,140}\bauffindeort\b.{0,80}\btatort\b"
OUTSIDE = r"\b(?:tatort|unfallort|ort)\s*:\s*[^.;]{1,80},\s*(?:schleswig-holstein|brandenburg|niedersachsen)\b"
NON_INCIDENT = r"allgemeinverfügung|aktionstag|videoschutz|präventions|speedweek|gemeinsam für mehr sicherheit|stadtweite durchsuchungs|koordinierte internationale kontroll|vermisstenfahndung|einladung|kriminalstatistik|verkehrshinweis|pressekonferenz|fototermin|bilanz einer aktionswoche|verkehrssicherheitsbilanz|neue streifenboote|in hamburg ist man plietsch|sendehinweis|nordseegipfel|krimisalon|kriminalpolizeiliche beratung|alkoholkonsumverbotszone|verkehrssicherheitsaktion|sicher\.mobil\.leben|kinder-hit-tag|lange nacht der museen|erledigung der öffentlichkeitsfahndung|ehrenkommissar|jahresempfang|eingeschränkte erreichbarkeit der polizeipressestelle|verkehrssicherheitskampagne vorgestellt|gemeinsame eingangs-und bearbeitungsstelle|befragung zu sicherheit und kriminalität|informationstag der polizei|frühjahrstagung der arbeitsgemeinschaft der polizeipräsident|hinweise der polizei.{0,80}hafengeburtstag|taufe.{0,80}polizeiboot|schiffstaufe.{0,100}polizeiboot|peterwagen.{0,100}dauerhaft mit blaulicht|quattro-streife.{0,100}(?:sichtbarer|präsenter)|droneport.{0,100}(?:drohnentechnologie|connect)"
PUBLIC_SEARCH = r"öffentlichkeitsfahndung"
NO_OFFENCE = r"\bkeine hinweise auf straftaten\b"
SUMMARY_TITLE = r"bilanz"
SUMMARY_BODY = r"\b(?:polizei zieht|ziehen\b.{0,160}?)\s+(?:eine )?(?:positive )?bilanz\b"
SERIES = r"\b(?:seit|über)\b.{0,100}\b(?:mehrfach(?:e|en)|wiederholt(?:e|en))\b.{0,60}\b(?:diebstähl|einbrüch|taten|vorfällen)"
SEVERAL_SITES = r"\ban einer anderen örtlichkeit umgepackt\b|\bermittlungen zu den einzelnen eingeleiteten ermittlungsverfahren\b"
WITHDRAWN = r"\beinsatzort\b.{0,100}\bnicht\b.{0,60}\beigentlichen tatort\b"
OPERATION = r"\b(?:pfänd|beschlagnahm|durchsuch|vollstreck|verhaft|festnahm|festnahme|sicherstell)\w*\b"
TIME, SCENE_TIME, PLACE, SCENE = r"\bzeit\s*:", r"\b(?:tatzeit|unfallzeit)\s*:", r"\bort\s*:", r"\b(?:tatort|unfallort)\s*:"
KILLING = r"\btötungsdelikt\b"
WOODLAND_SAID = r"\bOrt:\s*Hamburg-([^,;]+),\s*([A-ZÄÖÜ][\wÄÖÜäöüß-]*\s+Wald)\b"
STABBED_THERE = r"\b.{0,50}\bdort stach\b"
IN_THE_WOODS = r"\bzur tatzeit\b.{0,80}\bin dem wald\b.{0,200}\bauf ihr opfer eingewirkt\b"
DISCOVERY = r"\bfeststellzeit\s*:.*?\b(?:tödlich verletzte|leblose)\w*\b.{0,180}\baufgefunden\b"
KILLING_OR_MURDER = r"\b(?:tötungsdelikt|mord)\b"
HEADING_SAID = r"\b(?:tatort|unfallort|ort)\s*:"
RACE = r"kraftfahrzeugrennen|straßenrennen|strassenrennen"
SCENE_SAID = r"\b(?:tatort|unfallort)\s*:"
HEADINGS_SAID = r"\b(?:tatorte|unfallorte|orte)\s*:"
PLACES_SAID, SCENES_SAID = r"\borte\s*:", r"\b(?:tatorte|unfallorte)\s*:"
EARLIER_RELEASE = r"\bzunächst wird auf die pressemitteilung\b"
ONE_QUARTER = r"\bhamburg-[^,;]+,"


def twice(pattern: str) -> str:
    return f"(?:{pattern})(?s:.*)(?:{pattern})"


def rule(method: str, *has, lacks: tuple = ()) -> Rule:
    return Rule(method, has, lacks)


t, b, said, lead = (lambda p, c=c: (c, reports.LINE + p) for c in ("title", "body", "said", "lead"))
DEATH = AllOf((t(reports.MEDICAL_DEATH_PLAIN), b(reports.DEATH_INQUIRY_PLAIN)))
TOTALS = AnyOf(
    (
        AllOf((t(reports.JOINT_OPERATION_PLAIN), b(reports.JOINT_CONTROLS_PLAIN))),
        AllOf((t(reports.TOTALS_PLAIN), t(reports.TOTALS_TOPIC_PLAIN), b(reports.CONTROLS_PLAIN), b(reports.CHECKED_PLAIN), b(reports.OFFENCES_PLAIN))),
        AllOf((t(reports.SAFETY_RESULTS_PLAIN), b(reports.SAFETY_CONTROLS_PLAIN), b(reports.OFFENCES_PLAIN))),
    )
)
SEVERAL = said(HEADINGS_SAID)
GATES: tuple[Rule, ...] = (
    rule("outside_city_report", b(OUTSIDE), lacks=(("district", "."),)),
    rule("multi_event_summary", TOTALS),
    rule("non_incident_report", AnyOf((t(NON_INCIDENT), AllOf((t(PUBLIC_SEARCH), b(NO_OFFENCE))), DEATH))),
    rule("multi_event_summary", AnyOf((t(SUMMARY_TITLE), b(SUMMARY_BODY), b(SERIES)))),
    rule("multiple_locations_review", b(SEVERAL_SITES)),
    rule("reported_site_not_scene", b(WITHDRAWN)),
    rule("operation_locations_only", t(OPERATION), b(TIME), b(PLACE), lacks=(b(SCENE_TIME), b(SCENE), ("woodland", "."))),
    rule("discovery_only_scene_review", b(DISCOVERY), t(KILLING_OR_MURDER)),
    rule("multiple_official_scenes", said(twice(HEADING_SAID))),
    rule("moving_scene_review", t(RACE), lacks=(said(SCENE_SAID),)),
    rule("operation_locations_only", SEVERAL, said(PLACES_SAID), t(OPERATION), lacks=(said(SCENES_SAID),)),
    rule("followup_report", SEVERAL, t(OPERATION), b(EARLIER_RELEASE), lead(ONE_QUARTER), lacks=(lead(twice(ONE_QUARTER)),)),
    rule("multiple_official_scenes", SEVERAL),
)


def woodland(title: Column, body: Column, said: Column, district: Column) -> Column:
    """The wood of a killing that a report names with its own district and says to be the scene, else an empty text. title and body are normalized."""
    heading = lambda k: F.regexp_extract(said, "(?iU)" + WOODLAND_SAID, k)
    there = F.rlike(body, F.concat(F.lit(FLAGS + r"\bim \Q"), street_name(heading(2)), F.lit(r"\E" + STABBED_THERE)))
    same = (heading(2) != "") & (district != "") & (street_name(heading(1)) == street_name(district))
    return F.when(same & title.rlike(FLAGS + KILLING) & (there | body.rlike(FLAGS + IN_THE_WOODS)), heading(2)).otherwise("")


def with_districts(rows: DataFrame, localities: DataFrame) -> DataFrame:
    """Reports (id, title, body, district) with normalized texts as _title and _body; an empty district is that of a neighbourhood heading, if just one
    locality (name, admin_level) of level 10 has its name and the report does not say that the scene is unknown."""
    plain = rows.withColumn("_title", street_name(F.coalesce("title", F.lit("")))).withColumn("_body", street_name(F.coalesce("body", F.lit("")))).withColumn("district", F.coalesce("district", F.lit("")))
    asked = F.when((F.col("district") == "") & ~F.col("_body").rlike(FLAGS + UNLOCATED), F.regexp_extract("_body", FLAGS + NEIGHBOURHOOD, 1))
    known = localities.filter("admin_level = '10'").select("name", street_name(F.col("name")).alias("_quarter")).groupBy("_quarter").agg(F.count_distinct("name").alias("_n"), F.min("name").alias("_name")).filter("_n = 1").drop("_n")
    return plain.withColumn("_quarter", asked).join(known, "_quarter", "left").withColumn("district", F.coalesce("_name", "district")).drop("_quarter", "_name")


def gated(rows: DataFrame, localities: DataFrame) -> DataFrame:
    """Reports (id, title, body, district) with district as with_districts() has it and method, null for those that no gate ends."""
    plain = with_districts(rows, localities)
    forms = {"title": F.col("_title"), "body": F.col("_body"), "said": F.coalesce("body", F.lit("")), "district": F.col("district"), "lead": F.element_at(F.split("_body", "zunächst"), 1)}
    forms["woodland"] = woodland(forms["title"], forms["body"], forms["said"], forms["district"])
    method = F.transform(F.array(F.struct(*(c.alias(n) for n, c in forms.items()))), lambda r: first_match(GATES, {n: r[n] for n in forms}, ""))[0]
    return plain.select(*rows.columns, F.nullif(method, F.lit("")).alias("method"))


def located(rows: DataFrame, localities: DataFrame, names: DataFrame, roads: DataFrame, junctions: DataFrame, places: DataFrame) -> DataFrame:
    """One row per report (id, title, body, district): id, method, point. Names are looked for only in the reports that pass all gates."""
    found = stored(gated(rows.select("id", "title", "body", "district"), localities), "gated")
    rest = locating.located(found.filter("method is null").select("id", F.col("body").alias("text")), names, roads, junctions, places)
    none = F.lit(None).cast(rest.schema["point"].dataType)
    return found.filter("method is not null").select("id", "method", none.alias("point")).unionByName(rest)
