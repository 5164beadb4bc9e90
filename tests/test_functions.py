import datetime

from pyspark.sql import functions as F

from signalwerk.functions import dates, geo, text
from signalwerk.operators import places, versions
from signalwerk.plans import publish
from signalwerk.scratch import folder
from signalwerk.sources import listing


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_projection_and_cell(spark):
    e, n = geo.utm_sql("13.4", "52.5", 33)
    r = one(spark, F.expr(e), F.expr(n))
    assert abs(r[0] - 391358.0) < 500 and abs(r[1] - 5817910.0) < 1000
    c = one(spark, geo.hex_cell(F.lit(0.0), F.lit(0.0), F.lit(275.0)))
    assert c[0] == "275:0:0"


def test_tiles_of_a_box(spark):
    keys = one(spark, geo.tile_keys(F.lit(13.40), F.lit(52.50), F.lit(13.41), F.lit(52.51)))[0]
    assert keys == ["335_2100"]


def test_dates(spark):
    r = one(spark, dates.german_day(F.lit("Montag, 3. März 2026")), dates.german_day(F.lit("3. Foo 2026")), dates.retry_seconds(F.lit(1)), dates.retry_seconds(F.lit(30)), dates.archive_timestamp(F.lit("01.02.2026 10:30")))
    assert r[0] == datetime.date(2026, 3, 3) and r[1] is None and r[2] == 300 and r[3] == 76800 and r[4].hour == 10
    clear = lambda t: dates.local_is_clear(F.lit(t).cast("timestamp"), "Europe/Berlin")
    assert list(one(spark, clear("2026-03-29 02:30:00"), clear("2026-10-25 02:30:00"), clear("2026-06-01 12:00:00"))) == [False, False, True]


def test_text(spark):
    r = one(spark, text.street_name(F.lit("Große  Str. - S- und U-Bahnhofs")), text.sentences(F.lit("Am 3. März kam Dr. Weiß. Er ging. Ende!")), text.mentions(F.lit("Vor der Kneipe am Bahnhof laden sie ein.")), text.filled(F.lit("{a} und {b}"), F.create_map(F.lit("a"), F.lit("x"), F.lit("b"), F.lit("y"))))
    assert r[0] == "grosse str.-s+u-bahnhof" and one(spark, text.street_name(F.lit("Hauptstr.  5")))[0] == "hauptstrasse 5"
    assert r[1] == ["Am 3. März kam Dr. Weiß.", "Er ging.", "Ende!"]
    assert r[2] == ["bar", "station"]
    assert r[3] == "x und y"
    q = lambda *x: text.quotes_hold(F.array(*map(F.lit, x)), F.lit("Der Mann lief über die Straße davon."))
    assert list(one(spark, q("Der Mann lief über"), q("kurz"), q("Der Mann lief über", "Der Mann lief über"))) == [True, False, False]
    assert one(spark, text.nfkc(F.lit("ﬁX")))[0] == "fix"


def test_ring(spark):
    ring = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0))))
    assert list(one(spark, places.inside(F.lit(1.0), F.lit(1.0), ring), places.inside(F.lit(5.0), F.lit(1.0), ring))) == [True, False]


def test_revisions(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, "b", 3), (1, "a", 4), (2, None, 1)], "id int, c string, t int")
    got = {(r["id"], r["t"]): (r["revision"], r["change"]) for r in versions.revisions(df, "id", "c", "t").collect()}
    assert got == {(1, 1): (1, "new"), (1, 2): (1, "unchanged"), (1, 3): (2, "revised"), (1, 4): (3, "revised"), (2, 1): (1, "new")}


def test_bulletin_items(spark):
    items = one(spark, listing.numbered_items(F.lit("Head\n1. One\nbody a\n2. Two\nbody b\n")))[0]
    assert [tuple(x) for x in items] == [(1, "One", "body a"), (2, "Two", "body b")]


def test_publication_is_idempotent(spark):
    root, df = folder(spark, "pub"), spark.range(4).selectExpr("id", "id % 2 AS month")
    for _ in range(2):
        publish.publish(root, "g1", {"t": (df, ["month"])})
    publish.publish(root, "g2", {"t": (df.filter("id > 1"), ["month"])})
    assert publish.generations(spark, root) == ["g1", "g2"] and publish.current(spark, root, "t").count() == 2


def test_references_that_are_cut(spark):
    body = listing.between(F.lit("<article>a&amp;b &lt;c&gt; &#228;&#xe4; &uuml;&nosuch;&ampx; x&amp</h1> &am</article>"), "<article>", "</article>")
    assert one(spark, body)[0] == "a&b <c> ääü&nosuch;&ampx; x&amp &am".replace("ääü", "ää ü")
