"""Rings, cells, overlays, joined lines and chains of reports against plain Python."""

import random

import numpy as np
from pyspark.sql import functions as F

from signalwerk.functions import nested, rings
from signalwerk.operators import chains, followups, spatial
from signalwerk.sources import mails, sites

SHAPES = "dimension int, shape array<array<array<struct<x:double,y:double>>>>"


def blob(r, x, y, n, size):
    turns = sorted(r.random() * 2 * np.pi for _ in range(n))
    p = [(x + size * (0.3 + r.random()) * np.cos(t), y + size * (0.3 + r.random()) * np.sin(t)) for t in turns]
    return [p + [p[0]]]


def test_overlay_areas_and_members():
    r = random.Random(1)
    square = lambda: [[[(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]] for x, y, w, h in [[r.randint(0, 5) for _ in range(2)] + [r.randint(1, 5) for _ in range(2)]]]
    for k in range(120):
        x, y = (0, 0) if k % 4 == 0 else (4e5, 5.8e6)
        a, b = (square(), square()) if k % 4 == 0 else ([blob(r, x + r.random() * 5, y + r.random() * 5, r.randint(3, 20), 3)], [blob(r, x + r.random() * 5, y, r.randint(3, 20), 3) + blob(r, x + 2, y + 2, 6, 0.5)])
        of = {op: rings.overlay([a, b], op) for op in ("union", "intersection", "difference", "symmetric")}
        size = {op: rings.area_of(s) for op, s in of.items()}
        own = [rings.area_of(rings.overlay([s], "union")) for s in (a, b)]
        near = lambda p, q: abs(p - q) < 1e-4 * (sum(own) + 1)  # noqa: B023, E731
        assert near(sum(own), size["union"] + size["intersection"]) and near(own[0], size["intersection"] + size["difference"]) and near(size["union"], size["intersection"] + size["symmetric"])
        xy = np.array([(x + r.uniform(-4, 9), y + r.uniform(-4, 9)) for _ in range(40)])
        in_a, in_b = (rings.contains(rings.edges(s), xy) for s in (a, b))
        assert (rings.contains(rings.edges(of["union"]), xy) == (in_a | in_b)).all() and (rings.contains(rings.edges(of["intersection"]), xy) == (in_a & in_b)).all()
    assert rings.overlay([], "union") == [] and rings.overlay([[], []], "intersection") == []


def test_cells_hold_what_is_near():
    r = random.Random(2)
    for _ in range(60):
        e, margin, size = rings.edges([blob(r, 0, 0, r.randint(3, 20), 50)]), r.choice([0, 3, 12]), r.choice([7, 10, 25])
        cx, cy, inner = rings.cells(e, rings.AREA, size, margin)
        have = dict(zip(zip(cx.tolist(), cy.tolist(), strict=True), inner.tolist(), strict=True))
        assert len(have) == len(cx)
        xy = np.array([(r.uniform(-90, 90), r.uniform(-90, 90)) for _ in range(200)])
        for (x, y), inside, off in zip(xy, rings.contains(e, xy), rings.to_edges(xy, e), strict=True):
            cell = (int(x // size), int(y // size))
            assert cell in have or not (inside or off <= margin)
            assert not have.get(cell) or (inside and off >= margin - 1e-9)


def test_within_is_all_pairs(spark):
    r = random.Random(3)
    shapes = []
    for i in range(60):
        x, y = r.uniform(0, 400), r.uniform(0, 400)
        d = i % 3
        shape = [[[(x, y)]]] if d == 0 else [[[(x, y), (x + r.uniform(-80, 80), y + r.uniform(-80, 80)), (x + 90, y)]]] if d == 1 else [blob(r, x, y, 9, 60) + blob(r, x, y, 4, 6)]
        shapes.append((i, d, [[[(float(a), float(b)) for a, b in line] for line in part] for part in shape]))
    shapes.append((60, 2, []))
    df = spark.createDataFrame(shapes, f"id long, {SHAPES}")
    left, right = df.withColumnRenamed("id", "left_id"), df.withColumnRenamed("id", "right_id")
    for radius in (0.0, 25.0):
        want = {(a, b) for a, d, s in shapes for b, g, t in shapes if rings.distance(rings.edges(s), d, rings.edges(t), g) <= radius}
        got = [(x.left_id, x.right_id) for x in spatial.within(left, right, radius, 50.0).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_lines_join_to_chains_and_rings(spark):
    r = random.Random(4)
    rows, want, ids = [], {}, random.Random(5).sample(range(2000), 2000)

    def add(group, places, ring):
        mine = []
        for a, b in zip(places, places[1:], strict=False):
            mine.append(ids.pop())
            rows.append((mine[-1], group, *((a, b) if r.random() < 0.5 else (b, a))))
        want[min(mine)] = (set(mine), ring)

    for k in range(15):
        add(k % 3, [f"p{k}-{j}" for j in range(r.choice([1, 2, 3, 7, 20]) + 1)], False)
        s = [f"r{k}-{j}" for j in range(r.choice([1, 2, 3, 8, 16, 21]))]
        add(k % 3, s + [s[0]], True)
    for j in range(3):
        add(9, ["hub"] + [f"s{j}-{i}" for i in range(j + 2)], False)
    found: dict = {}
    for x in chains.chained(spark.createDataFrame(rows, "line_id long, group int, start string, end string")).collect():
        found.setdefault(x.chain_id, []).append(x)
    assert set(found) == set(want)
    ends = {a: (b, c) for a, _, b, c in rows}
    for chain, xs in found.items():
        xs.sort(key=lambda x: x.position)
        walk = [ends[x.line_id][::-1] if x.back else ends[x.line_id] for x in xs]
        assert [x.position for x in xs] == list(range(len(xs))) and {x.line_id for x in xs} == want[chain][0] and all(x.ring == want[chain][1] for x in xs)
        assert all(a[1] == b[0] for a, b in zip(walk, walk[1:], strict=False)) and xs[0].line_id <= xs[-1].line_id
        assert not (want[chain][1] or len(xs) == 1) or (xs[0].line_id == chain and not xs[0].back)


def test_chains_of_reports(spark):
    links = [(i, i - 1) for i in range(1, 51)] + [(100, 101), (101, 102), (102, 100), (103, 100), (200, 199)]
    got = {x.id: (x.root, x.hops) for x in followups.resolved(spark.createDataFrame(links, "id long, earlier long")).collect()}
    assert got == {**{i: (0, i) for i in range(1, 51)}, **{i: (None, None) for i in (100, 101, 102, 103)}, 200: (199, 1)}
    assert followups.resolved(spark.createDataFrame([], "id long, earlier long")).collect() == []


def test_json_in_text_and_odd_documents(spark):
    deep = "[" * 300 + "1" + "]" * 300
    rows = [(0, 'x "k": {"a":[1,{"b":"]}"}]} "k":2, "k": nope "k":"s"'), (1, f'"k": {deep}'), (2, None), (3, ""), (4, '"k":[1,2')]
    df = spark.createDataFrame(rows, "i int, t string")
    got = {x.i: x.v for x in df.select("i", nested.values_after(F.col("t"), '"k":').alias("v")).collect()}
    assert got[0] == ['{"a":[1,{"b":"]}"}]}', "2", '"s"'] and got[1] == [deep] and got[3] == [] and got[4] == [] and not got[2]
    docs = spark.createDataFrame([(0, '{"b":1,"a":{"d":1.25,"c":"1"}}'), (1, "{"), (2, None), (3, "[1.0, 1]")], "i int, t string")
    form = {x.i: (x.c, x.o, x.l and [tuple(y) for y in x.l]) for x in docs.select("i", nested.canonical(F.col("t"), 1).alias("c"), nested.objects(F.col("t")).alias("o"), nested.leaves(F.col("t")).alias("l")).collect()}
    assert form[0] == ('{"a":{"c":"1","d":1.2},"b":1}', ['{"b":1,"a":{"d":1.25,"c":"1"}}', '{"d":1.25,"c":"1"}'], [("/b", "1"), ("/a/d", "1.25"), ("/a/c", "1")])
    assert form[1] == form[2] == (None, None, None) and form[3] == ("[1.0,1]", [], [("/0", "1.0"), ("/1", "1")])


def test_mails_and_entities(spark):
    head = "From: a\nDate: b\n"
    cases = [head + "\nHallo", "From: a\n\nx", head + "Content-Type: text/plain; charset=nobody-knows\n\nx", head + "Content-Type: image/png\n\nx", None, head + "Content-Type: text/html\n\n<p>a&uuml;<script>x</script>b"]
    got = [x.t for x in spark.createDataFrame(list(enumerate(cases)), "i int, c string").select("i", mails.mail_text(F.col("c")).alias("t")).orderBy("i").collect()]
    assert got[:5] == ["Hallo", None, None, None, None] and got[5].split() == ["aü", "b"]
    assert spark.range(1).select(sites.visible(F.lit("<b>K&uuml;ste</b> &#228; &ndash;&amp;lt;"))).first()[0] == "Küste ä –&lt;"


def test_overlays_whose_crossings_round_apart():
    """Areas at odd places, whose edges cross within a grid's width of each other's rounding: rings close and areas are right. Many rows at once are as one by one."""
    from signalwerk.plans import spatial_queries as q

    rows, want = [], []
    for x, y, x0, y0 in ((405385.4980569096, 5805489.602337169, -75.0, -203.0), (398903.0586292057, 5811680.41477232, -140.0, -203.0), (392373.67213285743, 5810339.235372829, -92.0, -190.0)):
        x, y = x + 17.3 - 300 + 300, y + 11.7
        ring = lambda corners: [(x + dx, y + dy) for dx, dy in corners]  # noqa: B023, E731
        own = [[ring(q.L), ring(q.HOLE)], [ring(q.SQUARE)]]
        ax, ay = ring(q.L)[0][0] + 300, ring(q.L)[0][1] + 300
        rows.append([own, [[[(ax + a, ay + b) for a, b in ((x0, y0), (x0 + 600, y0), (x0 + 600, y0 + 650), (x0, y0 + 650), (x0, y0))]]]])
        over = lambda a, b, c, d: max(min(x0 + 600, b) - max(x0, a), 0) * max(min(y0 + 650, d) - max(y0, c), 0)  # noqa: B023, E731
        want.append(over(-300, 300, -300, 0) + over(-300, 0, 0, 300) - over(-170, -130, -170, -130) + over(400, 460, 400, 460))
    each = [rings.overlay(r, "intersection") for r in rows]
    assert [round(rings.area_of(s)) for s in each] == want and rings.overlays([*rows, [], [[]]], "intersection") == [*each, [], []]


def test_overlay_of_many_shapes():
    """More shapes than one word has bits, an empty one among them, and rings that touch at a corner."""
    square = lambda x, y, w=1.0: [[[(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]]]
    row = [square(float(i), 0.0) for i in range(0, 140, 2)] + [square(float(i), 1.0) for i in range(1, 140, 2)]
    assert len(rings.overlay(row, "union")) == 140 and rings.area_of(rings.overlay(row, "union")) == 140
    assert rings.area_of(rings.overlay([square(0.0, 0.0, 9.0), *row[:70]], "difference")) == 81 - 5 and rings.overlay([*row[:1] * 70, []], "intersection") == []
    assert rings.area_of(rings.overlay(row[:1] * 70, "intersection")) == 1 and rings.overlay(row[:1] * 70, "symmetric") == []


def test_unions_of_many_rows_take_no_time_each():
    """2,000 unions of four strips in one call: some ten seconds when rows were combined one by one."""
    import time

    strip = lambda k: [[[(10.0 * k + dx, dy) for dx, dy in ((0, 0.0), (15, 0.0), (15, 1.0), (0, 1.0), (0, 0.0))]]]
    rows = [[strip(i % 7), strip(i % 7 + 1), strip(i % 7), strip(i % 7 + 3)] for i in range(2000)]
    began = time.process_time()
    found = rings.overlays(rows, "union")
    assert time.process_time() - began < 3 and all([rings.area_of([p]) for p in s] == [15, 25] for s in found)


def test_chains_send_no_table_through_the_driver(spark):
    """Joins of tables that grow with the lines stay shuffled, however small their files look."""
    lines = spark.createDataFrame([(i, "g", [(float(i), 0.0), (float(i + 1), 0.0)]) for i in range(20)], "line_id long, group string, line array<struct<x:double,y:double>>")
    found = chains.merged(lines)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and [x.n_lines for x in found.collect()] == [20]


def test_common_junctions_of_many_asks_take_no_time_each():
    """600 asks whose roads' surroundings overlap, in one call: some ten seconds when each ask's were put together by themselves."""
    import time

    road = lambda x, *p: [[(x + a, b) for a, b in p]]
    asks = [[road(5e3 * i, (-20.0, 0.0), (20.0, 0.0)), road(5e3 * i, (-20.0, 15.0), (20.0, 15.0))] if i % 3 else [road(5e3 * i, (-9.0, 0.0), (9.0, 0.0))] for i in range(900)]
    began = time.process_time()
    found = rings.common_junction_of_each([*asks, []])
    assert time.process_time() - began < 5
    assert all((f is None) if i % 3 == 0 else (round(f[1]) == 53 and abs(f[0][1]) < 1e-9) for i, f in enumerate(found[:900])) and found[900] is None
    assert [rings.common_junction(x) for x in asks[:9]] == found[:9]


def test_lines_of_many_rows_are_united_at_once():
    """2,000 rows of lines in one call, as one by one; some three seconds when each was cut by itself."""
    import time

    rows = [[[(10.0 * (i % 5), 0.0), (10.0 * (i % 5) + 15, 0.0)], [(25.0, 0.0), (10.0, 0.0)], [(12.0, -1.0), (12.0, 1.0)]] for i in range(2000)]
    began = time.process_time()
    found = rings.noded_each([*rows, []])
    assert time.process_time() - began < 1.5 and found[2000] == [] and found[:5] == [rings.noded(r) for r in rows[:5]]
