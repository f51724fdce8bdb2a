"""Surveyed lines under ways, lines that run together, registers held against layers, packed lines: hand-worked and brute-force answers."""

import math
import random

import pytest
from pyspark.sql import functions as F

from waymeld.functions import geo
from waymeld.operators import gates, lines, physical, registers
from waymeld.sources import sinks

LINE = "array<struct<x:double,y:double>>"


def at(x, y, lat=52.0):
    """A place by metres east and north of 0, 52."""
    up = lat + y / geo.LAT_M
    return (x / (geo.LON_M * math.cos(math.radians(up))), up)


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def way(*points):
    return [at(*p) for p in points]


def test_under(spark):
    ways = table(spark, [("w", way((0, 0), (1000, 0))), ("far", way((0, 9000), (500, 9000))), ("dot", way((0, 0))), ("none", None)], f"k string, line {LINE}")
    surveyed = table(spark, [
        (1, way((0, 5), (520, 5))), (2, way((480, -5), (1000, -5))), (3, way((0, 8), (400, 8))),  # end to end, and one beside the first
        (4, way((300, -500), (300, 500))), (5, way((1000, 0), (1300, 900))), (6, way((0, 60), (1000, 60))),  # a crossing, a touch at the end, one too far
    ], f"o int, line {LINE}")
    got = {(r["k"], r["o"]): (r["weight"], round(r["cover"], 3)) for r in physical.under(ways, "k", "line", surveyed, "o", "line").collect()}
    # 41 points, 25 m apart; a line also covers points up to 20 m past its end.
    assert got == {("w", 1): (22, 1.0), ("w", 2): (22, 1.0)}
    assert physical.under(ways.filter("false"), "k", "line", surveyed, "o", "line").count() == 0


def test_attributes(spark):
    tags = table(spark, [(1, {"surface": "mud", "width": "3"}), (2, {"surface": "gravel", "width": "2.5", "maxwidth": "6'0\"", "tracktype": "grade2"}), (3, {"surface": "gravel", "smoothness": ""}), (4, {})], "o int, tags map<string,string>")
    chosen = table(spark, [("a", 1, 10), ("a", 2, 6), ("a", 3, 4), ("b", 4, 5)], "k string, o int, weight bigint")
    barriers = table(spark, [("a", "gate", {"maxwidth": "1.5 m"}), ("a", "bollard", {})], "k string, kind string, tags map<string,string>")
    rows = physical.attributes(chosen, "k", "o", tags, barriers)
    got = {r["k"]: tuple(r)[1:] for r in rows.collect()}
    # mud and gravel cover 10 points each; (3 * 10 + 1.829 * 6) / 16
    assert got == {"a": ("gravel", None, "grade2", 2.56, 1.5, ["bollard", "gate"]), "b": (None, None, None, None, None, [])}
    sums = physical.coverage(rows.withColumn("cover", F.when(F.col("k") == "a", 0.6))).first().asDict()
    assert sums == {"ways": 2, "matched_pct": 50.0, "width_pct": 50.0, "surface_pct": 50.0, "smoothness_pct": 0.0, "tracktype_pct": 50.0, "any_pct": 50.0, "barrier_pct": 50.0}
    assert physical.coverage(rows.withColumn("cover", F.lit(0.1)).filter("false")).first()["matched_pct"] == 0
    basis = table(spark, [({"designation": "restricted_byway", "surface": "mud"},), ({"designation": "public_byway", "width": "2"},), ({"designation": "byway_open_to_all_traffic", "surface": ""},)], "tags map<string,string>")
    assert {r["scope"]: (r["ways"], round(r["width_pct"]), round(r["surface_pct"])) for r in physical.designation_basis(basis).collect()} == {"all": (3, 33, 33), "open": (2, 50, 0)}


def test_running(spark):
    ways = table(spark, [("along", way((0, 0), (200, 0))), ("cross", way((100, -100), (100, 100))), ("turned", way((0, 0), (100, 0), (100, 100))), ("on", way((300, 0), (400, 0)))], f"k string, line {LINE}")
    others = table(spark, [("path", way((0, 10), (200, 10))), ("bridleway", way((0, -5), (100, -5)))], f"n string, line {LINE}")
    got = {r["k"]: (round(r["share"], 3), r["kind"], round(r["kind_share"], 3)) for r in lines.running(ways, "k", "line", others, "n", "line").collect()}
    # 41 points of `along`, all beside the path, the first 21 nearer the bridleway (which may be passed by 2 m).
    assert got == {"along": (1.0, "bridleway", 0.512), "cross": (0.0, None, 0.0), "turned": (0.488, "bridleway", 0.488), "on": (0.0, None, 0.0)}
    roads = table(spark, [("a", way((0, 0), (200, 0))), ("b", way((0, 0), (500, 0))), ("c", way((0, 500), (90, 500))), ("d", way((0, 1000), (100, 1000)))], f"k string, line {LINE}")
    byways = table(spark, [(way((0, 1005), (100, 1005)),)], f"line {LINE}")
    cut = lines.sections(roads, "k", "line", others, "n", "line", byways, "line")
    assert {r["k"]: (r["verdict"], r["kind"]) for r in cut.collect()} == {"a": ("dropped", "bridleway"), "b": ("partly", None), "c": ("kept", None), "d": ("dropped", lines.BYWAY)}


def test_running_brute_force(spark):
    rng = random.Random(5)
    some = lambda n: [(i, [(rng.uniform(0, 300), rng.uniform(0, 300)) for _ in range(rng.randint(2, 4))]) for i in range(n)]
    a, b = some(25), some(25)
    put = lambda rows: table(spark, [(i, [at(*p) for p in pts]) for i, pts in rows], f"k int, line {LINE}")
    got = {r["k"]: r["share"] for r in lines.running(put(a), "k", "line", put(b), "k", "line").collect()}
    real = lambda p: (lambda q: (q[0] * geo.LON_M * math.cos(math.radians(q[1])), q[1] * geo.LAT_M))(at(*p))
    legs = [(real(p), real(q)) for _, pts in b for p, q in zip(pts, pts[1:])]
    bearing = lambda p, q: math.degrees(math.atan2(q[1] - p[1], q[0] - p[0])) % 180
    for k, pts in a:
        pts, hit, n = [real(p) for p in pts], 0, 0
        for i, (p, q) in enumerate(zip(pts, pts[1:])):
            m = math.dist(p, q)
            many = max(1, int(m // 5))
            for j in range(many + (i == len(pts) - 2)):
                t = min(1.0, j * 5 / m)
                x, y = p[0] + (q[0] - p[0]) * t, p[1] + (q[1] - p[1]) * t
                n += 1
                for c, d in legs:
                    turn = abs(bearing(p, q) - bearing(c, d)) % 180
                    length = math.dist(c, d)
                    u = ((x - c[0]) * (d[0] - c[0]) + (y - c[1]) * (d[1] - c[1])) / length**2
                    if min(turn, 180 - turn) <= 30 and -2 / length <= u <= 1 + 2 / length:
                        u = min(1, max(0, u))
                        if math.dist((x, y), (c[0] + u * (d[0] - c[0]), c[1] + u * (d[1] - c[1]))) <= 20:
                            hit += 1
                            break
        assert got[k] == pytest.approx(hit / n, abs=1e-9), k


def test_registers(spark):
    old = table(spark, [("same", [way((0, 0), (500, 0))]), ("gone", [way((0, 2000), (400, 2000))]), ("longer", [way((0, 4000), (300, 4000))]), ("dot", [way((0, 0))])], f"k string, parts array<{LINE}>")
    new = table(spark, [("same2", [way((0, 3), (500, 3))]), ("longer2", [way((0, 4004), (900, 4004))]), ("fresh", [way((0, 6000), (200, 6000)), way((0, 6100), (200, 6100))])], f"k string, parts array<{LINE}>")
    kept, dropped, added = lines.settled(old, "k", "parts", new, "k", "parts")
    assert {r["k"] for r in kept.collect()} == {"same", "longer"} and {r["k"] for r in dropped.collect()} == {"gone"}
    assert {(r["k"], r["pos"], round(r["length_m"], -1)) for r in added.collect()} == {("longer2", 0, 580.0), ("fresh", 0, 200.0), ("fresh", 1, 200.0)}
    features, verdicts = lines.renewed(old, new, "k", "parts")
    assert {r["k"] for r in features.collect()} == {"same", "longer2", "fresh"}
    assert {(r["side"], r["k"]): r["verdict"] for r in verdicts.collect()} == {("old", "same"): "kept", ("old", "gone"): "dropped", ("old", "longer"): "dropped", ("new", "same2"): "known", ("new", "longer2"): "added", ("new", "fresh"): "added"}
    said = spark.createDataFrame([(0, 0, 0, 0.0), (8, 5, 9, 0.1), (8, 6, 9, 0.3), (8, 6, 9, 0.25), (0, 0, 9, 1.0)], "r int, k int, w int, n double")
    assert [r[0] is None for r in said.select(lines.agrees(F.col("r"), F.col("k"), F.col("w"), F.col("n"))).collect()] == [False, False, False, True, True]


def test_packed_lines(spark):
    rng = random.Random(3)
    rows = [(0, []), (1, [[]]), (2, None), (3, [[(0.0, 0.0)]]), (4, [[(-180.0, -90.0), (180.0, 90.0)], [(1.2345678, -0.0000001)]])]
    rows += [(5 + i, [[(rng.uniform(-9, 3), rng.uniform(49, 61)) for _ in range(rng.randint(0, 40))] for _ in range(rng.randint(1, 4))]) for i in range(20)]
    df = table(spark, rows, f"k int, parts array<{LINE}>").withColumn("body", geo.pack_lines("parts"))
    for r in df.withColumn("back", geo.unpack_lines("body")).collect():
        want = rows[r["k"]][1]
        assert (r["back"] is None) == (want is None)
        if want is not None:
            assert [[(p["x"], p["y"]) for p in line] for line in r["back"]] == [[(pytest.approx(x, abs=6e-8), pytest.approx(y, abs=6e-8)) for x, y in line] for line in want]
    # One line, two points: (1, 0) degrees is 10,000,000 steps, doubled for its sign; then one step back east and one up.
    small = table(spark, [([[(1e-7, 0.0), (0.0, 2e-7)]],)], f"parts array<{LINE}>").select(geo.pack_lines("parts")).first()[0]
    assert bytes(small) == bytes([1, 2, 2, 0, 1, 4])
    assert table(spark, [(b"",), (b"\x01\x05\x02",), (b"\x80",)], "b binary").filter(geo.unpack_lines("b").isNotNull()).count() == 0


def test_parts_of_unequal_lengths(spark):
    parts = [way((0, 0), (100, 0), (200, 0)), way((200, 0), (300, 0)), way((1000, 0), (1100, 0), (1200, 0), (1300, 0))]
    df = table(spark, [(0, parts), (1, parts[:2]), (2, [[], way((0, 0))]), (3, None)], f"k int, parts array<{LINE}>")
    got = {r["k"]: r["g"] for r in df.select("k", registers.gap_km("parts").alias("g")).collect()}
    assert got[0] == pytest.approx(0.7, abs=0.005) and got[1] == got[2] == 0 and got[3] is None
    # A line that leaves the tile and comes back is two pieces of two and three points.
    line = [(0.01, 0.01), (0.01, 30.0), (0.02, 30.0), (0.02, 0.01), (0.03, 0.01)]
    tiles = sinks.vector_tiles(table(spark, [(1, line)], f"k int, line {LINE}"), "k", "line", [], 8, "ways").collect()
    assert len(tiles) >= 2 and all(r["tile"] for r in tiles)


def test_resampled(spark):
    df = table(spark, [(0, way((0, 0), (60, 0))), (1, way((0, 0))), (2, way((0, 0), (0, 0))), (3, []), (4, way((0, 0), (0, 20), (0, 20), (0, 50)))], f"k int, line {LINE}")
    got = {r["k"]: [round(p["d"]) for p in r["p"]] for r in df.select("k", geo.resampled("line").alias("p")).collect()}
    assert got == {0: [0, 25, 50, 60], 1: [0], 2: [0], 3: [], 4: [0, 25, 50, 50]}


def test_gates(spark):
    records = table(spark, [("x", 1), ("x", 2), ("y", 2), ("y", 2)], "area string, uid int")
    drawn = table(spark, [("x", 1), ("x", 3), ("x", 3), ("y", 1)], "area string, uid int")
    assert {tuple(r) for r in gates.disagreeing(records, drawn, "area", "uid").collect()} == {("x", "held only", 1, 2), ("x", "drawn only", 1, 3), ("y", "held only", 1, 2), ("y", "drawn only", 1, 1)}
    assert {tuple(r)[:2] for r in gates.disagreeing(records, drawn, "area", "uid", F.col("area") == "y").collect()} == {("x", "held only"), ("x", "drawn only"), ("y", "drawn only")}
    keys = lambda *k: table(spark, [(i,) for i in k], "k int")
    assert {tuple(r) for r in gates.changeset_problems(keys(1, 2, 3), keys(2, 4, 4), keys(2, 9), keys(2, 7), "k").collect()} == {("carried and removed", 2), ("removed but not there", 9), ("carried twice", 4), ("carried without a box", 4), ("box of nothing", 7)}
    a, b = (table(spark, rows, "k int, at string, v string") for rows in ([(1, "2024-01-02", "old"), (2, None, "kept"), (3, "2024-01-01", "first")], [(1, "2024-01-01", "older"), (2, "2023-01-01", "dated"), (3, "2024-01-01", "last")]))
    assert {r["k"]: r["v"] for r in gates.later(a, b, key="k", at="at").collect()} == {1: "old", 2: "dated", 3: "last"}
