"""Registers in which ways stand several times, streets along ways, closures, stations: hand-worked answers."""

import json
import random

import pytest
from pyspark.sql import functions as F
from test_physical import LINE, table, way

from waymeld.operators import closures, dedupe
from waymeld.sources import services


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r["node"]: r["component"] for r in dedupe.components(table(spark, edges + [(None, 5)], "a int, b int")).collect()}
    assert got == {n: root(n) for n in parent}
    assert dedupe.components(table(spark, [], "a int, b int")).count() == 0


def test_merged(spark):
    rows = [
        # Twins of two authorities, and a double of one authority's own.
        ("a1", "boat", "AA", way((0, 0), (400, 0))), ("b1", "boat", "BB", way((0, 4), (395, 4))), ("a1x", "boat", "AA", way((0, 0), (400, 0))),
        # One authority draws whole what another draws in three pieces.
        ("a2", "boat", "AA", way((0, 1000), (700, 1000))), ("b2/1", "boat", "BB", way((0, 1005), (600, 1005))), ("b2/2", "boat", "BB", way((600, 1005), (605, 1005))), ("b2/3", "boat", "BB", way((605, 1005), (700, 1005))),
        # Sides that do not agree, another kind, a crossing, a way of its own, no line.
        ("a3", "boat", "AA", way((0, 2000), (900, 2000))), ("b3/1", "boat", "BB", way((0, 2003), (200, 2003))), ("b3/2", "boat", "BB", way((200, 2003), (400, 2003))),
        ("c1", "path", "CC", way((0, 2), (400, 2))), ("d1", "boat", "BB", way((200, -200), (200, 200))), ("e1", "boat", "AA", way((5000, 0), (5400, 0))), ("f1", "boat", "AA", None), (None, "boat", "AA", way((0, 0), (400, 0))),
    ]
    ways = table(spark, rows, f"id string, kind string, code string, line {LINE}")
    stay, gone = dedupe.merged(ways, "id", "line", "kind", "code")
    assert {r["id"]: r["kept"] for r in gone.collect()} == {"b1": ["a1"], "a1x": ["a1"], "b2/1": ["a2"], "b2/2": ["a2"], "b2/3": ["a2"]}
    assert {r["id"]: r["also"] for r in stay.collect()} == {"a1": ["a1x", "b1"], "a2": ["b2/1", "b2/2", "b2/3"], **{k: None for k in ("a3", "b3/1", "b3/2", "c1", "d1", "e1", "f1", None)}}
    # An authority of higher rank gives way, also where it drew the way whole.
    stay, gone = dedupe.merged(ways, "id", "line", "kind", "code", F.when(F.col("code") == "AA", 1).otherwise(0))
    assert {r["id"]: r["kept"] for r in gone.collect()} == {"a1": ["b1"], "a1x": ["b1"], "a2": ["b2/1", "b2/2", "b2/3"]}
    assert dedupe.merged(ways.filter("false"), "id", "line", "kind", "code")[0].count() == 0


def test_streets_and_closures(spark):
    ways = table(spark, [("w", way((0, 0), (400, 0))), ("short", way((0, 3000), (60, 3000)))], f"uid string, line {LINE}")
    streets = table(spark, [(11, way((0, 8), (150, 8))), (12, way((200, -300), (200, 300))), (13, way((300, 5), (900, 5))), (14, way((0, 3000), (30, 3000))), (None, way((0, 0), (400, 0)))], f"usrn long, line {LINE}")
    along = closures.streets_along(ways, "uid", "line", streets, "usrn", "line")
    assert {(r["uid"], r["usrn"]): round(r["share"], 2) for r in along.collect()} == {("w", 11): 0.4, ("w", 13): 0.28}
    rows = [("no", "road_closure", None, None, True), ("YES", "road_closure", None, "road closed", False), (None, None, "Works", "Lane CLOSED", True), (None, "lane_closure", "x", "enclosure", False), (None, None, None, None, False), (None, None, "TTRO", None, True)]
    for *given, want in rows:
        assert spark.range(1).select(closures.is_closure(*[F.lit(g).cast("string") for g in given])).first()[0] is want, given
    x, y = way((100, 0))[0]
    far = way((100, 400))[0]
    acts = table(spark, [("1", " 11 ", "2024-05-01T00:00", "2024-06-01", True, x, y), ("2", "11", "2024-05-01", None, True, *far), ("3", "13", "2024-05-01", "2024-05-02", True, None, None), ("4", "13", "2024-05-01", None, True, None, None), ("5", "13", "", None, True, None, None), ("6", "13", "2024-05-01", None, False, None, None), ("7", None, "2024-05-01", None, True, None, None)],
                 "activity string, street string, start string, end string, closes boolean, lon double, lat double")
    got = {r["activity"]: (r["ways"], r["start"], r["end"]) for r in closures.put_on_ways(acts, along, ways, "uid", "line", "usrn", "2024-05-20").collect()}
    assert got == {"1": (["w"], "2024-05-01", "2024-06-01"), "4": (["w"], "2024-05-01", None)}
    assert [tuple(r[0]) if r[0] else None for r in spark.createDataFrame([("POINT(377934.1 159051.3)",), ("point (1e9 2)",), ("POINT(900000 5)",), (None,)], "t string").select(closures.grid_point(F.col("t"))).collect()] == [(377934.1, 159051.3), None, None, None]


def test_matched_orders(spark):
    ways = table(spark, [("u1", "AA", "boat", "albury", "15", way((0, 0), (500, 0))), ("u2", "AA", "boat", "shere", "7/1", way((0, 1000), (500, 1000))), ("u3", "AA", "boat", "shere", "7/2", way((0, 1100), (500, 1100))), ("u4", "AA", "road", "shere", "7/3", way((0, 1200), (500, 1200))), ("u5", "BB", "boat", "c1", "3", way((0, 9000), (500, 9000)))],
                 f"uid string, authority string, class string, parish string, number string, line {LINE}")
    near, off = way((100, 100))[0], way((100, 2500))[0]
    rows = [("pin", ["AA"], None, None, None, ["u4", "u1"]), ("lost", ["AA"], None, None, None, ["u1", "gone"]), ("ref", ["AA"], "Albury / Shere", [(None, "BOAT 15")], [near], []), ("sections", ["AA"], "Shere (Albury in the order)", [(None, "7")], None, None),
            ("doubt", ["AA"], "Albury", [(None, "015")], [off], None), ("code", ["BB"], "x", [("C1", "3")], None, None), ("grid", ["AA"], "Elsewhere", [(None, "99")], [near], None), ("none", ["BB"], None, [(None, "1")], [near], None), ("bare", None, None, None, None, None)]
    orders = table(spark, rows, "order string, authorities array<string>, parish string, paths array<struct<code:string,number:string>>, points array<struct<x:double,y:double>>, pinned array<string>")
    got = {r["order"]: (r["ways"], r["how"], r["problem"]) for r in closures.matched_orders(orders, ways).collect()}
    assert got == {"pin": (["u1", "u4"], "reviewed", None), "lost": ([], None, "pinned ways are gone"), "ref": (["u1"], "reference", None), "sections": (["u2", "u3"], "reference", None), "doubt": (["u1"], "reference", "far from the grid references"),
                   "code": (["u5"], "reference", None), "grid": (["u1"], "grid", "by grid reference only"), "none": ([], None, "no way matches"), "bare": ([], None, "no way matches")}


def test_pieces(spark):
    items = table(spark, [("b", "w", None, [way((2, 0), (3, 0))], "t2"), ("a", "w", None, [way((0, 0), (1, 0))], "t1"), ("c", "w", 2, [way((0, 0), (1, 0))], "t3")], f"id string, way string, width int, parts array<{LINE}>, title string")
    got = {r["id"]: (r["width"], len(r["parts"]), r["title"], round(r["parts"][0][0]["x"], 6)) for r in closures.pieces_joined(items, "id", ["way", "width"], "parts").collect()}
    assert got == {"a": (None, 2, "t1", 0.0), "c": (2, 1, "t3", 0.0)}


def test_services(spark):
    pages = {("rain", 0): [{"notation": "E1-2", "label": ["A &amp; B", "x"], "lat": "51.5", "long": -1, "measures": [{"@id": "m/1"}, "m/2"], "stageScale": {"typicalRangeHigh": 2.5}}], ("rain", 2): [{"stationReference": "S2", "lat": 52, "lon": -2.0, "measures": {"notation": "m/3"}, "riverName": "Dove", "stageScale": "http://x"}, {"notation": "none"}]}
    fetch = lambda source, offset: json.dumps({"items": pages.get((source, offset), [])})
    raw = services.paged(spark, ["rain", "level"], fetch, limit=2).cache()
    assert raw.count() == 3
    found = services.stations(raw)
    assert {r["id"]: tuple(r)[1:] for r in found.collect()} == {"E1-2": ("A & B", 51.5, -1.0, None, None, None, 2.5, ["m/1", "m/2"]), "S2": (None, 52.0, -2.0, "Dove", None, None, None, ["m/3"])}
    sent = spark.createDataFrame([(json.dumps(r),) for r in ({"measure": "m/1", "dateTime": "2024-01-01T00:15:00Z", "value": 0.2}, {"measure": {"@id": "m/3"}, "dateTime": "2024-01-01T00:15:00Z", "value": "1"}, {"measure": "m/9", "dateTime": "2024-01-01T00:15:00Z", "value": 1}, {"measure": "m/1", "dateTime": "soon", "value": 1}, {"measure": "m/1", "dateTime": "2024-01-01T00:15:00Z", "value": [1]})], "body string")
    assert sorted((r["id"], r["value"]) for r in services.readings(sent, services.measure_index(found)).collect()) == [("E1-2", 0.2), ("S2", 1.0)]
    with pytest.raises(Exception, match="does not end"):
        services.paged(spark, ["x"], lambda s, o: '{"items": [1]}', most=3).collect()
    shapes = spark.createDataFrame([(json.dumps(r),) for r in ({"attributes": {"a": 1}, "geometry": {"paths": [[[0, 1], [2, 3]], [[5, 5]]]}}, {"attributes": {}, "geometry": {"rings": [[[0, 0], [1, 0], [0, 0]]]}}, {"attributes": {}, "geometry": None})], "body string")
    assert [(r["attributes"], [[tuple(p) for p in line] for line in r["parts"]]) for r in services.map_features(shapes).collect()] == [('{"a":1}', [[(0.0, 1.0), (2.0, 3.0)]]), ("{}", [[(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]])]
