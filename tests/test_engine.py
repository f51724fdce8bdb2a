"""Operators, functions, readers, writers and the feed on small made-up rows, against hand-worked or brute-force answers."""

import json
import math
import random
import sqlite3
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymeld.functions import climb, dates, geo, text, wet
from waymeld.operators import cdc, gates, lines, orders, ranking, readings, spatial
from waymeld.sources import files, sinks
from waymeld.streaming import catch_up


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_ascent(spark):
    for heights, want in (([0, 3, 2, 4], 4), ([5, 6, 7, 8], 3), ([0, 1], 1), ([60, 30, 2], 0), ([7], 0), ([], 0), ([0, 10, 7, 20, 0], 23)):
        h = F.array(*map(F.lit, heights)).cast("array<double>")
        assert one(spark, climb.total_ascent(h))[0] == want, heights
    assert one(spark, climb.harder_climb(F.array(F.lit(57.0), F.lit(20.0), F.lit(0.0))))[0] == 57


def test_text(spark):
    l = F.lit  # noqa: E741
    got = one(
        spark, text.fold(l("Dŵr-y-Bont, Łódź & Straße ÞÓR")), text.said_once(l("Powys - Powys")), text.said_once(l("Sir Benfro - Pembrokeshire")), text.slug(l("  St. Ives & Co ")),
        text.clean_text(l("a &amp;nbsp; b &not c\u00a0d")), text.unclean_in(l("x &amp; y\u00a0z")), text.council_reference(l("DY|Great Hucklow-WD41|18/3"), l("DY")),
        text.council_reference(l("GY|Abermaw|Prow Abermaw Rhif 2"), l("GY")), text.council_reference(l("KT|SR|74#1"), l("KT")), text.council_reference(l("ON|7"), l("ON")),
        text.council_reference(l("NT|Gamston (B)|Gamston (B)BOAT4"), l("NT")), text.number_key(l("uUCR 0306/0")), text.number_key(l("024/13A")), text.number_key(l("BOAT 0")),
        text.parish_variants(l("Outwood (Burstow in the order) / Shere")), text.without_contacts(l("Closed - Tom Smith Bc Contact 01632 960123 a@b.uk for further information")))
    assert list(got) == [
        "dwrybontlodzstrassethor", "Powys", "Sir Benfro - Pembrokeshire", "st-ives-co", "a   b &not c d", ["&amp;", "U+00A0"], ["Great Hucklow", "18/3"],
        ["Prow Abermaw Rhif 2"], ["SR", "74"], ["7"], ["Gamston (B)BOAT4"], "306", "24/13a", "0", ["Outwood", "Burstow", "Shere"], "Closed"]
    got = one(spark, text.description(l("BO|ON:22|0.144|none|-1.3")), text.description(l("BO|x|far|Gate")), text.width_m(l("6'6\"")), text.width_m(l("250")), text.width_m(l("2.5 m")),
              text.grid_reference(l("TQ 566 091")), text.grid_reference(l("0692 4666")), text.grid_reference(l("511436 149706")), text.month_of(l("January to March 2026")),
              text.vehicles(l("No vehicles with a width exceeding 1.5m")), text.vehicles(l("all motor vehicles except motorcycles")), text.page_text(l("<p>A&amp;B</p><script>x</script><div> c <br>d</div>")))
    assert got[0]["length_km"] == 0.231746 and got[0]["note"] is None and got[1]["length_km"] is None and got[1]["note"] == "Gate"
    assert got[2] == 1.981 and got[3] is None and got[4] == 2.5 and tuple(got[5]) == (556650.0, 109150.0) and got[6] is None and tuple(got[7]) == (511436.0, 149706.0) and got[8] == 3
    assert tuple(got[9]) == ("vehicles_over_width", 1.5) and got[10]["vehicles"] == "motor_vehicles_except_motorcycles" and got[11] == "A&B\nc\nd"
    assert all(v is None for v in one(spark, text.fold(l(None).cast("string")), text.clean_text(l(None).cast("string")), text.grid_reference(l(None).cast("string"))))


def test_dates(spark):
    l = F.lit  # noqa: E741
    got = one(spark, dates.written_date(l("24th December 2007")), dates.written_date(l("31/02/2026")), dates.epoch_day(l("32472144000000")), dates.epoch_day(l("86400000")), dates.end_of_month(l("(until February 2028)")),
              dates.season(l("(1 November - 31 March)")), dates.season_dates(l("11-01"), l("03-31"), l("2026-02-10").cast("date")), dates.season_dates(l("10-01"), l("02-29"), l("2026-05-01").cast("date")), dates.iso_day(l("2026-13-01")))
    assert [str(v) for v in got[:5]] == ["2007-12-24", "None", "None", "1970-01-02", "2028-02-29"] and tuple(got[5]) == ("11-01", "03-31")
    assert [str(v) for v in got[6]] == ["2025-11-01", "2026-03-31"] and got[7] is None and got[8] is None


def test_levels(spark):
    n, l = F.lit(None).cast("double"), F.lit  # noqa: E741
    got = one(spark, wet.level_state(l(2.0), n, l(1.5)), wet.level_state(n, l(0.1), l(1.5)), wet.level_state(l(0.05), l(0.1), l(1.5)), wet.verdict(l("hard"), l(99.0)), wet.verdict(l("soft"), n), wet.verdict(l("firm"), l(12.0)),
              wet.susceptibility(l("unpaved"), l("grade1")), wet.susceptibility(l("unpaved"), l(None).cast("string")), wet.susceptibility(l(None).cast("string"), l(None).cast("string")))
    assert [tuple(v) for v in got[:3]] == [("above", 0.5), ("unknown", None), ("below", -1.45)] and list(got[3:6]) == ["na", "unknown", "damp"]
    assert [tuple(v) for v in got[6:]] == [("hard", "tracktype", "grade1"), ("unknown", "surface", "unpaved"), ("unknown", "none", None)]


def test_grid_there_and_back(spark):
    lon, lat = geo._to_lonlat(np.array([651409.903]), np.array([313177.270]))
    # The water tower of the national grid's own worked example; seven parameters are good to some metres.
    assert abs(lon[0] - 1.71605) < 1e-4 and abs(lat[0] - 52.65798) < 1e-4
    g = np.random.default_rng(1)
    e, n = g.uniform(1e5, 6e5, 50), g.uniform(1e4, 1e6, 50)
    back = geo._to_grid(*geo._to_lonlat(e, n))
    assert max(np.abs(back[0] - e).max(), np.abs(back[1] - n).max()) < 1e-3


def test_tiles(spark):
    def hilbert(z, x, y):
        d, s = sum(4**k for k in range(z)), 1 << z >> 1
        while s:
            rx, ry = int(x & s > 0), int(y & s > 0)
            d += s * s * (3 * rx ^ ry)
            if not ry:
                if rx:
                    x, y = s - 1 - x, s - 1 - y
                x, y = y, x
            s >>= 1
        return d

    asked = [(0, 0, 0), *((z, random.Random(z * 9 + k).randrange(1 << z), random.Random(z * 7 + k + 1).randrange(1 << z)) for z in (1, 2, 5, 13) for k in range(9))]
    got = spark.createDataFrame(asked, "z int, x int, y int").select("*", geo.hilbert_id(F.col("z"), F.col("x"), F.col("y")).alias("h")).collect()
    assert all(r["h"] == hilbert(r["z"], r["x"], r["y"]) for r in got)
    level = spark.range(64).select(geo.hilbert_id(F.lit(3), F.col("id") % 8, F.floor(F.col("id") / 8)).alias("h")).collect()
    assert sorted(r[0] for r in level) == list(range(21, 85))
    box = one(spark, geo.tile_box(F.lit(1), F.lit(0), F.lit(0)), geo.degree_tiles(F.lit(-5.0), F.lit(50.0), F.lit(1.0), F.lit(52.0)), geo.lattice(F.lit(0.1), F.lit(0.1), F.lit(1.0), F.lit(0.6), 0.5))
    assert box[0]["west"] == -180 and abs(box[0]["north"] - 85.0511) < 1e-3 and box[1] == ["W5_N50", "E0_N50"] and len(box[2]) == 2


def test_near_everywhere(spark):
    """Cells hold at high latitudes and across the date line."""
    g = random.Random(5)
    left = [(i, g.choice([-89.9, -76.0, 0.0, 61.0, 75.5, 89.8]) + g.uniform(-0.1, 0.1), g.choice([-180.0, 179.9, 0.0]) + g.uniform(0, 0.09)) for i in range(150)]
    right = [(i, a + g.uniform(-0.05, 0.05), (b + g.uniform(-0.2, 0.2) + 180) % 360 - 180) for i, a, b in left[::3]]

    def metres(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        return 2 * 6371008.8 * math.asin(math.sqrt(min(1, math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2)))

    want = {(i, j): metres(a, b, c, d) for i, a, b in left for j, c, d in right}
    l, r = spark.createDataFrame(left, "lid long, llat double, llon double"), spark.createDataFrame(right, "rid long, rlat double, rlon double")  # noqa: E741
    assert {(x["lid"], x["rid"]) for x in spatial.candidates(l, r, 6000).collect()} == {k for k, m in want.items() if m <= 6000}
    assert {x["lid"] for x in spatial.near_semi(l, r, 6000).collect()} == {i for (i, _), m in want.items() if m <= 6000}
    best = {x["lid"]: x["rid"] for x in spatial.nearest(l, r, 6000).collect()}
    for i, *_ in left:
        near = min(((m, j) for (k, j), m in want.items() if k == i and m <= 6000), default=(None, None))
        assert best[i] == near[1]


def test_lines(spark):
    way = lambda points: [{"x": float(x), "y": float(y)} for x, y in points]
    g = random.Random(2)
    base = [(i, [(-2 + i * 0.05 + k * 0.0005, 52 + g.uniform(-1, 1) * 0.0002) for k in range(g.randrange(2, 12))]) for i in range(25)]
    rows = [*base, *((100 + i, [(x, y + 0.00006) for x, y in p]) for i, p in base[::2]), *((200 + i, p[: len(p) // 2 + 1]) for i, p in base[1::4]), (300, [(-2.0, 52.0)])]
    df = spark.createDataFrame([(k, way(p)) for k, p in rows], f"k long, line {geo.LINE}")
    want = set()
    known = [(k, np.array(p)) for k, p in rows if len(p) > 1]
    for i, (a, p) in enumerate(known):
        for b, q in known[i + 1 :]:
            m = lines.measure(p, q)
            if m[3] >= 0.85 and ((m[0] <= 15 and m[4] >= 0.5) or (m[1] <= 15 and m[5] >= 0.5)):
                want.add((min(a, b), max(a, b)))
    assert {(r["a"], r["b"]) for r in lines.twins(df, "k", "line").collect()} == want and len(want) >= 13
    bare = spark.createDataFrame([(1, way([(0, 0), (1, 0.01), (2, 0), (3, 2)])), (2, None)], f"k long, line {geo.LINE}").select("k", lines.simplified(F.col("line"), 0.1).alias("s"), lines.clipped(F.col("line"), 0.5, -1, 2.5, 0.5).alias("c")).orderBy("k").collect()
    assert [(p["x"], p["y"]) for p in bare[0]["s"]] == [(0, 0), (2, 0), (3, 2)] and bare[1]["s"] is None
    piece = bare[0]["c"][0]
    assert len(bare[0]["c"]) == 1 and (piece[0]["x"], piece[-1]["x"]) == (0.5, 2.25)
    run = lines.uncovered_runs(df.filter("k = 0"), df.filter("k = 1"), "k", "line").collect()
    assert len(run) == 1 and len(run[0]["points"]) == len(base[0][1])


def test_snapshots(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (4, None)], "o int, v string")
    new = spark.createDataFrame([(1, "a", 1), (3, "c", 1), (None, "n", None), (4, None, None)], "o int, v string, w int")
    assert {(r[0], r[1]) for r in cdc.snapshot_diff(old, new, "o").collect()} == {(2, "removed"), (3, "added"), (1, "changed")}
    assert {(r[0], r[1]) for r in cdc.snapshot_diff(old.select("o"), new.select("o"), "o").collect()} == {(2, "removed"), (3, "added")}
    digest = lambda df, *skip: cdc.content_digest(df, skip).first()[0]
    assert digest(new) == digest(new.orderBy(F.desc("v"))) != digest(new.filter("v IS NOT NULL")) and digest(new, "w") == digest(new.drop("w")) != digest(new.unionByName(new.limit(1)), "w")
    assert digest(old.limit(0)) != digest(old) and digest(old) != digest(old.select("o", F.coalesce("v", F.lit("")).alias("v")))
    numbers = cdc.stable_numbers(spark.createDataFrame([("b",), ("d",), ("c",)], "k string"), spark.createDataFrame([("a", 7), ("b", 3)], "k string, number long"), "k")
    assert {(r[0], r[1]) for r in numbers.collect()} == {("b", 3), ("c", 8), ("d", 9)}
    assert cdc.stable_numbers(old.select("o").limit(0), spark.createDataFrame([], "o int, number long"), "o").count() == 0
    keys = [random.Random(1).randrange(10**9) for _ in range(5000)]
    ranks = ranking.ranked(spark.createDataFrame([(k,) for k in keys], "k long"), "k").collect()
    assert [r["k"] for r in sorted(ranks, key=lambda r: r["rank"])] == sorted(keys) and sorted(r["rank"] for r in ranks) == list(range(1, 5001))


def test_restrictions(spark):
    place = {"type": "regulationLocation", "description": "here", "linearGeometry": {"linestring": "SRID=27700;LINESTRING(1 2,3 4)"}}
    regulation = {"condition": [{"timeValidity": {"start": "2026-01-01T00:00", "end": "2026-03-01"}}, {"timeValidity": {"start": "2025-12-01", "end": "2026-04-01"}}], "generalRegulation": {"regulationType": "miscRoadClosure"}}
    record = lambda **x: json.dumps({"source": {"reference": "R", "troName": "T", "traCreator": 5, "provision": {"regulation": {**regulation, **x}, "regulatedPlace": [place, {**place, "type": "diversionRoute"}, {"type": "regulationLocation"}, "odd"]}}})
    slot = {"condition": {"timeValidity": {"start": "2026-01-01", "isPlaceholderTro": True}}}
    rows = [(1, record()), (2, record(**slot)), (3, record(generalRegulation={"regulationType": "parking"})), (4, record(condition={"timeValidity": {"start": "2026-01-01"}})), (5, "broken"), (6, None), (7, "{}"), (8, record(generalRegulation=None, speedLimitValueBased={"mphValue": 20})), (9, record(condition=[{"timeValidity": {"start": "2026-12-01"}}]))]
    df = spark.createDataFrame(rows, "id int, body string")
    got = {r["id"]: r for r in orders.restrictions(df, "body", "2026-04-01", keep=("id",)).collect()}
    assert sorted(got) == [1, 4, 8] and (got[1]["start"], got[1]["end"], got[1]["tra"]) == ("2025-12-01", "2026-04-01", 5)
    assert got[4]["end"] is None and got[8]["label"] == "20 mph" and got[1]["wkt"].startswith("SRID")
    assert sorted(r["id"] for r in orders.restrictions(df, "body", "2026-04-02", keep=("id",)).collect()) == [4]
    assert sorted(r["id"] for r in orders.restrictions(df, "body", "2026-04-02", True, keep=("id",)).collect()) == [1, 4, 8, 9]
    shape = df.limit(1).select(geo.wkt(F.lit("SRID=27700;MULTILINESTRING((1 2,3 4),(5 6,7 8))")).alias("g"), geo.wkt(F.lit("SRID=4326;POINT(1 2)")).alias("h")).first()
    assert [len(p) for p in shape["g"]["parts"]] == [2, 2] and shape["h"] is None


def test_readings_and_gates(spark):
    rows = spark.sql("SELECT id % 2 AS k, TIMESTAMP'2026-01-01' + make_interval(0, 0, 0, 0, CAST(id * 5 AS INT)) AS at, CAST(id AS DOUBLE) AS v FROM range(40)")
    totals = readings.rolling_totals(rows, "k", "at", "v", 48, 6).orderBy("k", "edge").collect()
    seen = [(r["k"], r["at"], r["v"]) for r in rows.collect()]
    for r in totals:
        assert r["total"] == sum(v for k, t, v in seen if k == r["k"] and 0 <= (r["edge"] - t).total_seconds() <= 48 * 3600)
    assert readings.rolling_totals(rows.limit(0), "k", "at", "v").count() == 0 and {tuple(r) for r in readings.nearest_ranks(rows, "k", "v", (50,)).collect()} == {(0, 18.0), (1, 19.0)}
    assert readings.band_positions(rows, "v", {"damp": 10, "wet": 20}).collect()[0]["percentile"] == 25.0
    odd = spark.createDataFrame([("a&amp;b", "x", 1.0, 50.0), ("ok", "y", 500.0, 50.0), (None, "y", None, 50.0)], "t string, name string, lon double, lat double")
    assert [(r["column"], r["n"]) for r in gates.unclean(odd).collect()] == [("t", 1)] and {tuple(r) for r in gates.outside(odd, "name", "lon", "lat").collect()} == {("y", 2)}
    assert {tuple(r) for r in gates.repeated(odd, "name").collect()} == {("y", 2)} and gates.broken(odd, t=F.col("t").isNotNull()).collect()[0]["n"] == 1
    assert [r["name"] for r in gates.unknown_keys(odd, "name", odd.filter("name = 'x'").select(F.col("name").alias("code")), "code").collect()] == ["y"]


def _dbf(rows):
    head = struct.pack("<B3BIHH20x", 3, 26, 1, 1, len(rows), 32 + 32 + 1, 11) + b"NAME".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([10]) + b"\0" * 15 + b"\r"
    return head + b"".join(b" " + r.encode().ljust(10) for r in rows)


def test_readers_and_writers(spark, tmp_path):
    feature = {"type": "Feature", "properties": {"id": 1, "x": "é"}, "geometry": {"type": "LineString", "coordinates": [[-1.5, 52], [-1.4, 52.1, 9]]}}
    (tmp_path / "a.json").write_text(json.dumps({"type": "FeatureCollection", "features": [feature, {**feature, "geometry": {"type": "Point", "coordinates": [1, 2]}}, {**feature, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1]]]]}}, {**feature, "geometry": None}]}))
    (tmp_path / "b.json").write_text("not json")
    got = files.geojson(spark, str(tmp_path / "*.json")).collect()
    assert [(r["kind"], sum(map(len, r["parts"]))) for r in got] == [("LineString", 2), ("Point", 1), ("MultiPolygon", 3)] and json.loads(got[0]["properties"])["x"] == "é"
    (tmp_path / "c.csv").write_text('Id,Data\n1,"{""a"":\n""x""}"\n2,broken\n3,\n4,[1]\n')
    assert [r["corrupt"] for r in files.csv_records(spark, str(tmp_path / "c.csv")).orderBy("Id").collect()] == [False, True, True, True]
    (tmp_path / "d.kml").write_text("<kml><Placemark><name><![CDATA[A & B]]></name><LineString><coordinates>1,2,0 3,4,0</coordinates></LineString></Placemark><Placemark><Point><coordinates>5,6</coordinates></Point></Placemark></kml>")
    got = files.kml(spark, str(tmp_path / "d.kml")).collect()
    assert [(r["kind"], len(r["parts"][0])) for r in got] == [("LineString", 2), ("Point", 1)] and json.loads(got[0]["properties"])["name"] == "A & B"
    (tmp_path / "e.gml").write_text('<gml:featureMember><w:way><w:ref>7</w:ref><gml:posList srsDimension="2">1 2 3 4</gml:posList></w:way></gml:featureMember>')
    got = files.gml(spark, str(tmp_path / "e.gml")).first()
    assert json.loads(got["properties"])["ref"] == "7" and [(p["x"], p["y"]) for p in got["parts"][0]] == [(1, 2), (3, 4)]

    (tmp_path / "shp").mkdir()
    line = struct.pack("<i4d2i2i6d", 3, 0, 0, 9, 9, 2, 3, 0, 1, 1, 2, 3, 4, 5, 6)
    shapes = [struct.pack("<i2d", 1, 7.0, 8.0), line, struct.pack("<i", 0)]
    (tmp_path / "shp/w.shp").write_bytes(b"\0" * 100 + b"".join(struct.pack(">2i", i + 1, len(s) // 2) + s for i, s in enumerate(shapes)))
    (tmp_path / "shp/w.dbf").write_bytes(_dbf(["one", "two", "three"]))
    got = files.shapefiles(spark, str(tmp_path / "shp")).collect()
    assert [(r["kind"], [len(p) for p in r["parts"]], json.loads(r["properties"])["NAME"]) for r in got] == [("Point", [1], "one"), ("MultiLineString", [1, 2], "two")]

    con = sqlite3.connect(tmp_path / "f.gpkg")
    con.execute("CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT)")
    con.execute("CREATE TABLE ways (fid INTEGER, geom BLOB, name TEXT)")
    con.execute("INSERT INTO gpkg_geometry_columns VALUES ('ways', 'geom')")
    wkb = struct.pack("<BII6d", 1, 1002, 2, 1, 2, 0, 3, 4, 0)
    con.execute("INSERT INTO ways VALUES (1, ?, 'n')", (b"GP\0\x03" + struct.pack("<i4d", 4326, 1, 3, 2, 4) + wkb,))
    con.commit()
    con.close()
    got = files.geopackages(spark, str(tmp_path / "f.gpkg")).collect()
    assert [(r["kind"], [(p["x"], p["y"]) for p in r["parts"][0]]) for r in got] == [("LineString", [(1, 2), (3, 4)])] and json.loads(got[0]["properties"]) == {"fid": 1, "name": "n"}

    whole = files.geojson(spark, str(tmp_path / "a.json")).withColumn("area", F.col("kind"))
    sinks.write_geojson(whole, str(tmp_path / "out"), "area")
    back = [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert {f["geometry"]["type"]: f["geometry"]["coordinates"] for f in back}["MultiPolygon"] == [[[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0]]]] and len(back) == 3


def test_vector_tiles(spark):
    ways = spark.createDataFrame([(1, [{"x": -0.5, "y": 51.5}, {"x": 0.5, "y": 51.5}], "a", 3, True), (2, [{"x": -0.4, "y": 51.4}, {"x": -0.4, "y": 51.6}], None, -3, False)], f"id long, line {geo.LINE}, name string, n long, ok boolean")
    got = {(r["x"], r["y"]): bytes(r["tile"]) for r in sinks.vector_tiles(ways, "id", "line", ["name", "n", "ok"], 8, "ways").collect()}
    assert set(got) == {(127, 85), (128, 85)}

    def fields(b):
        at, out = 0, []
        def number():
            nonlocal at
            n = k = 0
            while True:
                n |= (b[at] & 127) << k
                at, k = at + 1, k + 7
                if b[at - 1] < 128:
                    return n
        while at < len(b):
            key = number()
            if key & 7 == 0:
                out.append((key >> 3, number()))
            else:
                size = number() if key & 7 == 2 else 8
                out.append((key >> 3, b[at : at + size]))
                at += size
        return out

    layer = fields(fields(got[127, 85])[0][1])
    assert dict(layer)[1] == b"ways" and dict(layer)[15] == 2 and dict(layer)[5] == 4096 and [k for k, _ in layer].count(2) == 2 and {v for k, v in layer if k == 3} == {b"name", b"n", b"ok"}


def test_catch_up(spark, tmp_path):
    feed = tmp_path / "feed"
    state = {"refuse": {"c"}}

    def hydrate(events):
        rows = F.when(F.col("id") == "e", 0).otherwise(F.when(F.col("id") == "b", 2).otherwise(1))
        out = events.select("id", F.explode(F.when(rows > 0, F.sequence(F.lit(1), rows)).otherwise(F.array().cast("array<int>"))).alias("part"))
        no = F.col("id").isin(list(state["refuse"]) or [""])
        return out.withColumn("body", F.concat("id", F.lit(state["refuse"] and "1" or "2"))).withColumn("refused", no)

    def run(*events):
        spark.createDataFrame(events, "id string, event_type string, at int").coalesce(1).write.mode("append").json(str(feed))
        job.start(spark.readStream.schema("id string, event_type string, at int").json(str(feed)), str(tmp_path / "ckpt")).awaitTermination()
        return {(r["id"], r["part"]) for r in job.rows().collect()}

    job = catch_up.CatchUp(spark, str(tmp_path / "home"), "id", "id string, part int, body string", hydrate, tries=2)
    assert run(("a", "create", 1), ("b", "create", 1), ("c", "create", 1), ("d", "create", 1), ("d", "delete", 1), (None, "create", 1)) == {("a", 1), ("b", 1), ("b", 2)}
    assert [tuple(r) for r in job.refused().collect()] == [("c", 1, False)]
    state["refuse"] = set()
    assert run(("a", "delete", 2), ("e", "update", 2)) == {("b", 1), ("b", 2), ("c", 1)} and job.refused().count() == 0
    before = job.rows().collect()
    job.apply(spark.createDataFrame([("b", "delete", 9)], "id string, event_type string, at int"), 1)  # a batch that already stands
    assert sorted(map(str, job.rows().collect())) == sorted(map(str, before))
    state["refuse"] = {"f"}
    run(("f", "create", 3))
    run(("a", "create", 4))
    assert [tuple(r) for r in job.refused().collect()] == [("f", 2, True)] and ("a", 1) in {(r["id"], r["part"]) for r in job.rows().collect()}


def test_windowed_stream(spark, tmp_path):
    spark.sql("SELECT id % 2 AS k, TIMESTAMP'2026-01-01' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS at, 1.0D AS v FROM range(60)").write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("k long, at timestamp, v double").json(str(tmp_path / "in"))
    q = catch_up.windowed_totals(stream, "k", "at", "v").writeStream.format("memory").queryName("totals").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.table("totals").filter("start >= '2026-01-01' AND k = 0").collect()
    assert got and all(r["total"] == 24 for r in got)
