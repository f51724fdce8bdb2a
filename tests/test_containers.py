"""Containers written and read back, tiles that coalesce, the lowest zoom that fits."""

import json
import sqlite3

from pyspark.sql import functions as F
from test_physical import LINE, table, way

from waymeld.sources import sinks


def test_containers(spark, tmp_path):
    rows = [("b", "north/east", 1.5, True, way((0, 0), (100, 50))), ("a", "north/east", None, None, way((-10, 0), (0, 0), (5, 5))), ("c", "south", 2.0, False, None), ("d", None, 1.0, True, way((0, 0), (1, 1))), ("a", "south", 3.0, True, [])]
    ways = table(spark, rows, f"uid string, area string, km double, open boolean, line {LINE}")
    folder = str(tmp_path / "out")
    made = {r["area"]: r for r in sinks.write_containers(ways, folder, "area", "uid", "line", {"schema": "1"}).collect()}
    assert {k: r["rows"] for k, r in made.items()} == {"north/east": 2, "south": 2}
    back = sinks.read_containers(spark, *[r["path"] for r in made.values()]).collect()
    got = {(r["path"].rsplit("/", 1)[1], json.loads(r["properties"])["uid"]): r for r in back}
    assert set(got) == {("north%2Feast.sqlite", "a"), ("north%2Feast.sqlite", "b"), ("south.sqlite", "c"), ("south.sqlite", "a")}
    one = got[("north%2Feast.sqlite", "b")]
    assert json.loads(one["properties"]) == {"id": 2, "uid": "b", "km": 1.5, "open": 1} and one["boxed"] and [(p["x"], p["y"]) for p in one["line"]] == [(round(x, 7), round(y, 7)) for x, y in rows[0][4]]
    assert not got[("south.sqlite", "a")]["boxed"] and not got[("south.sqlite", "c")]["boxed"]
    con = sqlite3.connect(made["north/east"]["path"])
    assert dict(con.execute("SELECT * FROM meta")) == {"schema": "1", "area": "north/east", "rows": "2"}
    west = way((0, 0))[0][0]
    assert con.execute("SELECT id FROM ways_rtree WHERE west <= ? AND east >= ?", (west - 1e-4, west - 1e-4)).fetchall() == [(1,)]
    con.close()
    # The same rows make the same files, whatever their order.
    again = {r["area"]: r["sha256"] for r in sinks.write_containers(ways.orderBy(F.desc("km")), folder, "area", "uid", "line", {"schema": "1"}).collect()}
    assert again == {k: r["sha256"] for k, r in made.items()}
    assert sinks.write_containers(ways.filter("false"), folder, "area", "uid", "line", {}).count() == 0


def test_coalesced_tiles(spark):
    ways = table(spark, [(i, "boat" if i % 2 else "path", way((i * 30, 0), (i * 30, 800))) for i in range(40)], f"uid long, class string, line {LINE}")
    apart = sinks.vector_tiles(ways, "uid", "line", ["class"], 10, "lanes").collect()
    alike = sinks.vector_tiles(ways, "uid", "line", ["class"], 10, "lanes", coalesce=True).collect()
    assert {(r["x"], r["y"]) for r in apart} == {(r["x"], r["y"]) for r in alike} and sum(len(r["tile"]) for r in alike) < sum(len(r["tile"]) for r in apart)
    sizes = {z: max(len(r["tile"]) for r in sinks.vector_tiles(ways, "uid", "line", ["class"], z, "lanes", coalesce=True).collect()) for z in (8, 9, 10, 14)}
    assert sinks.lowest_zoom(ways, "uid", "line", ["class"], 8, 10, "lanes", most=max(sizes[8], sizes[9], sizes[10])) == 8
    assert sinks.lowest_zoom(ways, "uid", "line", ["class"], 8, 10, "lanes", most=1) == 11
