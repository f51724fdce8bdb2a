"""Map extracts and tile archives: hand-made files, exact round trips, broken files."""

import struct
import zlib

import pytest
from pyspark.sql import functions as F

from waymeld.sources import archives, osm
from waymeld.sources.sinks import _field, _number, _zig


def _packed(k, values, sign=True):
    return _field(k, b"".join(_number(_zig(v) if sign else v) for v in values))


def _deltas(values):
    return [b - a for a, b in zip([0] + values, values)]


def _blob(kind, body, squeeze=True):
    blob = _number(2 << 3) + _number(len(body)) + _field(3, zlib.compress(body)) if squeeze else _field(1, body)
    head = _field(1, kind) + _number(3 << 3) + _number(len(blob))
    return struct.pack(">I", len(head)) + head + blob


def _extract(path):
    strings = ["", "highway", "track", "barrier", "gate", "designation", "restricted_byway", "surface", "mud", "motorway"]
    table = _field(1, b"".join(_field(1, s.encode()) for s in strings))
    # Five dense nodes, of which the second is a gate; one plain node; three ways.
    ids, lats, lons = [10, 11, 12, 13, 9_000_000_000], [500000000, 500010000, 500020000, 600000000, 600010000], [-10000000, -10000000, -10010000, 20000000, 20010000]
    dense = _field(2, _packed(1, _deltas(ids)) + _packed(8, _deltas(lats)) + _packed(9, _deltas(lons)) + _packed(10, [0, 3, 4, 0, 0, 0, 0], sign=False))
    plain = _field(1, _number(1 << 3) + _number(_zig(77)) + _packed(2, [3], False) + _packed(3, [4], False) + _number(8 << 3) + _number(_zig(500005000)) + _number(9 << 3) + _number(_zig(-10000000)))
    way = lambda i, tags, refs: _field(3, _number(1 << 3) + _number(i) + _packed(2, [k for k, _ in tags], False) + _packed(3, [v for _, v in tags], False) + _packed(8, _deltas(refs)))
    ways = way(1, [(1, 2), (5, 6), (7, 8)], [10, 11, 12, 13, 555]) + way(2, [(1, 2)], [13, 9_000_000_000]) + way(3, [(1, 9)], [10, 11])
    path.write_bytes(_blob(b"OSMHeader", b"") + _blob(b"OSMData", table + _field(2, dense) + _field(2, plain)) + _blob(b"OSMData", table + _field(2, ways), squeeze=False))
    return str(path)


def test_extract(spark, tmp_path):
    path = _extract(tmp_path / "a.osm.pbf")
    nodes, ways = osm.nodes(spark, path, parts=2).cache(), osm.ways(spark, path, parts=2).cache()
    got = {r["id"]: (round(r["lat"], 7), round(r["lon"], 7), r["tags"]) for r in nodes.collect()}
    assert got == {10: (50.0, -1.0, {}), 11: (50.001, -1.0, {"barrier": "gate"}), 12: (50.002, -1.001, {}), 13: (60.0, 2.0, {}), 9_000_000_000: (60.001, 2.001, {}), 77: (50.0005, -1.0, {"barrier": "gate"})}
    assert {r["id"]: r["refs"] for r in ways.collect()} == {1: [10, 11, 12, 13, 555], 2: [13, 9_000_000_000], 3: [10, 11]}
    box = (-2.0, 49.0, 0.0, 51.0)
    found = osm.roads(nodes, ways, box).collect()
    assert [(r["id"], r["tags"]["surface"], [round(p["y"], 4) for p in r["line"]]) for r in found] == [(1, "mud", [50.0, 50.001, 50.002, 60.0])]
    assert {r["id"] for r in osm.barriers(nodes, box).collect()} == {11, 77}
    assert [r["id"] for r in osm.designated(ways).collect()] == [1]
    whole = (tmp_path / "a.osm.pbf").read_bytes()
    (tmp_path / "cut.osm.pbf").write_bytes(whole[:-5])
    with pytest.raises(Exception, match="cut off"):
        osm.ways(spark, str(tmp_path / "cut.osm.pbf")).collect()
    (tmp_path / "none.osm.pbf").write_bytes(b"")
    assert osm.nodes(spark, str(tmp_path / "none.osm.pbf")).count() == 0


def test_numbers():
    values = [0, 1, 127, 128, 300, 2**31, 2**62]
    assert osm.numbers(b"".join(map(_number, values))).tolist() == values
    assert osm.signed(osm.numbers(b"".join(_number(_zig(v)) for v in (0, -1, 1, -(2**40), 2**40)))).tolist() == [0, -1, 1, -(2**40), 2**40]
    assert osm.numbers(b"").tolist() == []


def test_tile_numbers(spark):
    rows = spark.range(4**0 + 4 + 16 + 64 + 256).collect()
    from waymeld.functions import geo

    given = spark.createDataFrame([(r[0], *archives.tile_of(r[0])) for r in rows], "n bigint, z int, x bigint, y bigint")
    assert given.filter(geo.hilbert_id(F.col("z"), F.col("x"), F.col("y")) != F.col("n")).count() == 0


def _tiles(spark, zoom, body):
    side = 2**zoom
    return spark.range(side * side).select(F.lit(zoom).alias("z"), (F.col("id") % side).alias("x"), F.floor(F.col("id") / side).alias("y")).withColumn("tile", body)


def test_archive_round_trip(spark, tmp_path):
    # Water in the west is one tile stored once; a null tile is none.
    body = F.when(F.col("x") < 4, F.lit("water").cast("binary")).when(F.col("x") == 9, F.lit(None).cast("binary")).otherwise(F.concat_ws("/", "x", "y").cast("binary"))
    tiles = _tiles(spark, 4, body).unionByName(_tiles(spark, 2, F.lit("coarse").cast("binary"))).cache()
    path = str(tmp_path / "a.pmtiles")
    entries, stored = archives.write_archive(tiles, path, (-5.0, 50.0, 1.0, 55.0), {"name": "a"})
    want = {(r["z"], r["x"], r["y"], bytes(r["tile"])) for r in tiles.filter("tile IS NOT NULL").collect()}
    assert stored == len({b for *_, b in want}) and entries < len(want)
    assert archives.problems(path) == []
    read = archives.read_archives(spark, path, parts=2).collect()
    assert {(r["z"], r["x"], r["y"], bytes(r["tile"])) for r in read} == want and len(read) == len(want)
    with pytest.raises(ValueError):
        archives.write_archive(tiles.filter("z = 99"), path, (0, 0, 1, 1), {})


def test_archive_with_leaves(spark, tmp_path):
    # 65,536 tiles of odd lengths: the root could not hold them.
    body = F.repeat(F.hex(F.xxhash64("x", "y")), (F.pmod(F.xxhash64("y", "x"), F.lit(5)) + 1).cast("int")).cast("binary")
    tiles = _tiles(spark, 8, body).cache()
    path, again = str(tmp_path / "b.pmtiles"), str(tmp_path / "c.pmtiles")
    archives.write_archive(tiles, path, (-180.0, -85.0, 180.0, 85.0), {})
    assert archives.problems(path) == []
    same = lambda p: archives.read_archives(spark, p).select("z", "x", "y", "tile")
    assert same(path).exceptAll(tiles).count() == 0 and tiles.select("z", "x", "y", "tile").exceptAll(same(path)).count() == 0
    assert archives.repack(spark, path, again) > 0
    assert archives.problems(again) == [] and same(again).exceptAll(tiles).count() == 0 and same(again).count() == 65536


def test_broken_archives(tmp_path):
    p = tmp_path / "x"
    for body, said in ((b"", "shorter than a header"), (b"x" * 200, "no tile archive"), (b"PMTiles\x02" + bytes(130), "version 2 instead of 3")):
        p.write_bytes(body)
        assert archives.problems(str(p)) == [said]
    p.write_bytes(b"PMTiles\x03" + struct.pack("<8Q", 127, 20000, 0, 0, 0, 0, 127, 0) + bytes(60))
    assert archives.problems(str(p)) == ["root runs past the end of the file", "root directory ends past byte 16384", "data is empty"]
    assert archives.entries_of(archives.directory([(3, 0, 5, 2), (9, 5, 7, 1), (10, 0, 5, 1)])) == [(3, 0, 5, 2), (9, 5, 7, 1), (10, 0, 5, 1)]
