"""Writers: GeoJSON collections and SQLite containers, a file per group, and vector tiles as binary columns."""

from __future__ import annotations

import hashlib
import json
import sqlite3
import struct
import uuid
from urllib.parse import quote

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymeld.functions import geo

#: Bytes that a tile may have.
MOST_TILE = 512 * 1024


def feature_json(properties: Column, kind: Column, parts: Column) -> Column:
    """A GeoJSON feature as text. properties is JSON text; parts are lines."""
    point = lambda p: F.array(p["x"], p["y"])
    lines = F.transform(parts, lambda line: F.transform(line, point))
    xy = F.when(kind == "Point", F.to_json(F.get(F.get(lines, 0), 0))).when(kind.isin("LineString", "MultiPoint"), F.to_json(F.get(lines, 0))).when(kind == "MultiPolygon", F.to_json(F.transform(lines, lambda r: F.array(r)))).otherwise(F.to_json(lines))
    return F.concat(F.lit('{"type":"Feature","properties":'), F.coalesce(properties, F.lit("{}")), F.lit(',"geometry":{"type":"'), kind, F.lit('","coordinates":'), xy, F.lit("}}"))


def write_geojson(features: DataFrame, path: str, by: str) -> None:
    """A folder per value of `by` with GeoJSON text sequences, one feature a line, which any number of tasks write side by side."""
    rows = features.select(F.col(by).alias("_by"), feature_json(F.col("properties"), F.col("kind"), F.col("parts")).alias("value"))
    rows.write.mode("overwrite").partitionBy("_by").text(path)


def _number(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(k: int, body: bytes) -> bytes:
    return _number(k << 3 | 2) + _number(len(body)) + body


def _zig(n: int) -> int:
    return n << 1 if n >= 0 else -n * 2 - 1


def tile(layer: str, features: list[tuple[int, list[list[tuple[int, int]]], dict]], extent: int = 4096) -> bytes:
    """A vector tile of one layer of lines. features: id, lines in tile units, attributes (texts, whole numbers, floats, truth values)."""
    keys: dict[str, int] = {}
    values: dict[bytes, int] = {}
    body = bytearray()
    for uid, lines, props in features:
        tags, shape, x, y = [], [], 0, 0
        for k, v in props.items():
            if v is not None:
                kind = _number(7 << 3) + _number(int(v)) if isinstance(v, bool) else _number(6 << 3) + _number(_zig(v)) if isinstance(v, int) else _number(3 << 3 | 1) + struct.pack("<d", v) if isinstance(v, float) else _field(1, str(v).encode())
                tags += [keys.setdefault(k, len(keys)), values.setdefault(kind, len(values))]
        for line in lines:
            steps = [(a, b) for i, (a, b) in enumerate(line) if i == 0 or (a, b) != line[i - 1]]
            if len(steps) < 2:
                continue
            shape += [1 << 3 | 1, _zig(steps[0][0] - x), _zig(steps[0][1] - y), (len(steps) - 1) << 3 | 2]
            x, y = steps[0]
            for a, b in steps[1:]:
                shape += [_zig(a - x), _zig(b - y)]
                x, y = a, b
        if shape:
            body += _field(2, _number(1 << 3) + _number(uid) + _field(2, b"".join(map(_number, tags))) + _number(3 << 3) + _number(2) + _field(4, b"".join(map(_number, shape))))
    head = _number(15 << 3) + _number(2) + _field(1, layer.encode())
    tail = b"".join(_field(3, k.encode()) for k in keys) + b"".join(_field(4, v) for v in values) + _number(5 << 3) + _number(extent)
    return _field(3, head + bytes(body) + tail) if body else b""


def vector_tiles(features: DataFrame, uid: str, line: str, props: list[str], zoom: int, layer: str, extent: int = 4096, margin: int = 64, coalesce: bool = False) -> DataFrame:
    """z, x, y, tile: lines cut into the tiles they touch and encoded, empty tiles left out.

    `coalesce` makes one feature of all lines of a tile that are alike in `props`, with the least of their ids: for far
    zooms, where single lines are not told apart. Lines are dealt to tiles and clipped there before tiles are gathered, so a task holds one tile's pieces at a time.
    """
    cut = features.select(F.col(uid).alias("id"), F.col(line).alias("line"), F.struct(*[F.col(c) for c in props] or [F.lit(None).alias("_")]).alias("props"), F.explode(geo.tiles_touched(F.col(line), zoom)).alias("t"))
    scaled = lambda p: F.struct(((geo.tile_x(p["x"], zoom) - F.col("t.x")) * extent).alias("x"), ((geo.tile_y(p["y"], zoom) - F.col("t.y")) * extent).alias("y"))
    from waymeld.operators.lines import clipped

    pieces = cut.select("id", "props", F.col("t.x").alias("x"), F.col("t.y").alias("y"), clipped(F.transform("line", scaled), -margin, -margin, extent + margin, extent + margin).alias("lines")).filter(F.size("lines") > 0).withColumn("lines", geo.boxed(F.col("lines")))

    def encode(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values("id", kind="stable")
        found = [(int(i), [[(round(p["x"]), round(p["y"])) for p in part["p"]] for part in lines], {k: v for k, v in p.items() if k != "_"}) for i, lines, p in zip(rows["id"], rows["lines"], rows["props"])]
        if coalesce:
            alike: dict = {}
            for i, lines, p in found:
                alike.setdefault(tuple(p.items()), (i, [], p))[1].extend(lines)
            found = list(alike.values())
        body = tile(layer, found, extent)
        return pd.DataFrame([(zoom, int(rows["x"].iloc[0]), int(rows["y"].iloc[0]), body)] if body else [], columns=["z", "x", "y", "tile"])

    return pieces.groupBy("x", "y").applyInPandas(encode, "z int, x bigint, y bigint, tile binary")


def lowest_zoom(features: DataFrame, uid: str, line: str, props: list[str], low: int, high: int, layer: str, most: int = MOST_TILE) -> int:
    """The lowest zoom from which on every tile up to `high` has at most `most` bytes; high + 1 if there is none.

    Tiles do not shrink evenly from zoom to zoom, so all are measured, each zoom once.
    """
    worst = {z: vector_tiles(features, uid, line, props, z, layer, coalesce=True).agg(F.max(F.length("tile"))).first()[0] or 0 for z in range(low, high + 1)}
    fits = high + 1
    while fits > low and worst[fits - 1] <= most:
        fits -= 1
    return fits


_SQL = {"bigint": "INTEGER", "int": "INTEGER", "boolean": "INTEGER", "double": "REAL", "float": "REAL", "binary": "BLOB"}


def write_containers(ways: DataFrame, folder: str, by: str, uid: str, line: str, meta: dict[str, str]) -> DataFrame:
    """Writes a SQLite container per value of `by` and returns by, path, rows, sha256 of each.

    Table `ways` has a whole-number id, all plain columns and the packed line; `ways_rtree` the box of each id, which holds
    exactly the rows with a line; `meta` the given pairs. Rows are in order of uid, so equal rows make equal files. A
    container is made by one task in memory, as it is one file, and stands under its name only when it is complete.
    """
    plain = [c for c, kind in ways.dtypes if c not in (by, line) and not kind.startswith(("array", "map", "struct"))]
    kinds = dict(ways.dtypes)
    box = lambda f, c: f(F.transform(line, lambda p: p[c]))
    rows = ways.filter(F.col(by).isNotNull()).select(F.col(by).cast("string").alias("_by"), *plain, geo.pack_lines(F.array(line)).alias("geometry"), box(F.array_min, "x").alias("_w"), box(F.array_max, "x").alias("_e"), box(F.array_min, "y").alias("_s"), box(F.array_max, "y").alias("_n"))
    sql = ", ".join(f'"{c}" {_SQL.get(kinds[c], "TEXT")}' for c in plain)

    def build(group: pd.DataFrame) -> pd.DataFrame:
        name = group["_by"].iloc[0]
        group = group.sort_values(uid, kind="stable").reset_index(drop=True)
        con = sqlite3.connect(":memory:")
        con.execute(f"CREATE TABLE ways (id INTEGER PRIMARY KEY, {sql}, geometry BLOB)")
        con.execute("CREATE VIRTUAL TABLE ways_rtree USING rtree(id, west, east, south, north)")
        con.execute("CREATE TABLE meta (key TEXT PRIMARY KEY, value TEXT)")
        con.executemany("INSERT INTO meta VALUES (?, ?)", sorted({**meta, by: name, "rows": str(len(group))}.items()))
        clean = lambda v: None if v is None or v is pd.NaT or (isinstance(v, float) and v != v) else v.item() if hasattr(v, "item") else v if isinstance(v, (int, float, bytes, str)) else str(v)
        con.executemany(f"INSERT INTO ways VALUES ({', '.join('?' * (len(plain) + 2))})", ([i + 1, *map(clean, r)] for i, r in enumerate(group[[*plain, "geometry"]].itertuples(index=False, name=None))))
        con.executemany("INSERT INTO ways_rtree VALUES (?, ?, ?, ?, ?)", ([i + 1, *r] for i, r in enumerate(group[["_w", "_e", "_s", "_n"]].itertuples(index=False, name=None)) if r[0] == r[0]))
        con.commit()
        body = con.serialize()
        con.close()
        files, inner = pafs.FileSystem.from_uri(f"{folder}/{quote(name, safe='')}.sqlite")
        files.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        part = f"{inner}.{uuid.uuid4().hex}"
        with files.open_output_stream(part) as out:
            out.write(body)
        files.move(part, inner)
        return pd.DataFrame([(name, f"{folder}/{quote(name, safe='')}.sqlite", len(group), hashlib.sha256(body).hexdigest())], columns=["by", "path", "rows", "sha256"])

    done = rows.groupBy("_by").applyInPandas(build, "by string, path string, rows bigint, sha256 string").collect()
    return ways.sparkSession.createDataFrame([tuple(r) for r in done], f"{by} string, path string, rows bigint, sha256 string")


def read_containers(spark, *paths: str) -> DataFrame:
    """path, uid columns as JSON text (`properties`), line, boxed (whether the container's index has the row) of written containers."""
    def read(batches):
        for batch in batches:
            for path in batch["path"]:
                files, inner = pafs.FileSystem.from_uri(path)
                con = sqlite3.connect(":memory:")
                with files.open_input_file(inner) as f:
                    con.deserialize(f.read())
                found = con.execute("SELECT w.*, r.id IS NOT NULL AS _boxed FROM ways w LEFT JOIN ways_rtree r ON r.id = w.id ORDER BY w.id")
                names = [c[0] for c in found.description]
                while some := found.fetchmany(10_000):
                    each = [dict(zip(names, r)) for r in some]
                    yield pd.DataFrame([(path, r.pop("geometry"), bool(r.pop("_boxed")), json.dumps({k: v for k, v in r.items() if not isinstance(v, bytes)})) for r in each], columns=["path", "geometry", "boxed", "properties"])
                con.close()

    given = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    rows = given.mapInPandas(read, "path string, geometry binary, boxed boolean, properties string")
    return rows.select("path", "properties", F.get(geo.unpack_lines("geometry"), 0).alias("line"), "boxed")
