"""Distances, grids, tiles and well-known text. Lines are arrays of points with x (longitude) and y (latitude)."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Mean radius in metres and metres of a degree, as distances along lines take them. Fixed values.
EARTH_M, LON_M, LAT_M = 6371008.8, 111320.0, 110574.0
#: Airy 1830 and WGS84 axes; scale, true and false origin of the national grid; shifts, turns (seconds) and scale of the datum change. Fixed values.
AIRY, WGS = (6377563.396, 6356256.909), (6378137.0, 6356752.314245)
F0, LAT0, LON0, E0, N0 = 0.9996012717, math.radians(49.0), math.radians(-2.0), 400000.0, -100000.0
SHIFT, TURN, PPM = (446.448, -125.157, 542.060), (0.1502, 0.2470, 0.8421), -20.4894e-6
#: The grid's box in metres and Britain's in degrees. Fixed values.
GRID_BOX, GB_BOX = (0.0, 0.0, 800000.0, 1400000.0), (-9.0, 49.0, 2.5, 61.5)
LINE = "array<struct<x:double,y:double>>"
_NUMBER = T.DoubleType()
LINE_TYPE = T.ArrayType(T.StructType([T.StructField("x", _NUMBER), T.StructField("y", _NUMBER)]))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def flat_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Kilometres on a plane that is true at the mean latitude: for near points."""
    x = F.radians(lon2 - lon1) * F.cos(F.radians((lat1 + lat2) / 2))
    return EARTH_M / 1000 * F.sqrt(x * x + F.pow(F.radians(lat2 - lat1), 2))


def metres(p: Column) -> Column:
    """A point in local metres; lengths along a meridian or parallel come out true."""
    return F.struct((p["x"] * LON_M * F.cos(F.radians(p["y"]))).alias("x"), (p["y"] * LAT_M).alias("y"))


def segment_m(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance of a point to a segment, all in metres."""
    dx, dy = bx - ax, by - ay
    ll = dx * dx + dy * dy
    t = F.when(ll == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - ax) * dx + (py - ay) * dy) / F.nullif(ll, F.lit(0.0)))))
    return F.sqrt(F.pow(px - (ax + t * dx), 2) + F.pow(py - (ay + t * dy), 2))


def beside_m(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column, slack: float = 2.0) -> Column:
    """Distance of a point to a segment where it lies square across from it; null beyond its ends by more than `slack`."""
    dx, dy = bx - ax, by - ay
    t, over = ((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy), F.lit(slack) / F.sqrt(dx * dx + dy * dy)
    return F.when((t >= -over) & (t <= 1 + over), segment_m(px, py, ax, ay, bx, by))


def axis(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Bearing of a segment without direction, 0 to 180 degrees."""
    return F.pmod(F.degrees(F.atan2(by - ay, bx - ax)), F.lit(180.0))


def turn(a: Column, b: Column) -> Column:
    """Angle between two axes, 0 to 90 degrees."""
    d = F.pmod(F.abs(a - b), F.lit(180.0))
    return F.least(d, 180.0 - d)


def length_m(line: Column) -> Column:
    """Metres along a line; 0 for a point or none."""
    pts = F.transform(line, metres)
    legs = F.zip_with(F.slice(pts, F.lit(1), F.greatest(F.size(pts) - 1, F.lit(0))), F.slice(pts, F.lit(2), F.greatest(F.size(pts) - 1, F.lit(0))), lambda a, b: F.sqrt(F.pow(b["x"] - a["x"], 2) + F.pow(b["y"] - a["y"], 2)))
    return F.aggregate(legs, F.lit(0.0), lambda s, d: s + d)


def tile_x(lon: Column, zoom: Column | int) -> Column:
    """Web-mercator tile column, with its fraction."""
    return (lon + 180.0) / 360.0 * F.pow(F.lit(2.0), F.lit(zoom) if isinstance(zoom, int) else zoom)


def tile_y(lat: Column, zoom: Column | int) -> Column:
    """Web-mercator tile row, with its fraction."""
    r = F.radians(lat)
    return (1.0 - F.log(F.tan(r) + 1.0 / F.cos(r)) / math.pi) / 2.0 * F.pow(F.lit(2.0), F.lit(zoom) if isinstance(zoom, int) else zoom)


def tile_box(z: Column, x: Column, y: Column) -> Column:
    """(west, south, east, north) of a tile."""
    n = F.pow(F.lit(2.0), z)
    lat = lambda row: F.degrees(F.atan(F.sinh(math.pi * (1 - 2 * row / n))))
    return F.struct((x / n * 360.0 - 180.0).alias("west"), lat(y + 1).alias("south"), ((x + 1) / n * 360.0 - 180.0).alias("east"), lat(y).alias("north"))


def tiles_touched(line: Column, zoom: int) -> Column:
    """Tiles (x, y) of the box around each segment of a line, each once."""
    at = F.transform(line, lambda p: F.struct(F.floor(tile_x(p["x"], zoom)).alias("x"), F.floor(tile_y(p["y"], zoom)).alias("y")))
    legs = F.zip_with(at, F.slice(at, F.lit(2), F.size(at)), lambda a, b: F.struct(a.alias("a"), F.coalesce(b, a).alias("b")))
    span = lambda a, b: F.sequence(F.least(a, b), F.greatest(a, b))
    return F.array_distinct(F.flatten(F.transform(legs, lambda s: F.flatten(F.transform(span(s["a"]["x"], s["b"]["x"]), lambda x: F.transform(span(s["a"]["y"], s["b"]["y"]), lambda y: F.struct(x.alias("x"), y.alias("y")))))))) 


def hilbert_id(z: Column, x: Column, y: Column) -> Column:
    """Number of a tile in zoom order, along a Hilbert curve within the zoom; zooms up to 26."""
    before = ((F.pow(F.lit(4.0), z) - 1) / 3).cast("long")
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("d"))

    def step(a: Column, bit: Column) -> Column:
        s = F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int"))
        rx, ry = F.when(a["x"].bitwiseAND(s) > 0, 1).otherwise(0), F.when(a["y"].bitwiseAND(s) > 0, 1).otherwise(0)
        flip = (ry == 0) & (rx == 1)
        fx, fy = F.when(flip, s - 1 - a["x"].bitwiseAND(s - 1)).otherwise(a["x"].bitwiseAND(s - 1)), F.when(flip, s - 1 - a["y"].bitwiseAND(s - 1)).otherwise(a["y"].bitwiseAND(s - 1))
        quarter = F.when((rx == 0) & (ry == 0), 0).when(rx == 0, 1).when(ry == 1, 2).otherwise(3)
        return F.struct(F.when(ry == 0, fy).otherwise(fx).alias("x"), F.when(ry == 0, fx).otherwise(fy).alias("y"), (a["d"] + s * s * quarter).alias("d"))

    bits = F.when(z > 0, F.sequence(z.cast("int") - 1, F.lit(0), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    return before + F.aggregate(bits, start, step, lambda a: a["d"])


def degree_tile(lon: Column, lat: Column) -> Column:
    """Name of the tile of five by five degrees that holds a point, by its lower left corner."""
    w, s = F.floor(lon / 5) * 5, F.floor(lat / 5) * 5
    return F.concat(F.when(w >= 0, "E").otherwise("W"), F.abs(w).cast("string"), F.lit("_"), F.when(s >= 0, "N").otherwise("S"), F.abs(s).cast("string"))


def degree_tiles(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Names of all such tiles that a box touches."""
    corners = lambda a, b: F.sequence((F.floor(a / 5) * 5).cast("int"), (F.floor(b / 5) * 5).cast("int"), F.lit(5))
    return F.flatten(F.transform(corners(south, north), lambda s: F.transform(corners(west, east), lambda w: degree_tile(w, s))))


def lattice(west: Column, south: Column, east: Column, north: Column, step: float) -> Column:
    """Points (x, y) inside a box of a lattice that all boxes share."""
    along = lambda a, b: F.when(F.ceil(a / step) <= F.floor(b / step), F.sequence(F.ceil(a / step), F.floor(b / step))).otherwise(F.array().cast("array<bigint>"))
    return F.flatten(F.transform(along(south, north), lambda j: F.transform(along(west, east), lambda i: F.struct((i * step).alias("x"), (j * step).alias("y")))))


def terrarium_m(r: Column, g: Column, b: Column) -> Column:
    """Height in metres that a picture's colours stand for."""
    return r * 256.0 + g + b / 256.0 - 32768.0


def stable_id(uid: Column) -> Column:
    """A positive 63-bit number from a text's digest."""
    return F.shiftrightunsigned(F.conv(F.substring(F.sha2(uid, 256), 1, 16), 16, -10).cast("bigint"), 1)


def in_box(x: Column, y: Column, box: tuple = GB_BOX) -> Column:
    return x.between(box[0], box[2]) & y.between(box[1], box[3])


def wkt(text: Column) -> Column:
    """'SRID=27700;KIND(...)' as (kind, parts: lines of x, y); another reference system or form is null.

    The parts of the multi forms stay apart, and a polygon's rings are read as one run of points.
    """
    p = r"(?is)^\s*SRID=(\d+);\s*([A-Z]+)\s*(?:Z|M|ZM)?\s*(\(.*\))\s*$"
    kind, body = F.upper(F.regexp_extract(text, p, 2)), F.regexp_extract(text, p, 3)
    many = F.startswith(kind, F.lit("MULTI")) | (kind == "GEOMETRYCOLLECTION")
    runs = F.when(many, F.regexp_extract_all(body, F.lit(r"\(([^()]*)\)"), F.lit(1))).otherwise(F.array(F.translate(body, "()", "  ")))
    pair = lambda c: F.split(F.trim(c), r"\s+")
    point = lambda c: F.struct(F.get(pair(c), 0).try_cast("double").alias("x"), F.get(pair(c), 1).try_cast("double").alias("y"))
    read = lambda run: F.filter(F.transform(F.split(run, ","), point), lambda q: q["x"].isNotNull() & q["y"].isNotNull())
    parts = F.filter(F.transform(runs, read), lambda r: F.size(r) > 0)
    return F.when((F.regexp_extract(text, p, 1) == "27700") & (F.size(parts) > 0), F.struct(kind.alias("kind"), parts.alias("parts")))


def _to_lonlat(e: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grid metres to longitude and latitude: inverse transverse Mercator, then the seven-parameter datum change."""
    a, b = AIRY
    e2, k = (a * a - b * b) / (a * a), (a - b) / (a + b)
    arc = lambda t: b * F0 * ((1 + k + 1.25 * k**2 + 1.25 * k**3) * (t - LAT0) - (3 * k + 3 * k**2 + 2.625 * k**3) * np.sin(t - LAT0) * np.cos(t + LAT0)
                              + (1.875 * k**2 + 1.875 * k**3) * np.sin(2 * (t - LAT0)) * np.cos(2 * (t + LAT0)) - 35 / 24 * k**3 * np.sin(3 * (t - LAT0)) * np.cos(3 * (t + LAT0)))
    foot = LAT0 + (n - N0) / (a * F0)
    for _ in range(10):
        foot = foot + (n - N0 - arc(foot)) / (a * F0)
    s, t = np.sin(foot), np.tan(foot)
    nu = a * F0 / np.sqrt(1 - e2 * s * s)
    rho = a * F0 * (1 - e2) / (1 - e2 * s * s) ** 1.5
    eta2, d, sec = nu / rho - 1, e - E0, 1 / np.cos(foot)
    lat = foot - d**2 * t / (2 * rho * nu) + d**4 * t / (24 * rho * nu**3) * (5 + 3 * t**2 + eta2 - 9 * t**2 * eta2) - d**6 * t / (720 * rho * nu**5) * (61 + 90 * t**2 + 45 * t**4)
    lon = LON0 + d * sec / nu - d**3 * sec / (6 * nu**3) * (nu / rho + 2 * t**2) + d**5 * sec / (120 * nu**5) * (5 + 28 * t**2 + 24 * t**4) - d**7 * sec / (5040 * nu**7) * (61 + 662 * t**2 + 1320 * t**4 + 720 * t**6)
    nu = a / np.sqrt(1 - e2 * np.sin(lat) ** 2)
    xyz = np.stack([nu * np.cos(lat) * np.cos(lon), nu * np.cos(lat) * np.sin(lon), (1 - e2) * nu * np.sin(lat)])
    rx, ry, rz = (math.radians(v / 3600) for v in TURN)
    x, y, z = np.array([[1 + PPM, -rz, ry], [rz, 1 + PPM, -rx], [-ry, rx, 1 + PPM]]) @ xyz + np.array(SHIFT)[:, None]
    a, b = WGS
    e2, p = (a * a - b * b) / (a * a), np.hypot(x, y)
    lat = np.arctan2(z, p * (1 - e2))
    for _ in range(8):
        lat = np.arctan2(z + e2 * a / np.sqrt(1 - e2 * np.sin(lat) ** 2) * np.sin(lat), p)
    return np.degrees(np.arctan2(y, x)), np.degrees(lat)


def _to_grid(lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of _to_lonlat by Newton steps on it, so that both ways agree."""
    e, n = E0 + (lon + 2) * LON_M * np.cos(np.radians(lat)), N0 + (lat - 49) * LAT_M
    for _ in range(8):
        x, y = _to_lonlat(e, n)
        xe, ye = _to_lonlat(e + 1, n)
        xn, yn = _to_lonlat(e, n + 1)
        a, b, c, d = xe - x, xn - x, ye - y, yn - y
        fx, fy, det = x - lon, y - lat, a * d - b * c
        e, n = e - (d * fx - b * fy) / det, n - (a * fy - c * fx) / det
    return e, n


@F.pandas_udf(T.StructType([T.StructField("lon", _NUMBER), T.StructField("lat", _NUMBER)]))
def grid_to_wgs84(easting: pd.Series, northing: pd.Series) -> pd.DataFrame:
    lon, lat = _to_lonlat(easting.to_numpy(float), northing.to_numpy(float))
    return pd.DataFrame({"lon": lon, "lat": lat})


@F.pandas_udf(T.StructType([T.StructField("easting", _NUMBER), T.StructField("northing", _NUMBER)]))
def wgs84_to_grid(lon: pd.Series, lat: pd.Series) -> pd.DataFrame:
    e, n = _to_grid(lon.to_numpy(float), lat.to_numpy(float))
    return pd.DataFrame({"easting": e, "northing": n})


@F.pandas_udf(LINE_TYPE)
def line_to_wgs84(line: pd.Series) -> pd.Series:
    """A run of grid points in degrees to five places: points off the grid or Britain and repeats go."""
    def one(points):
        xy = np.array([(p["x"], p["y"]) for p in points], dtype=float).reshape(-1, 2)
        xy = xy[(xy[:, 0] > GRID_BOX[0]) & (xy[:, 0] < GRID_BOX[2]) & (xy[:, 1] > GRID_BOX[1]) & (xy[:, 1] < GRID_BOX[3])]
        if not len(xy):
            return []
        lon, lat = (np.round(v, 5) for v in _to_lonlat(xy[:, 0], xy[:, 1]))
        ok = (lon >= GB_BOX[0]) & (lon <= GB_BOX[2]) & (lat >= GB_BOX[1]) & (lat <= GB_BOX[3])
        lon, lat = lon[ok], lat[ok]
        new = np.ones(len(lon), dtype=bool)
        new[1:] = (np.diff(lon) != 0) | (np.diff(lat) != 0)
        return [{"x": float(x), "y": float(y)} for x, y in zip(lon[new], lat[new])]
    return line.map(one, na_action="ignore")


#: Units per degree of packed lines, and metres between points of a resampled one.
PACKED, EVERY_M = 10**7, 25.0


def _bytes_of(n: np.ndarray) -> bytes:
    """Whole numbers written seven bits a byte, least first."""
    n = n.astype(np.uint64)
    size = np.ones(len(n), dtype=np.int64)
    for k in range(1, 10):
        size += n >> np.uint64(7 * k) > 0
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out = (np.repeat(n, size) >> (7 * place).astype(np.uint64) & np.uint64(127)).astype(np.uint8)
    return (out | np.where(place < np.repeat(size, size) - 1, 128, 0).astype(np.uint8)).tobytes()


def boxed(parts: Column) -> Column:
    """Lines each in a struct `p`, since arrays of arrays of unequal lengths do not reach pandas."""
    return F.transform(parts, lambda line: F.struct(line.alias("p")))


def pack_lines(parts: Column | str) -> Column:
    """Lines as bytes: how many, and of each the number of its points and the signed steps from point to point, to seven places. `unpack_lines` undoes it; a null line counts as empty."""
    return _pack_lines(boxed(F.col(parts) if isinstance(parts, str) else parts))


@F.pandas_udf(T.BinaryType())
def _pack_lines(parts: pd.Series) -> pd.Series:
    def one(lines) -> bytes:
        numbers = [np.array([len(lines)])]
        for boxed_line in lines:
            line = boxed_line["p"] if boxed_line["p"] is not None else []
            at = np.rint(np.array([(p["x"], p["y"]) for p in line], dtype=float).reshape(-1, 2) * PACKED).astype(np.int64)
            steps = np.diff(at, axis=0, prepend=np.zeros((1, 2), dtype=np.int64)).ravel()
            numbers += [np.array([len(line)]), (steps << 1) ^ (steps >> 63)]
        return _bytes_of(np.concatenate(numbers))

    return parts.map(one, na_action="ignore")


@F.pandas_udf(T.ArrayType(LINE_TYPE))
def unpack_lines(body: pd.Series) -> pd.Series:
    """The lines of `pack_lines`. Bytes that end too early give null."""
    def one(packed: bytes) -> list | None:
        b = np.frombuffer(packed, dtype=np.uint8)
        last = np.flatnonzero(b < 128)
        if not len(last):
            return None
        first = np.concatenate(([0], last[:-1] + 1))
        place = np.arange(last[-1] + 1) - np.repeat(first, last - first + 1)
        n = np.add.reduceat((b[: last[-1] + 1] & 127).astype(np.uint64) << (7 * place).astype(np.uint64), first).astype(np.int64)
        out, at = [], 1
        for _ in range(n[0]):
            if at >= len(n) or at + 1 + 2 * n[at] > len(n):
                return None
            steps = n[at + 1 : at + 1 + 2 * n[at]]
            xy = np.cumsum((steps >> 1 ^ -(steps & 1)).reshape(-1, 2), axis=0) / PACKED
            out.append([{"x": x, "y": y} for x, y in xy.tolist()])
            at += 1 + 2 * n[at]
        return out

    return body.map(one, na_action="ignore")


def by_line(lines: pa.Array, make: Callable[[np.ndarray], np.ndarray], columns: tuple[str, ...]) -> pa.Array:
    """make(points) of every line, as lists of structs of numbers; null lines stay null. Points pass as arrays, never one by one."""
    xy = np.column_stack([lines.values.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("x", "y")])
    ends, known = lines.offsets.to_numpy(), lines.is_valid().to_numpy(zero_copy_only=False)
    made = [make(xy[a:b]) if k else np.zeros((0, len(columns))) for a, b, k in zip(ends[:-1].tolist(), ends[1:].tolist(), known.tolist())]
    rows = np.concatenate([np.zeros((0, len(columns))), *made])
    out = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(columns))], names=list(columns))
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, made)]), pa.int32()), out, mask=pa.array(~known))


def _every(p: np.ndarray) -> np.ndarray:
    if len(p) < 2:
        return np.column_stack((p, np.zeros(len(p))))
    lon, lat = np.radians(p[:, 0]), np.radians(p[:, 1])
    h = np.sin(np.diff(lat) / 2) ** 2 + np.cos(lat[:-1]) * np.cos(lat[1:]) * np.sin(np.diff(lon) / 2) ** 2
    ends = np.concatenate(([0.0], np.cumsum(2 * EARTH_M * np.arcsin(np.sqrt(np.minimum(1.0, h))))))
    at = np.arange(0.0, ends[-1], EVERY_M) if ends[-1] > 0 else np.zeros(1)
    at = np.append(at[at <= ends[-1] - 1e-9] if ends[-1] > 0 else at, [ends[-1]] if ends[-1] > 0 else [])
    moved = np.concatenate(([True], np.diff(ends) > 0))
    return np.column_stack((np.interp(at, ends[moved], p[moved, 0]), np.interp(at, ends[moved], p[moved, 1]), at))


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField(c, T.DoubleType()) for c in ("x", "y", "d")])))
def resampled(line: pa.Array) -> pa.Array:
    """Points every EVERY_M along a line with their distance from its start; its own end is always the last."""
    return by_line(line, _every, ("x", "y", "d"))
