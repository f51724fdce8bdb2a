"""Heights from pictures, between pixels and along ways."""

import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_physical import LINE, table

from waymeld.operators import heights


def png(pixels, kinds):
    """A picture whose rows are filtered in the given ways."""
    h, w, n = pixels.shape
    rows, p = b"", pixels.astype(int)
    for y in range(h):
        kind = kinds[y % len(kinds)]
        row = bytearray()
        for x in range(w):
            for c in range(n):
                a = p[y, x - 1, c] if x else 0
                b = p[y - 1, x, c] if y else 0
                d = p[y - 1, x - 1, c] if x and y else 0
                paeth = min((abs(b - d), 0, a), (abs(a - d), 1, b), (abs(a + b - 2 * d), 2, d))[2]
                row.append((p[y, x, c] - [0, a, b, (a + b) // 2, paeth][kind]) % 256)
        rows += bytes([kind]) + bytes(row)
    chunk = lambda k, body: struct.pack(">I", len(body)) + k + body + struct.pack(">I", zlib.crc32(k + body))
    half = zlib.compress(rows)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">2I5B", w, h, 8, 2 if n == 3 else 6, 0, 0, 0)) + chunk(b"IDAT", half[:20]) + chunk(b"IDAT", half[20:]) + chunk(b"IEND", b"")


def test_pictures(spark):
    rng = np.random.default_rng(1)
    for n in (3, 4):
        given = rng.integers(0, 256, (11, 7, n))
        assert (heights._pixels(png(given, [0, 1, 2, 3, 4])) == given).all()
    with pytest.raises(ValueError):
        heights._pixels(b"GIF89a")
    one = np.array([[[128, 10, 128], [127, 255, 0]]])
    assert table(spark, [(png(one, [0]),), (None,)], "tile binary").select(heights.picture_heights("tile")).collect()[0][0] == [10.5, -1.0]


def test_heights_between_pixels(spark):
    rng, side = random.Random(2), heights.SIDE
    grids = {(x, y): np.array([[rng.uniform(0, 500) for _ in range(side)] for _ in range(side)]) for x, y in ((2, 1), (2, 2))}
    tiles = table(spark, [(x, y, g.ravel().tolist()) for (x, y), g in grids.items()], "x int, y int, heights array<double>")
    # At zoom 2 a tile is 90 degrees wide; places are set by pixel, also near edges and in tiles that are not there.
    import math

    spots = [(rng.uniform(2 * side, 3 * side), rng.uniform(side, 3 * side)) for _ in range(60)] + [(2 * side + 0.2, side + 40.3), (3 * side - 0.1, side + 9.7), (2 * side + 7.7, 2 * side), (10.0, 300.0)]
    place = lambda px, py: (px / side / 4 * 360 - 180, math.degrees(math.atan(math.sinh(math.pi * (1 - 2 * py / side / 4)))))
    points = table(spark, [(i, *place(*s)) for i, s in enumerate(spots)], "i int, lon double, lat double")
    got = {r["i"]: r["height"] for r in heights.heights_at(points, "i", "lon", "lat", tiles, 2).collect()}

    def pixel(gx, gy):
        g = grids.get((gx // side, gy // side))
        return None if g is None else g[gy % side, gx % side]

    for i, (px, py) in enumerate(spots):
        fx, fy = px - 0.5, py - 0.5
        x, y = math.floor(fx), math.floor(fy)
        four = [pixel(x + a, y + b) for b in (0, 1) for a in (0, 1)]
        known = [v for v in four if v is not None]
        if not known:
            assert i not in got
            continue
        a, b, c, d = (sum(known) / len(known) if v is None else v for v in four)
        u, v = fx - x, fy - y
        assert got[i] == pytest.approx((a + (b - a) * u) * (1 - v) + (c + (d - c) * u) * v, abs=1e-3), i


def test_measured(spark):
    # A plane that rises 100 m a pixel eastwards; a pixel is 360 / 1024 degrees at zoom 2.
    plane = F.transform(F.sequence(F.lit(0), F.lit(heights.SIDE**2 - 1)), lambda i: (F.col("x") * heights.SIDE + i % heights.SIDE) * 100.0)
    tiles = spark.createDataFrame([(2, 1)], "x int, y int").select("x", "y", plane.alias("heights"))
    step = 360 / 1024
    ways = table(spark, [("up", [[(10.0, 20.0), (10.0 + step / 10, 20.0)]]), ("two", [[(10.0, 20.0), (10.0 + step / 10, 20.0)], [(12.0, 20.0), (12.0 - step / 20, 20.0)]]), ("out", [[(-100.0, 20.0), (-99.9, 20.0)]]), ("dot", [[(10.0, 20.0)]]), ("none", None)], f"k string, parts array<{LINE}>")
    got = {r["k"]: r for r in heights.measured(ways, "k", "parts", tiles, 2).collect()}
    assert (got["up"]["ascent_m"], got["up"]["descent_m"], got["up"]["climb_m"]) == (10.0, 0.0, 10.0)
    assert (got["two"]["ascent_m"], got["two"]["descent_m"], got["two"]["climb_m"]) == (10.0, 5.0, 10.0)
    assert got["up"]["sustained_pct"] == pytest.approx(10 / got["up"]["measured_m"] * 100, abs=0.1)
    assert {k: (got[k]["climb_m"], got[k]["samples"], got[k]["measured_m"]) for k in ("out", "dot", "none")} == {k: (None, 0, 0.0) for k in ("out", "dot", "none")}
