"""Heights of ways from tiles of a height map, and what the ways climb."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymeld.functions import climb, geo
from waymeld.operators.sizes import grown

#: Pixels along a tile's side and along that of a block, which divides it, and passes of smoothing.
SIDE, BLOCK, PASSES = 256, 32, 2


def _pixels(body: bytes) -> np.ndarray:
    """Rows, columns and channels of an 8-bit picture (PNG, not interlaced)."""
    if body[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG picture")
    at, packed, head = 8, b"", b""
    while at + 8 <= len(body):
        size, kind = int.from_bytes(body[at : at + 4], "big"), body[at + 4 : at + 8]
        if kind == b"IHDR":
            head = body[at + 8 : at + 8 + size]
        elif kind == b"IDAT":
            packed += body[at + 8 : at + 8 + size]
        at += size + 12
    width, height = int.from_bytes(head[:4], "big"), int.from_bytes(head[4:8], "big")
    depth, colour, woven = head[8], head[9], head[12]
    if depth != 8 or colour not in (2, 6) or woven:
        raise ValueError("only plain 8-bit pictures in red, green and blue hold heights")
    n = 3 if colour == 2 else 4
    rows = np.frombuffer(zlib.decompress(packed), dtype=np.uint8).reshape(height, 1 + width * n)
    out = np.zeros((height, width, n), dtype=np.uint8)
    above = np.zeros((width, n), dtype=np.uint8)
    for y, (kind, row) in enumerate(zip(rows[:, 0], rows[:, 1:].reshape(height, width, n))):
        if kind == 0:
            out[y] = row
        elif kind == 1:
            out[y] = np.cumsum(row, axis=0, dtype=np.uint8)
        elif kind == 2:
            out[y] = row + above
        elif kind in (3, 4):
            left, corner = np.zeros(n, dtype=int), np.zeros(n, dtype=int)
            for x in range(width):
                up = above[x].astype(int)
                if kind == 3:
                    guess = (left + up) // 2
                else:
                    p = left + up - corner
                    a, b, c = abs(p - left), abs(p - up), abs(p - corner)
                    guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
                left, corner = (row[x] + guess) & 255, up
                out[y, x] = left
        else:
            raise ValueError(f"row of unknown kind {kind}")
        above = out[y]
    return out


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def picture_heights(tile: pd.Series) -> pd.Series:
    """Heights in metres of a picture's pixels, row by row."""
    def one(body: bytes) -> np.ndarray:
        p = _pixels(body)[..., :3].astype(float)
        return (p[..., 0] * 256 + p[..., 1] + p[..., 2] / 256 - 32768).ravel()

    return tile.map(one, na_action="ignore")


def heights_at(points: DataFrame, point: str, lon: str, lat: str, tiles: DataFrame, zoom: int) -> DataFrame:
    """point, height: between the centres of the four pixels around each point; those that no tile holds count as the mean of the others, and a point without any has no row.

    tiles: x, y, heights of one zoom, SIDE by SIDE. Tiles are dealt in blocks of pixels, so a point asks once for each
    block that its four pixels lie in, mostly one, and those of one tile are met in many tasks.
    """
    many = SIDE // BLOCK
    px, py = geo.tile_x(F.col(lon), zoom) * SIDE - 0.5, geo.tile_y(F.col(lat), zoom) * SIDE - 0.5
    asked = points.select(F.col(point).alias("_p"), px.alias("_x"), py.alias("_y")).withColumn("_gx", F.floor("_x")).withColumn("_gy", F.floor("_y"))
    block = lambda i, j: F.struct(F.floor((F.col("_gx") + i) / BLOCK).alias("bx"), F.floor((F.col("_gy") + j) / BLOCK).alias("by"))
    corners = [(i, j) for i in (0, 1) for j in (0, 1)]
    placed = asked.withColumn("_b", F.explode(F.array_distinct(F.array(*[block(i, j) for i, j in corners])))).select("_p", "_x", "_y", "_gx", "_gy", "_b.*")
    dealt = tiles.select(F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), "heights", F.explode(F.sequence(F.lit(0), F.lit(many**2 - 1))).alias("n"))
    left, top = F.pmod(F.col("n"), F.lit(many)), F.floor(F.col("n") / many)
    rows = F.transform(F.sequence(F.lit(0), F.lit(BLOCK - 1)), lambda r: F.slice("heights", ((top * BLOCK + r) * SIDE + left * BLOCK + 1).cast("int"), F.lit(BLOCK)))
    blocks = dealt.select((F.col("x") * many + left).alias("bx"), (F.col("y") * many + top).alias("by"), rows.alias("_rows"))
    read = placed.join(grown(blocks), ["bx", "by"])
    at = lambda i, j: F.when(block(i, j) == F.struct("bx", "by"), F.get(F.get("_rows", F.pmod(F.col("_gy") + j, F.lit(BLOCK)).cast("int")), F.pmod(F.col("_gx") + i, F.lit(BLOCK)).cast("int")))
    found = read.select("_p", "_x", "_y", *[at(i, j).alias(f"_h{i}{j}") for i, j in corners]).groupBy("_p").agg(F.first("_x").alias("_x"), F.first("_y").alias("_y"), *[F.max(f"_h{i}{j}").alias(f"_h{i}{j}") for i, j in corners])
    own = [F.col(f"_h{i}{j}") for i, j in corners]
    known = sum((F.when(c.isNotNull(), 1).otherwise(0) for c in own), F.lit(0))
    found = found.withColumn("_mean", sum((F.coalesce(c, F.lit(0.0)) for c in own), F.lit(0.0)) / F.nullif(known, F.lit(0))).filter("_mean IS NOT NULL")
    h = {k: F.coalesce(f"_h{k}", "_mean") for k in ("00", "10", "01", "11")}
    dx, dy = F.col("_x") - F.floor("_x"), F.col("_y") - F.floor("_y")
    top, foot = h["00"] + (h["10"] - h["00"]) * dx, h["01"] + (h["11"] - h["01"]) * dx
    return found.select(F.col("_p").alias(point), (top + (foot - top) * dy).alias("height"))


def profiles(ways: DataFrame, key: str, parts: str, tiles: DataFrame, zoom: int, passes: int = PASSES) -> DataFrame:
    """key, pos, heights (smoothed), distances of each line of each way, at points 25 m apart that a tile holds; of lines with two such points."""
    # Ways are small and their points many, so ways are dealt out before; outer, since the filter of a plain one would be pushed below that.
    lines = ways.select(key, parts).repartition(key).select(key, F.posexplode(parts).alias("pos", "_line"))
    points = lines.select(key, "pos", F.posexplode_outer(geo.resampled("_line")).alias("_i", "_q")).filter("_i IS NOT NULL").select(F.struct(key, "pos", "_i").alias("at"), "_q.*")
    known = grown(points).join(heights_at(points, "at", "x", "y", tiles, zoom), "at")
    rows = known.groupBy(F.col(f"at.{key}").alias(key), F.col("at.pos").alias("pos")).agg(F.sort_array(F.collect_list(F.struct(F.col("at._i").alias("i"), "height", "d"))).alias("_s")).filter(F.size("_s") > 1)
    return rows.select(key, "pos", climb.smooth(F.transform("_s", lambda s: s["height"]), passes).alias("heights"), F.transform("_s", lambda s: s["d"]).alias("distances"))


def measured(ways: DataFrame, key: str, parts: str, tiles: DataFrame, zoom: int, step_m: float | None = None) -> DataFrame:
    """key, climb_m, ascent_m, descent_m, sustained_pct, sustained_run_m, samples, measured_m of every way.

    Lines are measured one by one, as nothing is known of the heights between them: climbs add up, in the direction that
    has more of them, and the steepest line counts. `step_m`: the height map's vertical step, four of which a fall must have to end a climb.
    A way without heights has nulls and 0 samples.
    """
    threshold = max(climb.THRESHOLD, 4.0 * step_m) if step_m else climb.THRESHOLD
    h, d = F.col("heights"), F.col("distances")
    each = profiles(ways, key, parts, tiles, zoom).select(key, climb.total_ascent(h, threshold).alias("up"), climb.total_ascent(F.reverse(h), threshold).alias("down"), climb.steepest_run(h, d).alias("steep"), F.size(h).alias("n"), (F.element_at(d, -1) - F.get(d, 0)).alias("m"))
    sums = each.groupBy(key).agg(F.sum("up").alias("_up"), F.sum("down").alias("_down"), F.max("steep").alias("_steep"), F.sum("n").alias("_n"), F.sum("m").alias("_m"))
    out = ways.select(key).distinct().join(grown(sums), key, "left")
    return out.select(key, F.round(F.greatest("_up", "_down"), 1).alias("climb_m"), F.round("_up", 1).alias("ascent_m"), F.round("_down", 1).alias("descent_m"), F.round("_steep.pct", 1).alias("sustained_pct"), F.round("_steep.run_m", 1).alias("sustained_run_m"),
                      F.coalesce("_n", F.lit(0)).alias("samples"), F.round(F.coalesce("_m", F.lit(0.0)), 1).alias("measured_m"))
