"""Joins of lines with lines: what share of one lies along others, what does not, and which are one line twice.

Lines are arrays of points with x (longitude) and y (latitude), keyed. Points taken along a line meet the segments
of other lines through grid cells, so every join is an equi-join and no two lines are held against each other whole
unless they share a cell.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymeld.functions import geo
from waymeld.operators.lineage import cut
from waymeld.operators.sizes import grown

#: Metres between points taken along a line, within which two lines are one way, of the least uncovered run, and of a cell.
STEP, SAME, LEAST, CELL = 5.0, 15.0, 30.0, 50.0
#: Points of a leg that are asked for at once, each a bit of a number.
BLOCK = 32
#: Share of the longer line's length that a twin has at least, and of its own length that it must run along the other.
RATIO, TRAVEL = 0.85, 0.5
#: Metres and degrees within which a way runs with a line; shares of a section on a path that drop or mark it, the latter from so many metres.
ALONG, ANGLE, DROPPED, PARTLY, PARTLY_M = 20.0, 30.0, 0.75, 0.3, 100.0
BYWAY = "byway_open_to_all_traffic"
#: Share of a record that must still be drawn; least share of records kept and most share of new length for a layer to be trusted.
KEEP, LEAST_KEPT, MOST_NEW = 0.9, 0.75, 0.25


def segments(lines: DataFrame, key: str, line: str) -> DataFrame:
    """key, ax, ay, bx, by in metres. Lines of fewer than two points have none."""
    pts = lines.select(key, F.transform(line, geo.metres).alias("p")).filter(F.size("p") > 1)
    legs = F.zip_with(F.slice("p", F.lit(1), F.size("p") - 1), F.slice("p", F.lit(2), F.size("p") - 1), lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")))
    return pts.select(key, F.posexplode(legs).alias("leg", "s")).select(key, "leg", "s.*")


def samples(lines: DataFrame, key: str, line: str, step: float = STEP) -> DataFrame:
    """key, _at (order), x, y in metres, vertex: every vertex and a point each `step` metres after one."""
    legs = segments(lines, key, line).withColumn("m", F.sqrt(F.pow(F.col("bx") - F.col("ax"), 2) + F.pow(F.col("by") - F.col("ay"), 2)))
    inner = F.when(F.ceil(F.col("m") / step) > 1, F.sequence(F.lit(1), (F.ceil(F.col("m") / step) - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    between = F.transform(inner, lambda i: F.struct(i.alias("i"), (i * step / F.col("m")).alias("t"), F.lit(False).alias("vertex")))
    ends = F.concat(F.when(F.col("leg") == 0, F.array(F.struct(F.lit(0).alias("i"), F.lit(0.0).alias("t"), F.lit(True).alias("vertex")))).otherwise(F.array().cast("array<struct<i:int,t:double,vertex:boolean>>")), between, F.array(F.struct(F.lit(2147483647).alias("i"), F.lit(1.0).alias("t"), F.lit(True).alias("vertex"))))
    at = legs.select(key, "leg", "ax", "ay", "bx", "by", F.explode(ends).alias("e"))
    return at.select(key, F.struct("leg", "e.i").alias("_at"), (F.col("ax") + (F.col("bx") - F.col("ax")) * F.col("e.t")).alias("x"), (F.col("ay") + (F.col("by") - F.col("ay")) * F.col("e.t")).alias("y"), "e.vertex")


def _span(a: Column, b: Column, d: float, cell: float) -> Column:
    return F.explode(F.sequence(F.floor((F.least(a, b) - d) / cell), F.floor((F.greatest(a, b) + d) / cell)))


def flagged(points: DataFrame, others: DataFrame, key: str, line: str, d: float = SAME, cell: float = CELL) -> DataFrame:
    """points (key, _at, x, y, ...) with `near`: whether a line of others, which need no key, passes within d metres.

    Segments are dealt to all cells that their box, grown by d, touches, so a point asks its own cell alone and stops
    at the first segment that is near. Both joins read the same two exchanges.
    """
    legs = segments(others.select(F.lit(0).alias(key), line), key, line).select("ax", "ay", "bx", "by")
    dealt = legs.withColumn("cx", _span(F.col("ax"), F.col("bx"), d, cell)).withColumn("cy", _span(F.col("ay"), F.col("by"), d, cell)).distinct()
    close = geo.segment_m(F.col("x"), F.col("y"), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")) <= d
    met = (F.floor(F.col("x") / cell) == F.col("cx")) & (F.floor(F.col("y") / cell) == F.col("cy")) & close
    return points.join(dealt, met, "left_semi").withColumn("near", F.lit(True)).unionByName(points.join(dealt, met, "left_anti").withColumn("near", F.lit(False)))


def _near_mask(d: float, step: float) -> Callable:
    """Bits of a leg's points `lo` to `hi` that lie within d metres of a segment (sax, say, sbx, sby)."""
    @F.arrow_udf(T.LongType())
    def run(ax: pa.Array, ay: pa.Array, bx: pa.Array, by: pa.Array, m: pa.Array, lo: pa.Array, hi: pa.Array, last: pa.Array, sax: pa.Array, say: pa.Array, sbx: pa.Array, sby: pa.Array) -> pa.Array:
        ax, ay, bx, by, m, lo, hi, last, sax, say, sbx, sby = (c.to_numpy(zero_copy_only=False)[:, None] for c in (ax, ay, bx, by, m, lo, hi, last, sax, say, sbx, sby))
        j = lo + np.arange(BLOCK)
        t = np.where(j == last, 1.0, np.divide(j * step, m, out=np.zeros(j.shape), where=m > 0))
        x, y, dx, dy = ax + (bx - ax) * t, ay + (by - ay) * t, sbx - sax, sby - say
        ll = dx * dx + dy * dy
        u = np.clip(((x - sax) * dx + (y - say) * dy) / np.where(ll == 0, 1, ll), 0, 1)
        near = (np.sqrt((x - (sax + u * dx)) ** 2 + (y - (say + u * dy)) ** 2) <= d) & (j <= hi)
        return pa.array((near << np.arange(BLOCK)).sum(axis=1))

    return run


def stepped(legs: DataFrame, step: float = STEP) -> DataFrame:
    """legs (leg, ax, ay, bx, by) with their length m, and `first` and `last`, the numbers of the points that `samples` takes of each."""
    m = F.sqrt(F.pow(F.col("bx") - F.col("ax"), 2) + F.pow(F.col("by") - F.col("ay"), 2))
    return legs.withColumn("m", m).withColumn("last", F.greatest(F.lit(1).cast("long"), F.coalesce(F.ceil(F.col("m") / step), F.lit(1)))).withColumn("first", F.when(F.col("leg") == 0, 0).otherwise(1).cast("long"))


def near_bits(legs: DataFrame, theirs: DataFrame, own: list[str], other: list[str], d: float = SAME, step: float = STEP, cell: float = 200.0, on: tuple[str, ...] = (), where: Column | None = None) -> DataFrame:
    """own (of legs, as `stepped`), other (of theirs: segments sax, say, sbx, sby), the leg's ends, lo, _bits: which of the BLOCK points of a leg from the `lo`th on lie within d metres of a segment.

    Points are never rows: BLOCK points of a leg are one, and each segment near them sets bits. `on`: columns that both
    have and that agree; `where`: what else a pair must fulfil.
    """
    cut = legs.withColumn("lo", F.explode(F.sequence(F.col("first"), F.col("last"), F.lit(BLOCK).cast("long")))).withColumn("hi", F.least(F.col("lo") + (BLOCK - 1), "last"))
    t = lambda j: F.when(F.col(j) == F.col("last"), 1.0).otherwise(F.coalesce(F.col(j) * step / F.nullif("m", F.lit(0.0)), F.lit(0.0)))
    at = lambda a, b, j: F.col(a) + (F.col(b) - F.col(a)) * t(j)
    boxed = cut.withColumns({"x0": at("ax", "bx", "lo"), "x1": at("ax", "bx", "hi"), "y0": at("ay", "by", "lo"), "y1": at("ay", "by", "hi")})
    asked = boxed.select(*own, *on, "ax", "ay", "bx", "by", "m", "lo", "hi", "last", F.least("x0", "x1").alias("px"), F.least("y0", "y1").alias("py"), F.greatest("x0", "x1").alias("qx"), F.greatest("y0", "y1").alias("qy"))
    asked = asked.withColumn("cx", _span(F.col("px"), F.col("qx"), 0.0, cell)).withColumn("cy", _span(F.col("py"), F.col("qy"), 0.0, cell))
    dealt = theirs.withColumn("cx", _span(F.col("sax"), F.col("sbx"), d, cell)).withColumn("cy", _span(F.col("say"), F.col("sby"), d, cell))
    # Of the cells that a block and a segment share, the first answers, and only where their boxes meet.
    first = lambda p, a, b: F.floor(F.greatest(F.col(p), F.least(a, b) - d) / cell)
    meets = lambda p, q, a, b: (F.col(p) <= F.greatest(a, b) + d) & (F.col(q) >= F.least(a, b) - d)
    once = (F.col("cx") == first("px", "sax", "sbx")) & (F.col("cy") == first("py", "say", "sby")) & meets("px", "qx", "sax", "sbx") & meets("py", "qy", "say", "sby")
    met = asked.join(grown(dealt), ["cx", "cy", *on]).filter(once if where is None else once & where)
    return met.select(*own, *other, "ax", "ay", "bx", "by", "lo", _near_mask(d, step)("ax", "ay", "bx", "by", "m", "lo", "hi", "last", "sax", "say", "sbx", "sby").alias("_bits"))


def covered_share(lines: DataFrame, others: DataFrame, key: str, line: str, d: float = SAME, step: float = STEP, cell: float = 200.0) -> DataFrame:
    """key, share: of the points along each line, those within d metres of any of the others. Lines without points are left out.

    The points are those of `samples`, but they are never rows (`near_bits`).
    """
    ends = ["ax", "ay", "bx", "by"]
    legs = stepped(segments(lines, key, line).groupBy(key, "leg", *ends).agg(F.count("*").alias("c")), step)
    all_ = legs.groupBy(key).agg(F.sum(F.col("c") * (F.col("last") - F.col("first") + 1)).alias("_all"))
    theirs = segments(others.select(F.lit(0).alias(key), line), key, line).select(*[F.col(c).alias(f"s{c}") for c in ends]).distinct()
    near = near_bits(legs, theirs, [key, "leg", "c"], [], d, step, cell)
    near = near.groupBy(key, "leg", *ends, "c", "lo").agg(F.bit_or("_bits").alias("_bits"))
    hit = near.groupBy(key).agg(F.sum(F.col("c") * F.bit_count("_bits")).alias("_hit"))
    return all_.join(grown(hit), key, "left").select(key, (F.coalesce("_hit", F.lit(0)) / F.col("_all")).alias("share"))


def uncovered_runs(lines: DataFrame, others: DataFrame, key: str, line: str, d: float = SAME, least: float = LEAST, step: float = STEP) -> DataFrame:
    """key, run, length_m, points (in metres: the run's ends and the vertices within) of what lies farther than d from all others."""
    order = W.partitionBy(key).orderBy("_at")
    marked = flagged(samples(lines, key, line, step), others, key, line, d).withColumn("starts", (~F.col("near") & F.coalesce(F.lag("near").over(order), F.lit(True))).cast("int"))
    runs = marked.withColumn("run", F.sum("starts").over(order.rowsBetween(W.unboundedPreceding, 0))).filter(~F.col("near"))
    inside = W.partitionBy(key, "run").orderBy("_at")
    ends = runs.withColumn("edge", F.lag("_at").over(inside).isNull() | F.lead("_at").over(inside).isNull())
    kept = ends.filter("vertex OR edge").withColumn("leg_m", F.coalesce(F.sqrt(F.pow(F.col("x") - F.lag("x").over(inside), 2) + F.pow(F.col("y") - F.lag("y").over(inside), 2)), F.lit(0.0)))
    out = kept.groupBy(key, "run").agg(F.sum("leg_m").alias("length_m"), F.sort_array(F.collect_list(F.struct("_at", "x", "y"))).alias("p"))
    return out.filter((F.size("p") > 1) & (F.col("length_m") >= least)).select(key, "run", "length_m", F.transform("p", lambda p: F.struct(p["x"], p["y"])).alias("points"))


def _taken(p: np.ndarray, step: float) -> np.ndarray:
    parts = [p[:1]]
    for a, b in zip(p, p[1:]):
        n = max(1, math.ceil(float(np.hypot(*(b - a))) / step))
        parts.append(a + (b - a) * (np.arange(1, n + 1) / n)[:, None])
    return np.vstack(parts)


def _onto(q: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distance of each point of q to line p, and how far along p the nearest place lies."""
    if len(p) == 1:
        return np.hypot(*(q - p[0]).T), np.zeros(len(q))
    a, leg = p[:-1], np.diff(p, axis=0)
    ll = (leg**2).sum(axis=1)
    t = np.clip(((q[:, None] - a) * leg).sum(axis=2) / np.where(ll == 0, 1, ll), 0, 1)
    off = q[:, None] - (a + leg * t[..., None])
    far = np.hypot(off[..., 0], off[..., 1])
    best, i = far.argmin(axis=1), np.arange(len(q))
    start = np.concatenate([[0], np.cumsum(np.sqrt(ll))])[:-1]
    return far[i, best], start[best] + t[i, best] * np.sqrt(ll[best])


def measure(a: np.ndarray, b: np.ndarray, step: float = STEP) -> tuple[float, ...]:
    """Farthest of a from b and of b from a, mean of both means, ratio of lengths, share of a and of b that runs along the other."""
    lat0 = math.radians((a[0, 1] + b[0, 1]) / 2)
    a, b = (p * [LON * math.cos(lat0), LAT] for p in (a, b))
    long_ = [float(np.hypot(*np.diff(p, axis=0).T).sum()) if len(p) > 1 else 0.0 for p in (a, b)]
    (da, at), (db, bt) = _onto(_taken(a, step), b), _onto(_taken(b, step), a)
    travel = lambda own, other, t: 1.0 if own <= 0 or len(other) < 2 else float(np.abs(np.diff(t)).sum()) / own
    return float(da.max()), float(db.max()), float(da.mean() + db.mean()) / 2, min(long_) / max(long_) if max(long_) > 0 else 1.0, travel(long_[0], b, at), travel(long_[1], a, bt)


LON, LAT = geo.LON_M, geo.LAT_M
_MEASURE = ["a_off", "b_off", "mean_off", "ratio", "a_along", "b_along"]


@F.pandas_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in _MEASURE]))
def compared(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    xy = lambda line: np.array([(p["x"], p["y"]) for p in line], dtype=float)
    return pd.DataFrame([measure(xy(p), xy(q)) for p, q in zip(a, b)], columns=_MEASURE)


def twins(lines: DataFrame, key: str, line: str, same: float = SAME, ratio: float = RATIO, travel: float = TRAVEL, cell: float = 500.0) -> DataFrame:
    """a, b (a < b) and the measure of every two lines that are one way drawn twice.

    One must lie wholly within `same` metres of the other and run along it, and their lengths agree within `ratio`.
    The first point of a line that lies on another is near that one, so pairs are sought from first points to cells
    of segments; lengths and boxes rule pairs out before lines are brought together.
    """
    known = lines.filter(F.size(line) > 1).withColumn("len", geo.length_m(F.col(line)))
    first = known.select(F.col(key).alias("p"), geo.metres(F.get(line, 0)).alias("at"), F.col("len").alias("plen"))
    asked = first.select("p", "plen", F.col("at.x").alias("x"), F.col("at.y").alias("y")).withColumn("cx", F.floor(F.col("x") / cell)).withColumn("cy", F.floor(F.col("y") / cell))
    slack = same * 1.1 + 2
    legs = segments(known, key, line).join(grown(known).select(key, "len"), key).withColumnRenamed(key, "q")
    dealt = legs.withColumn("cx", _span(F.col("ax"), F.col("bx"), slack, cell)).withColumn("cy", _span(F.col("ay"), F.col("by"), slack, cell))
    close = geo.segment_m(F.col("x"), F.col("y"), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")) <= slack
    fits = F.least("plen", "len") >= (ratio - 0.02) * F.greatest("plen", "len")
    pairs = asked.join(grown(dealt), ["cx", "cy"]).filter((F.col("p") != F.col("q")) & fits & close).select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
    side = lambda k, to: grown(lines).select(F.col(key).alias(k), F.col(line).alias(to))
    out = pairs.join(side("a", "la"), "a").join(side("b", "lb"), "b").select("a", "b", compared("la", "lb").alias("m")).select("a", "b", "m.*")
    on = lambda s: (F.col(f"{s}_off") <= same) & (F.col(f"{s}_along") >= travel)
    return out.filter((F.col("ratio") >= ratio) & (on("a") | on("b")))


def _kept(p: np.ndarray, tolerance: float) -> np.ndarray:
    """Which points a line keeps when those within `tolerance` of the chord go, farthest first."""
    keep, open_ = np.zeros(len(p), dtype=bool), [(0, len(p) - 1)]
    keep[[0, -1]] = True
    while open_:
        i, j = open_.pop()
        if j > i + 1:
            far, _ = _onto(p[i + 1 : j], p[[i, j]])
            k = int(far.argmax())
            if far[k] > tolerance:
                keep[i + 1 + k] = True
                open_ += [(i, i + 1 + k), (i + 1 + k, j)]
    return keep


def simplified(line: Column, tolerance: float) -> Column:
    """A line without the points that lie within `tolerance` (its own unit) of what is left."""
    @F.pandas_udf(geo.LINE_TYPE)
    def run(lines: pd.Series) -> pd.Series:
        def one(points):
            if len(points) < 3:
                return list(points)
            keep = _kept(np.array([(p["x"], p["y"]) for p in points], dtype=float), tolerance)
            return [p for p, k in zip(points, keep) if k]
        return lines.map(one, na_action="ignore")
    return run(line)


def clipped(line: Column, west: float, south: float, east: float, north: float) -> Column:
    """The pieces of a line inside a box, as an array of lines."""
    @F.pandas_udf(T.ArrayType(geo.LINE_TYPE))
    def run(lines: pd.Series) -> pd.Series:
        def one(points):
            p, out, piece = [(q["x"], q["y"]) for q in points], [], []
            for (ax, ay), (bx, by) in zip(p, p[1:]):
                t0, t1, dx, dy = 0.0, 1.0, bx - ax, by - ay
                for d, lo, hi in ((dx, west - ax, east - ax), (dy, south - ay, north - ay)):
                    if d == 0:
                        t1 = t1 if lo <= 0 <= hi else -1.0
                    else:
                        u, v = sorted((lo / d, hi / d))
                        t0, t1 = max(t0, u), min(t1, v)
                if t0 <= t1:
                    a, b = (ax + dx * t0, ay + dy * t0), (ax + dx * t1, ay + dy * t1)
                    if not piece or piece[-1] != a:
                        if len(piece) > 1:
                            out.append(piece)
                        piece = [a]
                    if b != a:
                        piece.append(b)
            if len(piece) > 1:
                out.append(piece)
            return [[{"x": x, "y": y} for x, y in piece] for piece in out]
        return lines.map(one, na_action="ignore")
    return run(line)


def running(ways: DataFrame, key: str, line: str, others: DataFrame, name: str, other_line: str, d: float = ALONG, degrees: float = ANGLE, cell: float = CELL) -> DataFrame:
    """key, share, kind, kind_share: how much of a way runs with others: within d metres of a segment that it is beside, at a small angle.

    others carry a `name` each, such as their class. A point counts once, for the nearest such segment, of equals for the
    lesser name; `kind` is the name with most points, of equals the lesser. Lines crossed or met at their ends do not count.
    """
    legs = segments(ways, key, line).withColumn("m", F.sqrt(F.pow(F.col("bx") - F.col("ax"), 2) + F.pow(F.col("by") - F.col("ay"), 2)))
    ends = ways.select(key, (F.size(line) - 2).alias("_last"))
    many = F.greatest(F.lit(1), F.floor(F.col("m") / STEP)).cast("int")
    cut = legs.join(ends, key).filter("m > 0").withColumn("i", F.explode(F.sequence(F.lit(0), F.when(F.col("leg") == F.col("_last"), many).otherwise(many - 1))))
    t = F.least(F.lit(1.0), F.col("i") * STEP / F.col("m"))
    points = cut.select(key, "leg", "i", (F.col("ax") + (F.col("bx") - F.col("ax")) * t).alias("x"), (F.col("ay") + (F.col("by") - F.col("ay")) * t).alias("y"), geo.axis(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")).alias("_axis"))
    theirs = segments(others.select(F.col(name).alias("_name"), F.col(other_line).alias("_line")), "_name", "_line").drop("leg").filter("ax <> bx OR ay <> by").distinct()
    dealt = theirs.withColumn("cx", _span(F.col("ax"), F.col("bx"), d, cell)).withColumn("cy", _span(F.col("ay"), F.col("by"), d, cell)).withColumn("_other", geo.axis(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")))
    asked = points.withColumn("cx", F.floor(F.col("x") / cell)).withColumn("cy", F.floor(F.col("y") / cell))
    far = geo.beside_m(F.col("x"), F.col("y"), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    near = asked.join(dealt, ["cx", "cy"]).filter(geo.turn(F.col("_axis"), F.col("_other")) <= degrees).withColumn("_far", far).filter(F.col("_far") <= d)
    best = near.groupBy(key, "leg", "i").agg(F.min(F.struct("_far", "_name")).alias("b"))
    tally = best.groupBy(key, F.col("b._name").alias("kind")).agg(F.count("*").alias("n")).groupBy(key).agg(F.sum("n").alias("_hit"), F.min(F.struct((-F.col("n")).alias("less"), "kind")).alias("_best"))
    out = points.groupBy(key).agg(F.count("*").alias("_all")).join(tally, key, "left")
    return out.select(key, F.coalesce(F.col("_hit") / F.col("_all"), F.lit(0.0)).alias("share"), F.col("_best.kind").alias("kind"), F.coalesce(-F.col("_best.less") / F.col("_all"), F.lit(0.0)).alias("kind_share"))


def sections(ways: DataFrame, key: str, line: str, paths: DataFrame, name: str, path_line: str, byways: DataFrame, byway_line: str) -> DataFrame:
    """key, verdict, kind, share, length_m: sections of roads that the definitive record holds as a path or byway are 'dropped'; others stay, 'partly' where a long one runs on a path for a while.

    Lines of fewer than two different points are left out.
    """
    on_path = running(ways, key, line, paths, name, path_line)
    on_byway = running(ways, key, line, byways.select(F.lit(BYWAY).alias("_kind"), F.col(byway_line).alias("_byway")), "_kind", "_byway").select(key, F.col("share").alias("_on"))
    both = on_path.join(on_byway, key).join(ways.select(key, geo.length_m(F.col(line)).alias("length_m")), key)
    path, byway = F.col("share") >= DROPPED, F.col("_on") >= DROPPED
    verdict = F.when(path | byway, "dropped").when((F.col("share") >= PARTLY) & (F.col("length_m") >= PARTLY_M), "partly").otherwise("kept")
    return both.select(key, verdict.alias("verdict"), F.when(path, F.col("kind")).when(byway, BYWAY).alias("kind"), F.when(~path & byway, F.col("_on")).otherwise(F.col("share")).alias("share"), "length_m")


def drawn(features: DataFrame, key: str, parts: str, others: DataFrame, line: str, d: float = SAME) -> DataFrame:
    """key, share, length_m: how much of each feature's parts, by length, lies along the others' lines. Features without a line of two points are left out."""
    # Features are small and their points many, so features are dealt out before they are taken apart.
    each = features.select(key, parts).repartition(key).select(key, F.posexplode(parts).alias("_pos", "_line")).filter(F.size("_line") > 1)
    each = each.select(F.struct(key, "_pos").alias("_part"), "_line", geo.length_m(F.col("_line")).alias("_m"))
    shares = covered_share(each, others, "_part", "_line", d).join(grown(each).select("_part", "_m"), "_part")
    return shares.groupBy(F.col(f"_part.{key}").alias(key)).agg(F.coalesce(F.sum(F.col("share") * F.col("_m")) / F.nullif(F.sum("_m"), F.lit(0.0)), F.lit(0.0)).alias("share"), F.sum("_m").alias("length_m"))


def _lines_of(features: DataFrame, parts: str) -> DataFrame:
    return features.select(parts).repartition(parts).select(F.explode(parts).alias("_line")).filter(F.size("_line") > 1)


def settled(register: DataFrame, key: str, parts: str, layer: DataFrame, layer_key: str, layer_parts: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, dropped, added): a register held against the layer that decides which ways there are.

    Records that the layer still draws are kept as they are, the others dropped; what the layer draws and the kept ones
    lack is added, run by run (layer_key, pos, run, length_m, points in metres).
    """
    shares = drawn(register, key, parts, _lines_of(layer, layer_parts), "_line")
    kept = register.join(shares.filter(F.col("share") >= KEEP).select(key), key, "left_semi")
    dropped = register.join(shares.filter(F.col("share") < KEEP).select(key), key, "left_semi")
    theirs = layer.select(layer_key, F.posexplode(layer_parts).alias("pos", "_line")).filter(F.size("_line") > 1).select(F.struct(layer_key, "pos").alias("_part"), "_line")
    added = uncovered_runs(theirs, _lines_of(kept, parts), "_part", "_line")
    return kept, dropped, added.select("_part.*", "run", "length_m", "points")


def renewed(old: DataFrame, new: DataFrame, key: str, parts: str) -> tuple[DataFrame, DataFrame]:
    """(features, verdicts): a newer copy of a register in which unchanged records keep their rows, so their ids do not move.

    An old record that the new copy still draws is kept; a new one that the kept ones do not draw is added whole, and kept
    ones that the added draw give way. verdicts: side, key, verdict (kept, dropped, added, known), length_m, share.
    """
    first = cut(drawn(old, key, parts, _lines_of(new, parts), "_line"))
    held = old.join(first.filter(F.col("share") >= KEEP).select(key), key, "left_semi")
    fresh = cut(drawn(new, key, parts, _lines_of(held, parts), "_line"))
    added = new.join(fresh.filter(F.col("share") < KEEP).select(key), key, "left_semi")
    gives = cut(drawn(held, key, parts, _lines_of(added, parts), "_line").filter(F.col("share") >= KEEP).select(key))
    kept = held.join(gives, key, "left_anti")
    said = lambda df, side, verdict: df.select(F.lit(side).alias("side"), key, verdict.alias("verdict"), "length_m", "share")
    gone = first.join(gives.withColumn("_gives", F.lit(True)), key, "left")
    verdicts = said(gone, "old", F.when((F.col("share") >= KEEP) & F.col("_gives").isNull(), "kept").otherwise("dropped")).unionByName(said(fresh, "new", F.when(F.col("share") < KEEP, "added").otherwise("known")))
    return kept.unionByName(added), verdicts


def agrees(records: Column, kept: Column, ways: Column, new_share: Column) -> Column:
    """Null if a layer may replace a register, else why not."""
    return F.when(ways == 0, "the layer holds no ways").when((records > 0) & (kept < LEAST_KEPT * records), "the layer draws too few of the register's records").when((records > 0) & (new_share > MOST_NEW), "too much of the layer is not in the register")
