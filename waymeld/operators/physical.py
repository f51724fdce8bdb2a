"""What a survey says of recorded ways: which surveyed lines lie under a way, and the physical attributes they give it."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymeld.functions import geo, text
from waymeld.operators import lines
from waymeld.operators.sizes import grown

#: Metres between points taken along a way, and within which a point is on a line; least |cos| of the angle between the two.
STEP, ON, COS = 25.0, 20.0, 0.70
#: Points that a line covers at least, the share of a way's points that it covers at least, and that all of them must cover.
LEAST, SHARE, UNION = 2, 0.10, 0.60
#: Tags of a line that give its width, and of a barrier that give its gap, first found first.
WIDTHS, GAPS = ("width", "maxwidth", "est_width", "maxwidth:physical"), ("maxwidth", "width", "opening", "maxwidth:physical")
ATTRIBUTES = ("surface", "smoothness", "tracktype")


def _spaced(p: np.ndarray) -> np.ndarray:
    if len(p) < 2:
        return np.zeros((0, 3))
    p = np.column_stack((p[:, 0] * geo.LON_M * np.cos(np.radians(p[:, 1])), p[:, 1] * geo.LAT_M))
    d = np.diff(p, axis=0)
    size = np.hypot(d[:, 0], d[:, 1])
    ends = np.cumsum(size)
    at = np.linspace(0.0, ends[-1], max(3, int(ends[-1] / STEP) + 1))
    leg = np.minimum(np.searchsorted(ends, at, side="left"), len(size) - 1)
    t = np.clip(np.divide(at - (ends[leg] - size[leg]), size[leg], out=np.zeros(len(at)), where=size[leg] > 0), 0, 1)[:, None]
    return np.column_stack((p[leg] + d[leg] * t, np.arctan2(d[leg, 1], d[leg, 0])))


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField(c, T.DoubleType()) for c in ("x", "y", "angle")])))
def spaced(line: pa.Array) -> pa.Array:
    """Points of a line in metres, evenly spaced about STEP apart and three at least, with the bearing of their segment. Lines of fewer than two points have none."""
    return geo.by_line(line, _spaced, ("x", "y", "angle"))


def hits(ways: DataFrame, key: str, line: str, surveyed: DataFrame, other: str, other_line: str, cell: float = 200.0) -> tuple[DataFrame, DataFrame]:
    """(key, other, points: numbers of the way's points that lie on the line and run with it), (key, total: the way's points)."""
    # Lines are small and their points many, so lines are dealt out before they are taken apart.
    each = ways.select(key, line).repartition(key).select(key, spaced(line).alias("_s"))
    # Outer, since the filter that Spark adds to a plain one would be pushed below the dealing and take the lines apart there too.
    pts = each.select(key, F.posexplode_outer("_s").alias("i", "p")).filter("i IS NOT NULL").select(key, "i", "p.*")
    legs = lines.segments(surveyed.select(F.col(other).alias("_o"), other_line).repartition("_o"), "_o", other_line).withColumn("_a", F.atan2(F.col("by") - F.col("ay"), F.col("bx") - F.col("ax")))
    dealt = legs.withColumn("cx", lines._span(F.col("ax"), F.col("bx"), ON, cell)).withColumn("cy", lines._span(F.col("ay"), F.col("by"), ON, cell))
    met = pts.withColumn("cx", F.floor(F.col("x") / cell)).withColumn("cy", F.floor(F.col("y") / cell)).join(grown(dealt), ["cx", "cy"]).filter(
        (geo.segment_m(F.col("x"), F.col("y"), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")) <= ON) & (F.abs(F.cos(F.col("_a") - F.col("angle"))) >= COS))
    return met.groupBy(key, F.col("_o").alias(other)).agg(F.sort_array(F.collect_set("i")).alias("points")), pts.groupBy(key).agg(F.count("*").alias("total"))


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("line", "weight", "fresh")])))
def _greedy(lines_points: pd.Series) -> pd.Series:
    """Of one way's lines in order, those that are taken: their place in it, their points, and how many of these are new."""
    def one(found) -> list:
        left, covered, out = [(i, set(map(int, f["p"]))) for i, f in enumerate(found)], set(), []
        while left:
            best = max(left, key=lambda r: len(r[1] - covered))
            new = best[1] - covered
            if not new:
                break
            covered |= new
            out.append({"line": best[0], "weight": len(best[1]), "fresh": len(new)})
            left.remove(best)
        return out

    return lines_points.map(one)


def under(ways: DataFrame, key: str, line: str, surveyed: DataFrame, other: str, other_line: str) -> DataFrame:
    """key, other, weight (points covered), cover: surveyed lines under each way, and the share of its points that all of them cover.

    A way is usually several surveyed lines end to end, so lines are taken greedily, most new points first; of equals the
    one that is met first along the way, then the lesser key. Lines that cover too few points are out before any is taken.
    A way with no line has no row. One group holds one way's lines, a number each per point.
    """
    found, totals = hits(ways, key, line, surveyed, other, other_line)
    good = found.join(grown(totals), key).filter((F.size("points") >= LEAST) & (F.size("points") >= SHARE * F.col("total")))
    row = F.struct(F.get("points", 0).alias("at"), F.col(other).alias("o"), F.col("points").alias("p"))
    ways_lines = good.groupBy(key).agg(F.sort_array(F.collect_list(row)).alias("_l"), F.first("total").alias("_n"))
    taken = ways_lines.withColumn("_t", _greedy(F.transform("_l", lambda l: F.struct(l["p"].alias("p")))))
    cover = F.aggregate("_t", F.lit(0).cast("bigint"), lambda s, t: s + t["fresh"]) / F.col("_n")
    return taken.select(key, "_l", cover.alias("cover"), F.explode_outer("_t").alias("_t")).select(key, F.get("_l", F.col("_t.line").cast("int"))["o"].alias(other), F.col("_t.weight").alias("weight"), "cover")


def narrowest(tags: Column, names: tuple = WIDTHS) -> Column:
    """The least credible width that tags give, in metres."""
    return F.array_min(F.array(*[text.width_m(tags[n]) for n in names]))


def gap(tags: Column) -> Column:
    """The gap that a barrier's tags give, in metres; never a usual one."""
    return F.coalesce(*[text.width_m(tags[n]) for n in GAPS])


def attributes(chosen: DataFrame, key: str, other: str, tags: DataFrame, barriers: DataFrame) -> DataFrame:
    """key and its surface, smoothness, tracktype, width_m, min_width_m, barriers, from `chosen` (key, other, weight).

    tags: other, tags. barriers: key, kind, tags of the barriers on a way. The value that covers most points stands, of
    equals the lesser; the width is the mean by points covered; the least width also counts the barriers' gaps. What
    nothing says is null, and `barriers` is empty where none is mapped.
    """
    rows = chosen.join(tags.select(other, "tags"), other)
    said = rows.select(key, "weight", F.inline(F.array(*[F.struct(F.lit(a).alias("name"), F.nullif(F.col("tags")[a], F.lit("")).alias("value")) for a in ATTRIBUTES]))).filter("value IS NOT NULL")
    best = said.groupBy(key, "name", "value").agg(F.sum("weight").alias("w")).groupBy(key, "name").agg(F.min(F.struct((-F.col("w")).alias("less"), "value")).alias("b"))
    values = best.groupBy(key).agg(*[F.max(F.when(F.col("name") == a, F.col("b.value"))).alias(a) for a in ATTRIBUTES])
    wide = rows.withColumn("_w", narrowest(F.col("tags"))).groupBy(key).agg(
        F.round(F.sum(F.col("_w") * F.col("weight")) / F.sum(F.when(F.col("_w").isNotNull(), F.col("weight"))), 2).alias("width_m"), F.min("_w").alias("_least"))
    stops = barriers.groupBy(key).agg(F.min(gap(F.col("tags"))).alias("_gap"), F.sort_array(F.collect_list("kind")).alias("barriers"))
    out = wide.join(values, key, "left").join(stops, key, "left")
    return out.select(key, *ATTRIBUTES, "width_m", F.round(F.least("_least", "_gap"), 2).alias("min_width_m"), F.coalesce("barriers", F.array().cast("array<string>")).alias("barriers"))


def coverage(rows: DataFrame) -> DataFrame:
    """ways and the percentages of them that are matched, and that have each attribute, any, or a barrier. rows: attributes with cover; null cover is none."""
    share = lambda c: F.coalesce(100.0 * F.avg(F.coalesce(c, F.lit(False)).cast("double")), F.lit(0.0))
    known = {a: F.col(a).isNotNull() for a in ("width_m", *ATTRIBUTES)}
    return rows.agg(F.count("*").alias("ways"), share(F.col("cover") >= UNION).alias("matched_pct"), *[share(c).alias(f"{a.removesuffix('_m')}_pct") for a, c in known.items()],
                    share(known["width_m"] | known["surface"] | known["smoothness"] | known["tracktype"]).alias("any_pct"), share(F.size("barriers") > 0).alias("barrier_pct"))


def designation_basis(designated: DataFrame) -> DataFrame:
    """scope ('all', or 'open' without the restricted), ways and the percentages that carry a tag of width, surface, smoothness, tracktype. An empty tag is none."""
    has = lambda *names: F.coalesce(F.greatest(*[F.coalesce(F.col("tags")[n] != "", F.lit(False)) for n in names], F.lit(False)), F.lit(False))
    scoped = designated.select("tags", F.explode(F.when(F.contains(F.col("tags")["designation"], F.lit("restricted")), F.array(F.lit("all"))).otherwise(F.array(F.lit("all"), F.lit("open")))).alias("scope"))
    share = lambda *names: 100.0 * F.avg(has(*names).cast("double"))
    return scoped.groupBy("scope").agg(F.count("*").alias("ways"), share("width", "maxwidth", "est_width").alias("width_pct"), *[share(a).alias(f"{a}_pct") for a in ATTRIBUTES])
