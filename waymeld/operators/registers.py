"""Registers of ways and orders: pieces of one way, twins, matches by place or reference, folds of two sources, links of builds."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymeld.functions import geo
from waymeld.operators import lines
from waymeld.operators.lineage import cut

#: Kilometres at which two pieces still touch.
TOUCH_KM = 0.025
#: Kinds of restriction by regulation type. Fixed values.
TYPES = {
    "miscRoadClosure": "prohibition",
    "miscLaneClosure": "prohibition",
    "movementOrderProhibitedAccess": "prohibition",
    "miscPedestrianZone": "prohibition",
    "miscFootwayClosure": "footway",
    "miscCycleLaneClosure": "footway",
    "mandatoryDirectionOneWay": "oneway",
    "miscContraflow": "oneway",
    "bannedMovementNoRightTurn": "turn",
    "bannedMovementNoLeftTurn": "turn",
    "bannedMovementNoUTurn": "turn",
    "dimensionMaximumWeightStructural": "weight",
    "dimensionMaximumWidth": "width",
    "dimensionMaximumHeightStructural": "height",
    "dimensionMaximumLength": "length",
    "miscSuspensionOfOneWay": "suspension",
    "miscSuspensionOfWeightRestriction": "suspension",
    "speedLimitValueBased": "speed",
}


def order_type(code: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair]), code), F.lit("other"))


def order_form(title: Column, start: Column, end: Column) -> Column:
    """experimental or seasonal by the order's own title, seasonal if it has both dates, else permanent."""
    t = F.coalesce(title, F.lit(""))
    dated = (F.coalesce(start, F.lit("")) != "") & (F.coalesce(end, F.lit("")) != "")
    return F.when(t.rlike(r"(?i)\bexperimental\b"), "experimental").when(t.rlike(r"(?i)\b(?:seasonal|temporar(?:y|ily)|ttro|t\.t\.r\.o)\b") | dated, "seasonal").otherwise("permanent")


def first_category(tags: Column, rules: list[tuple[str, list[tuple[str, str]]]]) -> Column:
    """Name of the first rule of which a (key, value) is among the tags; null if none. Rules are in order of precedence."""
    out = F.lit(None).cast("string")
    for name, selectors in reversed(rules):
        hit = F.lit(False)
        for key, value in selectors:
            hit = hit | F.coalesce(F.element_at(tags, F.lit(key)) == value, F.lit(False))
        out = F.when(hit, name).otherwise(out)
    return out


def usable(tags: Column, closed: tuple = ("private", "no")) -> Column:
    """False where the tags say plainly that nobody may; no tag passes."""
    return ~F.coalesce(F.element_at(tags, F.lit("access")).isin(*closed), F.lit(False))


def in_region(line: Column, box: tuple) -> Column:
    """Whether any point of a line lies in the box; a line may lie in several regions."""
    return F.coalesce(F.exists(line, lambda p: geo.in_box(p["x"], p["y"], box)), F.lit(False))


def lane_id(code: Column, number: Column, line: Column) -> Column:
    """code, number and ten digits of the digest of the points, to five places; the same way has the same id in every build."""
    written = F.array_join(F.transform(line, lambda p: F.format_string("%.5f,%.5f", p["x"], p["y"])), ";")
    return F.concat_ws("-", code, number, F.substring(F.sha1(written), 1, 10))


def joined(pieces: DataFrame, keys: list[str], piece: str, line: str, length: str, said: str) -> DataFrame:
    """One row per way: keys, pieces (ids in order), lines (each distinct one once), length (null if any is unknown), said (if all agree).

    A line that stands in several pieces counts once: pieces are folded by their line's digest first.
    """
    once = pieces.groupBy(*keys, F.sha2(F.to_json(F.struct(line)), 256).alias("_d")).agg(
        F.collect_list(piece).alias("_ids"), F.min_by(line, piece).alias("_line"), F.max(length).alias("_m"), F.min(said).alias("_s0"), F.max(said).alias("_s1"), F.count(said).alias("_n"), F.count("*").alias("_all"))
    out = once.groupBy(*keys).agg(
        F.sort_array(F.flatten(F.collect_list("_ids"))).alias("pieces"), F.sort_array(F.collect_list(F.struct("_d", "_line"))).alias("_lines"),
        F.when(F.count("_m") == F.count("*"), F.sum("_m")).alias("length"), F.when((F.min("_s0") == F.max("_s1")) & (F.sum("_n") == F.sum("_all")), F.min("_s0")).alias("said"))
    return out.withColumn("lines", F.transform("_lines", lambda x: x["_line"])).drop("_lines")


def gap_km(parts: Column | str) -> Column:
    """The widest distance from one chain of touching parts to the nearest other; 0 where all parts chain up."""
    return _gap_km(geo.boxed(F.col(parts) if isinstance(parts, str) else parts))


@F.pandas_udf(T.DoubleType())
def _gap_km(parts: pd.Series) -> pd.Series:
    def near(a: np.ndarray, b: np.ndarray) -> float:
        lat = np.radians((a[:, None, 1] + b[None, :, 1]) / 2)
        x, y = np.radians(b[None, :, 0] - a[:, None, 0]) * np.cos(lat), np.radians(b[None, :, 1] - a[:, None, 1])
        return float(np.hypot(x, y).min()) * geo.EARTH_M / 1000

    def one(rows) -> float:
        p = [np.array([(q["x"], q["y"]) for q in r["p"]], dtype=float) for r in rows if r["p"] is not None and len(r["p"])]
        if len(p) < 2:
            return 0.0
        far = np.array([[0.0 if i == j else near(a, b) for j, b in enumerate(p)] for i, a in enumerate(p)])
        chain = np.arange(len(p))
        for i, j in zip(*np.nonzero(far <= TOUCH_KM)):
            chain[chain == chain[j]] = chain[i]
        return max((float(far[np.ix_(chain == c, chain != c)].min()) for c in set(chain)), default=0.0) if len(set(chain)) > 1 else 0.0

    return parts.map(one, na_action="ignore")


def exact_twins(ways: DataFrame, within: list[str], key: str, line: str) -> DataFrame:
    """ways without those whose line, of the same values in `within`, a lesser key has too; `also` names the ones left out."""
    w = W.partitionBy(*within, F.sha2(F.to_json(F.struct(line)), 256))
    rows = ways.withColumn("_first", F.min(key).over(w)).withColumn("also", F.sort_array(F.collect_set(key).over(w)))
    return rows.filter(F.col(key) == F.col("_first")).withColumn("also", F.array_except("also", F.array(key))).drop("_first")


def nearest_line(points: DataFrame, ways: DataFrame, point: str, lon: str, lat: str, key: str, line: str, metres: float = 25.0, cell: float = 100.0) -> DataFrame:
    """point, key, m of the way whose line passes nearest each point, ties by key; null beyond `metres`.

    Segments are dealt to the cells around them, and each point keeps its best segment before anything is gathered.
    """
    legs = lines.segments(ways, key, line).select(F.col(key).alias("_way"), "ax", "ay", "bx", "by")
    dealt = legs.withColumn("cx", lines._span(F.col("ax"), F.col("bx"), metres, cell)).withColumn("cy", lines._span(F.col("ay"), F.col("by"), metres, cell))
    at = geo.metres(F.struct(F.col(lon).alias("x"), F.col(lat).alias("y")))
    asked = points.select(F.col(point).alias("_point"), at.alias("_at")).select("_point", F.col("_at.x").alias("x"), F.col("_at.y").alias("y")).withColumn("cx", F.floor(F.col("x") / cell)).withColumn("cy", F.floor(F.col("y") / cell))
    near = asked.join(dealt, ["cx", "cy"]).select("_point", "_way", geo.segment_m(F.col("x"), F.col("y"), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")).alias("m")).filter(F.col("m") <= metres)
    best = near.groupBy("_point").agg(F.min(F.struct("m", "_way")).alias("b"))
    return asked.select("_point").distinct().join(best, "_point", "left").select(F.col("_point").alias(point), F.col("b._way").alias(key), F.col("b.m").alias("m"))


def matched(items: DataFrame, item: str, by_place: DataFrame, by_reference: DataFrame, way: str) -> DataFrame:
    """item, way, how: ways by place where there are any, else by reference, else one row with a null way and 'unmatched'.

    by_place and by_reference: item, way. 'review' marks items of which both name ways and none is the same.
    """
    place, reference = by_place.select(item, way).distinct(), by_reference.select(item, way).distinct()
    both = place.select(item).distinct().join(reference.select(item).distinct(), item).join(place.join(reference, [item, way]).select(item).distinct(), item, "left_anti").select(item, F.lit("review").alias("_how"))
    left = items.select(item).distinct()
    one = place.join(both, item, "left").select(item, way, F.coalesce("_how", F.lit("place")).alias("how"))
    two = reference.join(place.select(item).distinct(), item, "left_anti").select(item, way, F.lit("reference").alias("how"))
    none = left.join(place.select(item).unionByName(reference.select(item)).distinct(), item, "left_anti").select(item, F.lit(None).cast(dict(place.dtypes)[way]).alias(way), F.lit("unmatched").alias("how"))
    return one.unionByName(two).unionByName(none)


def same_dates(a_start: Column, a_end: Column, a_form: Column, b_start: Column, b_end: Column, b_form: Column, start_days: int = 3, end_days: int = 14) -> Column:
    """Whether two orders have the same kind of life: both an end or neither, one form, and dates near where both have them."""
    near = lambda a, b, days: a.isNull() | b.isNull() | (F.abs(F.datediff(a, b)) <= days)
    return (a_end.isNull() == b_end.isNull()) & (F.coalesce(a_form, F.lit("permanent")) == F.coalesce(b_form, F.lit("permanent"))) & near(a_start, b_start, start_days) & near(a_end, b_end, end_days)


@F.pandas_udf(T.BooleanType())
def same_place(a: pd.Series, b: pd.Series) -> pd.Series:
    """Whether half of the shorter line, itself 20 m long at least, lies within 25 m of the other."""
    def one(p, q) -> bool:
        if p is None or q is None or not len(p) or not len(q):
            return False
        p, q = (np.array([(v["x"], v["y"]) for v in line], dtype=float) for line in (p, q))
        lat0 = math.radians(float(np.vstack([p, q])[:, 1].mean()))
        p, q = (line * [geo.LON_M * math.cos(lat0), geo.LAT_M] for line in (p, q))
        size = lambda line: float(np.hypot(*np.diff(line, axis=0).T).sum()) if len(line) > 1 else 0.0
        if size(p) > size(q):
            p, q = q, p
        return size(p) >= 20 and float((lines._onto(lines._taken(p, 10.0), q)[0] <= 25).mean()) >= 0.5

    return pd.Series([one(x, y) for x, y in zip(a, b)])


def _boxes_meet(a: Column, b: Column, metres: float) -> Column:
    """Whether the boxes of two lines, one grown by `metres`, have a place in common."""
    side = lambda line, axis, end: (F.array_max if end else F.array_min)(F.transform(line, lambda p: p[axis]))
    lat = metres / geo.LAT_M
    lon = metres / (geo.LON_M * F.greatest(F.cos(F.radians(F.greatest(F.abs(side(a, "y", 1)), F.abs(side(a, "y", 0))) + lat)), F.lit(1e-6)))
    meet = lambda axis, pad: (side(a, axis, 0) - pad <= side(b, axis, 1)) & (side(b, axis, 0) - pad <= side(a, axis, 1))
    return meet("y", lat) & meet("x", lon)


def folded(council: DataFrame, feed: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """council without the orders that the feed has too, and feed with `also`, the keys of those, and `ways` of both.

    Both: key, tra, kind, start, end (dates), form, line, ways. Two are one order if authority and kind are the same,
    their dates are near and their places overlap. Orders alike in all of these are held against others once, as one.
    Dates are dealt to buckets as wide as they may differ, ends where there are any, else starts, so an authority with
    very many orders is no all-pairs join; a null start without end meets every order without end of its authority and kind.
    """
    slot = lambda c, days: F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / days)
    bucket = lambda how, at: F.struct(F.lit(how).alias("how"), F.coalesce(at, F.lit(0)).cast("bigint").alias("at"))
    around = lambda how, c, days: [bucket(how, slot(c, days) + k) for k in (-1, 0, 1)]
    a = council.select(F.col(key).alias("ak"), "tra", "kind", F.col("start").alias("a_start"), F.col("end").alias("a_end"), F.col("form").alias("a_form"), F.col("line").alias("a_line"), F.col("ways").alias("a_ways"))
    b = feed.select(F.col(key).alias("bk"), "tra", "kind", F.col("start").alias("b_start"), F.col("end").alias("b_end"), F.col("form").alias("b_form"), F.col("line").alias("b_line"))
    said = ["tra", "kind", "a_start", "a_end", "a_form", "a_line"]
    asks = F.when(F.col("a_end").isNotNull(), F.array(*around("end", F.col("a_end"), 15))).when(F.col("a_start").isNotNull(), F.array(*around("start", F.col("a_start"), 4), bucket("none", F.lit(0)))).otherwise(F.array(bucket("all", F.lit(0))))
    answers = F.when(F.col("b_end").isNotNull(), F.array(bucket("end", slot(F.col("b_end"), 15)))).when(F.col("b_start").isNotNull(), F.array(bucket("start", slot(F.col("b_start"), 4)), bucket("all", F.lit(0)))).otherwise(F.array(bucket("none", F.lit(0)), bucket("all", F.lit(0))))
    spread = a.select(said).distinct().withColumn("slot", F.explode(asks))
    alike = b.groupBy("tra", "kind", "b_start", "b_end", "b_form", "b_line").agg(F.min("bk").alias("bk")).withColumn("slot", F.explode(answers))
    pairs = spread.join(alike, ["tra", "kind", "slot"]).filter(same_dates(F.col("a_start"), F.col("a_end"), F.col("a_form"), F.col("b_start"), F.col("b_end"), F.col("b_form")))
    # Boxes that lie apart are settled before lines leave the JVM. An order folds into one twin only, the one with the least key.
    met = pairs.filter(_boxes_meet(F.col("a_line"), F.col("b_line"), 25.0)).filter(same_place("a_line", "b_line")).groupBy(said).agg(F.min("bk").alias("bk"))
    found = a.alias("a").join(met.alias("m"), [F.col(f"a.{c}").eqNullSafe(F.col(f"m.{c}")) for c in said]).select("ak", "bk", "a_ways")
    twins = found.groupBy("ak").agg(F.min("bk").alias("bk"), F.first("a_ways").alias("a_ways"))
    taken = twins.groupBy(F.col("bk").alias(key)).agg(F.sort_array(F.collect_list("ak")).alias("also"), F.flatten(F.collect_list("a_ways")).alias("_more"))
    more = feed.join(taken, key, "left").withColumn("ways", F.when(F.col("_more").isNotNull(), F.sort_array(F.array_union(F.coalesce("ways", F.array().cast("array<string>")), "_more"))).otherwise(F.col("ways"))).drop("_more")
    return council.join(twins.select(F.col("ak").alias(key)), key, "left_anti"), more


def reaching(links: DataFrame, published: DataFrame) -> DataFrame:
    """Those links (file, from, to) from which a chain leads to the file's published build. published: file, build.

    Walked backwards, a round per step of the longest history, each a join by file and build; a build met before is
    not walked from again, so circles end.
    """
    found = published.select("file", F.col("build").alias("to"))
    edge, out = found, None
    while True:
        step = cut(links.join(edge, ["file", "to"], "left_semi").select("file", "from", "to"))
        out = step if out is None else out.unionByName(step)
        edge = cut(step.select("file", F.col("from").alias("to")).distinct().join(found, ["file", "to"], "left_anti"))
        if edge.isEmpty():
            return out.distinct()
        found = found.unionByName(edge)


def firing(spark, cron: str, start: str, days: int) -> DataFrame:
    """`at`: every time that a five-field cron line fires in `days` days from `start`.

    Where both day fields are restricted, either may match; Sunday is 0 and 7.
    """
    def field(text: str, lo: int, hi: int) -> list[int]:
        out: set[int] = set()
        for part in text.split(","):
            span, _, step = part.partition("/")
            a, _, b = span.partition("-")
            first, last = (lo, hi) if span == "*" else (int(a), int(b) if b else hi if step else int(a))
            out |= set(range(first, last + 1, int(step or 1)))
        return sorted(out)

    parts = cron.split()
    if len(parts) != 5:
        raise ValueError(f"{cron!r} does not have five fields")
    minutes, hours, doms, months, dows = (field(p, lo, hi) for p, (lo, hi) in zip(parts, ((0, 59), (0, 23), (1, 31), (1, 12), (0, 7))))
    rows = spark.range(days).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("d"))
    by_dom, by_dow = F.dayofmonth("d").isin(doms), (F.dayofweek("d") - 1).isin([x % 7 for x in dows])
    day = by_dom & by_dow if "*" in (parts[2], parts[4]) else by_dom | by_dow
    times = [F.expr(f"INTERVAL {h} HOURS {m} MINUTES") for h in hours for m in minutes]
    return rows.filter(F.month("d").isin(months) & day).select(F.explode(F.array(*[F.col("d").cast("timestamp") + t for t in times])).alias("at"))


def age_summary(df: DataFrame, by: list[str], date: str, today: Column) -> DataFrame:
    """Per group: rows, dated, unknown, future_dated, over_year, newest, median, p90 and oldest age in days by nearest rank; future dates count as age 0."""
    from waymeld.functions.dates import iso_day

    raw = df.withColumn("_raw", F.datediff(today, iso_day(F.col(date)))).withColumn("_age", F.greatest("_raw", F.lit(0)))
    raw = raw.withColumn("_age", F.when(F.col("_raw").isNotNull(), F.col("_age")))
    counts = raw.groupBy(*by, "_age").agg(F.count("*").alias("_c"), F.count_if(F.col("_raw") < 0).alias("_f"))
    g = W.partitionBy(*by)
    upto = counts.withColumn("_n", F.coalesce(F.sum(F.when(F.col("_age").isNotNull(), F.col("_c"))).over(g), F.lit(0))).withColumn("_upto", F.sum(F.when(F.col("_age").isNotNull(), F.col("_c"))).over(g.orderBy(F.col("_age").asc_nulls_last()).rowsBetween(W.unboundedPreceding, 0)))
    rank = lambda p: F.greatest(F.lit(1), F.bround(F.col("_n") * p / 100.0).cast("bigint"))
    return upto.groupBy(*by).agg(
        F.sum("_c").alias("rows"), F.max("_n").alias("dated"), (F.sum("_c") - F.max("_n")).alias("unknown"), F.sum("_f").alias("future_dated"), F.coalesce(F.sum(F.when(F.col("_age") > 365, F.col("_c"))), F.lit(0)).alias("over_year"),
        F.min("_age").alias("newest"), F.min(F.when(F.col("_upto") >= rank(50), F.col("_age"))).alias("median"), F.min(F.when(F.col("_upto") >= rank(90), F.col("_age"))).alias("p90"), F.max("_age").alias("oldest"))


def next_stamp(published: Column, candidate: Column, now: Column) -> Column:
    """The time a changed build carries: its own if later than the published one, else now, and never the published one's or before."""
    return F.when(published.isNull() | (candidate > published), F.coalesce(candidate, now)).otherwise(F.greatest(now, published + F.expr("INTERVAL 1 SECOND")))


def near_in_time(df: DataFrame, key: str, row: str, at: str, days: int) -> DataFrame:
    """a, b (a < b): rows of one key whose dates are at most `days` apart.

    Rows are dealt to buckets of days + 1, one side to the next bucket too, so a key with very many rows meets only
    what is near in time.
    """
    slot = F.floor(F.datediff(F.col(at), F.lit("1970-01-01").cast("date")) / (days + 1))
    one = df.filter(F.col(at).isNotNull()).select(key, F.col(row).alias("a"), F.col(at).alias("_at"), slot.alias("_s"))
    two = one.select(key, F.col("a").alias("b"), F.col("_at").alias("_bt"), F.explode(F.array(*[F.col("_s") + k for k in (-1, 0, 1)])).alias("_s"))
    return one.join(two, [key, "_s"]).filter((F.col("a") < F.col("b")) & (F.abs(F.datediff("_at", "_bt")) <= days)).select("a", "b")


def in_boxes(points: DataFrame, lon: str, lat: str, boxes: DataFrame, name: str, cell: float = 1.0) -> DataFrame:
    """points with `name` of each box (west, south, east, north) that holds them, edges included; a point may be in several.

    Boxes are dealt to the cells they cover, so points meet only the boxes of their own cell.
    """
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / cell), F.floor(F.col(b) / cell)))
    dealt = boxes.select(name, "west", "south", "east", "north").withColumn("_x", span("west", "east")).withColumn("_y", span("south", "north"))
    asked = points.withColumn("_x", F.floor(F.col(lon) / cell)).withColumn("_y", F.floor(F.col(lat) / cell))
    inside = F.col(lon).between(F.col("west"), F.col("east")) & F.col(lat).between(F.col("south"), F.col("north"))
    return asked.join(dealt, ["_x", "_y"]).filter(inside).select(*points.columns, name)


def _box(line: Column) -> Column:
    of = lambda f, c: f(F.transform(line, lambda p: p[c]))
    return F.struct(of(F.array_min, "x").alias("west"), of(F.array_min, "y").alias("south"), of(F.array_max, "x").alias("east"), of(F.array_max, "y").alias("north"))


def bounds(ways: DataFrame, by: str, line: str) -> DataFrame:
    """by, west, south, east, north: the box around all points; null where there are none."""
    return ways.select(by, _box(F.col(line)).alias("b")).groupBy(by).agg(F.min("b.west").alias("west"), F.min("b.south").alias("south"), F.max("b.east").alias("east"), F.max("b.north").alias("north"))


def boxes_meeting(a: DataFrame, key: str, line: str, b: DataFrame, other: str, other_line: str, cell: float) -> DataFrame:
    """key, other: lines whose boxes meet, edges included; lines without points meet none.

    Boxes are dealt to the cells that they touch, and a pair is given by the one cell that holds the lower left corner
    of what the two share, so none comes twice and nothing needs to be made distinct.
    """
    def dealt(df: DataFrame, k: str, col: str, to: str) -> DataFrame:
        box = df.filter(F.size(col) > 0).select(F.col(k), _box(F.col(col)).alias(to))
        span = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(f"{to}.{lo}") / cell), F.floor(F.col(f"{to}.{hi}") / cell)))
        return box.withColumn("cx", span("west", "east")).withColumn("cy", span("south", "north"))

    met = dealt(a, key, line, "_a").join(dealt(b, other, other_line, "_b"), ["cx", "cy"])
    meet = (F.col("_a.west") <= F.col("_b.east")) & (F.col("_b.west") <= F.col("_a.east")) & (F.col("_a.south") <= F.col("_b.north")) & (F.col("_b.south") <= F.col("_a.north"))
    home = (F.floor(F.greatest("_a.west", "_b.west") / cell) == F.col("cx")) & (F.floor(F.greatest("_a.south", "_b.south") / cell) == F.col("cy"))
    return met.filter(meet & home).select(key, other)
