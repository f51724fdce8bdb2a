"""Orders and street works put on ways: by the streets a way runs along, by references, by places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymeld.functions import geo, text
from waymeld.operators import lines
from waymeld.operators.cdc import latest_by_key

#: Metres within which a way runs along a street; the share and the metres of it that must do so; how near an activity's point must be.
ON, SHARE, ALONG_M, POINT_M = 12.0, 0.25, 50.0, 150.0
#: Metres from a grid reference at which a way may be meant, and beyond which one named by its number is doubted.
NEAR_M, DOUBT_M = 150.0, 300.0


def streets_along(ways: DataFrame, key: str, line: str, streets: DataFrame, street: str, street_line: str) -> DataFrame:
    """key, street, share: streets that a way runs along for a quarter of its length and 50 metres at least."""
    pts = lines.samples(ways, key, line)
    legs = lines.segments(streets.select(F.col(street).alias("_street"), F.col(street_line).alias("_line")).filter("_street IS NOT NULL"), "_street", "_line")
    dealt = legs.withColumn("cx", lines._span(F.col("ax"), F.col("bx"), ON, lines.CELL)).withColumn("cy", lines._span(F.col("ay"), F.col("by"), ON, lines.CELL))
    asked = pts.withColumn("cx", F.floor(F.col("x") / lines.CELL)).withColumn("cy", F.floor(F.col("y") / lines.CELL))
    met = asked.join(dealt, ["cx", "cy"]).filter(geo.segment_m(F.col("x"), F.col("y"), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")) <= ON).select(key, "_at", "_street").distinct()
    sizes = pts.groupBy(key).agg(F.count("*").alias("_n")).join(ways.groupBy(key).agg(F.sum(geo.length_m(F.col(line))).alias("_m")), key)
    shares = met.groupBy(key, "_street").agg(F.count("*").alias("_hit")).join(sizes, key).withColumn("share", F.col("_hit") / F.col("_n"))
    return shares.filter((F.col("share") >= SHARE) & (F.col("share") * F.col("_m") >= ALONG_M)).select(key, F.col("_street").alias(street), "share")


def is_closure(cancelled: Column, management: Column, kind: Column, name: Column) -> Column:
    """Whether an activity shuts a road: it says so, or its words do, and it is not cancelled."""
    words = F.concat_ws(" ", kind, name).rlike(r"(?i)temporary traffic regulation|\bTTR[ON]\b|\bclosure\b|\bclosed\b")
    return (F.lower(F.coalesce(cancelled, F.lit(""))) != "yes") & (F.coalesce(management == "road_closure", F.lit(False)) | words)


def grid_point(wkt: Column) -> Column:
    """(easting, northing) of a point in text, null off the grid."""
    at = lambda n: F.regexp_extract(wkt, r"(?i)POINT\s*\(\s*([-\d.]+)\s+([-\d.]+)\s*\)", n).try_cast("double")
    e, n = at(1), at(2)
    return F.when((e > 0) & (e < 800000) & (n > 0) & (n < 1400000), F.struct(e.alias("easting"), n.alias("northing")))


def newest(events: DataFrame, key: str, at: str, read: str) -> DataFrame:
    """The newest event of each key, of equal times the last read; events without a time are the oldest."""
    return latest_by_key(events.filter(F.col(key).isNotNull()), key, F.coalesce(F.col(at), F.lit("")).desc(), F.col(read).desc())


def distances(pairs: DataFrame, a: str, x: str, y: str, ways: DataFrame, key: str, line: str) -> DataFrame:
    """a, key, m: metres from each pair's points (degrees) to the way, the least of several."""
    legs = lines.segments(ways, key, line)
    at = pairs.select(a, key, geo.metres(F.struct(F.col(x).alias("x"), F.col(y).alias("y"))).alias("_p"))
    return at.join(legs, key).groupBy(a, key).agg(F.min(geo.segment_m(F.col("_p.x"), F.col("_p.y"), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))).alias("m"))


def put_on_ways(activities: DataFrame, along: DataFrame, ways: DataFrame, key: str, line: str, street: str, today: str) -> DataFrame:
    """activity, ways, start, end: closures whose street a way runs along, that have a start and have not ended.

    activities: activity, street, start, end (texts of dates), closes (boolean), lon, lat. A street may run on for miles, so
    an activity that has a point must be within 150 m of the way; one without passes. Activities on no way are left out.
    """
    day = lambda c: F.nullif(F.substring(F.coalesce(c, F.lit("")), 1, 10), F.lit(""))
    open_ = activities.filter("closes").withColumns({"start": day(F.col("start")), "end": day(F.col("end"))}).filter(F.col("start").isNotNull() & (F.col("end").isNull() | (F.col("end") >= today)))
    pairs = open_.withColumn("_street", F.nullif(F.trim(F.col("street").cast("string")), F.lit(""))).join(along.select(key, F.col(street).cast("string").alias("_street")).distinct(), "_street").join(ways.select(key), key, "left_semi")
    known = F.col("lon").isNotNull() & F.col("lat").isNotNull()
    close = distances(pairs.filter(known), "activity", "lon", "lat", ways, key, line).filter(F.col("m") <= POINT_M).select("activity", key)
    kept = pairs.filter(known).join(close, ["activity", key], "left_semi").unionByName(pairs.filter(~known))
    return kept.groupBy("activity").agg(F.array_sort(F.collect_set(key)).alias("ways"), F.max("start").alias("start"), F.max("end").alias("end"))


def matched_orders(orders: DataFrame, ways: DataFrame) -> DataFrame:
    """order, ways, how, problem of sealed orders.

    orders: order, authorities (array), parish, paths (array of struct code, number; a null code means the parish), points
    (array of x, y in degrees), pinned (array of way ids). ways: uid, authority, class, parish, number, line; a parish and
    number as compared (text.parish_key, text.number_key). Pinned ways win, if all of them are known. Then references: ways
    of that number, or byways that are sections of it; they are doubted if over 300 m from every point given. Without any,
    byways within 150 m of a point are a suggestion.
    """
    pinned = orders.filter(F.size("pinned") > 0)
    looked = pinned.select("order", F.explode("pinned").alias("uid")).distinct().join(ways.select("uid", F.lit(True).alias("_known")), "uid", "left")
    fixed = looked.groupBy("order").agg(F.array_sort(F.collect_list("uid")).alias("ways"), F.count_if(F.col("_known").isNull()).alias("_lost")).select("order", F.when(F.col("_lost") == 0, F.col("ways")).otherwise(F.array().cast("array<string>")).alias("ways"), F.when(F.col("_lost") == 0, "reviewed").alias("how"), F.when(F.col("_lost") > 0, "pinned ways are gone").alias("problem"))
    rest = orders.filter(F.coalesce(F.size("pinned"), F.lit(0)) <= 0)

    asked = rest.select("order", "parish", F.explode("authorities").alias("authority"), "paths").select("order", "parish", "authority", F.posexplode("paths").alias("_i", "p"))
    places = F.when(F.col("p.code").isNotNull(), F.array("p.code")).otherwise(F.when(F.size(text.parish_variants(F.col("parish"))) > 0, text.parish_variants(F.col("parish"))).otherwise(F.array(F.lit(""))))
    wanted = asked.select("order", "authority", "_i", F.col("p.code").isNotNull().alias("_coded"), F.posexplode(places).alias("_v", "_place"), text.number_key(F.col("p.number")).alias("head")).withColumn("parish", text.parish_key(F.col("_place"))).filter("head <> ''")
    parts = F.split("number", "/")
    heads = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    numbered = ways.filter("number <> ''").select("uid", "authority", "class", "parish", "number", F.explode(heads).alias("head"))
    found = wanted.join(numbered, ["authority", "parish", "head"]).withColumn("_whole", F.col("number") == F.col("head")).filter("_whole OR (class = 'boat' AND NOT _coded)")
    best = found.groupBy("order", "authority", "_i", "_v").agg(F.max("_whole").alias("_any"), F.collect_set(F.when(F.col("_whole"), F.col("uid"))).alias("_exact"), F.collect_set("uid").alias("_all"))
    named = best.select("order", F.explode(F.when(F.col("_any"), F.col("_exact")).otherwise(F.col("_all"))).alias("uid")).distinct()

    points = rest.select("order", "authorities", F.explode("points").alias("p")).select("order", "authorities", F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    nearest = distances(named.join(points, "order"), "order", "x", "y", ways, "uid", "line").groupBy("order").agg(F.min("m").alias("_m"))
    by_name = named.groupBy("order").agg(F.array_sort(F.collect_list("uid")).alias("ways")).join(nearest, "order", "left").select("order", "ways", F.lit("reference").alias("how"), F.when(F.col("_m") > DOUBT_M, "far from the grid references").alias("problem"))

    free = points.join(named.select("order"), "order", "left_anti").withColumn("_p", geo.metres(F.struct("x", "y")))
    cell = DOUBT_M
    legs = lines.segments(ways, "uid", "line").join(ways.select("uid", "authority"), "uid")
    dealt = legs.withColumn("cx", lines._span(F.col("ax"), F.col("bx"), NEAR_M, cell)).withColumn("cy", lines._span(F.col("ay"), F.col("by"), NEAR_M, cell))
    spot = free.select("order", F.explode("authorities").alias("authority"), F.col("_p.x").alias("px"), F.col("_p.y").alias("py")).withColumn("cx", F.floor(F.col("px") / cell)).withColumn("cy", F.floor(F.col("py") / cell))
    close = spot.join(dealt, ["cx", "cy", "authority"]).filter(geo.segment_m(F.col("px"), F.col("py"), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")) <= NEAR_M)
    by_place = close.groupBy("order").agg(F.array_sort(F.collect_set("uid")).alias("ways")).select("order", "ways", F.lit("grid").alias("how"), F.lit("by grid reference only").alias("problem"))

    said = by_name.unionByName(by_place)
    none = rest.select("order").distinct().join(said.select("order"), "order", "left_anti").select("order", F.array().cast("array<string>").alias("ways"), F.lit(None).cast("string").alias("how"), F.lit("no way matches").alias("problem"))
    return fixed.unionByName(said).unionByName(none)


def pieces_joined(items: DataFrame, key: str, same: list[str], parts: str) -> DataFrame:
    """One item per order and way: items alike in `same`, nulls equal, are the one of least key, with the parts of all in order of key."""
    rest = [c for c in items.columns if c not in (*same, parts)]
    out = items.groupBy(*same).agg(F.min_by(F.struct(*rest), key).alias("_r"), F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), F.col(parts).alias("p")))).alias("_p"))
    return out.select(*[F.col(f"_r.{c}").alias(c) for c in rest], *same, F.flatten(F.transform("_p", lambda x: x["p"])).alias(parts))
