"""Traffic orders: nested records to one row per restriction and place, validity, and what a change event is worth.

A record is JSON text. Lists of one element are sometimes published as bare objects, so every list is read as text
first and taken as it comes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Regulation types worth carrying and their labels. Fixed values.
KINDS = {
    "miscRoadClosure": "Road closed",
    "miscLaneClosure": "Lane closed",
    "miscFootwayClosure": "Footway closed",
    "miscCycleLaneClosure": "Cycle lane closed",
    "movementOrderProhibitedAccess": "No access",
    "miscPedestrianZone": "Pedestrian zone",
    "mandatoryDirectionOneWay": "One way",
    "miscSuspensionOfOneWay": "One way suspended",
    "bannedMovementNoRightTurn": "No right turn",
    "bannedMovementNoLeftTurn": "No left turn",
    "bannedMovementNoUTurn": "No U-turn",
    "miscContraflow": "Contraflow",
    "dimensionMaximumWeightStructural": "Weight limit",
    "dimensionMaximumHeightStructural": "Height limit",
    "dimensionMaximumWidth": "Width limit",
    "dimensionMaximumLength": "Length limit",
    "miscSuspensionOfWeightRestriction": "Weight limit suspended",
}
SPEED = "speedLimitValueBased"
HORIZON_DAYS = 90


def items(text: Column) -> Column:
    """The objects of a JSON array, or a bare object as an array of one; anything else is empty."""
    t = F.trim(text)
    many = F.filter(F.from_json(t, "array<string>"), lambda x: F.startswith(F.trim(x), F.lit("{")))
    return F.when(F.startswith(t, F.lit("[")), F.coalesce(many, F.array().cast("array<string>"))).when(F.startswith(t, F.lit("{")), F.array(t)).otherwise(F.array().cast("array<string>"))


def strings(text: Column) -> Column:
    """The non-empty texts of a JSON array of texts, or a bare text as an array of one."""
    t = F.trim(text)
    many = F.filter(F.from_json(t, "array<string>"), lambda x: x.isNotNull() & (x != ""))
    return F.when(F.startswith(t, F.lit("[")), F.coalesce(many, F.array().cast("array<string>"))).when(F.coalesce(t, F.lit("")) != "", F.array(t)).otherwise(F.array().cast("array<string>"))


def at(text: Column, path: str) -> Column:
    return F.get_json_object(text, f"$.{path}")


def validity(regulation: Column) -> Column:
    """(start, end, placeholder): the widest window over a regulation's conditions; an open end of one opens all."""
    spans = F.filter(F.transform(items(at(regulation, "condition")), lambda c: at(c, "timeValidity")), lambda v: F.startswith(F.trim(v), F.lit("{")))
    starts = F.filter(F.transform(spans, lambda v: F.substring(at(v, "start"), 1, 10)), lambda d: F.coalesce(d, F.lit("")) != "")
    ends = F.transform(spans, lambda v: F.substring(at(v, "end"), 1, 10))
    open_ = F.exists(ends, lambda d: F.coalesce(d, F.lit("")) == "") | (F.size(ends) == 0)
    slot = F.exists(spans, lambda v: ~F.coalesce(at(v, "isPlaceholderTro"), F.lit("false")).isin("false", "", "0"))
    return F.struct(F.array_min(starts).alias("start"), F.when(~open_, F.array_max(ends)).alias("end"), slot.alias("placeholder"))


def kind(regulation: Column) -> Column:
    """(code, label) of a regulation worth carrying, else null. A general regulation decides before a speed limit."""
    general, code = at(regulation, "generalRegulation"), at(regulation, "generalRegulation.regulationType")
    mph = at(regulation, f"{SPEED}.mphValue")
    label = F.element_at(F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair]), code)
    return F.when(F.startswith(F.trim(general), F.lit("{")), F.when(code.isin(*KINDS), F.struct(code.alias("code"), label.alias("label")))).when(
        mph.isNotNull(), F.struct(F.lit(SPEED).alias("code"), F.concat(mph, F.lit(" mph")).alias("label")))


def expired(end: Column, today: Column) -> Column:
    """The day of the end still counts; no end never is over."""
    return F.coalesce(end < today, F.lit(False))


def not_yet(start: Column, today: Column, horizon_days: int = HORIZON_DAYS) -> Column:
    return F.coalesce(start > F.date_format(F.date_add(F.to_date(today), horizon_days), "yyyy-MM-dd"), F.lit(False))


def restrictions(records: DataFrame, body: str, today: str, keep_expired: bool = False, horizon_days: int = HORIZON_DAYS, keep: tuple = ()) -> DataFrame:
    """One row per provision, regulation and place of each record: columns in `keep`, then ref, name, tra, code, label, start, end, where, wkt.

    Placeholders, other kinds, diversions and places without geometry go; so do orders that are over or start beyond
    the horizon, unless `keep_expired`. Broken or missing records give no rows.
    """
    source = records.select(*keep, at(F.col(body), "source").alias("_s")).filter("_s LIKE '{%'")
    heads = source.select(*keep, at(F.col("_s"), "reference").alias("ref"), at(F.col("_s"), "troName").alias("name"),
                          F.coalesce(F.nullif(at(F.col("_s"), "currentTraOwner"), F.lit("0")), at(F.col("_s"), "traCreator")).cast("int").alias("tra"), F.explode(items(at(F.col("_s"), "provision"))).alias("_p"))
    one = heads.select("*", F.explode(items(at(F.col("_p"), "regulation"))).alias("_r")).withColumns({"_k": kind(F.col("_r")), "_v": validity(F.col("_r"))}).filter("_k IS NOT NULL AND NOT _v.placeholder")
    if not keep_expired:
        one = one.filter(~expired(F.col("_v.end"), F.lit(today)) & ~not_yet(F.col("_v.start"), F.lit(today), horizon_days))
    places = one.select("*", F.explode(items(at(F.col("_p"), "regulatedPlace"))).alias("_w")).filter(at(F.col("_w"), "type") == "regulationLocation")
    shapes = [F.nullif(at(F.col("_w"), f"{shape}.{field}"), F.lit("")) for shape in ("linearGeometry", "pointGeometry", "polygonGeometry") for field in ("linestring", "point", "polygon")]
    return places.select(*keep, "ref", "name", "tra", "_k.code", "_k.label", "_v.start", "_v.end", at(F.col("_w"), "description").alias("where"), F.coalesce(*shapes).alias("wkt")).filter("wkt IS NOT NULL")


def worth_fetching(event_type: Column, types: Column, starts: Column, ends: Column, today: Column, horizon_days: int = HORIZON_DAYS) -> Column:
    """Whether a change event may concern an order worth carrying: deletes always, and whatever cannot be ruled out. Lists are JSON texts."""
    t, s, e = strings(types), strings(starts), strings(ends)
    dull = (F.size(t) > 0) & ~F.exists(t, lambda x: x.isin(*KINDS, SPEED))
    over = (F.size(e) > 0) & F.forall(e, lambda d: expired(F.substring(d, 1, 10), today))
    far = (F.size(s) > 0) & F.forall(s, lambda d: not_yet(F.substring(d, 1, 10), today, horizon_days))
    return event_type.eqNullSafe(F.lit("delete")) | ~(dull | over | far)


def season_spans(orders: DataFrame, first: str, last: str, day: Column) -> DataFrame:
    """orders with start and end of the season in force, or the next; those whose next season lies beyond the horizon go."""
    from waymeld.functions.dates import season_dates

    return orders.withColumn("_s", season_dates(F.col(first), F.col(last), day)).filter("_s IS NOT NULL").withColumns({"start": F.col("_s.start"), "end": F.col("_s.end")}).drop("_s")
