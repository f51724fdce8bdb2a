"""Distance joins as blocked equi-joins: explode one side over neighbouring cells, join on the cell, check exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymeld.functions.geo import haversine_m
from waymeld.operators.lineage import cut

#: Metres of a degree of latitude, at the least.
DEGREE_M = 110_000.0
#: Right points that a cell of the first search of `nearest` may hold, and quarterings of its radius at most.
BUSY, FINEST = 16, 8


def _band(lat: Column, metres: float) -> Column:
    return F.floor(lat * DEGREE_M / metres)


def _columns(band: Column, metres: float) -> Column:
    """Cells around the globe in a band: none narrower than `metres` in it or its neighbours, whatever the latitude; one cell at the poles."""
    edge = F.least(F.lit(90.0), (F.greatest(F.abs(band), F.abs(band + 1)) + 1) * metres / DEGREE_M)
    return F.greatest(F.lit(1), F.floor(360.0 * DEGREE_M * F.cos(F.radians(edge)) / metres)).cast("bigint")


def _column(lon: Column, many: Column) -> Column:
    return F.pmod(F.floor((lon + 180.0) / 360.0 * many), many)


def _cells(df: DataFrame, lat: str, lon: str, metres: float) -> DataFrame:
    return df.withColumn("_r", _band(F.col(lat), metres)).withColumn("_c", _column(F.col(lon), _columns(F.col("_r"), metres)))


def _spread(df: DataFrame, lat: str, lon: str, metres: float) -> DataFrame:
    """Rows in their own and the neighbouring cells, around the date line too."""
    rows = df.withColumn("_r", F.explode(F.sequence(_band(F.col(lat), metres) - 1, _band(F.col(lat), metres) + 1))).withColumn("_many", _columns(F.col("_r"), metres))
    near = F.array_distinct(F.array(*[F.pmod(_column(F.col(lon), F.col("_many")) + k, F.col("_many")) for k in (-1, 0, 1)]))
    return rows.withColumn("_c", F.explode(near)).drop("_many")


def _distance() -> Column:
    return haversine_m(F.col("llat"), F.col("llon"), F.col("rlat"), F.col("rlon"))


def candidates(left: DataFrame, right: DataFrame, metres: float) -> DataFrame:
    """Pairs within `metres`, with their distance m; columns lid, llat, llon and rid, rlat, rlon. The right side, as a rule the smaller, is dealt to its neighbouring cells."""
    pairs = _cells(left, "llat", "llon", metres).join(_spread(right, "rlat", "rlon", metres), ["_r", "_c"]).drop("_r", "_c")
    return pairs.withColumn("m", _distance()).filter(F.col("m") <= metres)


def near_semi(left: DataFrame, right: DataFrame, metres: float) -> DataFrame:
    """Rows of left with a right point within `metres`; each is settled by its first match, and no pairs are made."""
    l, r = _cells(left, "llat", "llon", metres).alias("l"), _spread(right, "rlat", "rlon", metres).withColumnsRenamed({"_r": "_r2", "_c": "_c2"}).alias("r")
    return l.join(r, (F.col("_r") == F.col("_r2")) & (F.col("_c") == F.col("_c2")) & (_distance() <= metres), "left_semi").drop("_r", "_c")


def _fine(spots: DataFrame, metres: float) -> float:
    """A radius of metres / 4^k at which no cell holds more than BUSY of the places; of the least one, at most FINEST steps down, it may."""
    for k in range(FINEST + 1):
        radius = metres / 4**k
        most = _cells(spots, "rlat", "rlon", radius).groupBy("_r", "_c").count().agg(F.max("count")).first()[0]
        if k == FINEST or (most or 0) <= BUSY:
            return radius


def nearest(left: DataFrame, right: DataFrame, metres: float) -> DataFrame:
    """Every left row with its nearest right point, ties by rid; NULL beyond `metres`.

    Places ask, not rows: those of many rows ask once, and of right points at one place the least rid answers. A small
    circle is searched first, and only places without an answer in it ask again in a wider one, up to `metres`.
    """
    spots = cut(right.groupBy("rlat", "rlon").agg(F.min("rid").alias("rid")))
    asked, best = cut(left.filter("llat IS NOT NULL AND llon IS NOT NULL").select("llat", "llon").distinct()), None
    radius = _fine(spots, metres)
    while True:
        found = cut(candidates(asked, spots, radius).groupBy("llat", "llon").agg(F.min(F.struct("m", "rid")).alias("b")))
        best = found if best is None else best.unionByName(found)
        if radius >= metres:
            break
        asked, radius = cut(asked.join(found, ["llat", "llon"], "left_anti")), min(metres, radius * 4)
        if asked.isEmpty():
            break
    return left.join(best, ["llat", "llon"], "left").select("lid", F.col("b.rid").alias("rid"), F.col("b.m").alias("m"))
