"""Rain, levels and surfaces: classes and verdicts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Surfaces by what rain does to them. Fixed values.
HARD = ("asphalt", "paved", "concrete", "concrete:plates", "concrete:lanes", "chipseal", "paving_stones", "sett", "cobblestone", "unhewn_cobblestone", "metal", "wood", "bricks", "grass_paver")
FIRM = ("gravel", "fine_gravel", "compacted", "pebblestone", "limestone", "hardcore", "rock", "stone", "shells")
SOFT = ("dirt", "earth", "ground", "mud", "grass", "sand", "clay", "soil", "woodchips", "salt")
GRADES = {"grade1": "hard", "grade2": "firm", "grade3": "soft", "grade4": "soft", "grade5": "soft"}
#: Millimetres from which a class is damp and wet. Fixed values.
BANDS = {"firm": (12.0, 30.0), "soft": (5.0, 15.0), "unknown": (5.0, 15.0)}


def susceptibility(surface: Column, grade: Column) -> Column:
    """(class, basis, value): the surface decides, else the track's grade, also where the surface is only 'unpaved'."""
    s, g = F.lower(F.trim(surface)), F.lower(F.trim(grade))
    by_surface = F.when(s.isin(*HARD), "hard").when(s.isin(*FIRM), "firm").when(s.isin(*SOFT), "soft")
    by_grade = F.coalesce(*[F.when(g == k, v) for k, v in GRADES.items()])
    out = lambda klass, basis, value: F.struct(klass.alias("class"), F.lit(basis).alias("basis"), value.cast("string").alias("value"))
    return F.when(by_surface.isNotNull(), out(by_surface, "surface", surface)).when(by_grade.isNotNull(), out(by_grade, "tracktype", grade)).when(
        s == "unpaved", out(F.lit("unknown"), "surface", surface)).otherwise(out(F.lit("unknown"), "none", F.lit(None)))


def verdict(klass: Column, mm: Column, bands: dict = BANDS) -> Column:
    """'na' for a class without bands, 'unknown' without a total, else dry, damp or wet."""
    edge = lambda k: F.coalesce(*[F.when(klass == name, F.lit(float(b[k]))) for name, b in bands.items()])
    return F.when(edge(0).isNull(), "na").when(mm.isNull(), "unknown").when(mm >= edge(1), "wet").when(mm >= edge(0), "damp").otherwise("dry")


def level_state(level: Column, low: Column, high: Column) -> Column:
    """(state, delta_m): below, normal or above the typical range, and metres over its top; unknown without level or top."""
    known = level.isNotNull() & high.isNotNull()
    state = F.when(~known, "unknown").when(level > high, "above").when(level < low, "below").otherwise("normal")
    return F.struct(state.alias("state"), F.when(known, F.round(level - high, 3)).alias("delta_m"))
