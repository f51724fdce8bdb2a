"""Profiles of heights, held in arrays along a line."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Metres that a fall must have to end a climb. Metres of the run that steepness is measured over, and the least worth measuring.
THRESHOLD, MIN_RUN, MAX_RUN, FLOOR = 2.0, 100.0, 150.0, 25.0


def total_ascent(heights: Column, threshold: float = THRESHOLD) -> Column:
    """Sum of rises, each from where its climb began to its top; falls smaller than `threshold` end no climb.

    A new climb begins where a fall was believed, not at the lowest point after it. Fewer than two heights: 0.
    """
    first = F.get(heights, 0).cast("double")
    start = F.struct(first.alias("foot"), first.alias("top"), F.lit(0.0).alias("sum"))

    def step(a: Column, height: Column) -> Column:
        h = height.cast("double")
        fell = h <= a["top"] - threshold
        return F.struct(
            F.when(fell, h).otherwise(a["foot"]).alias("foot"), F.when(fell, h).otherwise(F.greatest(a["top"], h)).alias("top"),
            F.when(fell, a["sum"] + F.greatest(F.lit(0.0), a["top"] - a["foot"])).otherwise(a["sum"]).alias("sum"))

    return F.when(F.size(heights) < 2, F.lit(0.0)).otherwise(F.aggregate(heights, start, step, lambda a: a["sum"] + F.greatest(F.lit(0.0), a["top"] - a["foot"])))


def harder_climb(heights: Column, threshold: float = THRESHOLD) -> Column:
    """The ascent in whichever direction has more of it."""
    return F.greatest(total_ascent(heights, threshold), total_ascent(F.reverse(heights), threshold))


def smooth(heights: Column, passes: int = 1) -> Column:
    """Passes of the weights 1, 2, 1 over inner heights; the ends stay."""
    out = F.transform(heights, lambda h: h.cast("double"))

    def once(now: Column) -> Column:
        return F.transform(now, lambda h, i: F.when((i == 0) | (i == F.size(now) - 1), h).otherwise((F.get(now, i - 1) + 2 * h + F.get(now, i + 1)) / 4))

    for _ in range(passes):  # a pass is bound to a name, else each height would make the whole pass before anew
        out = F.get(F.transform(F.array(out), once), 0)
    return out


def steepest_run(heights: Column, distances: Column, least: float = MIN_RUN, most: float = MAX_RUN, floor: float = FLOOR) -> Column:
    """(pct, run_m) of the steepest stretch between `least` and `most` metres long, either way up.

    A line shorter than `least` is measured whole, one shorter than `floor` not at all. Where samples lie too far
    apart for such a stretch, the shortest from each sample that is at least `least` long counts.
    """
    places = F.arrays_zip(heights.alias("h"), distances.alias("d"))
    total = F.element_at(distances, -1) - F.get(distances, 0)
    run = lambda a, b: F.struct((100.0 * F.abs(b["h"] - a["h"]) / (b["d"] - a["d"])).alias("pct"), (b["d"] - a["d"]).alias("run_m"))
    within = F.flatten(F.transform(places, lambda a, i: F.transform(
        F.filter(F.slice(places, i + 1, F.size(places)), lambda b: (b["d"] - a["d"] >= least) & (b["d"] - a["d"] <= most)), lambda b: run(a, b))))
    beyond = F.flatten(F.transform(places, lambda a, i: F.transform(
        F.slice(F.filter(F.slice(places, i + 1, F.size(places)), lambda b: b["d"] - a["d"] >= least), 1, 1), lambda b: run(a, b))))
    ends = F.array(run(F.get(places, 0), F.element_at(places, -1)))
    best = lambda runs: F.array_max(runs)
    return F.when((F.size(heights) < 2) | (total < floor), F.lit(None)).when(total < least, best(ends)).otherwise(F.coalesce(best(within), best(beyond)))
