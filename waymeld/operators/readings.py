"""Series of readings by key: totals over windows, percentiles by nearest rank, and where bands lie among them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def window_totals(readings: DataFrame, key: str, at: str, value: str, now: Column, hours: tuple = (24, 48)) -> DataFrame:
    """key, total_<h>h for each span of hours up to `now`, n (of the longest) and latest. A span without readings is null, never 0."""
    since = lambda h: (F.col(at) >= now - F.expr(f"INTERVAL {h} HOURS")) & (F.col(at) <= now)
    return readings.groupBy(key).agg(*[F.sum(F.when(since(h), F.col(value))).alias(f"total_{h}h") for h in hours], F.count_if(since(max(hours))).alias("n"), F.max(at).alias("latest"))


def rolling_totals(readings: DataFrame, key: str, at: str, value: str, window_h: int = 48, step_h: int = 6) -> DataFrame:
    """key, edge, total of every window of `window_h` hours, both ends included, that fits between a key's first and last reading.

    Windows start at the first reading and move by `step_h`. A reading goes straight to the windows that hold it, at
    most window / step + 1, and is summed before the shuffle; windows without readings total 0.
    """
    w, s = window_h * 3600, step_h * 3600
    seen = readings.filter(F.col(at).isNotNull()).select(key, F.unix_seconds(F.col(at).cast("timestamp")).alias("_t"), F.col(value).alias("_v"))
    spans = seen.groupBy(key).agg(F.min("_t").alias("_lo"), F.max("_t").alias("_hi")).withColumn("_n", F.floor((F.col("_hi") - F.col("_lo") - w) / s)).filter("_n >= 0")
    first, last = F.greatest(F.lit(0), F.ceil((F.col("_t") - F.col("_lo") - w) / s)), F.least(F.col("_n"), F.floor((F.col("_t") - F.col("_lo")) / s))
    sums = seen.join(spans, key).filter(first <= last).select(key, "_v", F.explode(F.sequence(first, last)).alias("_k")).groupBy(key, "_k").agg(F.sum("_v").alias("_v"))
    edges = spans.select(key, "_lo", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n"))).alias("_k"))
    return edges.join(sums, [key, "_k"], "left").select(key, F.timestamp_seconds(F.col("_lo") + w + F.col("_k") * s).alias("edge"), F.coalesce("_v", F.lit(0.0)).alias("total"))


def nearest_ranks(df: DataFrame, key: str, value: str, points: tuple = (50, 75, 90, 95, 99)) -> DataFrame:
    """key, p<point>: the value at rank max(1, round(point / 100 * n)), halves to even; nulls do not count.

    Values are counted per key first, so a key with very many readings of few values is small, and ranks are found
    by running counts rather than in one array.
    """
    from pyspark.sql import Window as W

    counts = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("_c"))
    upto = counts.withColumn("_upto", F.sum("_c").over(W.partitionBy(key).orderBy(value).rowsBetween(W.unboundedPreceding, 0))).withColumn("_n", F.sum("_c").over(W.partitionBy(key)))
    rank = lambda p: F.greatest(F.lit(1), F.bround(F.lit(p) / 100.0 * F.col("_n")).cast("bigint"))
    return upto.groupBy(key).agg(*[F.min(F.when(F.col("_upto") >= rank(p), F.col(value))).alias(f"p{p}") for p in points])


def band_positions(df: DataFrame, value: str, edges: dict[str, float]) -> DataFrame:
    """edge, mm, percentile: what percentage of all values lies below each edge. No values: no rows."""
    sums = df.agg(F.count(value).alias("n"), *[F.count_if(F.col(value) < e).alias(f"_{i}") for i, e in enumerate(edges.values())]).filter("n > 0")
    rows = F.array(*[F.struct(F.lit(k).alias("edge"), F.lit(float(e)).alias("mm"), F.round(100.0 * F.col(f"_{i}") / F.col("n"), 1).alias("percentile")) for i, (k, e) in enumerate(edges.items())])
    return sums.select(F.inline(rows))


def widest_gap(df: DataFrame, key: str, at: str) -> DataFrame:
    """key, gap: the longest time between one row and the next; null for a single row."""
    from pyspark.sql import Window as W

    return df.withColumn("_gap", F.col(at) - F.lag(at).over(W.partitionBy(key).orderBy(at))).groupBy(key).agg(F.max("_gap").alias("gap"))


def hourly(series: DataFrame, key: str, at: str, value: str, start: Column, hours: int) -> DataFrame:
    """key, slot, value for each hour from `start`; a slot without a row of that very time is null."""
    slots = series.select(key).distinct().select(key, F.explode(F.sequence(start, start + F.expr(f"INTERVAL {hours - 1} HOURS"), F.expr("INTERVAL 1 HOUR"))).alias("slot"))
    return slots.join(series.groupBy(key, F.col(at).alias("slot")).agg(F.first(value, True).alias(value)), [key, "slot"], "left")
