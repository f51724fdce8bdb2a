"""Checks that a build must pass, as queries: each returns the problems it finds, none if all is well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waymeld.functions import geo, text


def fallen(before: DataFrame, now: DataFrame, key: str, least: float = 0.75) -> DataFrame:
    """key, was, now, verdict: 'refuse' where a key keeps less than the share `least` of its rows, 'new' where there were none."""
    a, b = before.groupBy(key).agg(F.count("*").alias("was")), now.groupBy(key).agg(F.count("*").alias("now"))
    both = a.join(b, key, "full").withColumns({"was": F.coalesce("was", F.lit(0)), "now": F.coalesce("now", F.lit(0))})
    return both.withColumn("verdict", F.when(F.col("was") == 0, "new").when(F.col("now") < least * F.col("was"), "refuse").otherwise("pass"))


def outside(points: DataFrame, name: str, lon: str, lat: str, box: tuple = geo.GB_BOX) -> DataFrame:
    """name, n: how many points of each name lie outside the box or have no place."""
    ok = F.coalesce(geo.in_box(F.col(lon), F.col(lat), box), F.lit(False))
    return points.filter(~ok).groupBy(name).agg(F.count("*").alias("n"))


def unclean(df: DataFrame) -> DataFrame:
    """column, n, example: text columns that hold character references or odd spaces."""
    cols = [c for c, t in df.dtypes if t == "string"]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, n bigint, example string")
    long_ = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols])))
    return long_.filter(F.size(text.unclean_in(F.col("value"))) > 0).groupBy("column").agg(F.count("*").alias("n"), F.min("value").alias("example"))


def unknown_keys(df: DataFrame, key: str, known: DataFrame, to: str) -> DataFrame:
    """key, n: keys that the table of known ones lacks, and their rows."""
    return df.groupBy(key).agg(F.count("*").alias("n")).join(known.select(F.col(to).alias("_known")), F.col(key) == F.col("_known"), "left_anti")


def repeated(df: DataFrame, key: str) -> DataFrame:
    """key, n of keys that more than one row has."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def broken(df: DataFrame, **rules: Column) -> DataFrame:
    """rule, n: how many rows break each named rule; a rule that comes out null is broken."""
    counts = df.agg(*[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("n")) for n in rules]))).filter("n > 0")


def stale(df: DataFrame, key: str, at: str, limit_days: Column, now: Column) -> DataFrame:
    """key, oldest, age_days of keys whose oldest date is missing or more than the limit ago."""
    ages = df.groupBy(key).agg(F.min(at).alias("oldest"), F.max(F.col(at).isNull()).alias("_none"), F.max(limit_days).alias("_limit")).withColumn("age_days", F.datediff(now, "oldest"))
    return ages.filter(F.col("_none") | F.col("oldest").isNull() | (F.col("age_days") > F.col("_limit"))).select(key, "oldest", "age_days")


def last_good(previous: DataFrame, now: DataFrame, key: str, floor: int = 6, share: float = 1 / 3) -> DataFrame:
    """now, but for keys that came back empty or shrank below `share` of at least `floor` rows: these keep their previous rows."""
    a, b = previous.groupBy(key).agg(F.count("*").alias("_was")), now.groupBy(key).agg(F.count("*").alias("_now"))
    kept = a.join(b, key, "left").filter("_now IS NULL").select(key).unionByName(a.join(b, key).filter((F.col("_was") >= floor) & (F.col("_now") < share * F.col("_was"))).select(key))
    return now.join(kept, key, "left_anti").unionByName(previous.join(kept, key, "left_semi"))


def packed(sizes: DataFrame, name: str, size: str, budget: int) -> DataFrame:
    """name, pack: names in order go into one pack while it stays within the budget, then into the next.

    Each step depends on all before, so the list of names, which is far smaller than what they hold, is folded in one
    row; a name above the budget is a pack of its own, as by rule it is cut before.
    """
    start = F.struct(F.lit(0).cast("bigint").alias("pack"), F.lit(0).cast("bigint").alias("used"), F.array().cast("array<bigint>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        fits = (a["used"] + s["size"] <= budget) | (F.size(a["out"]) == 0)
        pack = F.when(fits, a["pack"]).otherwise(a["pack"] + 1)
        return F.struct(pack.alias("pack"), F.when(fits, a["used"] + s["size"]).otherwise(s["size"]).alias("used"), F.concat(a["out"], F.array(pack)).alias("out"))

    rows = sizes.groupBy(name).agg(F.sum(size).cast("bigint").alias("size")).agg(F.sort_array(F.collect_list(F.struct(F.col(name).alias("name"), "size"))).alias("s"))
    return rows.select(F.inline(F.arrays_zip(F.transform("s", lambda s: s["name"]).alias(name), F.aggregate("s", start, step, lambda a: a["out"]).alias("pack"))))


def top(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n keys with the most rows, ties by key."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(n)


def newest(df: DataFrame, key: str, *order: Column, keep: int = 6) -> DataFrame:
    """The first `keep` rows of each key in the given order."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(*order))).filter(F.col("_n") <= keep).drop("_n")


def disagreeing(records: DataFrame, drawn: DataFrame, area: str, uid: str, late: Column | None = None) -> DataFrame:
    """area, problem, n, first: ids that an area's tiles draw and its records lack ('drawn only'), or the other way round ('held only').

    Each area must stand on its own. `late`: condition on the area's records that are held but drawn at no zoom of these tiles.
    """
    held = (records if late is None else records.withColumn("_late", late)).select(area, uid, (F.lit(False) if late is None else F.coalesce("_late", F.lit(False))).alias("_late")).groupBy(area, uid).agg(F.max("_late").alias("_late"))
    both = held.withColumn("_held", F.lit(True)).join(drawn.select(area, uid).distinct().withColumn("_drawn", F.lit(True)), [area, uid], "full")
    problem = F.when(F.col("_held").isNull(), "drawn only").when(F.col("_drawn").isNull() & ~F.col("_late"), "held only")
    return both.withColumn("problem", problem).filter("problem IS NOT NULL").groupBy(area, "problem").agg(F.count("*").alias("n"), F.min(uid).alias("first"))


def changeset_problems(old: DataFrame, carried: DataFrame, removed: DataFrame, boxes: DataFrame, key: str) -> DataFrame:
    """problem, key of a changeset against the build it starts from: a key both carried and removed, removed though the old build lacks it, carried twice, or carried without a box, and boxes of keys that are not carried."""
    say = lambda df, problem: df.select(F.lit(problem).alias("problem"), key)
    once = carried.select(key).distinct()
    return say(removed.select(key).distinct().join(once, key, "left_semi"), "carried and removed").unionByName(say(removed.select(key).distinct().join(old.select(key), key, "left_anti"), "removed but not there")).unionByName(
        say(repeated(carried, key), "carried twice")).unionByName(say(once.join(boxes.select(key), key, "left_anti"), "carried without a box")).unionByName(say(boxes.select(key).distinct().join(once, key, "left_anti"), "box of nothing"))


def later(*copies: DataFrame, key: str, at: str) -> DataFrame:
    """The rows of all copies, of one key the latest; of equal times that of the last copy. A row without a time gives way to any other."""
    both = None
    for i, df in enumerate(copies):
        one = df.withColumn("_copy", F.lit(i))
        both = one if both is None else both.unionByName(one, allowMissingColumns=True)
    names = [c for c in both.columns if c != "_copy"]
    best = both.groupBy(key).agg(F.max_by(F.struct(*names), F.struct(F.coalesce(F.col(at).cast("timestamp"), F.lit("0001-01-01").cast("timestamp")), "_copy")).alias("_row"))
    return best.select("_row.*")
