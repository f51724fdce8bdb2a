"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length within each source. Whole passes over a source are taken first; what is
left of its budget is spread over the lengths in proportion, and a bounded-knapsack programme over the lengths'
remaining counts fits the last few thousand words to the word. A seeded hash then picks as many documents of each
length as the plan says. Ranks are taken within hash buckets, so no source or length is ever ordered in one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._store import WORD, table, written

#: Weights of the sources in order, share of all words to take, most passes over a source, hash buckets of a group.
WEIGHTS, SHARE, MOST, BUCKETS, SEED = (5, 2, 1), 1.5, 2, 64, 17
#: Words of a source's budget that the knapsack fits exactly.
WINDOW = 1 << 16


def subset_sum(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each size to take so that their sum is as near below budget as any choice comes."""
    taken = np.zeros(len(sizes), dtype=np.int64)
    if budget <= 0:
        return taken
    items: list[tuple[int, int, int]] = []
    first = np.full(budget + 1, -1, dtype=np.int32)
    reach, mask = 1, (1 << (budget + 1)) - 1
    for k in range(len(sizes)):
        size, left, step = int(sizes[k]), int(min(counts[k], budget // max(int(sizes[k]), 1))), 1
        while size > 0 and left > 0:
            many = min(step, left)
            now = (reach | reach << (size * many)) & mask
            if new := now & ~reach:
                bits = np.unpackbits(np.frombuffer(new.to_bytes(budget // 8 + 1, "little"), np.uint8), bitorder="little")
                first[np.flatnonzero(bits[: budget + 1])] = len(items)
                items.append((k, size, many))
            reach, left, step = now, left - many, step * 2
        if reach >> budget & 1:
            break
    at = reach.bit_length() - 1
    while at > 0:
        k, size, many = items[first[at]]
        taken[k] += many
        at -= size * many
    return taken


def plan_source(sizes: np.ndarray, counts: np.ndarray, budget: int, window: int = WINDOW) -> tuple[int, np.ndarray]:
    """Whole passes, and documents of each size to take once more; together they meet the budget."""
    total = int((sizes * counts).sum())
    if total <= 0 or budget <= 0:
        return 0, np.zeros(len(sizes), dtype=np.int64)
    passes, rest = divmod(budget, total)
    extra = (counts * (rest / total)).astype(np.int64)
    left = rest - int((sizes * extra).sum())
    for k in np.argsort(-sizes, kind="stable"):  # one document of a size each, long ones first, until the knapsack can finish
        if left <= window:
            break
        many = min(int(counts[k] - extra[k]), max(1, (left - window) // max(int(sizes[k]), 1)))
        if 0 < sizes[k] * many <= left:
            extra[k] += many
            left -= int(sizes[k]) * many
    order = np.argsort(sizes, kind="stable")
    extra[order] += subset_sum(sizes[order], (counts - extra)[order], left)
    return int(passes), extra


def targets(totals: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target: share of all words by weight, none above most times its source.

    Resharing the excess by weight until none is above ends at one level x: every target is min(x * weight, cap).
    Sources in order of cap / weight fill up first, so x follows from running sums over the list of sources.
    """
    ranked = totals.withColumn("n", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("n") - 1, F.lit(len(weights))) + 1).cast("int"))
    caps = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order, everything = W.orderBy(F.col("cap") / F.col("weight"), "n"), W.partitionBy()
    before = order.rowsBetween(W.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    # The level read at the first source that does not fill up is the final one, and the least over all sources read up to there.
    levels = caps.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
    final = levels.withColumn("x", F.max(F.when(F.col("open"), F.struct(-F.col("cap") / F.col("weight"), -F.col("n"), "level"))).over(everything))
    return final.select("source", "source_size", F.when(F.col("x").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("x.level") * F.col("weight"))).alias("target"))


def source_mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken (words, repeats counted).

    Null text has size 0 and null source is a source of its own, last in order. Documents without words are
    never taken. Ties of the seeded hash go by doc_id; rows that repeat a doc_id are ranked by nothing further,
    their total is fixed. Empty in, empty out. Other columns are ignored.
    """
    sized = written(docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col("doc_id")).alias("h")).withColumn("bucket", F.pmod(F.shiftright("h", 40), F.lit(buckets)).cast("int")))
    counts = written(sized.groupBy("source", "size", "bucket").agg(F.count("*").alias("n")))
    goals = written(targets(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, share, most), 1)
    # None of the keys is ever null from here on: a null source travels as (true, '').
    key = [F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("src")]
    lengths = counts.groupBy("source", "size").agg(F.sum("n").alias("n")).select(*key, "size", "n")
    asked = lengths.join(goals.select(*key, "target", "source_size"), ["none", "src"])

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        g = group.sort_values("size")
        sizes, have = g["size"].to_numpy(np.int64), g["n"].to_numpy(np.int64)
        passes, extra = plan_source(sizes, have, int(np.floor(g["target"].iloc[0] + 1e-6)))
        return pd.DataFrame({"none": g["none"], "src": g["src"], "size": sizes, "passes": passes, "extra": extra, "source_size": g["source_size"], "target": g["target"]})

    plan = asked.groupBy("none", "src").applyInPandas(fit, "none boolean, src string, size long, passes long, extra long, source_size long, target double")
    before = W.partitionBy("none", "src", "size").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    ahead = counts.select(*key, "size", "bucket", "n").withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0)))
    cuts = ahead.join(plan, ["none", "src", "size"]).withColumn("cut", F.col("extra") - F.col("ahead")).drop("n", "ahead", "extra")
    rows = sized.select("doc_id", *key, "size", "bucket", "h").join(written(cuts), ["none", "src", "size", "bucket"])
    rank = F.row_number().over(W.partitionBy("none", "src", "size", "bucket").orderBy("h", "doc_id"))
    return rows.withColumn("rank", rank).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * (F.col("passes") + (F.col("rank") <= F.col("cut")).cast("long"))).alias("taken"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix(table(spark, sf_dir, "documents"))
