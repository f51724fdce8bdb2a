"""Numbers by order over a whole table, without bringing it into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def ranked(df: DataFrame, key: str, to: str = "rank", parts: int = 64) -> DataFrame:
    """df with `to`: 1, 2, ... in order of `key`; equal keys are numbered in no set order, null keys come first.

    A sample of keys, chosen by their hash and so the same on every run, cuts the order into `parts` ranges. Ranks
    within a range plus the counts of the ranges before are the ranks over all. At most some thousand keys reach the driver.
    """
    share = max(1, df.count() // 4096)
    some = sorted(r[0] for r in df.filter(F.col(key).isNotNull() & (F.pmod(F.xxhash64(F.lit(29), key), F.lit(share)) == 0)).select(key).distinct().limit(16384).collect())
    cuts = some[:: max(1, len(some) // parts)]
    part = F.lit(0)
    for c in cuts:
        part = part + F.coalesce((F.col(key) >= F.lit(c)).cast("int"), F.lit(0))
    placed = df.withColumn("_part", part)
    before = placed.groupBy("_part").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    within = F.row_number().over(W.partitionBy("_part").orderBy(F.col(key).asc_nulls_first()))
    return placed.withColumn("_within", within).join(F.broadcast(before), "_part").withColumn(to, F.col("_before") + F.col("_within")).drop("_part", "_within", "_before")
