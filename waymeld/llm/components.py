"""Connected components of an edge table, by joins only; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import dropped, written


def components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """edges (a, b) -> one row (id, component) per id in an edge; component is the smallest id reachable.

    Each round hooks every id to the least label among its neighbours and itself, then follows the label's own
    label (pointer jumping), so a path of length n takes about log n rounds. Every round is a written table.
    Null ends are left out; no edges, no rows.
    """
    both = edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    links = written(both.select("a", "b").unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component")))
    for _ in range(rounds):
        near = links.join(labels.select(F.col("id").alias("b"), F.col("component").alias("c")), "b").groupBy("a").agg(F.min("c").alias("c"))
        hooked = labels.join(near, labels["id"] == near["a"]).select("id", F.col("component").alias("was"), F.least("component", "c").alias("component"))
        # The old root hears of the new label too, so that whole trees move at once.
        told = hooked.groupBy(F.col("was").alias("id")).agg(F.min("component").alias("told"))
        met = written(hooked.join(told, "id", "left").select("id", "was", F.least("component", "told").alias("component")))
        jump = met.select(F.col("id").alias("component"), F.col("component").alias("root"))
        step = written(met.join(jump, "component", "left").select("id", "was", F.least("component", "root").alias("component")))
        dropped(labels, met)
        labels = step.select("id", "component")
        labels._waymeld_path = step._waymeld_path
        if step.filter(F.col("was") != F.col("component")).limit(1).count() == 0:
            break
    else:
        raise RuntimeError("components did not settle")
    dropped(links)
    return labels
