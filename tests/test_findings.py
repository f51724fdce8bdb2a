"""What a reviewer found on larger tables and odd inputs, on small rows that show the same."""

import random

from pyspark.sql import functions as F

from waymeld.functions import climb, geo
from waymeld.operators import closures, dedupe, heights, lines, physical, registers, spatial
from waymeld.plans import engine


def test_ways_apart_stay_apart(spark):
    keys = [13, 14, 699, 700, 769_987, 770_013, 770_014, 899_999, 1_540_013]
    rows = spark.createDataFrame([(k,) for k in keys], "c_custkey long")
    ways = engine._apart(rows, "c_custkey", 3)
    copies = ways.withColumn("line", engine._moved(F.lit(0.00008)))
    both = ways.select((F.col("k") * 2).alias("k"), "line").unionByName(copies.select((F.col("k") * 2 + 1).alias("k"), "line"))
    assert {(r.a, r.b) for r in lines.twins(both, "k", "line").collect()} == {(2 * k, 2 * k + 1) for k in keys}

    streets = engine._apart(rows, "c_custkey", 4).select(F.col("k").alias("street"), engine._moved(F.lit(0.00004)).alias("line"))
    found = closures.streets_along(engine._apart(rows.filter("c_custkey < 20"), "c_custkey", 2), "k", "line", streets, "street", "line")
    assert {(r.k, r.street) for r in found.collect()} == {(13, 13), (14, 14)}


def test_nearest_asks_by_place_and_widens(spark, monkeypatch):
    """A crowd at one place is one place; what it does not answer asks farther."""
    lefts = [(i, 51.0, -1.0) for i in range(300)] + [(1000, 51.0, -1.05), (1001, 51.2, -1.0), (1002, 53.0, 1.0), (1003, None, None)]
    rights = [(900 - i, 51.0, -1.0) for i in range(300)] + [(7, 51.0, -1.001), (8, 51.3, -1.0)]
    left, right = spark.createDataFrame(lefts, "lid long, llat double, llon double"), spark.createDataFrame(rights, "rid long, rlat double, rlon double")
    made, plain = [], spatial.candidates
    monkeypatch.setattr(spatial, "candidates", lambda *a: made.append(plain(*a)) or made[-1])
    got = {r.lid: r.rid for r in spatial.nearest(left, right, 50_000).collect()}
    assert got == {i: 601 for i in range(300)} | {1000: 7, 1001: 8, 1002: None, 1003: None}
    assert sum(df.count() for df in made) < 50  # 300 rows against 300 are 90,000 pairs


def test_fold_of_orders_without_end(spark, monkeypatch):
    """Orders without end meet those that start near, those without start meet all, and the least key of like ones is the twin."""
    line = "array(named_struct('x', -1.0D, 'y', 52.0D), named_struct('x', -0.999D, 'y', 52.0D))"
    rows = [(1, "1995-01-01", None), (2, "1995-01-20", None), (3, None, None), (4, "1995-01-01", "1995-02-01"), (5, "1995-01-01", "1995-04-01"), (6, None, "1995-02-01")]
    feed = [(13, "1995-01-04", None), (12, "1995-01-04", None), (14, "1995-01-02", "1995-02-15")]
    table = lambda r: spark.createDataFrame(r, "k long, s string, e string").selectExpr("k", "'t' AS tra", "'p' AS kind", "CAST(s AS DATE) AS start", "CAST(e AS DATE) AS end", "CAST(NULL AS STRING) AS form", f"{line} AS line", "array(CAST(k AS STRING)) AS ways")
    left, more = registers.folded(table(rows), table(feed), "k")
    assert {r.k for r in left.collect()} == {2, 5}
    assert {r.k: r.also for r in more.collect()} == {12: [1, 3], 13: None, 14: [4, 6]}
    # Like orders are compared once: 200 against 200 are one pair, not 40,000.
    calls = spark.sparkContext.accumulator(0)

    def counted(p, q):
        calls.add(1)
        return True

    monkeypatch.setattr(registers, "same_place", F.udf(counted, "boolean"))
    like = lambda first: table([(first + i, "1995-01-01", None) for i in range(200)])
    assert registers.folded(like(1), like(1000), "k")[0].count() == 0
    assert 0 < calls.value <= 8


def test_surveyed_lines_are_taken_without_a_call_per_way(spark):
    """Lines under many ways are taken batch by batch, from lines that are dealt out first; each way has its own."""
    point = lambda k, i: f"named_struct('x', {k} * 0.1D + {i} * 0.001D, 'y', 50.0D)"
    made = lambda name, key, first, last: spark.range(1, 41).selectExpr(f"{key} AS {name}", f"array({', '.join(point('id', i) for i in range(first, last + 1))}) AS line")
    surveyed = made("o", "id * 4", 0, 2).unionByName(made("o", "id * 4 + 1", 2, 4).filter("o % 8 = 1")).unionByName(made("o", "id * 4 + 2", 0, 1))
    found = physical.under(made("k", "id", 0, 4), "k", "line", surveyed.coalesce(1), "o", "line")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("FlatMapGroupsInPandas" not in plan, plan.count("ArrowEvalPython")) == (True, 3)  # points, their number, lines taken: none below the dealing
    assert {(r.k, r.o) for r in found.collect()} == {(k, 4 * k) for k in range(1, 41)} | {(k, 4 * k + 1) for k in range(2, 41, 2)}


def test_heights_in_small_plans(spark):
    """A pass of smoothing is made once, not anew for each height, and the plan holds no tile of numbers."""
    said = [len(climb.smooth(F.col("h"), n)._jc.toString()) for n in (1, 2, 6)]
    assert said[2] - said[1] < 5 * (said[1] - said[0])
    row = spark.range(1).select(climb.smooth(F.array(*map(F.lit, (0, 0, 16, 0, 0))), 2).alias("h")).first()
    assert row.h == [0.0, 4.0, 6.0, 4.0, 0.0]
    out = engine.q_way_heights(spark, "/root/testdata/sf0.001")
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 50_000


def test_covered_share_without_rows_of_points(spark, monkeypatch):
    """Shares equal those of the points one by one, also for long legs, lines of no length and keys that stand twice, and no point is a row."""
    g = random.Random(4)
    walk = lambda n: [(-1.0 + g.uniform(0, 0.02), 51.0 + g.uniform(0, 0.01)) for _ in range(n)]
    schema = "k long, line array<struct<x:double,y:double>>"
    a = spark.createDataFrame([(i % 28, walk(g.randrange(0, 5))) for i in range(30)] + [(90, [(-1.0, 51.0)] * 2), (91, None)], schema)
    b = spark.createDataFrame([(i, walk(3)) for i in range(20)], schema)
    points = lines.flagged(lines.samples(a, "k", "line"), b, "k", "line").groupBy("k").agg(F.avg(F.col("near").cast("double")).alias("share"))
    want = {r.k: round(r.share, 9) for r in points.collect()}
    monkeypatch.setattr(lines, "samples", None)
    assert {r.k: round(r.share, 9) for r in lines.covered_share(a, b, "k", "line").collect()} == want and 0 < sum(want.values())


def test_near_ways_are_a_row_per_pair(spark):
    """Points near another way are held with the pair, not as a row each; the pair's numbers are those of the points."""
    line = lambda up: [(-1.0, 52.0 + up), (-0.999, 52.0 + up)]
    ways = spark.createDataFrame([(1, "A", line(0)), (2, "B", line(0.00005)), (3, "B", line(0.01)), (4, "A", line(0.00001))], "k long, code string, line array<struct<x:double,y:double>>").withColumn("kind", F.lit("t"))
    near, counts = dedupe._near(ways, "k", "line", "kind", "code", lines.SAME)
    got, n = near.collect(), {r.a: r.n for r in counts.collect()}
    assert sorted((r.a, r.b) for r in got) == [(1, 2), (2, 1), (2, 4), (4, 2)] and all(len(r.ats) == n[r.a] for r in got)


def _broadcasts(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Broadcast")


def _grown_ways(spark, n, shift=0.0):
    """Ways of five points that Spark takes for n rows of two numbers."""
    point = lambda i: f"named_struct('x', id % 700 / 100.0D + {i} * 0.001D, 'y', 50.0D + floor(id / 700) / 200.0D + {shift}D)"
    return spark.range(n).selectExpr("id AS k", f"array({', '.join(point(i) for i in range(5))}) AS line")


def test_near_ways_and_twins_are_not_gathered_in_the_driver(spark):
    """Segments, points and lines are more than Spark estimates, so no join of them is planned as a broadcast."""
    both = _grown_ways(spark, 20).selectExpr("k * 2 AS k", "line", "'A' AS code").unionByName(_grown_ways(spark, 20, 0.00005).selectExpr("k * 2 + 1 AS k", "line", "'B' AS code")).withColumn("kind", F.lit("t"))
    near, counts = dedupe._near(both, "k", "line", "kind", "code", lines.SAME)
    found = lines.twins(both, "k", "line")
    assert [_broadcasts(df) for df in (near, counts, found)] == [0, 0, 0]
    assert near.count() == 40 and {(r.a, r.b) for r in found.collect()} == {(2 * k, 2 * k + 1) for k in range(20)}


def test_heights_and_points_are_not_gathered_in_the_driver(spark):
    """Tiles of heights and points along ways are more than Spark estimates, so no join of them is planned as a broadcast."""
    ways = _grown_ways(spark, 8).select("k", F.array("line").alias("parts"))
    tiles = spark.range(16).selectExpr("CAST(127 + id % 4 AS INT) AS x", "CAST(83 + floor(id / 4) AS INT) AS y", "transform(sequence(0, 65535 + CAST(0 * id AS INT)), i -> 7.0D) AS heights").distinct()
    out = heights.measured(ways, "k", "parts", tiles, 8)
    assert _broadcasts(out) == 0
    assert {(r.k, r.climb_m, r.samples > 2) for r in out.collect()} == {(k, 0.0, True) for k in range(8)}


def test_surveyed_lines_are_not_gathered_in_the_driver(spark):
    """Segments of surveyed lines and points along ways are more than Spark estimates, so no join of them is planned as a broadcast."""
    ways = _grown_ways(spark, 20)
    surveyed = ways.select((F.col("k") * 2).alias("o"), F.slice("line", 1, 3).alias("line")).unionByName(ways.select((F.col("k") * 2 + 1).alias("o"), F.slice("line", 3, 3).alias("line")))
    found = physical.under(ways, "k", "line", surveyed, "o", "line")
    assert _broadcasts(found) == 0
    assert {(r.k, r.o, r.cover) for r in found.collect()} == {(k, 2 * k + n, 1.0) for k in range(20) for n in (0, 1)}


def test_near_ways_without_rows_of_points(spark, monkeypatch):
    """Points near another way equal those found one by one, also for lines of no length, null kinds and keys, and no point is a row."""
    g = random.Random(7)
    walk = lambda n: [(-1.0 + g.uniform(0, 0.006), 51.0 + g.uniform(0, 0.004)) for _ in range(n)]
    rows = [(i, "AB"[i % 2], ("t", "u", None)[i % 3], walk(g.randrange(0, 5))) for i in range(40)] + [(90, "A", "t", [(-1.0, 51.0)] * 2), (91, "B", "t", None), (92, "B", "t", [(-1.0, 51.00005)] * 3), (None, "B", "t", walk(3))]
    ways = spark.createDataFrame(rows, "k long, code string, kind string, line array<struct<x:double,y:double>>")
    said = ways.select("k", "kind", "code")
    pts = lines.samples(ways, "k", "line").join(said, "k").select(F.col("k").alias("a"), "kind", "code", "_at", "x", "y")
    legs = lines.segments(ways, "k", "line").join(said, "k").select(F.col("k").alias("b"), "kind", F.col("code").alias("other"), "ax", "ay", "bx", "by")
    close = geo.segment_m(*[F.col(c) for c in ("x", "y", "ax", "ay", "bx", "by")]) <= lines.SAME
    want = {(r.a, r.b): r.n for r in pts.join(legs, "kind").filter((F.col("code") != F.col("other")) & close).groupBy("a", "b").agg(F.countDistinct("_at").alias("n")).collect()}
    counts = {r.a: r.n for r in pts.groupBy("a").agg(F.count("*").alias("n")).collect()}
    monkeypatch.setattr(lines, "samples", None)
    near, n = dedupe._near(ways, "k", "line", "kind", "code", lines.SAME)
    assert {(r.a, r.b): len(r.ats) for r in near.collect()} == want and {r.a: r.n for r in n.collect()} == counts and len(want) > 9
