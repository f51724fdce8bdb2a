"""Registered queries of the engine's own operators, each with its DuckDB twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymeld.operators import cdc, ranking, spatial

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f
    return register


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""
WITH edge AS (SELECT max(ts) AS now FROM events)
SELECT user_id, sum(value) FILTER (ts >= now - INTERVAL 24 HOUR) AS mm_24h, sum(value) FILTER (ts >= now - INTERVAL 48 HOUR) AS mm_48h,
       count(*) FILTER (ts >= now - INTERVAL 48 HOUR) AS n, max(ts) AS latest_at
FROM events, edge GROUP BY user_id
""".replace("sum(value)", "round(sum(value)").replace("HOUR) AS mm", "HOUR), 4) AS mm"))
def q_window_totals(spark, sf_dir):
    """Totals of the last 24 and 48 hours per station: NULL, never 0, where nothing was read."""
    events = t(spark, sf_dir, "events")
    now = events.agg(F.max("ts").alias("now"))
    since = lambda h: F.col("ts") >= F.col("now") - F.expr(f"INTERVAL {h} HOURS")
    return events.join(F.broadcast(now)).groupBy("user_id").agg(
        F.round(F.sum(F.when(since(24), F.col("value"))), 4).alias("mm_24h"), F.round(F.sum(F.when(since(48), F.col("value"))), 4).alias("mm_48h"),
        F.count_if(since(48)).alias("n"), F.max("ts").alias("latest_at"))


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations")


def both(name: str, spark_sql: str, duck_sql: str | None = None) -> None:
    """A query in SQL that both engines run, or in two dialects."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frames = {n: t(spark, sf_dir, n) for n in TABLES if "{" + n + "}" in spark_sql}
        return spark.sql(spark_sql, **frames)

    run.__name__ = name
    QUERIES[name] = run
    ORACLE[name] = (duck_sql or spark_sql).replace("{", "").replace("}", "")


# Windows and latest values of readings
both("q_islands", """SELECT user_id, run, min(event_id) AS first_id, max(event_id) AS last_id, count(*) AS n FROM (SELECT user_id, event_id, sum(starts) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT user_id, event_id, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) THEN 0 ELSE 1 END AS starts FROM {events}) a) b GROUP BY user_id, run""",
     """SELECT user_id, CAST(run AS BIGINT) AS run, min(event_id) AS first_id, max(event_id) AS last_id, count(*) AS n FROM (SELECT user_id, event_id, sum(starts) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT user_id, event_id, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) THEN 0 ELSE 1 END AS starts FROM events) a) b GROUP BY user_id, run""")
# Aggregates
both("q_distinct_length", """SELECT l_suppkey, round(sum(q), 4) AS km FROM (SELECT DISTINCT l_suppkey, l_partkey, l_quantity AS q FROM {lineitem}) x GROUP BY l_suppkey""")
both("q_rollup_totals", """SELECT r_name, n_name, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""")
both("q_weighted_mode", """SELECT l_suppkey, l_returnflag AS surface FROM (SELECT l_suppkey, l_returnflag, row_number() OVER (PARTITION BY l_suppkey ORDER BY sum(l_quantity) DESC, l_returnflag) AS n FROM {lineitem} GROUP BY l_suppkey, l_returnflag) x WHERE n = 1""")
both("q_all_types_present", """SELECT c_nationkey FROM {customer} WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') GROUP BY c_nationkey HAVING count(DISTINCT c_mktsegment) = 3""")
both("q_not_exists", """SELECT c_custkey FROM {customer} c WHERE NOT EXISTS (SELECT 1 FROM {orders} o WHERE o.o_custkey = c.c_custkey AND o.o_orderkey % 5 = 0)""")
# Text, references, documents
both("q_match_ref", """SELECT s_suppkey, c_custkey FROM (SELECT s_suppkey, regexp_replace(regexp_extract(s_name, '[0-9]+', 0), '^0+', '') AS ref FROM {supplier}) s JOIN (SELECT c_custkey, regexp_replace(regexp_extract(c_name, '[0-9]+', 0), '^0+', '') AS ref FROM {customer}) c ON s.ref = c.ref""")

# Grouped summaries, bands and gates
both("q_validity", """SELECT o_custkey, CAST(CAST(min(o_orderdate) AS DATE) AS STRING) AS start_on, CASE WHEN max(CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END) = 0 THEN CAST(CAST(max(o_orderdate) AS DATE) AS STRING) END AS end_on FROM {orders} GROUP BY o_custkey""")
both("q_authority_rows", """SELECT n_nationkey, coalesce(c.n, 0) AS records FROM {nation} LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM {customer} WHERE c_acctbal > 9000 GROUP BY c_nationkey) c ON n_nationkey = c.c_nationkey""")
both("q_length_totals", """SELECT r_name, n_name, CASE WHEN count(*) = count(km) THEN round(sum(km), 2) END AS km FROM (SELECT r_name, n_name, CASE WHEN c_custkey % 40 <> 0 THEN c_acctbal END AS km FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey) x GROUP BY ROLLUP (r_name, n_name)""")
both("q_coverage", """SELECT l_suppkey, round(100 * avg(CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS DOUBLE)), 3) AS matched_pct FROM {lineitem} GROUP BY l_suppkey""")
both("q_band_position", """SELECT c_nationkey, """ + ", ".join(f"round(100 * avg(CAST(CASE WHEN c_acctbal < {edge} THEN 1 ELSE 0 END AS DOUBLE)), 3) AS below_{edge}" for edge in (1000, 5000, 9000)) + """ FROM {customer} GROUP BY c_nationkey""")
both("q_count_judge", """SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.n IS NULL THEN 'new' WHEN b.n IS NULL THEN 'gone' WHEN b.n < 0.6 * a.n THEN 'fell' WHEN b.n > 2 * a.n THEN 'rose' ELSE 'pass' END AS verdict FROM (SELECT l_suppkey AS k, count(*) AS n FROM {lineitem} WHERE l_linenumber <= 2 GROUP BY 1) a FULL JOIN (SELECT l_suppkey AS k, count(*) AS n FROM {lineitem} WHERE l_linenumber >= 3 GROUP BY 1) b ON a.k = b.k""")
# Order within a group

# Snapshots
_LATEST = "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END, event_id DESC) AS n FROM events) x WHERE n = 1"


@query(_LATEST)
def q_latest_by_key(spark, sf_dir):
    """Latest event per order; of equal times a delete wins, then the last read."""
    return cdc.latest_by_key(t(spark, sf_dir, "events"), "user_id", F.desc("ts"), F.when(F.col("event_type") == "error", 0).otherwise(1), F.desc("event_id")).select("user_id", "event_id", "event_type")


def _snapshots(spark, sf_dir):
    orders = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    new = orders.filter("o_orderkey % 11 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_totalprice")))
    return orders.filter("o_orderkey % 13 <> 0"), new


_OLD = "o AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 13 <> 0), n AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 11 <> 0)"


@query(f"WITH {_OLD} SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'added' WHEN n.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS op FROM o FULL JOIN n USING (o_orderkey) WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_custkey IS DISTINCT FROM n.o_custkey OR o.o_totalprice IS DISTINCT FROM n.o_totalprice")
def q_snapshot_diff(spark, sf_dir):
    return cdc.snapshot_diff(*_snapshots(spark, sf_dir), "o_orderkey")


@query(f"WITH {_OLD} SELECT * FROM n")
def q_apply_diff(spark, sf_dir):
    """Applying a diff to the old build gives the new one, row for row."""
    old, new = _snapshots(spark, sf_dir)
    diff = cdc.snapshot_diff(old, new, "o_orderkey")
    return cdc.apply_diff(old, new.join(diff.filter("op <> 'removed'"), "o_orderkey", "left_semi"), diff.filter("op = 'removed'").select("o_orderkey"), "o_orderkey")


@query(f"WITH {_OLD}, p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS number FROM o) SELECT o_orderkey, CAST(number AS BIGINT) AS number FROM n JOIN p USING (o_orderkey) UNION ALL SELECT o_orderkey, (SELECT max(number) FROM p) + row_number() OVER (ORDER BY o_orderkey) FROM n WHERE o_orderkey NOT IN (SELECT o_orderkey FROM p)")
def q_stable_number(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    previous = ranking.ranked(old.select("o_orderkey"), "o_orderkey", "number")
    return cdc.stable_numbers(new.select("o_orderkey"), previous, "o_orderkey")


# Distance joins
def _points(df: DataFrame, key: str, side: str) -> DataFrame:
    k = F.col(key)
    return df.select(k.alias(f"{side}id"), (F.lit(50.0) + (k * 53 % 550) / 100.0).alias(f"{side}lat"), (F.lit(-5.0) + (k * 37 % 700) / 100.0).alias(f"{side}lon"))


_PAIRS = """l AS (SELECT c_custkey AS lid, 50.0 + (c_custkey * 53 % 550) / 100.0 AS llat, -5.0 + (c_custkey * 37 % 700) / 100.0 AS llon FROM customer),
r AS (SELECT s_suppkey AS rid, 50.0 + (s_suppkey * 53 % 550) / 100.0 AS rlat, -5.0 + (s_suppkey * 37 % 700) / 100.0 AS rlon FROM supplier),
d AS (SELECT lid, rid, 2 * 6371008.8 * asin(sqrt(least(1.0, pow(sin(radians(rlat - llat) / 2), 2) + cos(radians(llat)) * cos(radians(rlat)) * pow(sin(radians(rlon - llon) / 2), 2)))) AS m FROM l, r)"""


@query(f"WITH {_PAIRS} SELECT DISTINCT lid FROM d WHERE m <= 20000")
def q_near_semi(spark, sf_dir):
    """Customers within 20 km of a supplier, by grid cells."""
    return spatial.near_semi(_points(t(spark, sf_dir, "customer"), "c_custkey", "l"), _points(t(spark, sf_dir, "supplier"), "s_suppkey", "r"), 20_000).select("lid")


@query(f"WITH {_PAIRS}, b AS (SELECT lid, arg_min(rid, round(m, 3) * 1000000 + rid) AS rid, round(min(m), 3) AS m FROM d WHERE m <= 50000 GROUP BY lid) SELECT l.lid, b.rid, b.m FROM l LEFT JOIN b USING (lid)")
def q_knn_gauge(spark, sf_dir):
    """Nearest supplier of every customer, NULL beyond 50 km."""
    near = spatial.nearest(_points(t(spark, sf_dir, "customer"), "c_custkey", "l"), _points(t(spark, sf_dir, "supplier"), "s_suppkey", "r"), 50_000)
    return near.select("lid", "rid", F.round("m", 3).alias("m"))
