"""Registered queries that apply the engine's own operators to the driver's tables, with DuckDB twins written on their own."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waymeld.functions import climb, dates, geo, text, wet
from waymeld.operators import cdc, closures, dedupe, gates, heights, lines, orders, physical, ranking, readings, registers
from waymeld.plans.catalog import query, t

TODAY = "1995-06-17"


# Heights along a line: the quantities of an order's lines in order
def _profiles(spark, sf_dir):
    rows = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_quantity"))).alias("p"))
    return rows.select("l_orderkey", F.transform("p", lambda x: x["l_quantity"]).alias("h"), F.transform("p", lambda x: x["l_linenumber"] * 60.0).alias("d"))


_STEPS = "s AS (SELECT l_orderkey, l_quantity AS h, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) AS k, count(*) OVER (PARTITION BY l_orderkey) AS n, l_linenumber * 60.0 AS d FROM lineitem)"


@query(f"""WITH RECURSIVE {_STEPS},
r AS (SELECT l_orderkey, k, n, h AS foot, h AS top, CAST(0 AS DOUBLE) AS sum FROM s WHERE k = 1 UNION ALL
 SELECT r.l_orderkey, s.k, s.n, CASE WHEN s.h <= r.top - 2 THEN s.h ELSE r.foot END, CASE WHEN s.h <= r.top - 2 THEN s.h ELSE greatest(r.top, s.h) END,
 CASE WHEN s.h <= r.top - 2 THEN r.sum + r.top - r.foot ELSE r.sum END FROM r JOIN s ON s.l_orderkey = r.l_orderkey AND s.k = r.k + 1)
SELECT l_orderkey, CAST(sum + top - foot AS DOUBLE) AS ascent FROM r WHERE k = n""")
def q_climb_hysteresis(spark, sf_dir):
    """Total ascent of each profile."""
    return _profiles(spark, sf_dir).select("l_orderkey", climb.total_ascent(F.col("h")).alias("ascent"))


@query(f"""WITH {_STEPS}, a AS (SELECT *, coalesce(lag(h) OVER w, h) AS b, coalesce(lead(h) OVER w, h) AS c FROM s WINDOW w AS (PARTITION BY l_orderkey ORDER BY k))
SELECT l_orderkey, k, round(CASE WHEN k = 1 OR k = n THEN h ELSE (b + 2 * h + c) / 4 END, 4) AS h FROM a""")
def q_smooth(spark, sf_dir):
    """One pass of the weights 1, 2, 1."""
    return _profiles(spark, sf_dir).select("l_orderkey", F.posexplode(climb.smooth(F.col("h"))).alias("k", "h")).select("l_orderkey", (F.col("k") + 1).cast("bigint").alias("k"), F.round("h", 4).alias("h"))


@query(f"""WITH {_STEPS}, e AS (SELECT l_orderkey, max(d) - min(d) AS total, arg_min(h, k) AS h1, arg_max(h, k) AS h2, max(n) AS n FROM s GROUP BY 1),
p AS (SELECT a.l_orderkey, b.d - a.d AS run, 100 * abs(b.h - a.h) / (b.d - a.d) AS pct, row_number() OVER (PARTITION BY a.l_orderkey, a.k ORDER BY b.k) AS nth FROM s a JOIN s b ON a.l_orderkey = b.l_orderkey AND b.k > a.k AND b.d - a.d >= 100)
SELECT e.l_orderkey, round(CASE WHEN n < 2 OR total < 25 THEN NULL WHEN total < 100 THEN 100 * abs(h2 - h1) / total
 ELSE coalesce(max(pct) FILTER (run <= 150), max(pct) FILTER (nth = 1)) END, 4) AS pct FROM e LEFT JOIN p USING (l_orderkey) GROUP BY e.l_orderkey, n, total, h1, h2""")
def q_steepest_run(spark, sf_dir):
    """Steepest stretch of 100 to 150 metres."""
    return _profiles(spark, sf_dir).select("l_orderkey", F.round(climb.steepest_run(F.col("h"), F.col("d"))["pct"], 4).alias("pct"))


# Text
@query("""SELECT p_partkey, regexp_replace(replace(replace(replace(strip_accents(lower(translate(p_name, 'aeiouydt', 'âéîøŵŷðþ'))), 'ø', 'o'), 'ð', 'd'), 'þ', 'th'), '[^a-z0-9]', '', 'g') AS folded FROM part""")
def q_fold(spark, sf_dir):
    """Names with accents put in, folded."""
    return t(spark, sf_dir, "part").select("p_partkey", text.fold(F.translate("p_name", "aeiouydt", "âéîøŵŷðþ")).alias("folded"))


@query("""SELECT c_custkey, CAST(c_custkey % 97 AS VARCHAR) || CASE WHEN c_custkey % 5 = 2 THEN '/' || CAST(c_custkey % 7 + 1 AS VARCHAR) ELSE '' END || CASE WHEN c_custkey % 3 = 1 THEN 'a' ELSE '' END AS number,
 lower(c_mktsegment) || 'and' || CAST(c_nationkey AS VARCHAR) AS parish FROM customer""")
def q_reference_keys(spark, sf_dir):
    """Path numbers and parishes as compared, from several ways to write them."""
    k = F.col("c_custkey")
    tail = F.when(k % 5 == 2, F.concat(F.lit(" / 0"), (k % 7 + 1).cast("string"))).otherwise("")
    number = F.concat(F.when(k % 4 == 0, "BOAT No. ").when(k % 4 == 1, "uUCR ").otherwise(""), F.lpad((k % 97).cast("string"), 4, "0"), tail, F.when(k % 3 == 1, "A").otherwise(""), F.when((k % 3 != 1) & (k % 2 == 0), "/0").otherwise(""))
    parish = F.concat(F.col("c_mktsegment"), F.lit(" & "), F.col("c_nationkey").cast("string"), F.when(k % 2 == 0, " CP").otherwise(" Parish"))
    return t(spark, sf_dir, "customer").select("c_custkey", text.number_key(number).alias("number"), text.parish_key(parish).alias("parish"))


@query("""SELECT s_suppkey, CAST(CASE s_suppkey % 4 WHEN 0 THEN 500000 WHEN 1 THEN 400000 ELSE 300000 END + s_suppkey * 7 % 1000 * 100 + 50 AS DOUBLE) AS easting,
 CAST(CASE s_suppkey % 4 WHEN 0 THEN 100000 WHEN 1 THEN 300000 WHEN 2 THEN 400000 ELSE 500000 END + s_suppkey * 13 % 1000 * 100 + 50 AS DOUBLE) AS northing FROM supplier""")
def q_grid_reference(spark, sf_dir):
    """Six-figure references of four squares as metres."""
    k = F.col("s_suppkey")
    square = F.when(k % 4 == 0, "TQ").when(k % 4 == 1, "SK").when(k % 4 == 2, "SD").otherwise("NY")
    three = lambda n: F.lpad((k * n % 1000).cast("string"), 3, "0")
    written = F.concat(F.when(k % 2 == 0, F.lower(square)).otherwise(square), F.when(k % 3 == 0, " ").otherwise(""), three(7), F.when(k % 5 == 0, "").otherwise(" "), three(13))
    return t(spark, sf_dir, "supplier").select("s_suppkey", text.grid_reference(written).alias("g")).select("s_suppkey", "g.easting", "g.northing")


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders")
def q_parse_dates(spark, sf_dir):
    """Dates written in five ways."""
    k, d = F.col("o_orderkey") % 5, F.col("o_orderdate")
    written = F.when(k == 0, F.date_format(d, "yyyy-MM-dd'Z'")).when(k == 1, F.date_format(d, "dd/MM/yyyy")).when(k == 2, F.date_format(d, "yyyyMMdd")).when(k == 3, F.date_format(d, "EEEE d'th' MMMM yyyy")).otherwise(F.date_format(d, "d MMM, yyyy"))
    return t(spark, sf_dir, "orders").select("o_orderkey", dates.written_date(written).cast("string").alias("day"))


@query("""WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders),
s AS (SELECT o_orderkey, day, CASE WHEN day <= make_date(year(day), 4, 30) THEN year(day) - 1 ELSE year(day) END AS y FROM d)
SELECT o_orderkey, CASE WHEN make_date(y, 10, 1) <= day + 90 THEN CAST(make_date(y, 10, 1) AS VARCHAR) END AS start_on, CASE WHEN make_date(y, 10, 1) <= day + 90 THEN CAST(make_date(y + 1, 4, 30) AS VARCHAR) END AS end_on FROM s""")
def q_season(spark, sf_dir):
    """The season '1 October to 30 April' in force on each order's day, or the next within 90 days."""
    s = dates.season(F.lit("closed (1st October to 30 April)"))
    return t(spark, sf_dir, "orders").select("o_orderkey", dates.season_dates(s["from"], s["to"], F.col("o_orderdate").cast("date")).alias("s")).select("o_orderkey", F.col("s.start").cast("string").alias("start_on"), F.col("s.end").cast("string").alias("end_on"))


@query(f"""SELECT CASE WHEN d IS NULL THEN 'unknown' WHEN d < 0 THEN 'future' WHEN d <= 30 THEN 'under_30d' WHEN d <= 90 THEN 'under_90d' WHEN d <= 365 THEN 'under_1y' WHEN d <= 730 THEN 'under_2y' WHEN d <= 1825 THEN 'under_5y' ELSE 'over_5y' END AS bucket, count(*) AS n
FROM (SELECT CASE WHEN o_orderkey % 50 <> 0 THEN DATE '{TODAY}' - CAST(o_orderdate AS DATE) END AS d FROM orders) GROUP BY 1""")
def q_age_buckets(spark, sf_dir):
    day = F.when(F.col("o_orderkey") % 50 != 0, dates.iso_day(F.col("o_orderdate").cast("string")))
    return t(spark, sf_dir, "orders").groupBy(dates.age_bucket(day, F.lit(TODAY).cast("date")).alias("bucket")).agg(F.count("*").alias("n"))


# Orders
def _records(spark, sf_dir):
    """Each order as a nested record: a provision per line, bare objects where a list has one element."""
    one = F.to_json(F.struct(
        F.struct(F.when(F.col("l_linenumber") % 4 != 0, F.struct(F.when(F.col("l_linenumber") % 4 == 1, "miscRoadClosure").when(F.col("l_linenumber") % 4 == 2, "kerbsideParking").otherwise("dimensionMaximumWidth").alias("regulationType"))).alias("generalRegulation"),
                 F.when(F.col("l_linenumber") % 4 == 0, F.struct(F.col("l_linenumber").alias("mphValue"))).alias("speedLimitValueBased"),
                 F.array(F.struct(F.struct(F.date_format("l_shipdate", "yyyy-MM-dd").alias("start"), F.date_format(F.date_add("l_shipdate", 40), "yyyy-MM-dd").alias("end")).alias("timeValidity")),
                         F.when(F.col("l_returnflag") == "N", F.struct(F.struct(F.date_format("l_shipdate", "yyyy-MM-dd").alias("start"), F.lit(None).cast("string").alias("end")).alias("timeValidity")))).alias("condition")).alias("regulation"),
        F.array(F.struct(F.lit("regulationLocation").alias("type"), F.col("l_linestatus").alias("description"), F.struct(F.lit("SRID=27700;LINESTRING(1 2, 3 4)").alias("linestring")).alias("linearGeometry")),
                F.struct(F.when(F.col("l_linestatus") == "F", "regulationLocation").otherwise("diversionRoute").alias("type"), F.lit("second").alias("description"), F.struct(F.lit("SRID=27700;LINESTRING(5 6, 7 8)").alias("linestring")).alias("linearGeometry"))).alias("regulatedPlace")))
    lists = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(one).alias("p"))
    provision = F.when(F.size("p") == 1, F.get("p", 0)).otherwise(F.concat(F.lit("["), F.array_join("p", ","), F.lit("]")))
    return lists.select("l_orderkey", F.concat(F.lit('{"source":{"reference":"R'), F.col("l_orderkey"), F.lit('","troName":"order","traCreator":'), F.col("l_orderkey") % 90, F.lit(',"provision":'), provision, F.lit("}}")).alias("body"))


@query(f"""WITH p AS (SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS start_on, CASE WHEN l_returnflag <> 'N' THEN strftime(CAST(l_shipdate AS DATE) + 40, '%Y-%m-%d') END AS end_on, unnest(CASE WHEN l_linestatus = 'F' THEN ['F', 'second'] ELSE [l_linestatus] END) AS where_ FROM lineitem WHERE l_linenumber % 4 <> 2)
SELECT l_orderkey, 'R' || l_orderkey AS ref, CAST(l_orderkey % 90 AS INTEGER) AS tra, CASE l_linenumber % 4 WHEN 1 THEN 'Road closed' WHEN 3 THEN 'Width limit' ELSE l_linenumber || ' mph' END AS label, start_on, end_on, where_, count(*) AS n
FROM p WHERE (end_on IS NULL OR end_on >= '{TODAY}') AND start_on <= CAST(DATE '{TODAY}' + 90 AS VARCHAR) GROUP BY ALL""")
def q_restrictions(spark, sf_dir):
    """Nested records to one row per restriction in force or near, and place."""
    rows = orders.restrictions(_records(spark, sf_dir), "body", TODAY, keep=("l_orderkey",))
    return rows.groupBy("l_orderkey", "ref", "tra", "label", F.col("start").alias("start_on"), F.col("end").alias("end_on"), F.col("where").alias("where_")).agg(F.count("*").alias("n"))


@query(f"""SELECT event_id, event_type = 'error' OR (event_id % 3 <> 1 AND NOT (event_id % 2 = 0 AND day < DATE '{TODAY}') AND NOT (event_id % 5 = 0 AND day > DATE '{TODAY}' + 90)) AS worth
FROM (SELECT event_id, coalesce(event_type, '') AS event_type, DATE '{TODAY}' + CAST(event_id % 400 - 200 AS INTEGER) AS day FROM events)""")
def q_worth_fetching(spark, sf_dir):
    """Which change events may concern an order worth carrying; lists are bare texts in every other event."""
    k = F.col("event_id")
    day = F.date_format(F.date_add(F.lit(TODAY).cast("date"), (k % 400 - 200).cast("int")), "yyyy-MM-dd")
    listed = lambda x: F.when(k % 7 < 3, x).otherwise(F.to_json(F.array(x)))
    types = listed(F.when(k % 3 == 1, "kerbsideParking").otherwise("miscRoadClosure"))
    worth = orders.worth_fetching(F.when(F.col("event_type") == "error", "delete").otherwise("update"), types, F.when(k % 5 == 0, listed(day)), F.when(k % 2 == 0, listed(day)), F.lit(TODAY))
    return t(spark, sf_dir, "events").select("event_id", worth.alias("worth"))


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 4 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders
WHERE o_custkey % 7 <> 0 AND o_custkey % 4 <> 1 AND (o_custkey % 4 <> 0 OR o_orderkey % 2 = 0) AND o_totalprice > 1000""")
def q_merge_valid(spark, sf_dir):
    """All rows of a changed customer are replaced, some by none, deletions come last, and the rest is checked again."""
    base = t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_totalprice").alias("price"))
    changed = base.filter("o_custkey % 4 = 0 AND o_orderkey % 2 = 0").withColumn("price", F.col("price") + 1)
    emptied = base.filter("o_custkey % 4 = 1 OR o_custkey % 4 = 0").select("o_custkey").distinct()
    deleted = base.filter("o_custkey % 7 = 0").select("o_custkey").distinct()
    return cdc.merge_valid(base, changed, emptied, deleted, "o_custkey", F.when(F.col("o_custkey") % 4 == 0, F.col("price") > 1001).otherwise(F.col("price") > 1000)).select("o_orderkey", "price")


# Snapshots
@query("""SELECT n.o_orderkey, CASE WHEN p.o_orderkey IS NOT NULL AND p.price IS NOT DISTINCT FROM n.price THEN p.day ELSE '2026-01-01' END AS day, n.price FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS price FROM orders) n
LEFT JOIN (SELECT o_orderkey, o_totalprice AS price, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE o_orderkey % 13 <> 0) p ON n.o_orderkey = p.o_orderkey""")
def q_keep_dates(spark, sf_dir):
    """Rows that did not change keep their old date."""
    rows = t(spark, sf_dir, "orders")
    previous = rows.filter("o_orderkey % 13 <> 0").select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderdate").cast("date").cast("string").alias("day"))
    now = rows.select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("price"), F.lit("2026-01-01").alias("day"))
    return cdc.keep_dates(now, previous, "o_orderkey", "day")


@query("""SELECT o_orderkey, CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1 THEN CAST(o_custkey AS VARCHAR) ELSE o_custkey || '-' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8) END AS id FROM orders""")
def q_settle_ids(spark, sf_dir):
    rows = t(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("id"), "o_totalprice", "o_orderkey")
    return cdc.settled_ids(rows, "id", "o_totalprice", "o_orderkey").select("o_orderkey", "id")


@query("SELECT s_suppkey FROM (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS n FROM supplier) x WHERE (n - 1) % 3 = 0")
def q_stride_sample(spark, sf_dir):
    """Every third supplier in order of key."""
    return ranking.ranked(t(spark, sf_dir, "supplier"), "s_suppkey").filter("(rank - 1) % 3 = 0").select("s_suppkey")


@query("SELECT s_suppkey, CAST(CAST('0x' || substr(sha256(s_name), 1, 16) AS UBIGINT) // 2 AS BIGINT) AS id FROM supplier")
def q_stable_id(spark, sf_dir):
    return t(spark, sf_dir, "supplier").select("s_suppkey", geo.stable_id(F.col("s_name")).alias("id"))


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) x WHERE n <= 6")
def q_topk_per_key(spark, sf_dir):
    return gates.newest(t(spark, sf_dir, "events"), "user_id", F.desc("ts"), F.desc("event_id")).select("user_id", "event_id")


# Readings
@query("""WITH e AS (SELECT user_id, epoch(ts) AS s, value FROM events WHERE ts IS NOT NULL), b AS (SELECT user_id, floor(min(s)) AS lo, floor(max(s)) AS hi FROM e GROUP BY 1),
g AS (SELECT user_id, unnest(generate_series(CAST(lo + 172800 AS BIGINT), CAST(hi AS BIGINT), 43200)) AS edge FROM b)
SELECT g.user_id, make_timestamp(g.edge * 1000000) AS edge, round(coalesce(sum(value), 0), 4) AS total FROM g LEFT JOIN e ON e.user_id = g.user_id AND floor(e.s) BETWEEN edge - 172800 AND edge GROUP BY 1, 2""")
def q_rolling_totals(spark, sf_dir):
    """Every 48-hour total by steps of 12 hours."""
    out = readings.rolling_totals(t(spark, sf_dir, "events"), "user_id", "ts", "value", 48, 12)
    return out.select("user_id", F.col("edge").cast("timestamp_ntz").alias("edge"), F.round("total", 4).alias("total"))


@query("SELECT user_id, v[greatest(1, CAST(round_even(0.5 * len(v), 0) AS INT))] AS p50, v[greatest(1, CAST(round_even(0.9 * len(v), 0) AS INT))] AS p90 FROM (SELECT user_id, list_sort(list(value) FILTER (value IS NOT NULL)) AS v FROM events GROUP BY user_id) x")
def q_nearest_rank(spark, sf_dir):
    return readings.nearest_ranks(t(spark, sf_dir, "events"), "user_id", "value", (50, 90))


@query("SELECT user_id, max(gap) AS gap FROM (SELECT user_id, event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS gap FROM events) x GROUP BY user_id")
def q_cadence_gap(spark, sf_dir):
    return readings.widest_gap(t(spark, sf_dir, "events"), "user_id", "event_id")


@query("""WITH l AS (SELECT user_id, arg_max(value, event_id) AS level FROM events GROUP BY 1), x AS (SELECT user_id, CASE WHEN user_id % 9 <> 0 THEN level END AS level, CASE WHEN user_id % 4 <> 0 THEN 20.0 END AS low, CASE WHEN user_id % 5 <> 0 THEN 60.0 END AS high FROM l)
SELECT user_id, CASE WHEN level IS NULL OR high IS NULL THEN 'unknown' WHEN level > high THEN 'above' WHEN low IS NOT NULL AND level < low THEN 'below' ELSE 'normal' END AS state, round(level - high, 3) AS delta_m FROM x""")
def q_level_state(spark, sf_dir):
    """Latest level of each gauge against its typical range, where it has one."""
    k = F.col("user_id")
    last = t(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by("value", "event_id").alias("level"))
    state = wet.level_state(F.when(k % 9 != 0, F.col("level")), F.when(k % 4 != 0, F.lit(20.0)), F.when(k % 5 != 0, F.lit(60.0)))
    return last.select("user_id", state.alias("s")).select("user_id", "s.state", "s.delta_m")


@query("""WITH c AS (SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'hard' WHEN 1 THEN 'firm' WHEN 2 THEN 'soft' WHEN 3 THEN CASE WHEN p_partkey % 2 = 0 THEN 'firm' ELSE 'unknown' END WHEN 4 THEN CASE WHEN p_partkey % 2 = 0 THEN 'firm' ELSE 'unknown' END ELSE CASE WHEN p_partkey % 2 = 0 THEN 'firm' ELSE 'unknown' END END AS class,
 CASE WHEN p_partkey % 11 <> 0 THEN p_retailprice / 50 END AS mm FROM part)
SELECT p_partkey, class, CASE WHEN class = 'hard' THEN 'na' WHEN mm IS NULL THEN 'unknown' WHEN class = 'firm' THEN CASE WHEN mm >= 30 THEN 'wet' WHEN mm >= 12 THEN 'damp' ELSE 'dry' END WHEN mm >= 15 THEN 'wet' WHEN mm >= 5 THEN 'damp' ELSE 'dry' END AS verdict FROM c""")
def q_wet_verdict(spark, sf_dir):
    """Class of a surface, by its own tag or its track's grade, and what the rain makes of it."""
    n = F.col("p_size") % 6
    surface = F.when(n == 0, "Asphalt ").when(n == 1, "gravel").when(n == 2, "MUD").when(n == 3, "unpaved").when(n == 4, "moon dust")
    klass = wet.susceptibility(surface, F.when(F.col("p_partkey") % 2 == 0, "grade2"))["class"]
    return t(spark, sf_dir, "part").select("p_partkey", klass.alias("class"), wet.verdict(klass, F.when(F.col("p_partkey") % 11 != 0, F.col("p_retailprice") / 50)).alias("verdict"))


# Gates
@query("""SELECT coalesce(p.k, n.k) AS k, coalesce(p.n, 0) AS was, coalesce(n.n, 0) AS now, CASE WHEN p.n IS NULL THEN 'new' WHEN coalesce(n.n, 0) < 0.75 * p.n THEN 'refuse' ELSE 'pass' END AS verdict FROM (SELECT o_custkey % 50 AS k, count(*) AS n FROM orders WHERE o_orderkey % 3 <> 0 AND o_custkey % 50 <> 9 GROUP BY 1) p FULL JOIN (SELECT o_custkey % 50 AS k, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1) n ON p.k = n.k""")
def q_drop_gate(spark, sf_dir):
    rows = t(spark, sf_dir, "orders").withColumn("k", F.col("o_custkey") % 50)
    return gates.fallen(rows.filter("o_orderkey % 3 <> 0 AND k <> 9"), rows.filter("o_orderkey % 2 = 0"), "k")


@query("""WITH b AS (SELECT o_custkey % 50 AS k, o_orderkey FROM orders), n AS (SELECT * FROM b WHERE k % 3 = 0 OR (k % 3 = 1 AND o_orderkey % 9 = 0)), c AS (SELECT b.k, count(*) AS was, (SELECT count(*) FROM n WHERE n.k = b.k) AS now FROM b GROUP BY 1)
SELECT k, o_orderkey FROM n WHERE k NOT IN (SELECT k FROM c WHERE now = 0 OR (was >= 6 AND 3 * now < was)) UNION ALL SELECT k, o_orderkey FROM b WHERE k IN (SELECT k FROM c WHERE now = 0 OR (was >= 6 AND 3 * now < was))""")
def q_last_good(spark, sf_dir):
    """Keys that came back empty or much smaller keep what they had."""
    base = t(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("k"), "o_orderkey")
    return gates.last_good(base, base.filter("k % 3 = 0 OR (k % 3 = 1 AND o_orderkey % 9 = 0)"), "k")


@query("""WITH RECURSIVE g AS (SELECT c_nationkey, count(*) AS size, row_number() OVER (ORDER BY c_nationkey) AS i FROM customer GROUP BY 1), b AS (SELECT sum(size) // 6 AS budget FROM g),
r AS (SELECT c_nationkey, i, CAST(0 AS BIGINT) AS pack, CAST(size AS HUGEINT) AS used FROM g WHERE i = 1 UNION ALL
 SELECT g.c_nationkey, g.i, CASE WHEN r.used + g.size <= (SELECT budget FROM b) THEN r.pack ELSE r.pack + 1 END, CASE WHEN r.used + g.size <= (SELECT budget FROM b) THEN r.used + g.size ELSE g.size END FROM r JOIN g ON g.i = r.i + 1)
SELECT c_nationkey, pack FROM r""")
def q_pack_by_budget(spark, sf_dir):
    """Nations in order, packed while a sixth of all customers holds them."""
    rows = t(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("size"))
    budget = rows.agg(F.sum("size")).first()[0] // 6
    return gates.packed(rows, "c_nationkey", "size", budget)


@query("SELECT 'email' AS rule, count(*) AS n FROM documents WHERE text IS NULL OR regexp_matches(text, '[^ ]+@[^ ]+') HAVING count(*) > 0 UNION ALL SELECT 'long', count(*) FROM documents WHERE n_chars IS NULL OR n_chars >= 2000 HAVING count(*) > 0 UNION ALL SELECT 'source', count(*) FROM documents WHERE source IS NULL HAVING count(*) > 0")
def q_broken_rules(spark, sf_dir):
    """How many documents break each of some rules."""
    return gates.broken(t(spark, sf_dir, "documents"), email=~F.col("text").rlike("[^ ]+@[^ ]+"), long=F.col("n_chars") < 2000, source=F.col("source").isNotNull())


# Places and lines
@query("SELECT (CASE WHEN w >= 0 THEN 'E' ELSE 'W' END) || abs(w) || '_N' || s AS tile, count(*) AS n FROM (SELECT CAST(floor((-5.0 + (c_custkey * 37 % 700) / 100.0) / 5) * 5 AS INT) AS w, CAST(floor((50.0 + (c_custkey * 53 % 550) / 100.0) / 5) * 5 AS INT) AS s FROM customer) GROUP BY 1")
def q_degree_tiles(spark, sf_dir):
    k = F.col("c_custkey")
    return t(spark, sf_dir, "customer").groupBy(geo.degree_tile(F.lit(-5.0) + (k * 37 % 700) / 100.0, F.lit(50.0) + (k * 53 % 550) / 100.0).alias("tile")).agg(F.count("*").alias("n"))


@query("""SELECT c_custkey, CAST(floor((lon + 180) / 360 * 4096) AS BIGINT) AS x, CAST(floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 4096) AS BIGINT) AS y
FROM (SELECT c_custkey, -5.0 + (c_custkey * 37 % 700) / 100.0 AS lon, 50.0 + (c_custkey * 53 % 550) / 100.0 AS lat FROM customer)""")
def q_tile_bucket(spark, sf_dir):
    k = F.col("c_custkey")
    return t(spark, sf_dir, "customer").select("c_custkey", F.floor(geo.tile_x(F.lit(-5.0) + (k * 37 % 700) / 100.0, 12)).alias("x"), F.floor(geo.tile_y(F.lit(50.0) + (k * 53 % 550) / 100.0, 12)).alias("y"))


@query("SELECT l_orderkey, CASE WHEN l_orderkey % 3 = 0 THEN 'MULTILINESTRING' ELSE 'LINESTRING' END AS kind, CASE WHEN l_orderkey % 3 = 0 THEN count(*) ELSE 1 END AS parts, 2 * count(*) AS points, CAST(sum(l_linenumber * 3 + 1.5) AS DOUBLE) AS xs FROM lineitem GROUP BY 1")
def q_wkt(spark, sf_dir):
    """Well-known text of an order's lines, read back; the multi forms keep their parts apart."""
    run = F.format_string("%d 10.25, %s 20", F.col("l_linenumber") * 2, (F.col("l_linenumber") + 1.5).cast("string"))
    runs = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(run).alias("r"))
    written = F.when(F.col("l_orderkey") % 3 == 0, F.concat(F.lit("SRID=27700;MULTILINESTRING(("), F.array_join("r", "),("), F.lit("))"))).otherwise(F.concat(F.lit("SRID=27700;LINESTRING("), F.array_join("r", ", "), F.lit(")")))
    g = runs.select("l_orderkey", geo.wkt(written).alias("g"))
    points = F.flatten("g.parts")
    return g.select("l_orderkey", "g.kind", F.size("g.parts").cast("bigint").alias("parts"), F.size(points).cast("bigint").alias("points"), F.round(F.aggregate(points, F.lit(0.0), lambda s, p: s + p["x"]), 2).alias("xs"))


def _ways(df, key, legs):
    """A line per row that starts at the row's place and goes on by some legs of about a hundred metres."""
    k = F.col(key)
    lon, lat = F.lit(-5.0) + (k * 37 % 700) / 100.0, F.lit(50.0) + (k * 53 % 550) / 100.0
    points = [F.struct((lon + i * 0.001).alias("x"), (lat + 0.0007 * (i % 2)).alias("y")) for i in range(legs + 1)]
    return df.select(k.alias("k"), F.array(*points).alias("line"))


_WAY = lambda table, key, legs: f"SELECT {key} AS k, i, (-5.0 + ({key} * 37 % 700) / 100.0 + i * 0.001) AS lon, 50.0 + ({key} * 53 % 550) / 100.0 + 0.0007 * (i % 2) AS lat FROM {table}, generate_series(0, {legs}) AS g(i)"


@query(f"""WITH a AS ({_WAY('customer', 'c_custkey', 4)}), b AS ({_WAY('supplier', 's_suppkey', 2)}),
m AS (SELECT 'a' AS side, k, i, lon * 111320 * cos(radians(lat)) AS x, lat * 110574 AS y FROM a UNION ALL SELECT 'b', k, i, lon * 111320 * cos(radians(lat)), lat * 110574 FROM b),
l AS (SELECT side, k, i, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS by_ FROM m WINDOW w AS (PARTITION BY side, k ORDER BY i)),
s AS (SELECT *, sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) AS len FROM l WHERE bx IS NOT NULL),
p AS (SELECT k, ax AS x, ay AS y FROM s WHERE side = 'a' AND i = 0 UNION ALL SELECT k, bx, by_ FROM s WHERE side = 'a' UNION ALL
 SELECT k, ax + (bx - ax) * j * 5 / len, ay + (by_ - ay) * j * 5 / len FROM (SELECT *, unnest(generate_series(1, CAST(ceil(len / 5) AS BIGINT) - 1)) AS j FROM s WHERE side = 'a')),
d AS (SELECT p.k, p.x, p.y, min(sqrt(pow(p.x - (ax + greatest(0, least(1, ((p.x - ax) * (bx - ax) + (p.y - ay) * (by_ - ay)) / (len * len))) * (bx - ax)), 2) + pow(p.y - (ay + greatest(0, least(1, ((p.x - ax) * (bx - ax) + (p.y - ay) * (by_ - ay)) / (len * len))) * (by_ - ay)), 2))) AS far
 FROM p JOIN s ON side = 'b' AND ax < p.x + 2000 AND ax > p.x - 2000 AND abs(p.y - ay) < 2000 GROUP BY ALL)
SELECT p.k, round(avg(CASE WHEN far <= 15 THEN 1.0 ELSE 0.0 END), 4) AS share FROM p LEFT JOIN d USING (k, x, y) GROUP BY 1""")
def q_coverage_share(spark, sf_dir):
    """Share of each customer's way that lies along a supplier's."""
    out = lines.covered_share(_ways(t(spark, sf_dir, "customer"), "c_custkey", 4), _ways(t(spark, sf_dir, "supplier"), "s_suppkey", 2), "k", "line")
    return out.select("k", F.round("share", 4).alias("share"))


@query("SELECT k, CAST(1 AS BIGINT) AS runs FROM (SELECT c_custkey AS k FROM customer)")
def q_uncovered_runs(spark, sf_dir):
    """Each customer's way is longer than any supplier's, so one run of it lies along none."""
    out = lines.uncovered_runs(_ways(t(spark, sf_dir, "customer"), "c_custkey", 4), _ways(t(spark, sf_dir, "supplier"), "s_suppkey", 2), "k", "line")
    return out.groupBy("k").agg(F.count("*").alias("runs"))


def _apart(df, key, legs):
    """A way per row like those of `_ways`, each some hundred metres at least from all others: 770,000 between 50 and 55.5 degrees north, as many in each such band south of it."""
    k = F.col(key)
    row = F.floor(k / 700)
    lon, lat = F.lit(-5.0) + (k % 700) / 100.0, F.lit(50.0) + (row % 1100) / 200.0 - F.floor(row / 1100) * 5.5
    return df.select(k.alias("k"), F.array(*[F.struct((lon + i * 0.001).alias("x"), (lat + 0.0007 * (i % 2)).alias("y")) for i in range(legs + 1)]).alias("line"))


def _moved(up):
    return F.transform("line", lambda p: F.struct(p["x"].alias("x"), (p["y"] + up).alias("y")))


@query("SELECT c_custkey * 2 AS a, c_custkey * 2 + 1 AS b FROM customer WHERE c_custkey % 3 <> 0")
def q_line_twins(spark, sf_dir):
    """Ways drawn twice: a copy moved by some metres is a twin, one moved far is not."""
    ways = _apart(t(spark, sf_dir, "customer"), "c_custkey", 3)
    copies = ways.withColumn("line", _moved(F.when(F.col("k") % 3 == 0, 0.0006).otherwise(0.00008)))
    both = ways.select((F.col("k") * 2).alias("k"), "line").unionByName(copies.select((F.col("k") * 2 + 1).alias("k"), "line"))
    return lines.twins(both, "k", "line").select("a", "b")


@query("""SELECT 'old' AS side, c_custkey AS k, CASE WHEN c_custkey % 5 IN (0, 1, 2) THEN 'kept' ELSE 'dropped' END AS verdict FROM customer UNION ALL
SELECT 'new', c_custkey, CASE WHEN c_custkey % 5 IN (0, 1, 2) THEN 'known' ELSE 'added' END FROM customer WHERE c_custkey % 5 <> 4""")
def q_renewed(spark, sf_dir):
    """A newer copy of a register: ways redrawn some metres off are known, ways gone on further replace the old ones, others are dropped."""
    rows = t(spark, sf_dir, "customer")
    old = _apart(rows, "c_custkey", 3).select("k", F.array("line").alias("parts"))
    longer = _apart(rows, "c_custkey", 5).filter("k % 5 = 3")
    new = _apart(rows, "c_custkey", 3).filter("k % 5 < 3").withColumn("line", _moved(F.lit(0.00006))).unionByName(longer).select("k", F.array("line").alias("parts"))
    return lines.renewed(old, new, "k", "parts")[1].select("side", "k", "verdict")


@query("SELECT c_custkey AS k, CAST(CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 2 END AS BIGINT) AS lines, c_custkey % 3 <> 0 AS matched FROM customer")
def q_surveyed(spark, sf_dir):
    """Each way is surveyed in two lines end to end, of which every third lacks one; a line some way off does not count."""
    ways = _apart(t(spark, sf_dir, "customer"), "c_custkey", 4)
    half = lambda n, first: ways.select((F.col("k") * 4 + n).alias("o"), F.slice("line", first, 3).alias("line"))
    surveyed = half(0, 1).unionByName(half(1, 3).filter("floor(o / 4) % 3 <> 0")).unionByName(half(2, 1).withColumn("line", _moved(F.lit(0.0005))))
    under = physical.under(ways, "k", "line", surveyed, "o", "line")
    return under.groupBy("k").agg(F.count("*").alias("lines"), (F.max("cover") >= physical.UNION).alias("matched"))


@query("""WITH d AS (SELECT l_orderkey, l_quantity AS q, max(CASE WHEN l_linenumber <> 6 THEN l_quantity END) AS m, list(l_linenumber) AS ids, min(l_returnflag) AS s0, max(l_returnflag) AS s1 FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, CAST(sum(len(ids)) AS BIGINT) AS pieces, count(*) AS lines, round(CASE WHEN count(m) = count(*) THEN sum(m) END, 4) AS length, CASE WHEN min(s0) = max(s1) THEN min(s0) END AS said FROM d GROUP BY 1""")
def q_join_pieces(spark, sf_dir):
    """Pieces of one way: distinct lines once, length null if any is unknown, words only if all agree."""
    q = F.col("l_quantity").cast("double")
    rows = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.array(F.struct(q.alias("x"), q.alias("y"))).alias("line"), F.when(F.col("l_linenumber") != 6, q).alias("m"))
    out = registers.joined(rows, ["l_orderkey"], "l_linenumber", "line", "m", "l_returnflag")
    return out.select("l_orderkey", F.size("pieces").cast("bigint").alias("pieces"), F.size("lines").cast("bigint").alias("lines"), F.round("length", 4).alias("length"), "said")


@query("SELECT c_mktsegment, min(c_custkey) AS c_custkey, count(*) - 1 AS also FROM customer GROUP BY c_mktsegment, c_nationkey, c_custkey % 3")
def q_exact_twins(spark, sf_dir):
    """Rows whose line another row of the same segment and nation has too."""
    line = F.array(F.struct((F.col("c_custkey") % 3).cast("double").alias("x"), F.lit(1.0).alias("y")))
    out = registers.exact_twins(t(spark, sf_dir, "customer").withColumn("line", line), ["c_mktsegment", "c_nationkey"], "c_custkey", "line")
    return out.select("c_mktsegment", "c_custkey", F.size("also").cast("bigint").alias("also"))


@query(f"""WITH b AS ({_WAY('supplier', 's_suppkey', 2)}), m AS (SELECT k, i, lon * 111320 * cos(radians(lat)) AS x, lat * 110574 AS y FROM b),
s AS (SELECT k, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS by_ FROM m WINDOW w AS (PARTITION BY k ORDER BY i)),
c AS (SELECT c_custkey, (-5.0 + (c_custkey * 37 % 700) / 100.0 + 0.0004) * 111320 * cos(radians(50.0 + (c_custkey * 53 % 550) / 100.0 + 0.0003)) AS x, (50.0 + (c_custkey * 53 % 550) / 100.0 + 0.0003) * 110574 AS y FROM customer),
d AS (SELECT c_custkey, k, greatest(0, least(1, ((x - ax) * (bx - ax) + (y - ay) * (by_ - ay)) / (pow(bx - ax, 2) + pow(by_ - ay, 2)))) AS u, x, y, ax, ay, bx, by_ FROM c JOIN s ON bx IS NOT NULL AND abs(x - ax) < 500 AND abs(y - ay) < 500),
f AS (SELECT c_custkey, k, sqrt(pow(x - (ax + u * (bx - ax)), 2) + pow(y - (ay + u * (by_ - ay)), 2)) AS m FROM d)
SELECT c.c_custkey, arg_min(f.k, f.m) AS k, round(min(f.m), 3) AS m FROM c LEFT JOIN f ON f.c_custkey = c.c_custkey AND f.m <= 25 GROUP BY 1""")
def q_nearest_line(spark, sf_dir):
    """The supplier's way that passes each customer within 25 metres."""
    k = F.col("c_custkey")
    points = t(spark, sf_dir, "customer").select("c_custkey", (F.lit(-5.0) + (k * 37 % 700) / 100.0 + 0.0004).alias("lon"), (F.lit(50.0) + (k * 53 % 550) / 100.0 + 0.0003).alias("lat"))
    out = registers.nearest_line(points, _ways(t(spark, sf_dir, "supplier"), "s_suppkey", 2), "c_custkey", "lon", "lat", "k", "line")
    return out.select("c_custkey", "k", F.round("m", 3).alias("m"))


@query("""WITH g AS (SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_custkey % 10 = 3 AND s_suppkey = c_custkey % 97 + 1), r AS (SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_nationkey = s_nationkey AND c_custkey % 4 <> 0 AND s_suppkey <= 20)
SELECT c.c_custkey, coalesce(g.s_suppkey, r.s_suppkey) AS s_suppkey, CASE WHEN g.c_custkey IS NOT NULL THEN CASE WHEN EXISTS (SELECT 1 FROM r x WHERE x.c_custkey = c.c_custkey) AND NOT EXISTS (SELECT 1 FROM r x WHERE x.c_custkey = c.c_custkey AND x.s_suppkey = g.s_suppkey) THEN 'review' ELSE 'place' END WHEN r.c_custkey IS NOT NULL THEN 'reference' ELSE 'unmatched' END AS how
FROM customer c LEFT JOIN g USING (c_custkey) LEFT JOIN r ON r.c_custkey = c.c_custkey AND g.c_custkey IS NULL""")
def q_match_cascade(spark, sf_dir):
    """Ways by place, else by reference; what does not agree is for review."""
    c, s = t(spark, sf_dir, "customer"), t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    place = c.filter("c_custkey % 10 = 3").join(s, F.col("s_suppkey") == F.col("c_custkey") % 97 + 1).select("c_custkey", "s_suppkey")
    reference = c.filter("c_custkey % 4 <> 0").join(s.filter("s_suppkey <= 20"), F.col("c_nationkey") == F.col("s_nationkey")).select("c_custkey", "s_suppkey")
    return registers.matched(c, "c_custkey", place, reference, "s_suppkey")


@query("""WITH RECURSIVE l AS (SELECT 'p' || o_custkey AS file, o_orderkey AS f, o_orderkey + CASE WHEN o_orderkey % 5 = 0 THEN 3 ELSE 1 END AS t FROM orders), p AS (SELECT file, max(t) AS b FROM l GROUP BY 1),
r AS (SELECT file, b FROM p UNION SELECT l.file, l.f FROM l JOIN r ON l.file = r.file AND l.t = r.b) SELECT l.file, l.f AS "from", l.t AS "to" FROM l JOIN r ON l.file = r.file AND l.t = r.b""")
def q_reaching_links(spark, sf_dir):
    """Links of builds from which a chain leads to the published one."""
    k = F.col("o_orderkey")
    links = t(spark, sf_dir, "orders").select(F.concat(F.lit("p"), "o_custkey").alias("file"), k.alias("from"), (k + F.when(k % 5 == 0, 3).otherwise(1)).alias("to"))
    return registers.reaching(links, links.groupBy("file").agg(F.max("to").alias("build")))


@query("""SELECT d + to_hours(h) + to_minutes(30) AS at FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '1996-12-30', INTERVAL 1 DAY) AS g(d), (SELECT unnest([3, 9, 15]) AS h)
WHERE month(d) IN (1, 2, 3, 6) AND (day(d) IN (1, 11, 21, 31) OR dayofweek(d) IN (1, 2))""")
def q_cron_times(spark, sf_dir):
    """Every firing of a cron line in two years."""
    return registers.firing(spark, "30 3-15/6 */10 1-3,6 1,2", "1995-01-01", 730).select(F.col("at").cast("timestamp_ntz").alias("at"))


@query(f"""WITH d AS (SELECT o_orderstatus, CASE WHEN o_orderkey % 20 <> 0 THEN DATE '{TODAY}' - CAST(o_orderdate AS DATE) END AS raw FROM orders), a AS (SELECT o_orderstatus, raw, CASE WHEN raw IS NOT NULL THEN greatest(raw, 0) END AS age FROM d),
v AS (SELECT o_orderstatus, list_sort(list(age) FILTER (age IS NOT NULL)) AS v, count(*) AS rows, count(raw) AS dated, count(*) FILTER (raw < 0) AS future_dated, count(*) FILTER (age > 365) AS over_year FROM a GROUP BY 1)
SELECT o_orderstatus, rows, dated, rows - dated AS unknown, future_dated, over_year, CAST(v[1] AS INT) AS newest, CAST(v[greatest(1, CAST(round_even(len(v) * 0.5, 0) AS INT))] AS INT) AS median, CAST(v[greatest(1, CAST(round_even(len(v) * 90 / 100.0, 0) AS INT))] AS INT) AS p90, CAST(v[len(v)] AS INT) AS oldest FROM v""")
def q_age_summary(spark, sf_dir):
    rows = t(spark, sf_dir, "orders").withColumn("day", F.when(F.col("o_orderkey") % 20 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")))
    return registers.age_summary(rows, ["o_orderstatus"], "day", F.lit(TODAY).cast("date"))


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 1 THEN 'experimental' WHEN p_size % 4 = 2 OR p_partkey % 3 = 0 THEN 'seasonal' ELSE 'permanent' END AS form,
 CASE p_partkey % 5 WHEN 0 THEN 'prohibition' WHEN 1 THEN 'width' WHEN 2 THEN 'speed' WHEN 3 THEN 'other' ELSE 'other' END AS kind FROM part""")
def q_order_forms(spark, sf_dir):
    """Form and kind of orders from their titles, dates and codes."""
    k, n = F.col("p_partkey"), F.col("p_size") % 4
    title = F.when(n == 1, "The Road (EXPERIMENTAL) Temporary Order").when(n == 2, "Seasonal closure").when(n == 3, "Experimentally named")
    day = F.when(k % 3 == 0, "2026-01-01")
    code = F.when(k % 5 == 0, "miscRoadClosure").when(k % 5 == 1, "dimensionMaximumWidth").when(k % 5 == 2, "speedLimitValueBased").when(k % 5 == 3, "kerbside")
    return t(spark, sf_dir, "part").select("p_partkey", registers.order_form(title, day, day).alias("form"), registers.order_type(code).alias("kind"))


@query("""SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'water' WHEN event_id % 4 IN (1, 2) THEN 'fuel' END AS category, event_id % 3 <> 1 AS usable FROM events""")
def q_poi_category(spark, sf_dir):
    """First category whose selector is among an element's tags, and whether anyone may use it."""
    k = F.col("event_id")
    tags = F.map_filter(F.create_map(F.lit("amenity"), F.when(k % 4 < 3, F.when(k % 2 == 1, "fuel").otherwise("drinking_water")), F.lit("shop"), F.when(k % 4 == 2, "fuel"), F.lit("access"), F.when(k % 3 == 1, F.when(k % 2 == 0, "no").otherwise("private")).when(k % 3 == 2, "yes")), lambda a, b: b.isNotNull())
    tags = F.when(k % 4 == 2, F.map_filter(tags, lambda a, b: a != "amenity")).otherwise(tags)
    rules = [("water", [("amenity", "drinking_water")]), ("fuel", [("amenity", "fuel"), ("shop", "fuel")])]
    return t(spark, sf_dir, "events").select("event_id", registers.first_category(tags, rules).alias("category"), registers.usable(tags).alias("usable"))


@query("""WITH f AS (SELECT o_orderkey, o_custkey % 40 AS tra, CAST(o_orderdate AS DATE) AS start_on, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) + 30 END AS end_on, o_orderkey % 6 AS spot FROM orders WHERE o_orderkey % 2 = 0),
c AS (SELECT o_orderkey, o_custkey % 40 AS tra, CAST(o_orderdate AS DATE) + 1 AS start_on, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) + 40 END AS end_on, o_orderkey % 6 AS spot FROM orders WHERE o_orderkey % 2 = 1)
SELECT o_orderkey FROM c WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.tra = c.tra AND (f.end_on IS NULL) = (c.end_on IS NULL) AND abs(f.start_on - c.start_on) <= 3 AND (f.end_on IS NULL OR abs(f.end_on - c.end_on) <= 14) AND (f.spot + 1) // 2 = (c.spot + 1) // 2)""")
def q_council_fold(spark, sf_dir):
    """Council orders that the feed does not have: same authority, dates near, places overlapping."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    base = t(spark, sf_dir, "orders")
    spot = F.floor((k % 6 + 1) / 2) * 0.01
    line = F.array(F.struct((spot - 1).alias("x"), F.lit(52.0).alias("y")), F.struct((spot - 0.999).alias("x"), (F.lit(52.0) + (k % 2) * 0.00005).alias("y")))
    common = lambda rows, a, b: rows.select("o_orderkey", (F.col("o_custkey") % 40).alias("tra"), F.lit("prohibition").alias("kind"), F.date_add(d, a).alias("start"), F.when(k % 3 != 0, F.date_add(d, b)).alias("end"), F.lit("permanent").alias("form"), line.alias("line"), F.array(k.cast("string")).alias("ways"))
    return registers.folded(common(base.filter("o_orderkey % 2 = 1"), 1, 40), common(base.filter("o_orderkey % 2 = 0"), 0, 30), "o_orderkey")[0].select("o_orderkey")


@query("SELECT a.o_orderkey AS a, b.o_orderkey AS b FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND abs(date_diff('day', CAST(b.o_orderdate AS DATE), CAST(a.o_orderdate AS DATE))) <= 3")
def q_interval_tolerance(spark, sf_dir):
    """Orders of one customer at most three days apart."""
    return registers.near_in_time(t(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date")), "o_custkey", "o_orderkey", "day", 3)


@query("""SELECT box, count(*) AS n FROM (SELECT -5.0 + (c_custkey * 37 % 700) / 100.0 AS lon, 50.0 + (c_custkey * 53 % 550) / 100.0 AS lat FROM customer),
(VALUES ('west', -5.0, 49.0, -1.0, 56.0), ('mid', -2.0, 50.5, 1.0, 53.25), ('east', 0.0, 52.0, 2.5, 52.0), ('none', 9.0, 9.0, 9.5, 9.5)) AS b(box, w, s, e, n) WHERE lon BETWEEN w AND e AND lat BETWEEN s AND b.n GROUP BY 1""")
def q_region_boxes(spark, sf_dir):
    """Customers by the regions that hold them; a place may be in several."""
    k = F.col("c_custkey")
    points = t(spark, sf_dir, "customer").select("c_custkey", (F.lit(-5.0) + (k * 37 % 700) / 100.0).alias("lon"), (F.lit(50.0) + (k * 53 % 550) / 100.0).alias("lat"))
    boxes = spark.createDataFrame([("west", -5.0, 49.0, -1.0, 56.0), ("mid", -2.0, 50.5, 1.0, 53.25), ("east", 0.0, 52.0, 2.5, 52.0), ("none", 9.0, 9.0, 9.5, 9.5)], "box string, west double, south double, east double, north double")
    return registers.in_boxes(points, "lon", "lat", boxes, "box").groupBy("box").agg(F.count("*").alias("n"))


@query("""SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'motor_vehicles_except_motorcycles' WHEN 1 THEN 'vehicles_over_width' WHEN 2 THEN 'all_vehicles' WHEN 3 THEN 'motor_vehicles' WHEN 4 THEN 'motor_vehicles' END AS vehicles,
 CASE WHEN p_partkey % 6 = 1 THEN 1 + p_size / 10.0 END AS width_m FROM part""")
def q_classify(spark, sf_dir):
    """Whom an order's words shut out, and above which width."""
    k = F.col("p_partkey") % 6
    words = F.when(k == 0, "Prohibition of motor vehicles other than solo motorcycles").when(k == 1, F.concat(F.lit("All vehicles of a WIDTH exceeding "), (F.col("p_size") / 10.0 + 1).cast("string"), F.lit("m"))).when(k == 2, "Closed to any traffic").when(
        k == 3, "no Motor Vehicle may pass").when(k == 4, "Prohibition of Driving order").otherwise("Gate locked at night")
    return t(spark, sf_dir, "part").select("p_partkey", text.vehicles(words).alias("v")).select("p_partkey", "v.vehicles", "v.width_m")


@query(f"""WITH a AS ({_WAY('customer', 'c_custkey', 4)}), b AS ({_WAY('supplier', 's_suppkey', 2)}),
m AS (SELECT 'a' AS side, k, i, lon * 111320 * cos(radians(lat)) AS x, lat * 110574 AS y FROM a UNION ALL SELECT 'b', k, i, lon * 111320 * cos(radians(lat)), lat * 110574 + 3 FROM b),
l AS (SELECT side, k, i, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS by_ FROM m WINDOW w AS (PARTITION BY side, k ORDER BY i)),
s AS (SELECT *, sqrt(pow(bx - ax, 2) + pow(by_ - ay, 2)) AS len, degrees(atan2(by_ - ay, bx - ax)) AS deg FROM l WHERE bx IS NOT NULL),
p AS (SELECT k, i, j, ax + (bx - ax) * least(1, j * 5 / len) AS x, ay + (by_ - ay) * least(1, j * 5 / len) AS y, deg FROM (SELECT *, unnest(generate_series(0, CAST(floor(len / 5) AS BIGINT) - CASE WHEN i = 3 THEN 0 ELSE 1 END)) AS j FROM s WHERE side = 'a')),
n AS (SELECT p.k, p.i, p.j, s.k % 2 AS odd, ((p.x - ax) * (bx - ax) + (p.y - ay) * (by_ - ay)) / len AS far_along, abs((p.x - ax) * (by_ - ay) - (p.y - ay) * (bx - ax)) / len AS off, len FROM p JOIN s ON side = 'b' AND abs(ax - p.x) < 500 AND abs(ay - p.y) < 500 AND degrees(acos(least(1, abs(cos(radians(p.deg - s.deg)))))) <= 30),
h AS (SELECT k, i, j, arg_min(odd, d) AS odd FROM (SELECT *, sqrt(off * off + pow(greatest(0, -far_along, far_along - len), 2)) AS d FROM n WHERE far_along BETWEEN -2 AND len + 2) WHERE d <= 20 GROUP BY ALL),
c AS (SELECT k, count(odd) AS hit, count(*) AS n, count_if(odd = 1) AS odd FROM p LEFT JOIN h USING (k, i, j) GROUP BY 1)
SELECT k, round(hit / n, 4) AS share, CASE WHEN hit > 0 THEN CASE WHEN 2 * odd > hit THEN 'odd' ELSE 'even' END END AS kind FROM c""")
def q_running_with(spark, sf_dir):
    """How much of each customer's way runs with a supplier's, and with which kind of them."""
    others = _ways(t(spark, sf_dir, "supplier"), "s_suppkey", 2).select(F.when(F.col("k") % 2 == 1, "odd").otherwise("even").alias("kind"), _moved(F.lit(3 / geo.LAT_M)).alias("line"))
    out = lines.running(_ways(t(spark, sf_dir, "customer"), "c_custkey", 4), "k", "line", others, "kind", "line")
    return out.select("k", F.round("share", 4).alias("share"), "kind")


@query("""WITH r AS (SELECT l_orderkey AS k, l_quantity + l_partkey * 0.0137 AS w, p_size, CASE WHEN p_size % 4 <> 0 THEN p_brand END AS surface, CASE WHEN p_size % 3 <> 0 THEN p_size / 10.0 END AS width FROM lineitem JOIN part ON l_partkey = p_partkey),
s AS (SELECT k, arg_min(surface, row(-w, surface)) AS surface FROM (SELECT k, surface, sum(w) AS w FROM r WHERE surface IS NOT NULL GROUP BY ALL) GROUP BY 1),
b AS (SELECT l_orderkey AS k, count(*) AS n, min(CASE WHEN l_linenumber > 1 THEN l_linenumber / 2.0 END) AS gap FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT k, s.surface AS surface, round(sum(width * w) / sum(CASE WHEN width IS NOT NULL THEN w END), 2) AS width_m, round(least(min(width), min(gap)), 2) AS min_width_m, coalesce(min(n), 0) AS barriers FROM r LEFT JOIN s USING (k) LEFT JOIN b USING (k) GROUP BY k, s.surface""")
def q_way_attributes(spark, sf_dir):
    """Orders as ways that parts lie under: the surface of most of it, widths, barriers."""
    parts, items = t(spark, sf_dir, "part"), t(spark, sf_dir, "lineitem")
    tag = lambda **said: F.map_filter(F.create_map(*[x for k, v in said.items() for x in (F.lit(k), v)]), lambda a, b: b.isNotNull())
    size = F.col("p_size")
    tags = parts.select(F.col("p_partkey").alias("l_partkey"), tag(surface=F.when(size % 4 != 0, F.col("p_brand")), width=F.when(size % 3 != 0, F.format_string("%.1f m", size / 10.0))).alias("tags"))
    chosen = items.select("l_orderkey", "l_partkey", (F.col("l_quantity") + F.col("l_partkey") * 0.0137).alias("weight"))
    stops = items.filter("l_returnflag = 'R'").select("l_orderkey", F.lit("gate").alias("kind"), tag(maxwidth=F.when(F.col("l_linenumber") > 1, F.format_string("%.1f", F.col("l_linenumber") / 2.0))).alias("tags"))
    out = physical.attributes(chosen, "l_orderkey", "l_partkey", tags, stops)
    return out.select(F.col("l_orderkey").alias("k"), "surface", "width_m", "min_width_m", F.size("barriers").cast("bigint").alias("barriers"))


@query("""WITH r AS (SELECT c_nationkey AS area, c_custkey AS uid, c_custkey % 11 = 0 AS late FROM customer WHERE c_custkey % 5 <> 0), d AS (SELECT c_nationkey AS area, c_custkey AS uid FROM customer WHERE c_custkey % 7 <> 0)
SELECT area, CASE WHEN r.late IS NULL THEN 'drawn only' ELSE 'held only' END AS problem, count(*) AS n, min(uid) AS first FROM r FULL JOIN (SELECT *, TRUE AS drawn FROM d) USING (area, uid) WHERE r.late IS NULL OR (drawn IS NULL AND NOT r.late) GROUP BY 1, 2""")
def q_tiles_agree(spark, sf_dir):
    """Ids that tiles and records of an area do not share."""
    rows = t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("area"), F.col("c_custkey").alias("uid"))
    return gates.disagreeing(rows.filter("uid % 5 <> 0"), rows.filter("uid % 7 <> 0"), "area", "uid", F.col("uid") % 11 == 0)


@query("""SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'removed but not there' ELSE 'carried and removed' END AS problem, o_orderkey FROM orders WHERE o_orderkey % 11 = 0 AND (o_orderkey % 13 = 0 OR o_orderkey % 7 = 0)
UNION ALL SELECT 'carried and removed', o_orderkey FROM orders WHERE o_orderkey % 11 = 0 AND o_orderkey % 13 = 0 AND o_orderkey % 7 = 0
UNION ALL SELECT 'carried twice', o_orderkey FROM orders WHERE o_orderkey % 7 = 0 AND o_custkey % 4 = 0
UNION ALL SELECT 'carried without a box', o_orderkey FROM orders WHERE o_orderkey % 7 = 0 AND o_custkey % 5 = 0
UNION ALL SELECT 'box of nothing', o_orderkey FROM orders WHERE o_orderkey % 7 = 1 AND o_custkey % 5 <> 0""")
def q_changeset_problems(spark, sf_dir):
    """What is wrong with a changeset: keys on both sides, unknown, repeated, or at odds with its boxes."""
    rows = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    carried = rows.filter("o_orderkey % 7 = 0")
    return gates.changeset_problems(rows.filter("o_orderkey % 13 <> 0"), carried.unionByName(carried.filter("o_custkey % 4 = 0")), rows.filter("o_orderkey % 11 = 0"), rows.filter("o_orderkey % 7 <= 1 AND o_custkey % 5 <> 0"), "o_orderkey")


@query("SELECT event_id, arg_max(event_type, n) AS event_type FROM (SELECT event_id % 50 AS event_id, event_type, row_number() OVER (PARTITION BY event_id % 50 ORDER BY CAST(ts AS DATE), event_id % 2, event_type) AS n FROM (SELECT event_id, ts, CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS event_type FROM events)) x GROUP BY 1")
def q_later_copy(spark, sf_dir):
    """Of two copies of a table, the later row of each key."""
    rows = t(spark, sf_dir, "events").select((F.col("event_id") % 50).alias("event_id"), F.col("ts").cast("date").alias("day"), F.when(F.col("event_id") % 2 == 0, "even").otherwise("odd").alias("event_type"))
    return gates.later(rows.filter("event_type = 'even'"), rows.filter("event_type = 'odd'"), key="event_id", at="day").select("event_id", "event_type")


@query(f"""WITH w AS ({_WAY('customer', 'c_custkey', 4)}), u AS (SELECT k, i, CAST(round(lon * 1e7) AS BIGINT) AS x, CAST(round(lat * 1e7) AS BIGINT) AS y FROM w),
d AS (SELECT k, x - coalesce(lag(x) OVER o, 0) AS x, y - coalesce(lag(y) OVER o, 0) AS y FROM u WINDOW o AS (PARTITION BY k ORDER BY i)),
n AS (SELECT k, unnest([CASE WHEN x < 0 THEN -2 * x - 1 ELSE 2 * x END, CASE WHEN y < 0 THEN -2 * y - 1 ELSE 2 * y END]) AS z FROM d)
SELECT k, CAST(2 + sum(CASE WHEN z < 128 THEN 1 WHEN z < 16384 THEN 2 WHEN z < 2097152 THEN 3 WHEN z < 268435456 THEN 4 ELSE 5 END) AS INTEGER) AS bytes, TRUE AS exact FROM n GROUP BY 1""")
def q_packed_lines(spark, sf_dir):
    """Bytes of each way as packed, and whether unpacking gives it back."""
    packed = _ways(t(spark, sf_dir, "customer"), "c_custkey", 4).withColumn("body", geo.pack_lines(F.array("line"))).withColumn("back", F.get(geo.unpack_lines("body"), 0))
    near = F.forall(F.arrays_zip(F.col("line").alias("a"), F.col("back").alias("b")), lambda z: (F.abs(z["a"]["x"] - z["b"]["x"]) < 6e-8) & (F.abs(z["a"]["y"] - z["b"]["y"]) < 6e-8))
    return packed.select("k", F.length("body").alias("bytes"), near.alias("exact"))


@query("""SELECT c_custkey, 'Closed for works ' || CAST(c_custkey AS VARCHAR) AS clean FROM customer""")
def q_scrub_pii(spark, sf_dir):
    """Summaries with a contact in them, without it."""
    k = F.col("c_custkey")
    contact = F.when(k % 4 == 0, " 01632 960123").when(k % 4 == 1, F.concat(F.lit(" works"), k.cast("string"), F.lit("@council.example.org"))).when(k % 4 == 2, " - the highways contact").otherwise(" +44 1632 960 123 for further information, ")
    return t(spark, sf_dir, "customer").select("c_custkey", text.without_contacts(F.concat(F.lit("Closed for  works "), k.cast("string"), contact)).alias("clean"))


@query("""SELECT l_orderkey, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1""")
def q_json_explode(spark, sf_dir):
    """Items of each order, from JSON: an array of objects, or a bare object where there is one."""
    items = t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_quantity")).alias("i"))
    written = F.when(F.size("i") == 1, F.to_json(F.get("i", 0))).otherwise(F.to_json("i"))
    each = items.select("l_orderkey", F.explode(orders.items(written)).alias("item"))
    return each.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.round(F.sum(orders.at(F.col("item"), "l_quantity").cast("double")), 2).alias("quantity"))


_DECODED = "replace(replace(replace(replace({}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&')"


@query(r"""WITH a AS (SELECT page_id, regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<noscript\b.*?</noscript\s*>|<head\b.*?</head\s*>|<!--.*?-->', ' ', 'g') AS x FROM pages),
b AS (SELECT page_id, regexp_replace(regexp_replace(x, '(?i)<br\s*/?>|</(p|div|li|tr|h[1-6]|ul|ol|table|section|article)\s*>', chr(10), 'g'), '<[^>]*>', ' ', 'g') AS x FROM a),
c AS (SELECT page_id, translate(DECODED, chr(160), ' ') AS x FROM b)
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(x, '[ \t\r\f]+', ' ', 'g'), ' *\n\s*', chr(10), 'g'), '^\s+|\s+$', '', 'g') AS body FROM c""".replace("DECODED", _DECODED.format(_DECODED.format(_DECODED.format("x")))))
def q_html_text(spark, sf_dir):
    """Readable lines of each page."""
    return t(spark, sf_dir, "pages").select("page_id", text.page_text(F.col("html")).alias("body"))


@query("""SELECT o_orderkey AS node, min(o_orderkey) OVER (PARTITION BY o_custkey % 97, o_orderkey // 4096) AS component FROM orders QUALIFY count(*) OVER (PARTITION BY o_custkey % 97, o_orderkey // 4096) > 1""")
def q_components(spark, sf_dir):
    """Orders linked to the next of their group: the groups are found again."""
    group = W.partitionBy(F.col("o_custkey") % 97, F.floor(F.col("o_orderkey") / 4096)).orderBy("o_orderkey")
    edges = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("a"), F.lead("o_orderkey").over(group).alias("b"))
    return dedupe.components(edges)


@query("""SELECT c_custkey * 4 + 1 AS k, [c_custkey * 4] AS kept FROM customer WHERE c_custkey % 3 <> 2 UNION ALL SELECT c_custkey * 4 + 2, [c_custkey * 4] FROM customer WHERE c_custkey % 3 <> 1 UNION ALL SELECT c_custkey * 4 + 3, [c_custkey * 4] FROM customer WHERE c_custkey % 3 = 2
UNION ALL SELECT c_custkey * 4 + 1, [c_custkey * 4] FROM customer WHERE c_custkey % 3 = 2""".replace(", [c_custkey * 4] AS kept", ", CAST(c_custkey * 4 AS VARCHAR) AS kept").replace("[c_custkey * 4]", "CAST(c_custkey * 4 AS VARCHAR)"))
def q_dedupe_twins(spark, sf_dir):
    """Ways that stand twice: a double of one authority, another's copy, another's pieces; what each went for."""
    ways = _apart(t(spark, sf_dir, "customer"), "c_custkey", 4)
    near = _moved(F.lit(0.00005))
    one = lambda n, code, rows: rows.select((F.col("k") * 4 + n).alias("k"), F.lit(code).alias("code"), "line")
    copies = one(1, "A", ways.filter("k % 3 <> 2")).unionByName(one(2, "B", ways.filter("k % 3 = 0").withColumn("line", near)))
    pieces = ways.filter("k % 3 = 2").withColumn("line", near)
    cut = lambda first, size: pieces.withColumn("line", F.slice("line", first, size))
    both = one(0, "A", ways).unionByName(copies).unionByName(one(1, "B", cut(1, 2))).unionByName(one(2, "B", cut(2, 2))).unionByName(one(3, "B", cut(3, 3)))
    gone = dedupe.merged(both.withColumn("kind", F.lit("boat")), "k", "line", "kind", "code")[1]
    return gone.select("k", F.array_join(F.col("kept").cast("array<string>"), ",").alias("kept"))


@query("""SELECT s_suppkey AS k, c_custkey AS street, TRUE AS long FROM supplier JOIN customer ON c_custkey = s_suppkey""")
def q_streets_along(spark, sf_dir):
    """Streets that suppliers' ways run along."""
    streets = _apart(t(spark, sf_dir, "customer"), "c_custkey", 4).select(F.col("k").alias("street"), _moved(F.lit(0.00004)).alias("line"))
    found = closures.streets_along(_apart(t(spark, sf_dir, "supplier"), "s_suppkey", 2), "k", "line", streets, "street", "line")
    return found.select("k", "street", (F.col("share") > 0.8).alias("long"))


@query("""WITH o AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n, min(o_orderkey) AS id FROM orders GROUP BY ALL) SELECT id, n AS parts FROM o""")
def q_pieces_joined(spark, sf_dir):
    """Orders of one customer and day as pieces of one."""
    items = t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey", F.col("o_orderdate").cast("date").alias("day"), F.array("o_totalprice").alias("parts"))
    return closures.pieces_joined(items, "id", ["o_custkey", "day"], "parts").select("id", F.size("parts").cast("bigint").alias("parts"))


@query("""WITH b AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey % 7 <> 0) SELECT o_orderkey, CASE WHEN o_custkey % 4 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM b WHERE o_custkey % 4 <> 0 OR o_orderkey % 2 = 0""")
def q_merge_replace(spark, sf_dir):
    """Changed customers' orders replace all they had; deleted customers go."""
    base = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("price"))
    changed = base.filter("o_custkey % 4 = 0 AND o_orderkey % 2 = 0").withColumn("price", F.col("price") + 1)
    # A customer whose every order went is not among the changed, so these count as deleted.
    emptied = base.filter("o_custkey % 4 = 0").select("o_custkey").distinct().join(changed.select("o_custkey"), "o_custkey", "left_anti")
    deleted = base.filter("o_custkey % 7 = 0").select("o_custkey").distinct().unionByName(emptied)
    return cdc.merge_replace(base, changed, deleted, "o_custkey").select("o_orderkey", "price")


_BOXES = [("west", -5.0, 49.0, -1.0, 56.0), ("mid", -2.0, 50.5, 1.0, 53.25), ("east", 0.0, 52.0, 2.5, 52.0)]


@query(f"""WITH p AS ({_WAY('customer', 'c_custkey', 4)}), b(box, w, s, e, n) AS (VALUES {', '.join(f"('{n}', {a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE, {d}::DOUBLE)" for n, a, b, c, d in _BOXES)})
SELECT k, box FROM p JOIN b ON lon BETWEEN w AND e AND lat BETWEEN s AND b.n GROUP BY 1, 2""")
def q_region_multimatch(spark, sf_dir):
    """Regions that each way has a point in; a way may lie in several."""
    ways = _ways(t(spark, sf_dir, "customer"), "c_custkey", 4)
    named = F.filter(F.array(*[F.when(registers.in_region(F.col("line"), box), F.lit(name)) for name, *box in _BOXES]), lambda b: b.isNotNull())
    return ways.select("k", F.explode(named).alias("box"))


@query(f"""WITH a AS ({_WAY('customer', 'c_custkey', 4)}), b AS ({_WAY('supplier', 's_suppkey', 12)}), box AS (SELECT 'a' AS side, k, min(lon) AS w, max(lon) AS e, min(lat) AS s, max(lat) AS n FROM a GROUP BY k UNION ALL SELECT 'b', k, min(lon), max(lon), min(lat), max(lat) FROM b GROUP BY k)
SELECT x.k AS a, y.k AS b FROM box x JOIN box y ON x.side = 'a' AND y.side = 'b' AND x.w <= y.e AND y.w <= x.e AND x.s <= y.n AND y.s <= x.n""")
def q_bbox_overlap(spark, sf_dir):
    """Customers' and suppliers' ways whose boxes meet."""
    a, b = _ways(t(spark, sf_dir, "customer"), "c_custkey", 4), _ways(t(spark, sf_dir, "supplier"), "s_suppkey", 12)
    return registers.boxes_meeting(a, "k", "line", b.withColumnRenamed("k", "other"), "other", "line", 0.05).select(F.col("k").alias("a"), F.col("other").alias("b"))


@query(f"SELECT min(lon) AS west, min(lat) AS south, max(lon) AS east, max(lat) AS north, k % 25 AS area FROM ({_WAY('customer', 'c_custkey', 4)}) GROUP BY k % 25")
def q_bounds(spark, sf_dir):
    """The box around each area's ways."""
    return registers.bounds(_ways(t(spark, sf_dir, "customer"), "c_custkey", 4).withColumn("area", F.col("k") % 25), "area", "line")


@query("SELECT TRUE AS same_in_any_order, TRUE AS other_if_changed, TRUE AS other_if_repeated")
def q_digest_equal(spark, sf_dir):
    """A digest of content knows no order, but every value and every row."""
    rows = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    changed = rows.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 5003 == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    say = lambda df, name: cdc.content_digest(df).select(F.col("digest").alias(name))
    four = say(rows, "a").join(F.broadcast(say(rows.repartition(7, "o_custkey"), "b"))).join(F.broadcast(say(changed, "c"))).join(F.broadcast(say(rows.unionByName(rows.filter("o_custkey % 10 = 1")), "d")))
    return four.select((F.col("a") == F.col("b")).alias("same_in_any_order"), (F.col("a") != F.col("c")).alias("other_if_changed"), (F.col("a") != F.col("d")).alias("other_if_repeated"))


@query("SELECT l_orderkey, count(*) AS n FROM (SELECT l_orderkey FROM lineitem) l WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderkey % 10 <> 3) GROUP BY 1")
def q_ref_integrity(spark, sf_dir):
    """Lines whose order is not there."""
    return gates.unknown_keys(t(spark, sf_dir, "lineitem").select("l_orderkey"), "l_orderkey", t(spark, sf_dir, "orders").filter("o_orderkey % 10 <> 3").select("o_orderkey"), "o_orderkey")


@query("""SELECT k, min(src) AS src, arg_min(name, src) AS name FROM (SELECT c_custkey AS k, 2 AS src, c_name AS name FROM customer UNION ALL SELECT s_suppkey, 1, s_name FROM supplier UNION ALL SELECT n_nationkey, 3, n_name FROM nation) x GROUP BY 1""")
def q_union_dedupe(spark, sf_dir):
    """Registers in order of trust, of each key the first."""
    one = lambda table, key, name, src: t(spark, sf_dir, table).select(F.col(key).cast("long").alias("k"), F.lit(src).alias("src"), F.col(name).alias("name"))
    rows = one("customer", "c_custkey", "c_name", 2).unionByName(one("supplier", "s_suppkey", "s_name", 1)).unionByName(one("nation", "n_nationkey", "n_name", 3))
    return cdc.latest_by_key(rows, "k", F.asc("src"), F.asc("name"))


@query("SELECT p_partkey, p_name || ' & <' || p_brand || '> é ' || p_container AS clean FROM part".replace("|| p_container", "|| coalesce(p_type, '')"))
def q_text_clean(spark, sf_dir):
    """Texts with character references, some written twice over, and odd spaces made plain."""
    dirty = F.concat(F.col("p_name"), F.lit("\u00a0&amp;amp;\u202f&lt;"), F.col("p_brand"), F.lit("&gt; &#233;\u2007"), F.coalesce("p_type", F.lit("")))
    return t(spark, sf_dir, "part").select("p_partkey", text.clean_text(dirty).alias("clean"))


@query("SELECT c_custkey AS k, round(40 * (1 + c_custkey % 4) * 0.001 / 360 * 65536, 1) AS climb_m, CAST(0 AS DOUBLE) AS descent_m FROM customer")
def q_way_heights(spark, sf_dir):
    """What each way climbs on a slope that rises evenly eastwards, from tiles of heights."""
    ways = _apart(t(spark, sf_dir, "customer"), "c_custkey", 4).select("k", F.slice("line", F.lit(1), (F.col("k") % 4 + 2).cast("int")).alias("line"))
    met = ways.select(F.explode(geo.tiles_touched(F.col("line"), 8)).alias("t")).distinct()
    around = met.select(F.explode(F.array(*[F.struct((F.col("t.x") + i).alias("x"), (F.col("t.y") + j).alias("y")) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("t")).distinct().select("t.*")
    last = F.when(F.col("x").isNotNull(), heights.SIDE**2 - 1)  # no constant, else the plan would hold 65,536 numbers
    slope = F.transform(F.sequence(F.lit(0), last), lambda i: (F.col("x") * heights.SIDE + i % heights.SIDE) * 40.0)
    out = heights.measured(ways.select("k", F.array("line").alias("parts")), "k", "parts", around.select("x", "y", slope.alias("heights")), 8)
    return out.select("k", "climb_m", "descent_m")
