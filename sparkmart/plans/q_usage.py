"""MET queries. A customer is an installation; its cumulative order count is an all-time counter."""

from pyspark.sql import functions as F

from sparkmart.functions import money, ratio
from sparkmart.operators import calendar as CAL, metrics as M, scd as S, topk, usage as U, windows as wn
from sparkmart.plans.registry import by_day, by_minute, dsum, query

# Monthly counter per customer; months without an order have no ping (NULL).
PING_SQL = """
WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS n FROM orders GROUP BY 1, 2), c AS (SELECT *, CAST(SUM(n) OVER (PARTITION BY o_custkey ORDER BY month ROWS UNBOUNDED PRECEDING) AS BIGINT) AS counter FROM m),
 g AS (SELECT o_custkey, CAST(unnest(generate_series(MIN(month), MAX(month) + INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS DATE) AS month FROM m GROUP BY 1),
 p AS (SELECT g.o_custkey, g.month, counter, CASE WHEN counter IS NOT NULL THEN g.month END AS pm FROM g LEFT JOIN c USING (o_custkey, month)),
 d AS (SELECT *, counter - last_value(counter IGNORE NULLS) OVER w AS diff, date_diff('day', last_value(pm IGNORE NULLS) OVER w, month) AS days FROM p WINDOW w AS (PARTITION BY o_custkey ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 s AS (SELECT *, first_value(diff::DOUBLE / nullif(days, 0) IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS daily, MIN(pm) OVER (PARTITION BY o_custkey) AS lo, MAX(pm) OVER (PARTITION BY o_custkey) AS hi FROM d)"""


def pings(t):
    m = t.orders.groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    c = wn.running(m, "counter", "o_custkey", "month", "n").drop("n")
    return CAL.month_range(m, "o_custkey", "month").join(c, ["o_custkey", "month"], "left")


def diffs(t):
    df = U.ping_diff(pings(t), "counter", ["o_custkey"], "month")
    df = wn.last_known(df, "prev_ping", ["o_custkey"], "month", F.when(F.col("counter").isNotNull(), F.col("month")), include_current=False)
    return df.withColumn("days", F.datediff("month", "prev_ping"))


def smooth(t):
    return U.ping_smooth(diffs(t), "counter", ["o_custkey"], "month", "days", F.dayofmonth(F.last_day("month")))


@query("met_1_ping_difference", PING_SQL + " SELECT o_custkey, CAST(month AS VARCHAR) AS month, counter, diff AS counter_since_last_ping FROM d")
def _(t):
    return U.ping_diff(pings(t), "counter", ["o_custkey"], "month")


@query("met_2_ping_range", PING_SQL + " SELECT o_custkey, CAST(month AS VARCHAR) AS month, CAST(lo AS VARCHAR) AS counter_first_ping_month, CAST(hi AS VARCHAR) AS counter_last_ping_month FROM s")
def _(t):
    return U.ping_range(pings(t), "counter", ["o_custkey"], "month").drop("counter")


@query("met_3_ping_smoothed", PING_SQL + " SELECT o_custkey, CAST(month AS VARCHAR) AS month, round(daily, 6) AS daily, CAST(round(daily * day(last_day(month))) AS BIGINT) AS smoothed FROM s")
def _(t):
    return smooth(t).select("o_custkey", "month", F.round("counter_estimated_daily", 6).alias("daily"), F.col("counter_smoothed").alias("smoothed"))


@query("met_4_ping_estimated", PING_SQL + " SELECT o_custkey, CAST(month AS VARCHAR) AS month, CASE WHEN month <= lo OR month > hi THEN NULL ELSE CAST(round(daily * day(last_day(month))) AS BIGINT) END AS estimated FROM s")
def _(t):
    df = U.ping_estimate(U.ping_range(smooth(t), "counter", ["o_custkey"], "month"), "counter", "month")
    return df.select("o_custkey", "month", F.col("counter_estimated_monthly").alias("estimated"))


ORDER_PING_SQL = "SELECT o_orderkey, o_custkey, o_orderdate, 'orders.' || o_orderstatus AS metric, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate, o_orderkey) * 10 AS value FROM orders"


def order_pings(t):
    df = wn.row_number(t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"), "value", ["o_custkey", "o_orderstatus"], ["o_orderdate", "o_orderkey"], chunk=by_day("o_orderdate"))
    return df.select("o_orderkey", "o_custkey", "o_orderdate", F.concat(F.lit("orders."), "o_orderstatus").alias("metric"), (F.col("value") * 10).alias("value"))


@query("met_5_monthly_from_cumulative", f"""
SELECT o_orderkey, metric, date_diff('day', pd, o_orderdate) AS days_since_last_ping, value - coalesce(pv, 0) AS monthly_value, round((value - coalesce(pv, 0)) * 28.0::DOUBLE / coalesce(date_diff('day', pd, o_orderdate), 1), 6) AS normalized_monthly_value
FROM (SELECT *, lag(o_orderdate) OVER w AS pd, lag(value) OVER w AS pv FROM (SELECT * FROM ({ORDER_PING_SQL}) QUALIFY row_number() OVER (PARTITION BY o_custkey, metric, date_trunc('month', o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) WINDOW w AS (PARTITION BY o_custkey, metric ORDER BY o_orderdate))""")
def _(t):
    df = U.monthly_from_cumulative(order_pings(t), "o_custkey", "metric", "o_orderdate", "value", "o_orderkey")
    return df.select("o_orderkey", "metric", "days_since_last_ping", "monthly_value", F.round("normalized_monthly_value", 6).alias("normalized_monthly_value"))


@query("met_6_monthly_change", """
SELECT event_id, CASE WHEN v - lag(v) OVER w >= 0 THEN v - lag(v) OVER w ELSE v END AS v_change FROM (SELECT *, CAST(floor(value) AS BIGINT) AS v FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(t):
    df = t.events.select("event_id", "user_id", "ts", F.floor("value").alias("v"))
    return U.monthly_change(df, "v", "user_id", ["ts", "event_id"], chunk=by_minute()).select("event_id", "v_change")


@query("met_7_usage_estimate", """
WITH f AS (SELECT p_brand, p_type, CAST(SUM(p_size) AS BIGINT) AS recorded FROM part GROUP BY 1, 2), s AS (SELECT p_type, COUNT(*) FILTER (p_size > 20) AS r, COUNT(*) FILTER (p_size <= 20) AS n FROM part GROUP BY 1)
SELECT p_brand, p_type, recorded, round(CASE WHEN p_brand = 'Brand#1' THEN 1 ELSE r::DOUBLE / (r + n) END, 6) AS percent_reporting, CASE WHEN p_brand = 'Brand#1' THEN recorded ELSE round(recorded + recorded * (1 - r::DOUBLE / (r + n)) / (r::DOUBLE / (r + n))) END::DOUBLE AS total_with_estimate FROM f JOIN s USING (p_type)""")
def _(t):
    facts = t.part.groupBy("p_brand", "p_type").agg(F.sum("p_size").alias("recorded"))
    shares = t.part.groupBy("p_type").agg(F.count_if(F.col("p_size") > 20).alias("reporting_count"), F.count_if(F.col("p_size") <= 20).alias("not_reporting_count"))
    df = U.totals_with_estimates(facts, shares, "p_type", "recorded", F.col("p_brand") == "Brand#1")
    return df.select("p_brand", "p_type", "recorded", F.round("percent_reporting", 6).alias("percent_reporting"), "total_with_estimate")


@query("met_8_counter_adoption", """
WITH u AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_custkey, CAST(date_trunc('month', o_orderdate) - CAST(o_totalprice % 12 AS INTEGER) * INTERVAL 1 MONTH AS DATE) AS rel FROM (SELECT * REPLACE (floor(o_totalprice) AS o_totalprice) FROM orders)),
 c AS (SELECT DISTINCT p_brand || p_type AS metric, CAST(DATE '1995-03-01' + CAST(MIN(p_partkey) OVER (PARTITION BY p_brand, p_type) % 60 AS INTEGER) * INTERVAL 1 MONTH AS DATE) AS rel FROM part),
 last AS (SELECT month, o_custkey, rel FROM u QUALIFY row_number() OVER (PARTITION BY month, o_custkey ORDER BY rel DESC) = 1)
SELECT CAST(last.month AS VARCHAR) AS month, metric, round(COUNT(DISTINCT o_custkey) FILTER (last.rel >= c.rel)::DOUBLE / COUNT(DISTINCT o_custkey), 6) AS pct_with_counter FROM c JOIN last ON last.month >= c.rel GROUP BY 1, 2""")
def _(t):
    price = F.floor("o_totalprice").cast("int")
    usage = t.orders.select(F.trunc("o_orderdate", "month").alias("month"), "o_custkey", F.add_months(F.trunc("o_orderdate", "month"), -(price % 12)).alias("rel"))
    counters = t.part.groupBy("p_brand", "p_type").agg(F.min("p_partkey").alias("k")).select(
        F.concat("p_brand", "p_type").alias("metric"), F.add_months(F.lit("1995-03-01").cast("date"), (F.col("k") % 60).cast("int")).alias("rel"))
    df = U.adoption(usage, counters, "month", "o_custkey", "rel", "metric", "rel")
    return df.withColumn("pct_with_counter", F.round("pct_with_counter", 6))


@query("met_9_metric_dictionary", """
SELECT 'customers' AS metric, COUNT(*)::DOUBLE AS value, '2024-01-31' AS ping_date FROM customer UNION ALL SELECT 'rich_customers', COUNT(*) FILTER (c_acctbal > 5000), '2024-01-31' FROM customer
UNION ALL SELECT 'active_users', COUNT(DISTINCT user_id), '2024-01-31' FROM events UNION ALL SELECT 'max_value', MAX(value), '2024-01-31' FROM events UNION ALL SELECT 'purchase_value', CAST(SUM(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'purchase') AS DOUBLE), '2024-01-31' FROM events""")
def _(t):
    bought = F.col("event_type") == "purchase"
    specs = {"customers": M.count("customer"), "rich_customers": M.count("customer", where=F.col("c_acctbal") > 5000),
             "active_users": M.distinct("events", "user_id"), "max_value": M.total("events", "value", how="max"), "purchase_value": M.total("events", money("value"), bought)}
    return M.run_metrics({"customer": t.customer, "events": t.events}, specs, "2024-01-31")


def _counted(name: str, select: str) -> str:
    return f"SELECT '{name}' AS metric, CAST(({select}) AS DOUBLE) AS value, '2024-01-31' AS ping_date"


FORMS = {
    "orders": "SELECT COUNT(o_orderkey) FROM orders",
    "open_orders": "SELECT COUNT(o_orderkey) FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 1000",
    "building_buyers": "SELECT COUNT(DISTINCT o_custkey) FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING' AND o_orderstatus IN ('O', 'F')",
    "buyers": "SELECT COUNT(DISTINCT o_custkey) FROM orders",
    "statuses": "SELECT COUNT(DISTINCT o_orderstatus) FROM orders WHERE o_totalprice > 50000",
    "regular_buyers": "SELECT COUNT(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING COUNT(*) > 12)",
    "regular_open_buyers": "SELECT COUNT(*) FROM (SELECT o_custkey FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal > 0 AND o_orderstatus = 'O' GROUP BY 1 HAVING COUNT(*) BETWEEN 3 AND 8)",
    "mean_price": "SELECT round(avg(CAST(o_totalprice AS DECIMAL(18,2))), 4) FROM orders WHERE o_orderstatus <> 'P'",
    "no_price": "SELECT MIN(o_totalprice) FROM orders WHERE o_orderstatus = '?'",
    "discounted_lines": "SELECT COUNT(l_orderkey) FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_discount > 0.05 AND o_orderstatus = 'F'",
    "shipped_orders": "SELECT COUNT(DISTINCT l_orderkey) FROM lineitem WHERE l_returnflag = 'R'",
    "dear_line_parts": "SELECT COUNT(DISTINCT p_partkey) FROM part JOIN lineitem ON l_partkey = p_partkey WHERE l_extendedprice > 30000 AND p_size > 10",
}


@query("met_9_metric_forms", " UNION ALL ".join(_counted(n, q) for n, q in FORMS.items()) + " UNION ALL "
       + _counted("either_line", f"SELECT ({FORMS['discounted_lines']}) + ({FORMS['shipped_orders']})") + " UNION ALL " + _counted("orders_per_buyer", f"SELECT round(({FORMS['orders']}) / ({FORMS['buyers']}), 6)"))
def _(t):
    tables = {"orders": t.orders, "customer": t.customer, "lineitem": t.lineitem, "part": t.part}
    by_customer, by_order = M.Join("customer", (("o_custkey", "c_custkey"),), unique=True), M.Join("orders", (("l_orderkey", "o_orderkey"),), unique=True)
    lines = M.Join("lineitem", (("p_partkey", "l_partkey"),))
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    specs = {
        "orders": M.count("orders", "o_orderkey"),
        "open_orders": M.count("orders", "o_orderkey", (status == "O") & (price > 1000)),
        "building_buyers": M.distinct("orders", "o_custkey", (F.col("customer_c_mktsegment") == "BUILDING") & status.isin("O", "F"), [by_customer]),
        "buyers": M.distinct("orders", "o_custkey"),
        "statuses": M.distinct("orders", "o_orderstatus", price > 50000),
        "regular_buyers": M.groups("orders", "o_custkey", lambda n: n > 12),
        "regular_open_buyers": M.groups("orders", "o_custkey", lambda n: n.between(3, 8), (F.col("customer_c_acctbal") > 0) & (status == "O"), [by_customer]),
        "mean_price": M.total("orders", money("o_totalprice"), status != "P", how="avg"),
        "no_price": M.total("orders", "o_totalprice", status == "?", how="min"),
        "discounted_lines": M.count("lineitem", "l_orderkey", (F.col("l_discount") > 0.05) & (F.col("orders_o_orderstatus") == "F"), [by_order]),
        "shipped_orders": M.distinct("lineitem", "l_orderkey", F.col("l_returnflag") == "R"),
        "dear_line_parts": M.distinct("part", "p_partkey", (F.col("l_extendedprice") > 30000) & (F.col("p_size") > 10), [lines]),
        "either_line": M.combined(lambda a, b: a + b, "discounted_lines", "shipped_orders"),
        "orders_per_buyer": M.combined(lambda a, b: F.round(a / b, 6), "orders", "buyers"),
    }
    out = M.run_metrics(tables, specs, "2024-01-31")
    return out.withColumn("value", F.when(F.col("metric") == "mean_price", F.round("value", 4)).otherwise(F.col("value")))


@query("met_10_metric_versions", """
SELECT event_type, MIN(v) AS first_version_id, 'v' || MIN(v) AS first_version, MAX(v) AS last_version_id, 'v' || MAX(v) AS last_version, COUNT(DISTINCT user_id) AS instances FROM (SELECT *, CAST(floor(value) AS BIGINT) AS v FROM events) GROUP BY 1""")
def _(t):
    df = t.events.select("event_type", "user_id", F.floor("value").alias("v")).withColumn("version", F.concat(F.lit("v"), F.col("v").cast("string")))
    return U.metric_versions(df, ["event_type"], "v", "version", "user_id")


@query("met_11_xmau", """
WITH e AS (SELECT *, user_id // 10 AS ns, CAST(date_trunc('month', ts) AS DATE) AS month FROM events WHERE CAST(ts AS DATE) >= last_day(ts) - 27), p AS (SELECT ns, month, value > 40 AS paid FROM e QUALIFY row_number() OVER (PARTITION BY ns, month ORDER BY ts DESC, event_id DESC) = 1),
 r AS (SELECT month, user_id, paid, 'all' AS level, 'all' AS name FROM e JOIN p USING (ns, month) UNION ALL SELECT month, user_id, paid, 'stage', event_type FROM e JOIN p USING (ns, month) UNION ALL SELECT month, user_id, paid, 'group', CASE WHEN event_type <> 'error' THEN left(event_type, 1) END FROM e JOIN p USING (ns, month))
SELECT CAST(month AS VARCHAR) AS month, level, name, 'total' AS plan, COUNT(DISTINCT user_id) AS active_users FROM r WHERE name IS NOT NULL GROUP BY 1, 2, 3 UNION ALL SELECT CAST(month AS VARCHAR), level, name, CASE WHEN paid THEN 'paid' ELSE 'free' END, COUNT(DISTINCT user_id) FROM r WHERE name IS NOT NULL GROUP BY 1, 2, 3, 4""")
def _(t):
    ev = t.events.withColumn("ns", F.floor(F.col("user_id") / 10)).withColumn("paid", F.col("value") > 40)
    levels = {"all": F.lit("all"), "stage": "event_type", "group": F.when(F.col("event_type") != "error", F.substring("event_type", 1, 1))}
    return U.xmau(ev, "ts", "user_id", "ns", levels, "paid", "event_id")


STAGES = ["click", "error", "purchase", "signup", "view"]


@query("met_12_stages_per_org", """
SELECT org, CAST(month AS VARCHAR) AS month, COUNT(*) FILTER (u > 0) AS active_stage_count, """ + ", ".join(f"MAX(u) FILTER (event_type = '{s}') AS {s}_stage" for s in STAGES) + """
FROM (SELECT user_id // 10 AS org, CAST(date_trunc('month', ts) AS DATE) AS month, event_type, COUNT(DISTINCT user_id) AS u FROM events GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def _(t):
    df = t.events.select(F.floor(F.col("user_id") / 10).alias("org"), F.trunc("ts", "month").alias("month"), "event_type", "user_id")
    return U.stages_per_org(df, "org", "month", "event_type", "user_id", STAGES)


@query("met_13_last_ping", "SELECT o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def _(t):
    return U.last_ping(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), "o_custkey", "o_orderdate", "o_orderkey").select("o_orderkey")


@query("met_14_stage_sum", """
SELECT c_nationkey, CAST(coalesce(SUM(1) FILTER (f > 0 OR o > 0), 0) AS BIGINT) AS build_sum, CAST(coalesce(SUM(1) FILTER (p > 0), 0) AS BIGINT) AS plan_sum FROM customer LEFT JOIN (SELECT o_custkey, COUNT(*) FILTER (o_orderstatus = 'F') - 3 AS f, COUNT(*) FILTER (o_orderstatus = 'O') - 4 AS o, COUNT(*) FILTER (o_orderstatus = 'P') - 2 AS p FROM orders GROUP BY 1) ON o_custkey = c_custkey GROUP BY 1""")
def _(t):
    s = F.col("o_orderstatus")
    change = t.orders.groupBy("o_custkey").agg((F.count_if(s == "F") - 3).alias("f"), (F.count_if(s == "O") - 4).alias("o"), (F.count_if(s == "P") - 2).alias("p"))
    df = t.customer.join(change, F.col("o_custkey") == F.col("c_custkey"), "left").withColumn("users", F.lit(1))
    return U.stage_sum(df, ["c_nationkey"], {"build": ["f", "o"], "plan": ["p"]}, "users")


@query("met_15_iqr_fence", """
WITH q AS (SELECT event_type, quantile_cont(value, 0.75) + 0.5 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS b FROM events GROUP BY 1)
SELECT event_type, round(MAX(b), 6) AS outer_boundary, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events JOIN q USING (event_type) WHERE value <= b GROUP BY 1""")
def _(t):
    df = U.iqr_fence(t.events.select("event_type", "value"), ["event_type"], "value", 1, k=0.5)
    return df.groupBy("event_type").agg(F.round(F.max("outer_boundary"), 6).alias("outer_boundary"), F.count(F.lit(1)).alias("n"), F.sum(money("value")).alias("total"))


@query("met_16_scorecard", """
WITH o AS (SELECT p_type, quantile_cont(p_retailprice, 0.1) AS x FROM part GROUP BY 1) SELECT p_type, """ + ", ".join(
    f"round(quantile_cont(p_retailprice, {q}), 6) AS {n}" for n, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p80", 0.8), ("p90", 0.9), ("pmax", 1.0))) + " FROM part JOIN o USING (p_type) WHERE p_retailprice > x GROUP BY 1")
def _(t):
    df = U.scorecard(t.part.select("p_type", "p_retailprice"), ["p_type"], "p_retailprice", 10)
    return df.select("p_type", *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75", "p80", "p90", "pmax")])


@query("met_17_stage_durations", """
SELECT event_id, lead(event_type) OVER w AS next_stage, date_diff('day', ts, coalesce(lead(ts) OVER w, TIMESTAMP '2024-02-01')) AS days_in_stage, date_diff('day', MIN(ts) OVER (PARTITION BY user_id), MAX(ts) OVER (PARTITION BY user_id)) AS days_in_pipeline, lead(ts) OVER w IS NULL AS is_current_stage
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(t):
    df = U.stage_durations(t.events.select("event_id", "user_id", "ts", "event_type"), ["user_id"], "event_type", "ts", "event_id", "2024-02-01", chunk=by_minute())
    return df.select("event_id", "next_stage", "days_in_stage", "days_in_pipeline", "is_current_stage")


@query("met_18_headcount", """
WITH p AS (SELECT c_nationkey AS k, c_custkey, CAST(MIN(o_orderdate) AS DATE) AS h, CASE WHEN MAX(o_orderdate) < TIMESTAMP '2001-01-01' THEN CAST(MAX(o_orderdate) AS DATE) END AS l FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2),
 g AS (SELECT k, m FROM (SELECT DISTINCT k FROM p) CROSS JOIN (SELECT CAST(unnest(generate_series(DATE '1995-06-01', DATE '2001-07-01', INTERVAL 1 MONTH)) AS DATE) AS m)),
 c AS (SELECT g.k, g.m, COUNT(*) FILTER (h < m) - COUNT(*) FILTER (l < m) AS hs, COUNT(*) FILTER (h < m + INTERVAL 1 MONTH) - COUNT(*) FILTER (l < m + INTERVAL 1 MONTH) AS he, COUNT(*) FILTER (h >= m AND h < m + INTERVAL 1 MONTH) AS hires, COUNT(*) FILTER (l >= m AND l < m + INTERVAL 1 MONTH) AS seps FROM g JOIN p ON p.k = g.k GROUP BY 1, 2)
SELECT k AS c_nationkey, CAST(m AS VARCHAR) AS month, hires, seps AS separations, hs AS headcount_start, he AS headcount_end, (hs + he) / 2 AS headcount_average, CAST(SUM(seps) OVER w AS BIGINT) AS rolling_12_separations, round(1 - SUM(seps) OVER w / nullif(AVG((hs + he) / 2) OVER w, 0), 6) AS retention FROM c WINDOW w AS (PARTITION BY k ORDER BY m DESC ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING)""")
def _(t):
    span = t.orders.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("h"), F.max("o_orderdate").alias("x"))
    people = t.customer.join(span, F.col("o_custkey") == F.col("c_custkey")).select("c_nationkey", "h", F.when(F.col("x") < F.lit("2001-01-01").cast("timestamp_ntz"), F.to_date("x")).alias("l"))
    df = U.headcount(people, ["c_nationkey"], "h", "l", F.lit("1995-06-01").cast("date"), F.lit("2001-07-01").cast("date"))
    return df.select("c_nationkey", "month", "hires", "separations", "headcount_start", "headcount_end", "headcount_average", "rolling_12_separations", F.round("retention", 6).alias("retention"))


@query("met_19_feature_table", """
SELECT o_custkey, CAST(SUM(x) FILTER (a BETWEEN 0 AND 179) AS DOUBLE) AS spend_p1, CAST(SUM(x) FILTER (a BETWEEN 180 AND 359) AS DOUBLE) AS spend_p2, COUNT(*) FILTER (a BETWEEN 0 AND 179) AS events_p1, CAST(coalesce(SUM(x) FILTER (a BETWEEN -180 AND -1), 0) AS DOUBLE) AS target_value
FROM (SELECT o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS x, date_diff('day', o_orderdate, DATE '1999-06-30') AS a FROM orders) WHERE a BETWEEN -180 AND 359 GROUP BY 1""")
def _(t):
    df = U.feature_table(t.orders, "o_custkey", "o_orderdate", "1999-06-30", 180, {"spend": money("o_totalprice")}, money("o_totalprice"))
    return df.select("o_custkey", F.nullif("spend_p1", F.lit(0)).alias("spend_p1"), F.nullif("spend_p2", F.lit(0)).alias("spend_p2"), "events_p1", "target_value")


@query("met_20_open_items", """
WITH i AS (SELECT o_orderkey, o_custkey, o_orderdate AS c, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + 40 * INTERVAL 1 DAY END AS e FROM orders), h AS (SELECT o_custkey, o_orderpriority AS label, o_orderdate AS f FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1),
 d AS (SELECT *, CAST(unnest(generate_series(greatest(CAST(c AS DATE), DATE '2001-05-01'), least(coalesce(CAST(e AS DATE), DATE '2001-06-15'), DATE '2001-06-15'), INTERVAL 1 DAY)) AS DATE) AS day FROM i)
SELECT CAST(day AS VARCHAR) AS day, label, COUNT(*) AS open_items, CAST(SUM(age) AS BIGINT) AS total_age FROM (SELECT d.*, date_diff('day', c, day) AS age, label FROM d ASOF LEFT JOIN h ON d.o_custkey = h.o_custkey AND CAST(d.day + 1 AS TIMESTAMP) - INTERVAL 1 MICROSECOND >= h.f) GROUP BY 1, 2""")
def _(t):
    items = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("c"), F.when(F.col("o_orderstatus") != "O", F.date_add("o_orderdate", 40)).alias("e"))
    history = topk.latest_per_key(t.orders.select("o_custkey", "o_orderdate", "o_orderkey", F.col("o_orderpriority").alias("label")), ["o_custkey", "o_orderdate"], [F.desc("o_orderkey")])
    history = history.select("o_custkey", "label", F.col("o_orderdate").alias("f"), F.lit(None).cast("timestamp_ntz").alias("until"))
    df = U.open_items(items, "o_custkey", "c", "e", "2001-05-01", "2001-06-15", history, "f", "until", ["label"], by_day)
    return df.groupBy("day", "label").agg(F.count(F.lit(1)).alias("open_items"), F.sum("open_age_days").alias("total_age"))


@query("met_21_latest_runs", """
SELECT user_id, round(value * 2, 6) AS run_seconds, CASE WHEN kind = 'error' THEN ok_at END AS last_success_at FROM (SELECT user_id, arg_max(value, (ts, event_id)) AS value, arg_max(event_type, (ts, event_id)) AS kind, MAX(ts) FILTER (event_type <> 'error') AS ok_at FROM events GROUP BY 1)""")
def _(t):
    df = t.events.withColumn("done_at", F.expr("ts + make_dt_interval(0, 0, 0, value * 2)")).withColumn("ok", F.col("event_type") != "error")
    runs = U.latest_runs(df, "user_id", "ts", "done_at", "event_id")
    return runs.join(U.last_success(df, "user_id", "ts", "ok", "event_id"), "user_id", "left")
