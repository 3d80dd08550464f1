"""JN queries."""

from pyspark.sql import functions as F

from sparkmart.functions import boundary_diff, money, trunc_to
from sparkmart.operators import joins as J
from sparkmart.plans.registry import by_minute, dsum, query



@query("jn_1_star", f"""
SELECT r_name, n_name, {dsum('o_totalprice')} AS revenue, COUNT(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def _(t):
    df = J.star(t.orders, (t.customer, "o_custkey", "c_custkey"), (t.nation, "c_nationkey", "n_nationkey"), (t.region, "n_regionkey", "r_regionkey"))
    return df.groupBy("r_name", "n_name").agg(F.sum(money("o_totalprice")).alias("revenue"), F.count(F.lit(1)).alias("n"))


@query("jn_2_left_composite", """
SELECT c_custkey, s_suppkey FROM customer LEFT JOIN supplier ON c_nationkey = s_nationkey AND c_custkey = s_suppkey""")
def _(t):
    return J.left_composite(t.customer, t.supplier, {"c_nationkey": "s_nationkey", "c_custkey": "s_suppkey"}).select("c_custkey", "s_suppkey")


@query("jn_3_full_match", """
SELECT coalesce(a.k, b.k, c.k) AS k, a.n_orders, b.n_events, c.balance, a.k IS NOT NULL AS in_orders, b.k IS NOT NULL AS in_events, c.k IS NOT NULL AS in_accounts,
 CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL AND c.k IS NOT NULL THEN 'all matching' WHEN a.k IS NOT NULL AND b.k IS NULL AND c.k IS NOT NULL THEN 'no events' WHEN a.k IS NULL AND b.k IS NULL THEN 'account only' END AS match_status
FROM (SELECT o_custkey AS k, COUNT(*) AS n_orders FROM orders GROUP BY 1) a FULL JOIN (SELECT user_id AS k, COUNT(*) AS n_events FROM events GROUP BY 1) b ON a.k = b.k
FULL JOIN (SELECT c_custkey AS k, c_acctbal AS balance FROM customer) c ON c.k = coalesce(a.k, b.k)""")
def _(t):
    lists = {
        "orders": t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n_orders")),
        "events": t.events.groupBy(F.col("user_id").alias("k")).agg(F.count(F.lit(1)).alias("n_events")),
        "accounts": t.customer.selectExpr("c_custkey AS k", "c_acctbal AS balance")}
    return J.full_match(lists, "k", [(("orders", "events", "accounts"), "all matching"), (("orders", "accounts"), "no events"), (("accounts",), "account only")])


@query("jn_4_right_spine", """
SELECT n_nationkey, coalesce(n, 0) AS n FROM (SELECT s_nationkey AS k, COUNT(*) AS n FROM supplier WHERE s_acctbal < 0 GROUP BY 1) RIGHT JOIN nation ON k = n_nationkey""")
def _(t):
    facts = t.supplier.filter("s_acctbal < 0").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    return J.right_spine(facts, t.nation.select("n_nationkey"), "n_nationkey").select("n_nationkey", F.coalesce("n", F.lit(0)).alias("n"))


@query("jn_5_cross_param", """
SELECT event_id, date_diff('day', ts, (SELECT MAX(ts) FROM events)) AS days_ago, (SELECT COUNT(*) FROM customer) AS n_customers FROM events""")
def _(t):
    df = J.cross_param(t.events.select("event_id", "ts"), latest=t.events.select(F.max("ts")).scalar(), n_customers=t.customer.select(F.count(F.lit(1))).scalar())
    return df.select("event_id", boundary_diff("day", "ts", "latest").alias("days_ago"), "n_customers")


@query("jn_6_densify", """
SELECT u.user_id, CAST(d.day AS VARCHAR) AS day, coalesce(n, 0) AS n FROM (SELECT DISTINCT user_id FROM events) u
CROSS JOIN (SELECT CAST(unnest(generate_series((SELECT MIN(CAST(ts AS DATE)) FROM events), (SELECT MAX(CAST(ts AS DATE)) FROM events), INTERVAL 1 DAY)) AS DATE) AS day) d
LEFT JOIN (SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1, 2) e ON e.user_id = u.user_id AND e.day = d.day""")
def _(t):
    days = t.events.select("user_id", F.to_date("ts").alias("day"))
    low, high = days.select(F.min("day")).scalar(), days.select(F.max("day")).scalar()
    grid = J.densify(days.select("user_id").distinct(), low, high, "day")
    counts = days.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counts, ["user_id", "day"], "left").select("user_id", "day", F.coalesce("n", F.lit(0)).alias("n"))


@query("jn_7_interval_explosion", """
SELECT CAST(m AS VARCHAR) AS month, l_returnflag, COUNT(*) AS n, CAST(SUM(l_partkey) AS BIGINT) AS part_sum FROM (SELECT *, l_shipdate + (CAST(l_quantity AS INTEGER) * 10) * INTERVAL 1 DAY AS end_at FROM lineitem) l
JOIN (SELECT CAST(unnest(generate_series(DATE '1994-01-01', DATE '2004-12-01', INTERVAL 1 MONTH)) AS DATE) AS m) ON m >= date_trunc('month', l_shipdate) AND m < CAST(end_at AS DATE) GROUP BY 1, 2""")
def _(t):
    df = t.lineitem.select("l_partkey", "l_returnflag", F.to_date("l_shipdate").alias("start"), F.col("l_quantity").cast("int").alias("q"))
    df = df.withColumn("end_at", F.date_add("start", F.col("q") * 10))
    return J.explode_interval(df, "start", "end_at").groupBy("month", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_partkey").alias("part_sum"))


SCD_SQL = "SELECT user_id, event_type AS state, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) - INTERVAL 1 MILLISECOND AS valid_to FROM events WHERE event_type <> 'purchase'"


@query("jn_8_asof", f"""
SELECT event_id, state FROM (SELECT event_id, state, row_number() OVER (PARTITION BY event_id ORDER BY valid_from DESC) AS rn FROM (SELECT * FROM events WHERE event_type = 'purchase') e
 LEFT JOIN ({SCD_SQL}) s ON s.user_id = e.user_id AND e.ts >= valid_from AND e.ts <= coalesce(valid_to, TIMESTAMP '9999-12-31')) WHERE rn = 1""")
def _(t):
    from sparkmart.operators import windows as wn
    ev = t.events.select("event_id", "user_id", "ts", "event_type")
    scd = wn.lead(ev.filter("event_type <> 'purchase'"), "nxt", "user_id", ["ts", "event_id"], "ts", chunk=by_minute())
    scd = scd.select("user_id", F.col("event_type").alias("state"), F.col("ts").alias("valid_from"), (F.col("nxt") - F.expr("INTERVAL 1 MILLISECOND")).alias("valid_to"))
    points = ev.filter("event_type = 'purchase'")
    return J.asof(points, "ts", scd, "user_id", "valid_from", "valid_to", ["state"], "event_id", chunk=by_minute).select("event_id", "state")


@query("jn_9_range_lookup", """
SELECT o_orderkey, p_partkey FROM orders JOIN (SELECT p_partkey, p_partkey * 60 AS lo, p_partkey * 60 + 49.5 + p_size AS hi FROM part) ON o_totalprice BETWEEN lo AND hi""")
def _(t):
    bands = t.part.select("p_partkey", (F.col("p_partkey") * 60).cast("double").alias("lo"), (F.col("p_partkey") * 60 + 49.5 + F.col("p_size")).alias("hi"))
    return J.range_lookup(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", bands, "lo", "hi", 100).select("o_orderkey", "p_partkey")


@query("jn_9_prefix_lookup", """
WITH n AS (SELECT p_partkey, 4 + p_partkey % 25 AS bits, 167772160 + (p_partkey % 7) * 65536 + (p_partkey % 200) * 256 + p_partkey % 250 AS a FROM part),
 r AS (SELECT p_partkey, bits, a - a % (1::BIGINT << (32 - bits)) AS lo, a - a % (1::BIGINT << (32 - bits)) + (1::BIGINT << (32 - bits)) - 1 AS hi FROM n),
 e AS (SELECT event_id, CASE WHEN event_id % 300 < 256 THEN 167772160 + (user_id % 9) * 65536 + (event_id % 256) * 256 + event_id % 300 END AS x FROM events),
 d AS (SELECT x, arg_max(p_partkey, bits * 10000000 - p_partkey) AS p_partkey, MAX(bits) AS bits FROM (SELECT DISTINCT x FROM e) JOIN r ON x BETWEEN lo AND hi GROUP BY x)
SELECT event_id, p_partkey, bits FROM e LEFT JOIN d USING (x)""")
def _(t):
    bits = F.col("p_partkey") % 25 + 4
    nets = t.part.select("p_partkey", bits.cast("int").alias("bits"), F.format_string("10.%d.%d.%d/%d", F.col("p_partkey") % 7, F.col("p_partkey") % 200, F.col("p_partkey") % 250, bits).alias("net"))
    ev = t.events.select("event_id", F.format_string("10.%d.%d.%d", F.col("user_id") % 9, F.col("event_id") % 256, F.col("event_id") % 300).alias("ip"))
    return J.prefix_lookup(ev, "ip", nets, "net", ["p_partkey", "bits"], "p_partkey").drop("ip")


def _hist(kind, n):
    return f"SELECT user_id, event_id AS {n}_id, ts AS {n}_from, coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts + INTERVAL 1 DAY) AS {n}_to FROM events WHERE event_type = '{kind}'"


@query("jn_10_overlap", f"""
SELECT a_id, b_id, greatest(a_from, b_from) AS overlap_from, least(a_to, b_to) AS overlap_to FROM ({_hist('view', 'a')}) a JOIN ({_hist('click', 'b')}) b ON a.user_id = b.user_id AND a_from <= b_to AND b_from <= a_to""")
def _(t):
    from sparkmart.operators import windows as wn

    def hist(kind, n):
        ev = t.events.filter(F.col("event_type") == kind).select("user_id", "event_id", "ts")
        ev = wn.lead(ev, "nxt", "user_id", ["ts", "event_id"], "ts", chunk=by_minute())
        return ev.select("user_id", F.col("event_id").alias(f"{n}_id"), F.col("ts").alias(f"{n}_from"), F.coalesce("nxt", F.col("ts") + F.expr("INTERVAL 1 DAY")).alias(f"{n}_to"))

    out = J.overlap_join(hist("view", "a"), hist("click", "b"), "user_id", ("a_from", "a_to"), ("b_from", "b_to"), lambda c: F.unix_date(F.to_date(c)))
    return out.select("a_id", "b_id", "overlap_from", "overlap_to")


MONTHLY = "SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS mrr FROM orders GROUP BY 1, 2"


def monthly(t):
    return t.orders.groupBy("o_custkey", trunc_to("month", "o_orderdate").cast("date").alias("month")).agg(F.sum(money("o_totalprice")).cast("double").alias("mrr"))


@query("jn_11_offset_self_join", f"SELECT a.o_custkey, CAST(a.month AS VARCHAR) AS month, a.mrr, b.mrr AS prior_mrr FROM ({MONTHLY}) a LEFT JOIN ({MONTHLY}) b ON a.o_custkey = b.o_custkey AND a.month = b.month + INTERVAL 12 MONTH")
def _(t):
    return J.offset_self_join(monthly(t), ["o_custkey"], "month", 12, ["mrr"])


@query("jn_12_parent_of", """
SELECT a.c_custkey, coalesce(b.c_name, a.c_name) AS parent_c_name FROM customer a LEFT JOIN customer b ON b.c_custkey = CASE WHEN a.c_custkey >= 10 THEN a.c_custkey // 10 END""")
def _(t):
    df = t.customer.select("c_custkey", "c_name", F.when(F.col("c_custkey") >= 10, F.floor(F.col("c_custkey") / 10)).alias("parent_id"))
    return J.parent_of(df, "c_custkey", "parent_id", ["c_name"]).select("c_custkey", "parent_c_name")


@query("jn_13_left_anti", "SELECT c_custkey FROM customer LEFT JOIN events ON c_custkey = user_id WHERE user_id IS NULL")
def _(t):
    return J.anti(t.customer.select("c_custkey"), t.events.select(F.col("user_id").alias("c_custkey")), "c_custkey")


@query("jn_14_not_in_null_aware", """
SELECT event_id, 'none null' AS part FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 2000)
UNION ALL SELECT event_id, 'with null' FROM events WHERE user_id NOT IN (SELECT CASE WHEN c_acctbal < 2000 THEN c_custkey END FROM customer)""")
def _(t):
    ev = t.events.select("event_id", "user_id")
    clean = t.customer.filter("c_acctbal < 2000").select(F.col("c_custkey").alias("user_id"))
    nulls = t.customer.select(F.when(F.col("c_acctbal") < 2000, F.col("c_custkey")).alias("user_id"))
    a = J.anti(ev, clean, "user_id", null_aware=True).select("event_id", F.lit("none null").alias("part"))
    return a.unionByName(J.anti(ev, nulls, "user_id", null_aware=True).select("event_id", F.lit("with null").alias("part")))


@query("jn_15_semi", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)")
def _(t):
    return J.semi(t.customer, t.events.select(F.col("user_id").alias("c_custkey")), "c_custkey").select("c_custkey", "c_name")


@query("jn_16_scalar", "SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT AVG(o_totalprice) * 1.5 FROM orders)")
def _(t):
    return t.orders.filter(F.col("o_totalprice") > t.orders.select(F.avg("o_totalprice") * 1.5).scalar()).select("o_orderkey")


@query("jn_17_cumulative_eligibility", """
SELECT CAST(m.month AS VARCHAR) AS month, COUNT(*) AS eligible FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders) m
JOIN (SELECT o_custkey, CAST(date_trunc('month', MIN(o_orderdate)) AS DATE) AS first_month FROM orders GROUP BY 1) c ON m.month >= c.first_month GROUP BY 1""")
def _(t):
    month = trunc_to("month", "o_orderdate").cast("date")
    first = t.orders.groupBy("o_custkey").agg(F.min(month).alias("first_month")).withColumn("one", F.lit(1))
    return J.cumulative_eligibility(first, t.orders.select(month.alias("month")).distinct(), "first_month", "month", "one", "eligible")


@query("jn_18_lateral_flatten", """
SELECT doc_id, w FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS w FROM documents)""")
def _(t):
    return J.explode_join(t.documents.select("doc_id", F.split("text", "\n").alias("lines")), "lines", "w").drop("lines")


@query("jn_19_eq_all", """
SELECT a.c_custkey FROM customer a JOIN (SELECT c_custkey, c_name, CASE WHEN c_nationkey < 12 THEN NULL ELSE c_nationkey END AS c_nationkey, CASE WHEN c_custkey % 3 = 0 THEN 'X' ELSE c_mktsegment END AS c_mktsegment FROM customer) b
 ON a.c_custkey = b.c_custkey AND a.c_name = b.c_name AND a.c_mktsegment = b.c_mktsegment AND CASE WHEN a.c_nationkey < 12 THEN NULL ELSE a.c_nationkey END IS NOT DISTINCT FROM b.c_nationkey""")
def _(t):
    nation = F.when(F.col("c_nationkey") >= 12, F.col("c_nationkey"))
    a = t.customer.select("c_custkey", "c_name", nation.alias("c_nationkey"), "c_mktsegment").alias("a")
    b = t.customer.select("c_custkey", "c_name", nation.alias("c_nationkey"), F.when(F.col("c_custkey") % 3 == 0, "X").otherwise(F.col("c_mktsegment")).alias("c_mktsegment")).alias("b")
    return J.eq_all(a, b, ["c_custkey"], ["c_name", "c_nationkey", "c_mktsegment"]).select("c_custkey")


@query("jn_20_fallback", """
SELECT k, matched, tier_name FROM (SELECT *, rank() OVER (PARTITION BY k ORDER BY tier) AS r FROM (
 SELECT DISTINCT o_custkey AS k, o_orderkey AS matched, 0 AS tier, 'big order' AS tier_name FROM orders WHERE o_totalprice > 400000
 UNION ALL SELECT o_custkey, MIN(o_orderkey), 1, 'first order' FROM orders GROUP BY o_custkey
 UNION ALL SELECT c_custkey, -1, 2, 'no order' FROM customer)) WHERE r = 1""")
def _(t):
    big = t.orders.filter("o_totalprice > 400000").selectExpr("o_custkey AS k", "o_orderkey AS matched")
    first = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.min("o_orderkey").alias("matched"))
    none = t.customer.selectExpr("c_custkey AS k", "-1L AS matched")
    return J.fallback_match([("big order", big), ("first order", first), ("no order", none)], "k")


@query("jn_21_map_key_join", """
SELECT event_id, event_type AS question, value AS map_value, CASE event_type WHEN 'purchase' THEN 1 ELSE 2 END AS weight FROM events WHERE event_type IN ('purchase', 'view')""")
def _(t):
    df = t.events.select("event_id", F.create_map("event_type", "value").alias("answers"))
    keys = t.spark.createDataFrame([("purchase", 1), ("view", 2), ("other", 3)], "question string, weight int")
    return J.map_key_join(df, "answers", keys, "question")


@query("jn_22_nearest", """
SELECT event_id, other_id FROM (SELECT a.event_id, b.event_id AS other_id, row_number() OVER (PARTITION BY a.event_id ORDER BY abs(epoch_us(a.ts) - epoch_us(b.ts)), b.ts) AS rn
 FROM (SELECT * FROM events WHERE event_type = 'purchase') a LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') b ON a.user_id = b.user_id) WHERE rn = 1""")
def _(t):
    ev = t.events.select("event_id", "user_id", "ts", "event_type")
    other = ev.filter("event_type = 'signup'").select("user_id", F.col("event_id").alias("other_id"), F.col("ts").alias("other_ts"))
    return J.nearest(ev.filter("event_type = 'purchase'"), "ts", other, "other_ts", "user_id", "event_id", ["other_id"], chunk=by_minute).select("event_id", "other_id")
