"""AG queries."""

from pyspark.sql import functions as F

from sparkmart.functions import money, trunc_to
from sparkmart.operators import aggregates as A, topk
from sparkmart.plans.registry import dsum, query


@query("ag_1_group_by", f"""
SELECT l_returnflag, l_linestatus, {dsum('l_quantity')} AS sum_qty, {dsum('l_extendedprice')} AS sum_price, MIN(l_discount) AS min_discount, MAX(l_tax) AS max_tax,
 round({dsum('l_quantity')} / COUNT(*), 6) AS avg_qty, COUNT(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-06-01' GROUP BY 1, 2""")
def _(t):
    df = t.lineitem.filter(F.col("l_shipdate") <= F.lit("2001-06-01").cast("timestamp_ntz"))
    return A.group(df, ["l_returnflag", "l_linestatus"], sum_qty=F.sum(money("l_quantity")), sum_price=F.sum(money("l_extendedprice")),
                   min_discount=F.min("l_discount"), max_tax=F.max("l_tax"),
                   avg_qty=F.round(F.sum(money("l_quantity")).cast("double") / F.count(F.lit(1)), 6), n=F.count(F.lit(1)))


@query("ag_2_count_distinct", "SELECT l_returnflag, COUNT(DISTINCT l_orderkey) AS orders, COUNT(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1")
def _(t):
    return A.group(t.lineitem, ["l_returnflag"], orders=F.count_distinct("l_orderkey"), suppliers=F.count_distinct("l_suppkey"))


@query("ag_3_conditional", f"""
SELECT o_custkey, CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS won, MAX(CASE WHEN o_orderpriority LIKE '1%' THEN o_totalprice END) AS max_urgent,
 COUNT(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS open_orders, COUNT(*) FILTER (o_totalprice > 200000) AS big FROM orders GROUP BY 1""")
def _(t):
    c = F.col
    return A.group(t.orders, ["o_custkey"], won=F.sum(F.when(c("o_orderstatus") == "F", money("o_totalprice")).otherwise(0)),
                   max_urgent=F.max(F.when(c("o_orderpriority").startswith("1"), c("o_totalprice"))),
                   open_orders=F.count(F.when(c("o_orderstatus") == "O", 1)), big=F.count_if(c("o_totalprice") > 200000))


@query("ag_4_having", "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1 HAVING COUNT(*) > 12")
def _(t):
    return A.having(t.orders, ["o_custkey"], "n > 12", n=F.count(F.lit(1)))


@query("ag_5_rollup_total", f"""
SELECT CASE WHEN grouping(r_name) = 1 THEN 'Total' ELSE r_name END AS r_name, CASE WHEN grouping(seg) = 1 THEN 'Total' ELSE seg END AS seg, {dsum('c_acctbal')} AS balance, COUNT(*) AS n
FROM (SELECT r_name, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS seg, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) GROUP BY ROLLUP (r_name, seg)""")
def _(t):
    df = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    df = df.select("r_name", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("seg"), "c_acctbal")
    return A.rollup_total(df, ["r_name", "seg"], balance=F.sum(money("c_acctbal")), n=F.count(F.lit(1)))


@query("ag_6_by_levels", " UNION ALL ".join(
    f"SELECT '{n}' AS level, CAST({c} AS VARCHAR) AS id, {dsum('o_totalprice')} AS arr FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 2"
    for n, c in (("customer", "c_custkey"), ("nation", "n_nationkey"), ("region", "n_regionkey"))))
def _(t):
    df = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return A.by_levels(df, {"customer": "c_custkey", "nation": "n_nationkey", "region": "n_regionkey"}, arr=F.sum(money("o_totalprice")))


@query("ag_7_management_cut", """
WITH a AS (SELECT r_name, c_mktsegment AS seg, CAST(o_totalprice AS DECIMAL(18,2)) AS v, CASE o_orderstatus WHEN 'F' THEN 'won' WHEN 'O' THEN 'open' END AS metric FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
 tg AS (SELECT r_name, c_mktsegment AS seg, CAST(c_acctbal AS DECIMAL(18,2)) AS v, CASE WHEN c_custkey % 2 = 0 THEN 'won' ELSE 'open' END AS metric FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
 ra AS (SELECT CASE WHEN grouping(r_name) = 1 THEN 'Total' ELSE r_name END AS r_name, CASE WHEN grouping(seg) = 1 THEN 'Total' ELSE seg END AS seg, CAST(SUM(v) FILTER (metric = 'won') AS DOUBLE) AS won_actual, CAST(SUM(v) FILTER (metric = 'open') AS DOUBLE) AS open_actual FROM a GROUP BY ROLLUP (r_name, seg)),
 rt AS (SELECT CASE WHEN grouping(r_name) = 1 THEN 'Total' ELSE r_name END AS r_name, CASE WHEN grouping(seg) = 1 THEN 'Total' ELSE seg END AS seg, CAST(SUM(v) FILTER (metric = 'won') AS DOUBLE) AS won_target, CAST(SUM(v) FILTER (metric = 'open') AS DOUBLE) AS open_target FROM tg GROUP BY ROLLUP (r_name, seg))
SELECT ra.*, won_target, open_target, round(won_actual / nullif(won_target, 0), 6) AS won_attainment, round(open_actual / nullif(open_target, 0), 6) AS open_attainment FROM ra LEFT JOIN rt USING (r_name, seg)""")
def _(t):
    geo = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).withColumnRenamed("c_mktsegment", "seg")
    status = F.when(F.col("o_orderstatus") == "F", "won").when(F.col("o_orderstatus") == "O", "open")
    actual = t.orders.join(geo, F.col("o_custkey") == F.col("c_custkey")).withColumn("metric", status)
    target = geo.withColumn("metric", F.when(F.col("c_custkey") % 2 == 0, "won").otherwise("open"))
    return A.management_cut(actual, target, ["r_name", "seg"], ["won", "open"], money("o_totalprice"), money("c_acctbal"))


@query("ag_8_array_agg", """
SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), '|') AS priorities FROM orders GROUP BY 1""")
def _(t):
    df = A.group(t.orders, ["o_custkey"], priorities=A.array_agg_sorted("o_orderpriority"))
    return df.withColumn("priorities", F.array_join("priorities", "|"))


@query("ag_9_listagg", "SELECT l_suppkey, string_agg(f, ',' ORDER BY f) AS flags FROM (SELECT DISTINCT l_suppkey, l_returnflag || l_linestatus AS f FROM lineitem) GROUP BY 1")
def _(t):
    return A.group(t.lineitem, ["l_suppkey"], flags=A.listagg(F.concat("l_returnflag", "l_linestatus")))


QS = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}


@query("ag_10_percentiles", """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 6) AS p25, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.75), 6) AS p75,
 round(quantile_cont(l_extendedprice, 0.9), 6) AS p90 FROM lineitem GROUP BY 1""")
def _(t):
    df = A.percentiles_wide(t.lineitem, ["l_returnflag"], "l_extendedprice", QS, 500)
    return df.select("l_returnflag", *[F.round(c, 6).alias(c) for c in QS])


@query("ag_11_percentile_approx", "SELECT DISTINCT l_returnflag, true AS p50_holds, true AS p90_holds FROM lineitem")
def _(t):
    # An approximate percentile has no exact value: its rank among all values must be within 1 / accuracy.
    # The found values are a row per flag; a shuffle by flag would sort every line in as many tasks as there are flags.
    found = percentiles_by_flag(t)
    df = t.lineitem.select("l_returnflag", "l_extendedprice").join(F.broadcast(found), "l_returnflag")
    below, upto = (lambda p: F.avg((F.col("l_extendedprice") < F.col(p)).cast("double"))), (lambda p: F.avg((F.col("l_extendedprice") <= F.col(p)).cast("double")))
    near = lambda p, q: (below(p) <= q + 1e-3) & (upto(p) >= q - 1e-3)
    return df.groupBy("l_returnflag").agg(near("p50", 0.5).alias("p50_holds"), near("p90", 0.9).alias("p90_holds"))


def percentiles_by_flag(t):
    return A.group(t.lineitem, ["l_returnflag"], p50=F.percentile_approx("l_extendedprice", 0.5, 10000), p90=F.percentile_approx("l_extendedprice", 0.9, 10000))


@query("ag_12_stddev", "SELECT p_brand, round(stddev_samp(p_retailprice), 6) AS sd FROM part GROUP BY 1")
def _(t):
    return A.group(t.part, ["p_brand"], sd=F.round(F.stddev_samp("p_retailprice"), 6))


@query("ag_13_bool", "SELECT o_custkey, bool_and(o_totalprice > 10000) AS all_big, bool_or(o_orderstatus = 'P') AS any_p FROM orders GROUP BY 1")
def _(t):
    return A.group(t.orders, ["o_custkey"], all_big=F.bool_and(F.col("o_totalprice") > 10000), any_p=F.bool_or(F.col("o_orderstatus") == "P"))


@query("ag_14_distinct", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def _(t):
    return t.lineitem.select("l_suppkey", "l_returnflag").distinct()


TYPES = ["click", "error", "purchase", "signup", "view"]


@query("ag_15_pivot", "SELECT user_id, " + ", ".join(f"coalesce(CAST(SUM(CASE WHEN event_type = '{x}' THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE), 0) AS {x}_sum" for x in TYPES) + " FROM events GROUP BY 1")
def _(t):
    return A.pivot_values(t.events, ["user_id"], "event_type", TYPES, lambda hit: F.sum(F.when(hit, money("value"))), 0, suffix="_sum")


@query("ag_16_column_values", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1")
def _(t):
    # Values are discovered first and then laid out, as a pivot would.
    names = A.column_values(t.events, "event_type", F.count(F.lit(1)), limit=1000)
    wide = A.pivot_values(t.events, [], "event_type", names, F.count_if)
    return A.melt(wide, [], names, "long", "event_type", "n")


@query("ag_17_melt", """
SELECT l_orderkey, l_linenumber, l_partkey, unnest(['l_quantity', 'l_discount', 'l_tax']) AS field_name, unnest([l_quantity, l_discount, l_tax]) AS value FROM lineitem""")
def _(t):
    return A.melt(t.lineitem, ["l_orderkey", "l_linenumber", "l_partkey"], ["l_quantity", "l_discount", "l_tax"])


@query("ag_18_max_by", "SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS last_priority, arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS biggest FROM orders GROUP BY 1")
def _(t):
    return A.group(t.orders, ["o_custkey"], last_priority=F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")), biggest=F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")))


@query("ag_19_latest_toggle", """
SELECT user_id, a AS added_at, CASE WHEN r > a OR a IS NULL THEN r END AS removed_at, CASE WHEN r > a OR a IS NULL THEN 'removed' ELSE 'added' END AS latest_state
FROM (SELECT user_id, MAX(ts) FILTER (event_type = 'signup') AS a, MAX(ts) FILTER (event_type = 'error') AS r FROM events WHERE event_type IN ('signup', 'error') GROUP BY 1)""")
def _(t):
    return A.latest_toggle(t.events.filter(F.col("event_type").isin("signup", "error")), ["user_id"], "event_type", "ts", "signup", "error").withColumn("latest_state", F.when(F.col("latest_state") == "signup", "added").otherwise("removed"))


@query("ag_20_kv_wide", "SELECT user_id, " + ", ".join(f"MAX(value) FILTER (event_type = '{x}') AS \"{x}\"" for x in TYPES) + " FROM events GROUP BY 1")
def _(t):
    return A.kv_wide(t.events, ["user_id"], "event_type", "value", TYPES)


@query("ag_21_max_rank", "SELECT p_brand, MAX(CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'STANDARD' THEN 2 WHEN 'PROMO' THEN 3 ELSE 0 END) AS top_rank FROM part GROUP BY 1")
def _(t):
    return A.group(t.part, ["p_brand"], top_rank=A.max_rank("p_type", {"ECONOMY": 1, "STANDARD": 2, "PROMO": 3}))


@query("ag_22_distinct_by_category", "SELECT user_id, " + ", ".join(f"COUNT(DISTINCT CASE WHEN event_type = '{x}' THEN CAST(ts AS DATE) END) AS days_{x}" for x in TYPES) + " FROM events GROUP BY 1")
def _(t):
    return A.distinct_by(t.events, ["user_id"], "event_type", F.to_date("ts"), TYPES, "days_")
