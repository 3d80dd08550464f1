"""WN queries. Event-grain windows run chunked by day or month."""

from pyspark.sql import functions as F

from sparkmart.functions import money, trunc_to
from sparkmart.operators import windows as wn
from sparkmart.plans.registry import by_day, by_minute, dsum, query

EV = ["ts", "event_id"]


@query("wn_1_row_number", "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events")
def _(t):
    df = wn.row_number(t.events.select("event_id", "user_id", "ts"), "rn", "user_id", EV, chunk=by_minute())
    return df.select("event_id", "rn")


@query("wn_2_rank", "SELECT o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS rnk FROM orders")
def _(t):
    df = wn.rank(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), "rnk", "o_custkey", "o_orderdate", chunk=by_day("o_orderdate"))
    return df.select("o_orderkey", "rnk")


@query("wn_3_dense_rank", "SELECT o_orderkey, dense_rank() OVER (ORDER BY date_trunc('month', o_orderdate)) AS month_no FROM orders")
def _(t):
    # A global rank runs over the distinct months, not the rows.
    df = wn.dense_rank(t.orders.select("o_orderkey", "o_orderdate"), "month_no", [], trunc_to("month", "o_orderdate"))
    return df.select("o_orderkey", F.col("month_no").cast("long"))


@query("wn_4_lag_lead", """
SELECT event_id, lag(event_type, 1, 'none') OVER w AS prev_type, lead(event_type) OVER w AS next_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(t):
    df, chunk = wn.cut(t.events.select("event_id", "user_id", "ts", "event_type"), "user_id", by_minute())
    df = wn.lag(df, "prev_type", "user_id", EV, "event_type", default="none", chunk=chunk)
    df = wn.lead(df, "next_type", "user_id", EV, "event_type", chunk=chunk)
    return df.select("event_id", "prev_type", "next_type")


@query("wn_4_lag_n", """
SELECT event_id, lag(value, 3) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS value_3_back,
  lead(value, 2) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS value_2_on FROM events""")
def _(t):
    df = t.events.select("event_id", "user_id", "ts", "value")
    exprs = {"value_3_back": lambda w: F.lag("value", 3).over(w), "value_2_on": lambda w: F.lead("value", 2).over(w)}
    return wn.halo(df, "user_id", EV, 3, 2, 100_000, exprs, chunk=by_minute()).select("event_id", *exprs)


@query("wn_5_lag_ignore_nulls", """
SELECT event_id, last_value(CASE WHEN event_type='purchase' THEN value END IGNORE NULLS) OVER
 (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_purchase FROM events""")
def _(t):
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    df = wn.last_known(t.events.select("event_id", "user_id", "ts", "event_type", "value"), "prev_purchase", "user_id", EV, bought, include_current=False, chunk=by_minute())
    return df.select("event_id", "prev_purchase")


@query("wn_6_first_last_value", """
SELECT event_id, first_value(event_type) OVER w AS first_type, last_value(event_type) OVER w AS last_type FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def _(t):
    order = F.struct(*EV)
    df = wn.partition_agg(
        t.events.select("event_id", "user_id", "ts", "event_type"), "user_id",
        first_type=F.min_by("event_type", order), last_type=F.max_by("event_type", order))
    return df.select("event_id", "first_type", "last_type")


@query("wn_7_backfill", """
SELECT event_id, first_value(CASE WHEN event_type='purchase' THEN value END IGNORE NULLS) OVER
 (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_purchase FROM events""")
def _(t):
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    df = wn.next_known(t.events.select("event_id", "user_id", "ts", "event_type", "value"), "next_purchase", "user_id", EV, bought, chunk=by_minute())
    return df.select("event_id", "next_purchase")


@query("wn_8_nth_value", """
SELECT o_orderkey, nth_value(o_totalprice, 2) OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey
 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second_price FROM orders""")
def _(t):
    df = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    df = wn.nth_value(df, "second_price", "o_custkey", [F.desc("o_totalprice"), "o_orderkey"], "o_totalprice", 2)
    return df.select("o_orderkey", "second_price")


@query("wn_9_partition_aggregates", """
SELECT o_orderkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DOUBLE) AS cust_total, MIN(o_totalprice) OVER w AS cust_min,
 MAX(o_totalprice) OVER w AS cust_max, COUNT(*) OVER w AS cust_orders FROM orders WINDOW w AS (PARTITION BY o_custkey)""")
def _(t):
    df = wn.partition_agg(
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), "o_custkey",
        cust_total=F.sum(money("o_totalprice")), cust_min=F.min("o_totalprice"),
        cust_max=F.max("o_totalprice"), cust_orders=F.count(F.lit(1)))
    return df.drop("o_custkey", "o_totalprice")


def _running_sql(frame, name):
    return f"""SELECT event_id, CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND {frame}) AS DOUBLE) AS {name} FROM events"""


@query("wn_10_running_total", _running_sql("CURRENT ROW", "spent"))
def _(t):
    df = wn.running(t.events.select("event_id", "user_id", "ts", "value"), "spent", "user_id", EV, money("value"), chunk=by_minute())
    return df.select("event_id", "spent")


@query("wn_11_prior_running_total", _running_sql("1 PRECEDING", "spent_before"))
def _(t):
    df = wn.running(t.events.select("event_id", "user_id", "ts", "value"), "spent_before", "user_id", EV, money("value"), include_current=False, chunk=by_minute())
    return df.select("event_id", "spent_before")


@query("wn_12_rolling_backward", """
SELECT event_id, CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id
 ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) AS last_three FROM events""")
def _(t):
    df = wn.rolling(t.events.select("event_id", "user_id", "ts", "value"), "last_three", "user_id", EV, money("value"), 2, chunk=by_minute())
    return df.select("event_id", "last_three")


MONTHLY = "SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS amount FROM orders GROUP BY 1, 2"


def monthly_orders(t):
    month = trunc_to("month", "o_orderdate").cast("date").alias("month")
    return t.orders.groupBy("o_custkey", month).agg(F.sum(money("o_totalprice")).alias("amount"))


@query("wn_13_rolling_forward_desc", f"""
SELECT o_custkey, CAST(month AS VARCHAR) AS month, CAST(SUM(amount) OVER (PARTITION BY o_custkey ORDER BY month DESC
 ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING) AS DOUBLE) AS trailing_12 FROM ({MONTHLY})""")
def _(t):
    # One row per customer and month: the window is bounded by the calendar.
    return wn.rolling(monthly_orders(t), "trailing_12", "o_custkey", F.desc("month"), "amount", 0, 11).drop("amount")


@query("wn_14_ratio_to_report", """
SELECT o_orderkey, round(CAST(o_totalprice AS DOUBLE) / CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey) AS DOUBLE), 6) AS share FROM orders""")
def _(t):
    df = wn.share_of(t.orders.select("o_orderkey", "o_custkey", money("o_totalprice").alias("p")), "share", "o_custkey", "p")
    return df.select("o_orderkey", F.round("share", 6).alias("share"))


@query("wn_15_count_distinct_over", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, n_parts FROM lineitem JOIN
 (SELECT l_suppkey AS k, COUNT(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY 1) ON k = l_suppkey""")
def _(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return wn.count_distinct_over(df, "n_parts", "l_suppkey", "l_partkey")


@query("wn_16_listagg_distinct_over", """
SELECT event_id, kinds FROM events JOIN (SELECT user_id AS u, string_agg(event_type, ',' ORDER BY event_type) AS kinds
 FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY 1) ON u = user_id""")
def _(t):
    df = t.events.select("event_id", "user_id", "event_type")
    return wn.listagg_distinct_over(df, "kinds", "user_id", "event_type").select("event_id", "kinds")


@query("wn_17_change_counter", """
SELECT event_id, CAST(SUM(ch) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM
 (SELECT *, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) <> event_type THEN 1 ELSE 0 END AS ch FROM events)""")
def _(t):
    df = t.events.select("event_id", "user_id", "ts", "event_type")
    return wn.change_counter(df, "island", "user_id", EV, "event_type", chunk=by_minute()).select("event_id", "island")


@query("wn_18_bool_over", """
SELECT o_orderkey, bool_or(o_orderstatus='F') OVER w AS any_f, bool_and(o_totalprice > 5000) OVER w AS all_big
FROM orders WINDOW w AS (PARTITION BY o_custkey)""")
def _(t):
    df = wn.partition_agg(
        t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), "o_custkey",
        any_f=F.bool_or(F.col("o_orderstatus") == "F"), all_big=F.bool_and(F.col("o_totalprice") > 5000))
    return df.select("o_orderkey", "any_f", "all_big")


@query("wn_19_window_over_aggregate", """
SELECT CAST(day AS VARCHAR) AS day, n, round(CAST(SUM(n) OVER () AS DOUBLE) / COUNT(*) OVER (), 6) AS mean_n FROM
 (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n FROM events GROUP BY 1)""")
def _(t):
    df = t.events.select(F.to_date("ts").alias("day"))
    df = wn.agg_then_window(df, "day", "mean_n", F.count(F.lit(1)).alias("n"), agg=F.sum("n").cast("double") / F.count(F.lit(1)))
    return df.withColumn("mean_n", F.round("mean_n", 6))


@query("wn_20_share_zero_guard", """
SELECT event_id, round(CASE WHEN tot = 0 THEN 0 ELSE bought / tot END, 6) AS share FROM
 (SELECT event_id, bought, SUM(bought) OVER (PARTITION BY CAST(ts AS DATE), user_id) AS tot FROM
  (SELECT *, CASE WHEN event_type='purchase' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS bought FROM events))""")
def _(t):
    bought = F.when(F.col("event_type") == "purchase", 1.0).otherwise(0.0).alias("bought")
    df = t.events.select("event_id", "user_id", F.to_date("ts").alias("day"), bought)
    df = wn.share_of_or_zero(df, "share", ["day", "user_id"], "bought")
    return df.select("event_id", F.round("share", 6).alias("share"))


@query("wn_21_period_to_date", """
SELECT CAST(day AS VARCHAR) AS day,
 CAST(SUM(amount) OVER (PARTITION BY date_trunc('week', day) ORDER BY day ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS week_to_date,
 CAST(SUM(amount) OVER (PARTITION BY date_trunc('month', day) ORDER BY day ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS month_to_date,
 CAST(SUM(amount) OVER (PARTITION BY date_trunc('quarter', day) ORDER BY day ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS quarter_to_date,
 CAST(SUM(amount) OVER (PARTITION BY date_trunc('year', day) ORDER BY day ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS year_to_date
FROM (SELECT CAST(o_orderdate AS DATE) AS day, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS amount FROM orders GROUP BY 1)""")
def _(t):
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum(money("o_totalprice")).alias("amount"))
    return wn.period_to_date(daily, [], "day", "amount").drop("amount")


@query("wn_22_last_in_period", """
SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1 THEN 1 ELSE 0 END AS is_last
FROM events""")
def _(t):
    df = t.events.select("event_id", "user_id", "ts", F.to_date("ts").alias("day"))
    return wn.last_in_period(df, "is_last", ["user_id", "day"], EV).select("event_id", "is_last")
