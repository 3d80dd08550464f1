"""TK and SET queries."""

from pyspark.sql import functions as F

from sparkmart.operators import sets as S, topk as K
from sparkmart.plans.registry import query


@query("tk_1_order_by", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey")
def _(t):
    return K.order_by(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), F.col("c_acctbal").desc_nulls_last(), "c_custkey")


@query("tk_2_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def _(t):
    return K.limit(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 100)


@query("tk_3_latest_per_key", "SELECT event_id, ts, user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def _(t):
    return K.latest_per_key(t.events.drop("props"), ["user_id"], [F.desc("ts"), F.desc("event_id")])


@query("tk_3_latest_narrow", "SELECT user_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def _(t):
    return K.latest_narrow(t.events, ["user_id"], "value", ["ts", "event_id"])


@query("tk_4_top_k_ties", "SELECT p_partkey, p_brand, p_size FROM part QUALIFY rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) <= 3")
def _(t):
    return K.top_k(t.part.select("p_partkey", "p_brand", "p_size"), ["p_brand"], F.desc("p_size"), 3, ties=True)


@query("tk_5_latest_per_period", """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def _(t):
    return K.latest_per_period(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], "o_orderdate", "month", "o_orderkey")


@query("tk_6_latest_state", "SELECT event_id, user_id FROM events WHERE CAST(ts AS DATE) = (SELECT MAX(CAST(ts AS DATE)) FROM events)")
def _(t):
    return K.latest_state(t.events.withColumn("day", F.to_date("ts")), "day").select("event_id", "user_id")


@query("tk_7_drop_duplicated", "SELECT doc_id, lang FROM documents WHERE md5(text) IN (SELECT md5(text) FROM documents GROUP BY 1 HAVING COUNT(*) = 1)")
def _(t):
    return K.drop_duplicated(t.documents.select("doc_id", "lang", F.md5("text").alias("h")), "h").drop("h")


@query("tk_8_duplicates", "SELECT l_orderkey, COUNT(*) AS copies FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1")
def _(t):
    return K.duplicates(t.lineitem, "l_orderkey")


@query("set_1_union_all", "SELECT c_custkey AS id, c_nationkey AS nation FROM customer UNION ALL SELECT s_suppkey, s_nationkey FROM supplier")
def _(t):
    return S.union_all(t.customer.selectExpr("c_custkey AS id", "c_nationkey AS nation"), t.supplier.selectExpr("s_nationkey AS nation", "s_suppkey AS id"))


@query("set_2_union_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def _(t):
    return S.union_distinct(t.customer.selectExpr("c_nationkey AS nation"), t.supplier.selectExpr("s_nationkey AS nation"))


@query("set_3_union_labelled", """
SELECT event_id, user_id, 'view' AS part, NULL AS value FROM events WHERE event_type = 'view' UNION ALL SELECT event_id, user_id, 'purchase', value FROM events WHERE event_type = 'purchase'""")
def _(t):
    ev = t.events.select("event_id", "user_id", "event_type", "value")
    parts = {"view": ev.filter("event_type = 'view'").drop("value", "event_type"), "purchase": ev.filter("event_type = 'purchase'").drop("event_type")}
    return S.union_labelled(parts, "part")


@query("set_4_history_and_current", """
SELECT o_custkey, COUNT(*) AS n, 'history' AS src FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-01' GROUP BY 1
UNION ALL SELECT o_custkey, COUNT(*), 'current' FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01' GROUP BY 1""")
def _(t):
    cut = F.lit("2001-07-01").cast("timestamp_ntz")
    agg = lambda df, name: df.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).withColumn("src", F.lit(name))
    return S.history_and_current(agg(t.orders.filter(F.col("o_orderdate") < cut), "history"), agg(t.orders.filter(F.col("o_orderdate") >= cut), "current"))


@query("set_5_intersect_except", """
SELECT k, 'both' AS side FROM (SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier)
UNION ALL SELECT k, 'customers only' FROM (SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier)""")
def _(t):
    a, b = t.customer.selectExpr("c_nationkey AS k"), t.supplier.selectExpr("s_nationkey AS k")
    return S.intersect_all(a, b).withColumn("side", F.lit("both")).unionByName(S.except_all(a, b).withColumn("side", F.lit("customers only")))


@query("set_6_blend_at_cutover", """
SELECT o_orderkey AS k, o_orderdate AS d, 'old' AS system FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL SELECT l_orderkey, l_shipdate, 'new' FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'""")
def _(t):
    old, new = t.orders.selectExpr("o_orderkey AS k", "o_orderdate AS d"), t.lineitem.selectExpr("l_orderkey AS k", "l_shipdate AS d")
    return S.blend(old, new, "d", "1998-01-01")
