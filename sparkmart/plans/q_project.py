"""PRJ queries."""

from datetime import date, datetime

from pyspark.sql import functions as F

from sparkmart.functions import (
    date_id, date_id_tz, flag_positive, keyed_null, null_negative, null_or_missing, pad_both, surrogate_key,
    to_infinity, variant_to_bool, variant_to_num, like_any, ilike_any, rlike_full,
)
from sparkmart.operators import project as P
from sparkmart.plans.registry import query


@query("prj_1_stage", """
SELECT o_orderkey AS order_id, CAST(o_custkey AS VARCHAR) AS customer, CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS amount,
 TRY_CAST(o_orderpriority AS INTEGER) AS priority_no,
 CASE WHEN o_orderpriority LIKE '5%' THEN TIMESTAMP '9999-12-30' ELSE o_orderdate END AS valid_until FROM orders""")
def _(t):
    far = F.when(F.col("o_orderpriority").startswith("5"), F.concat(F.lit("10"), F.col("o_orderdate").cast("string"))).otherwise(F.col("o_orderdate").cast("string"))
    return P.stage(t.orders, {
        "order_id": ("o_orderkey", "bigint"), "customer": ("o_custkey", "string"), "amount": ("o_totalprice", "decimal(18,2)"),
        "priority_no": ("o_orderpriority", "int"), "valid_until": (far, "timestamp_clamped")})


@query("prj_2_star_except", "SELECT * EXCLUDE (c_name, c_acctbal) FROM customer")
def _(t):
    return P.star_except(t.customer, ["c_name", "c_acctbal"])


@query("prj_3_surrogate_key", """
SELECT event_id, md5(concat_ws('-', coalesce(CAST(user_id AS VARCHAR), ''), coalesce(CASE WHEN event_type <> 'error' THEN event_type END, ''), CAST(CAST(ts AS DATE) AS VARCHAR))) AS event_key FROM events""")
def _(t):
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    return t.events.select("event_id", surrogate_key("user_id", kind, F.to_date("ts")).alias("event_key"))


@query("prj_4_keyed_null", "SELECT event_id, coalesce(CASE WHEN event_type <> 'error' THEN md5(event_type) END, md5('-1')) AS type_key FROM events")
def _(t):
    return t.events.select("event_id", keyed_null(F.when(F.col("event_type") != "error", F.md5("event_type"))).alias("type_key"))


@query("prj_5_date_id", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_id FROM orders")
def _(t):
    return t.orders.select("o_orderkey", date_id("o_orderdate").alias("date_id"))


@query("prj_6_date_id_tz", """
SELECT event_id, CAST(strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles', '%Y%m%d') AS INTEGER) AS date_pt_id FROM events""")
def _(t):
    return t.events.select("event_id", date_id_tz("ts").alias("date_pt_id"))


@query("prj_7_audit", """
SELECT n_nationkey, n_name, n_regionkey, '@a' AS created_by, '@b' AS updated_by, '2021-01-14' AS model_created_date,
 '2022-04-04' AS model_updated_date, TIMESTAMP '2024-02-01' AS row_updated_at,
 least((SELECT MIN(ts) FROM events), TIMESTAMP '2024-02-01') AS row_created_at FROM nation""")
def _(t):
    prior = t.events.select(F.col("ts").alias("row_created_at"))
    return P.audit(t.nation, "@a", "@b", date(2021, 1, 14), date(2022, 4, 4), datetime(2024, 2, 1), prior)


@query("prj_8_null_negative", "SELECT c_custkey, CASE WHEN c_acctbal - 1000 >= 0 THEN round(c_acctbal - 1000, 2) END AS balance FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.round(null_negative(F.col("c_acctbal") - 1000), 2).alias("balance"))


@query("prj_9_variant_convert", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN json_extract_string(props, '$.k') = '1' THEN true
 WHEN json_extract_string(props, '$.k') = '0' THEN false END AS k_flag FROM events""")
def _(t):
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "string")
    return t.events.select("event_id", variant_to_num(k).alias("k"), variant_to_bool(k).alias("k_flag"))


@query("prj_10_flag_positive", "SELECT event_id, CASE WHEN value - 50 > 0 THEN 1 ELSE 0 END AS is_used FROM events")
def _(t):
    return t.events.select("event_id", flag_positive(F.col("value") - 50).alias("is_used"))


@query("prj_11_to_infinity", "SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END, TIMESTAMP '9999-12-31') AS valid_to FROM orders")
def _(t):
    return t.orders.select("o_orderkey", to_infinity(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))).alias("valid_to"))


@query("prj_12_null_or_missing", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Missing segment' ELSE c_mktsegment END AS segment FROM customer""")
def _(t):
    return t.customer.select("c_custkey", null_or_missing(F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")), "segment").alias("segment"))


@query("prj_13_pad", "SELECT p_partkey, ' ' || p_name || ' ' AS padded FROM part")
def _(t):
    return t.part.select("p_partkey", pad_both("p_name").alias("padded"))


@query("prj_14_inline_values", """
SELECT n_nationkey, n_name FROM nation UNION ALL VALUES (-1, 'Missing nation'), (-2, 'Unknown nation')""")
def _(t):
    extra = P.values(t.spark, [(-1, "Missing nation"), (-2, "Unknown nation")], "n_nationkey int, n_name string")
    return t.nation.select("n_nationkey", "n_name").unionByName(extra)


@query("prj_15_single_field_dim", """
SELECT DISTINCT md5(CAST(c_mktsegment AS VARCHAR)) AS dim_segment_id, c_mktsegment AS segment_name FROM customer WHERE c_acctbal > 0
UNION ALL SELECT md5('-1'), 'Missing segment_name'""")
def _(t):
    return P.single_field_dim(t.customer, "c_mktsegment", "dim_segment_id", "c_mktsegment", "segment_name", F.col("c_acctbal") > 0)


@query("prj_16_predicates", """
SELECT p_partkey FROM part WHERE p_size BETWEEN 5 AND 30 AND p_type IN ('ECONOMY','LARGE','PROMO','SMALL') AND (p_name LIKE 'small%' OR p_name LIKE 'red%'
 OR lower(p_name) LIKE '%gear%') AND regexp_full_match(p_brand, 'Brand#[0-9]{1,2}') AND p_retailprice IS NOT NULL""")
def _(t):
    c = F.col
    return t.part.filter(P.all_of(
        c("p_size").between(5, 30), c("p_type").isin("ECONOMY", "LARGE", "PROMO", "SMALL"),
        like_any("p_name", ["small%", "red%"]) | ilike_any("p_name", ["%GEAR%"]),
        rlike_full("p_brand", "Brand#[0-9]{1,2}"), c("p_retailprice").isNotNull())).select("p_partkey")


@query("prj_17_valid_events", """
SELECT event_id FROM events WHERE (CASE WHEN event_id % 3 = 0 THEN 'rb-1' ELSE 'js-2' END LIKE 'rb%'
 OR NOT (CAST(user_id AS VARCHAR) LIKE '14%')) AND NOT (event_type IN ('click','signup') AND ts < TIMESTAMP '2024-01-15')""")
def _(t):
    tracker = F.when(F.col("event_id") % 3 == 0, "rb-1").otherwise("js-2")
    return P.valid_events(
        t.events, "user_id", tracker, F.col("user_id").cast("string"), "ts", "event_type", ["14"],
        {"click": "2024-01-15", "signup": "2024-01-15"}).select("event_id")


EMAIL = "lower(replace(replace(c_name, '#', CASE WHEN c_nationkey < 5 THEN '+' WHEN c_nationkey < 8 THEN 'test' ELSE '.' END), '00000', '')) || '@x.org'"


@query("prj_18_include_email", f"""
SELECT c_custkey, CASE WHEN c_nationkey < 8 OR email = 'customer.0010@x.org' THEN 'Exclude' ELSE 'Include' END AS verdict
FROM (SELECT *, {EMAIL} AS email FROM customer)""")
def _(t):
    mark = F.when(F.col("c_nationkey") < 5, "+").when(F.col("c_nationkey") < 8, "test").otherwise(".")
    email = F.concat(F.lower(F.replace(F.replace("c_name", F.lit("#"), mark), F.lit("00000"), F.lit(""))), F.lit("@x.org"))
    return t.customer.select("c_custkey", P.include_email(email, listed=["customer.0010@x.org"]).alias("verdict"))


@query("prj_19_exclude_listed", "SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def _(t):
    listed = t.customer.filter("c_mktsegment = 'BUILDING'")
    return P.exclude_listed(t.orders.select("o_orderkey", "o_custkey"), listed, "o_custkey", "c_custkey").select("o_orderkey")


@query("prj_20_flag_listed", "SELECT o_orderkey, o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5) AS is_core FROM orders")
def _(t):
    listed = t.customer.filter("c_nationkey < 5")
    return P.flag_listed(t.orders.select("o_orderkey", "o_custkey"), listed, "o_custkey", "is_core", "c_custkey").select("o_orderkey", "is_core")


@query("prj_21_filter_users", """
SELECT event_id, 'open' AS part FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 1000)
UNION ALL SELECT event_id, 'blocked' FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 1000)""")
def _(t):
    ev, blocked = t.events.select("event_id", "user_id"), F.col("c_acctbal") < 1000
    a = P.filter_users(ev, t.customer, "user_id", "c_custkey", blocked).withColumn("part", F.lit("open"))
    b = P.filter_users(ev, t.customer, "user_id", "c_custkey", blocked, "blocked").withColumn("part", F.lit("blocked"))
    return a.unionByName(b).drop("user_id")
