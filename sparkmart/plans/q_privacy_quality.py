"""PRV and DQ queries."""

from pyspark.sql import functions as F

from sparkmart.functions import money, split_name
from sparkmart.operators import calendar as CAL, privacy as P, quality as Q, scd as S
from sparkmart.plans.registry import dsum, query
from sparkmart.sources import sinks as W, versions as V

SALTS = {"name": "nsalt", "email": "esalt", "ip": "isalt", "other": "osalt"}


def people(t):
    email = F.concat(F.lower("c_name"), F.lit("@x.org"))
    return t.customer.select("c_custkey", "c_name", email.alias("email"), "c_nationkey", "c_acctbal")


@query("prv_1_salted_hash", "SELECT c_custkey, sha256(trim(lower(c_name || 'nsalt'))) AS c_name_hash, sha256(trim(lower(CAST(c_nationkey AS VARCHAR) || 'osalt'))) AS c_nationkey_hash FROM customer")
def _(t):
    return t.customer.select("c_custkey", P.hash_col("c_name", SALTS), P.hash_col("c_nationkey", SALTS))


@query("prv_2_hash_sensitive", "SELECT c_custkey, sha256(lower(c_name) || 'nsalt') AS c_name_hash, sha256(lower(c_name) || '@x.orgesalt') AS email_hash, c_nationkey, c_acctbal FROM customer")
def _(t):
    return P.hash_sensitive(P.tag(people(t), c_name={"sensitive": True}, email={"sensitive": True}), SALTS)


@query("prv_3_sensitive_only", "SELECT sha256(CAST(c_custkey AS VARCHAR) || 'osalt') AS c_custkey_hash, c_name, lower(c_name) || '@x.org' AS email FROM customer")
def _(t):
    return P.sensitive_only(P.tag(people(t), c_name={"sensitive": True}, email={"sensitive": True}), "c_custkey", SALTS)


@query("prv_4_mask", "SELECT c_custkey, '***MASKED***' AS c_name, lower(c_name) || '@x.org' AS email, 0 AS c_nationkey, 0.0::DOUBLE AS c_acctbal FROM customer")
def _(t):
    tagged = P.tag(people(t), c_name={"masking_policy": "people"}, email={"masking_policy": "mail"}, c_nationkey={"masking_policy": "geo"}, c_acctbal={"masking_policy": "finance"})
    return P.mask(tagged, roles=["mail"])


@query("prv_5_erase", """
SELECT c_custkey FROM customer WHERE sha256(lower(c_name) || '@x.org') NOT IN (SELECT sha256(lower(c_name) || '@x.org') FROM customer WHERE c_acctbal < 0 OR c_nationkey = 3)""")
def _(t):
    subjects = people(t).filter("c_acctbal < 0 OR c_nationkey = 3").select(F.sha2("email", 256).alias("email_sha"))
    return P.erase_subjects(people(t), subjects, ["email"]).select("c_custkey")


@query("prv_5_erase_files", """
WITH p AS (SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS part, c_nationkey IN (3, 4) AND c_acctbal < 0 AS gone FROM customer)
SELECT part, COUNT(*) FILTER (NOT gone) AS rows, NOT bool_or(gone) AS kept FROM p GROUP BY 1 HAVING COUNT(*) FILTER (NOT gone) > 0""")
def _(t):
    path = W.scratch(t.spark, "erase")
    V.publish(people(t), path, "c_nationkey")
    before = [r.file for r in V.manifest(t.spark, path).select("file").collect()]
    subjects = people(t).filter("c_acctbal < 0 AND c_nationkey IN (3, 4)").select(F.sha2("email", 256).alias("email_sha"))
    V.erase(t.spark, path, subjects, ["email"], "c_nationkey")
    return V.manifest(t.spark, path).groupBy("part").agg(F.max("rows").alias("rows"), F.bool_and(F.col("file").isin(*before)).alias("kept"))


@query("prv_5_redact", """
SELECT c_custkey, CASE WHEN c_custkey IN (7, 11) THEN 'GDPR Redacted' ELSE c_name END AS c_name, CASE WHEN c_custkey IN (7, 11) THEN sha256(lower(c_name) || '@x.org') ELSE lower(c_name) || '@x.org' END AS email FROM customer""")
def _(t):
    import hashlib
    shas = [hashlib.sha256(f"customer#{k:09d}@x.org".encode()).hexdigest() for k in (7, 11)]
    return P.redact(people(t), shas, ["email"], ["c_name"]).select("c_custkey", "c_name", "email")


@query("prv_6_split_name", """
SELECT doc_id, w[1] AS first_name, array_to_string(w[2:], ' ') AS last_name FROM (SELECT doc_id, string_split(trim(replace(text, chr(10), ' ')), ' ') AS w FROM documents)""")
def _(t):
    first, last = split_name(F.replace("text", F.lit("\n"), F.lit(" ")))
    return t.documents.select("doc_id", first.alias("first_name"), last.alias("last_name"))


# ---------------------------------------------------------------- quality

@query("dq_1_not_null_unique", """
SELECT 'null role' AS test, CAST(COUNT(*) AS BIGINT) AS violations FROM conversations WHERE CASE WHEN role <> 'system' THEN role END IS NULL UNION ALL SELECT 'duplicate line', COUNT(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1)
UNION ALL SELECT 'duplicate order', 0 UNION ALL SELECT 'never filled', 1""")
def _(t):
    n = lambda name, df: df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("test"), "violations")
    role = F.when(F.col("role") != "system", F.col("role"))
    return (n("null role", Q.not_null(t.conversations, role)).unionByName(n("duplicate line", Q.unique(t.lineitem, ["l_orderkey", "l_linenumber"])))
            .unionByName(n("duplicate order", Q.unique(t.orders, "o_orderkey"))).unionByName(n("never filled", Q.at_least_one(t.orders, F.when(F.col("o_totalprice") < -1, 1)))))


SUITE = {
    "orderkey filled": "SELECT COUNT(*) FROM lineitem WHERE l_orderkey IS NULL",
    "flag filled": "SELECT COUNT(*) FROM lineitem WHERE nullif(l_returnflag, 'A') IS NULL",
    "date filled": "SELECT COUNT(*) FROM lineitem WHERE l_shipdate IS NULL",
    "flag filled for parts": "SELECT COUNT(*) FROM lineitem WHERE nullif(l_returnflag, 'A') IS NULL AND l_partkey > 100",
    "line unique": "SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)",
    "order unique": "SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING COUNT(*) > 1)",
    "part unique in returns": "SELECT COUNT(*) FROM (SELECT 1 FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey HAVING COUNT(*) > 1)",
    "order and part": "SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey HAVING COUNT(*) > 1)",
    "tax filled once": "SELECT CASE WHEN COUNT(l_tax) = 0 THEN 1 ELSE 0 END FROM lineitem",
    "never above 100": "SELECT CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END FROM lineitem WHERE l_quantity > 100",
    "flags known": "SELECT COUNT(DISTINCT l_returnflag) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')",
    "numbers known": "SELECT COUNT(DISTINCT l_linenumber) FROM lineitem WHERE l_linenumber NOT IN (1, 2, 3)",
    "part exists": "SELECT COUNT(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)",
    "part is large": "SELECT COUNT(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)",
    "order exists": "SELECT COUNT(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)",
    "price positive": "SELECT COUNT(*) FROM lineitem WHERE NOT l_extendedprice > 0",
    "discount small": "SELECT COUNT(*) FROM lineitem WHERE NOT l_discount < 0.05",
    "many rows": "SELECT CASE WHEN COUNT(*) < 1000000000 THEN 1 ELSE 0 END FROM lineitem",
    "some returns": "SELECT CASE WHEN COUNT(*) < 10 THEN 1 ELSE 0 END FROM lineitem WHERE l_returnflag = 'R'",
    "quantity sold": "SELECT CASE WHEN SUM(l_quantity) < 1000 THEN 1 ELSE 0 END FROM lineitem",
}


def line_suite(t):
    flag = F.nullif(F.col("l_returnflag"), F.lit("A"))
    s = Q.Suite({"lineitem": t.lineitem, "part": t.part, "large_part": t.part.filter("p_size > 10"), "orders": t.orders})
    s.not_null("orderkey filled", "lineitem", "l_orderkey").not_null("flag filled", "lineitem", flag).not_null("date filled", "lineitem", "l_shipdate")
    s.not_null("flag filled for parts", "lineitem", flag, "l_partkey > 100").unique("line unique", "lineitem", ["l_orderkey", "l_linenumber"]).unique("order unique", "lineitem", "l_orderkey")
    s.unique("part unique in returns", "lineitem", "l_partkey", "l_returnflag = 'R'").unique_combination("order and part", "lineitem", ["l_orderkey", "l_partkey"])
    s.at_least_one("tax filled once", "lineitem", "l_tax").at_least_one("never above 100", "lineitem", F.lit(1), "l_quantity > 100")
    s.accepted_values("flags known", "lineitem", "l_returnflag", ["A", "N"]).accepted_values("numbers known", "lineitem", "l_linenumber", [1, 2, 3])
    s.relationships("part exists", "lineitem", "l_partkey", "part", "p_partkey").relationships("part is large", "lineitem", "l_partkey", "large_part", "p_partkey").relationships("order exists", "lineitem", "l_orderkey", "orders", "o_orderkey")
    s.expression_is_true("price positive", "lineitem", "l_extendedprice > 0").expression_is_true("discount small", "lineitem", F.col("l_discount") < 0.05)
    return s.row_count("many rows", "lineitem", 10**9).row_count("some returns", "lineitem", 10, "l_returnflag = 'R'").column_sum("quantity sold", "lineitem", "l_quantity", 1000)


@query("dq_suite", " UNION ALL ".join(f"SELECT '{n}' AS test, CAST(n AS BIGINT) AS violations, n = 0 AS passed FROM ({q}) AS x(n)" for n, q in SUITE.items()))
def _(t):
    return line_suite(t).report()


@query("dq_2_accepted_values", "SELECT o_orderpriority AS value, COUNT(*) AS rows FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1")
def _(t):
    return Q.accepted_values(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]).withColumnRenamed("o_orderpriority", "value")


@query("dq_2_relationships", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def _(t):
    return Q.relationships(t.customer, "c_custkey", t.events, "user_id").select("c_custkey")


@query("dq_3_combination_expression", """
SELECT l_orderkey, l_partkey, CAST(copies AS BIGINT) AS copies FROM (SELECT l_orderkey, l_partkey, COUNT(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1) UNION ALL SELECT o_orderkey, NULL, -1 FROM orders WHERE NOT (o_totalprice > 2000)""")
def _(t):
    a = Q.unique_combination(t.lineitem, ["l_orderkey", "l_partkey"])
    b = Q.expression_is_true(t.orders, "o_totalprice > 2000").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(None).cast("bigint").alias("l_partkey"), F.lit(-1).cast("bigint").alias("copies"))
    return a.unionByName(b)


@query("dq_4_row_count", "SELECT COUNT(*) AS row_count FROM lineitem WHERE l_returnflag = 'A' HAVING COUNT(*) < 100000000")
def _(t):
    return Q.row_count(t.lineitem, 100_000_000, "l_returnflag = 'A'")


@query("dq_5_column_sum", f"SELECT {dsum('o_totalprice')} AS column_sum FROM orders")
def _(t):
    return Q.column_sum(t.orders, money("o_totalprice"), 10**15)


@query("dq_6_new_rows_per_day", "SELECT '2024-01-16' AS day, COUNT(*) AS row_count FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-16'")
def _(t):
    return Q.new_rows_per_day(t.events, "ts", "2024-01-17", 10**9)


@query("dq_7_monthly_within_stdevs", """
SELECT CAST(month AS VARCHAR) AS month, n AS new_records, round(th, 6) AS threshold FROM (SELECT *, AVG(n) OVER () + stddev_samp(n) OVER () AS th FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS n FROM orders GROUP BY 1)) WHERE n > th""")
def _(t):
    return Q.monthly_rows_within(t.orders, "o_orderdate", 1.0).withColumn("threshold", F.round("threshold", 6))


@query("dq_8_golden_records", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey FROM customer WHERE c_nationkey >= 20 AND c_mktsegment = 'BUILDING'")
def _(t):
    segment = F.when((F.col("c_nationkey") >= 20) & (F.col("c_mktsegment") == "BUILDING"), "WRONG").when(F.col("c_nationkey") >= 15, F.col("c_mktsegment"))
    golden = t.customer.select("c_custkey", F.when(F.col("c_nationkey") >= 15, F.col("c_mktsegment")).alias("s"))
    return Q.golden_records(golden, t.customer.select("c_custkey", segment.alias("s"))).select("c_custkey")


@query("dq_9_existence", "SELECT n AS rows_checked, unnest(['o_clerk', 'o_comment']) AS missing FROM (SELECT COUNT(*) AS n FROM orders)")
def _(t):
    missing = Q.missing_columns(t.orders, ["o_orderkey", "o_clerk", "o_comment"])
    return t.orders.agg(F.count(F.lit(1)).alias("rows_checked")).withColumn("missing", F.explode(F.array(*[F.lit(c) for c in missing])))


@query("dq_10_freshness", """
SELECT source, last_loaded_at, round(epoch(TIMESTAMP '2024-02-01' - last_loaded_at) / 3600, 3) AS age_hours, CASE WHEN source = 'orders' THEN 'error' ELSE 'warn' END AS state FROM (SELECT 'orders' AS source, MAX(o_orderdate) AS last_loaded_at FROM orders UNION ALL SELECT 'events', MAX(date_trunc('second', ts)) FROM events)""")
def _(t):
    ev = t.events.select(F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"))
    df = Q.freshness({"orders": (t.orders, "o_orderdate"), "events": (ev, "ts")}, "2024-02-01", 24, 24 * 30)
    return df.withColumn("age_hours", F.round("age_hours", 3))


@query("dq_11_count_by_date", "SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, COUNT(*) AS row_count FROM orders GROUP BY 1")
def _(t):
    return Q.count_by_date(t.orders, "o_orderdate")


@query("dq_12_count_deviation", """
SELECT CAST(coalesce(a.d, b.d) AS VARCHAR) AS date, coalesce(n, 0) AS source_count, coalesce(m, 0) AS target_count, coalesce(n, 0) - coalesce(m, 0) AS deviation FROM (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n FROM orders GROUP BY 1) a FULL JOIN (SELECT CAST(l_shipdate AS DATE) AS d, COUNT(*) AS m FROM lineitem GROUP BY 1) b ON a.d = b.d""")
def _(t):
    return Q.count_deviation(t.orders.select(F.to_date("o_orderdate").alias("date")), t.lineitem.select(F.to_date("l_shipdate").alias("date")), ["date"])


@query("dq_13_detection_rules", """
WITH c AS (SELECT 1 AS rule_id, CAST(ts AS DATE) AS d, COUNT(DISTINCT user_id) AS processed, COUNT(DISTINCT CASE WHEN value > 10 THEN user_id END) AS passed FROM events GROUP BY 2 UNION ALL SELECT 2, CAST(ts AS DATE), COUNT(DISTINCT event_id), COUNT(DISTINCT CASE WHEN event_type <> 'error' THEN event_id END) FROM events GROUP BY 2),
 r AS (SELECT CAST(unnest(generate_series((SELECT MIN(CAST(ts AS DATE)) FROM events), (SELECT MAX(CAST(ts AS DATE)) FROM events) + INTERVAL 3 DAY, INTERVAL 1 DAY)) AS DATE) AS d)
SELECT CAST(r.d AS VARCHAR) AS run_date, rule_id, processed, passed, processed - passed AS failed, md5(CAST(r.d AS VARCHAR) || '-' || coalesce(CAST(rule_id AS VARCHAR), '')) AS primary_key FROM c RIGHT JOIN r USING (d)""")
def _(t):
    bounds = t.events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    dates = CAL.date_spine(bounds, "lo", F.date_add("hi", 3), out="run_date")
    rules = {1: (t.events, "user_id", F.col("value") > 10, "ts"), 2: (t.events, "event_id", F.col("event_type") != "error", "ts")}
    return Q.detection_rules(rules, dates)


@query("dq_14_scd_audit", """
SELECT o_custkey, COUNT(*) AS current_rows FROM (SELECT o_custkey, o_orderdate = MAX(o_orderdate) OVER (PARTITION BY o_custkey) AS cur FROM orders) WHERE cur GROUP BY 1 HAVING COUNT(*) > 1 UNION ALL SELECT -1, 0""")
def _(t):
    from sparkmart.operators import windows as wn
    df = wn.partition_agg(t.orders.select("o_custkey", "o_orderdate"), ["o_custkey"], last=F.max("o_orderdate"))
    bad = S.multi_current(df.withColumn("is_currently_valid", F.col("o_orderdate") == F.col("last")), "o_custkey")
    # A marker row keeps the result visible when every key passes.
    return bad.unionByName(t.spark.range(1).select(F.lit(-1).cast("bigint").alias("o_custkey"), F.lit(0).cast("bigint").alias("current_rows")))


@query("dq_15_allow_list", """
SELECT CAST(k AS INTEGER) AS value, 'not allowed' AS problem FROM (SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) UNION ALL SELECT k, 'not used' FROM (SELECT s_nationkey AS k FROM supplier WHERE s_acctbal > 5000 EXCEPT SELECT c_nationkey FROM customer)""")
def _(t):
    return Q.allow_list(t.customer, "c_nationkey", t.supplier.filter("s_acctbal > 5000"), "s_nationkey")
