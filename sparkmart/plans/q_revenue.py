"""REV queries. Orders stand for charges: a customer's monthly order value is its revenue."""

from pyspark.sql import functions as F

from sparkmart.functions import money, trunc_to
from sparkmart.operators import calendar as CAL, revenue as R, windows as wn
from sparkmart.plans.registry import by_day, dsum, query

CATEGORY = {"1-URGENT": 3, "2-HIGH": 2, "3-MEDIUM": 1}
RANK_SQL = "CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1 ELSE 0 END"
ARR_SQL = f"""SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS arr, CAST(SUM(coalesce(q, 0)) AS BIGINT) AS quantity, MAX({RANK_SQL}) AS product_ranking,
 array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS product_category FROM orders LEFT JOIN (SELECT l_orderkey, SUM(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1, 2"""
GRID_SQL = f"""
WITH a AS ({ARR_SQL}), g AS (SELECT o_custkey, CAST(unnest(generate_series(MIN(month), MAX(month) + INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS DATE) AS month FROM a GROUP BY 1),
 m AS (SELECT g.o_custkey, g.month, coalesce(arr, 0) AS arr, coalesce(quantity, 0) AS quantity, coalesce(product_ranking, 0) AS product_ranking, product_category FROM g LEFT JOIN a USING (o_custkey, month)),
 p AS (SELECT *, coalesce(lag(arr) OVER w, 0) AS parr, coalesce(lag(quantity) OVER w, 0) AS pq, coalesce(lag(product_ranking) OVER w, 0) AS pr, lag(product_category) OVER w AS pc, row_number() OVER w AS rn FROM m WINDOW w AS (PARTITION BY o_custkey ORDER BY month))"""


def monthly(t):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("q"))
    rank = F.when(F.col("o_orderpriority") == "1-URGENT", 3).when(F.col("o_orderpriority") == "2-HIGH", 2).when(F.col("o_orderpriority") == "3-MEDIUM", 1).otherwise(0)
    df = t.orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return df.groupBy("o_custkey", trunc_to("month", "o_orderdate").cast("date").alias("month")).agg(
        F.sum(money("o_totalprice")).alias("arr"), F.sum(F.coalesce("q", F.lit(0))).alias("quantity"), F.max(rank).alias("product_ranking"),
        F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("product_category"))


def change(t):
    return R.arr_change(monthly(t), "o_custkey", "month", ["arr", "quantity", "product_ranking", "product_category"])


CHARGES_SQL = """SELECT l_suppkey, l_returnflag, CAST(date_trunc('month', l_shipdate) AS DATE) AS s, CASE WHEN l_linenumber < 6 THEN CAST(date_trunc('month', l_shipdate) + CAST(l_quantity % 12 AS INTEGER) * INTERVAL 1 MONTH AS DATE) END AS e, l_extendedprice, l_quantity FROM lineitem"""
FACTS_SQL = f"""SELECT l_suppkey, l_returnflag, m AS charge_month, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS mrr, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) * 12 AS DOUBLE) AS arr, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
 FROM ({CHARGES_SQL}) JOIN (SELECT CAST(unnest(generate_series(DATE '1994-01-01', DATE '2004-01-01', INTERVAL 1 MONTH)) AS DATE) AS m) ON s <= m AND (e > m OR (e IS NULL AND m <= DATE '2002-01-15')) GROUP BY 1, 2, 3"""


def facts(t):
    s = F.trunc("l_shipdate", "month")
    charges = t.lineitem.select("l_suppkey", "l_returnflag", s.alias("s"), F.when(F.col("l_linenumber") < 6, F.add_months(s, (F.col("l_quantity") % 12).cast("int"))).alias("e"), "l_extendedprice", "l_quantity")
    return R.mrr_monthly(charges, "s", "e", ["l_suppkey", "l_returnflag"], "2002-01-15",
                         {"mrr": money("l_extendedprice"), "arr": money("l_extendedprice") * 12, "quantity": F.col("l_quantity").cast("long")})


@query("rev_1_mrr_monthly", f"SELECT l_suppkey, l_returnflag, CAST(charge_month AS VARCHAR) AS charge_month, mrr, arr, quantity FROM ({FACTS_SQL})")
def _(t):
    return facts(t)


@query("rev_2_split_by", f"""
SELECT l_suppkey, CAST(charge_month AS VARCHAR) AS charge_month, CAST(SUM(CAST(mrr AS DECIMAL(18,2))) AS DOUBLE) AS total_mrr, CAST(SUM(CAST(mrr AS DECIMAL(18,2))) FILTER (l_returnflag = 'A') AS DOUBLE) AS sm_mrr,
 CAST(SUM(CAST(mrr AS DECIMAL(18,2))) FILTER (l_returnflag = 'N') AS DOUBLE) AS saas_mrr, CAST(SUM(CAST(mrr AS DECIMAL(18,2))) FILTER (l_returnflag NOT IN ('A', 'N')) AS DOUBLE) AS other_mrr FROM ({FACTS_SQL}) GROUP BY 1, 2""")
def _(t):
    return R.split_by(facts(t), ["l_suppkey", "charge_month"], "l_returnflag", {"sm": "A", "saas": "N"}, ["mrr"])


CHANGE_CASE = "CASE WHEN rn = 1 THEN 'New' WHEN arr = 0 AND parr > 0 THEN 'Churn' WHEN arr < parr AND arr > 0 THEN 'Contraction' WHEN arr > parr AND rn > 1 THEN 'Expansion' WHEN arr = parr THEN 'No Impact' END"


@query("rev_3_arr_change", GRID_SQL + f" SELECT o_custkey, CAST(month AS VARCHAR) AS month, CAST(arr AS DOUBLE) AS arr, CAST(parr AS DOUBLE) AS previous_arr, rn AS month_no, {CHANGE_CASE} AS type_of_arr_change FROM p")
def _(t):
    return change(t).select("o_custkey", "month", "arr", "previous_arr", F.col("month_no").cast("long"), "type_of_arr_change")


PRICE = "quantity * (CAST(arr AS DOUBLE) / nullif(quantity, 0) - CAST(parr AS DOUBLE) / nullif(pq, 0))"


@query("rev_4_arr_change_reason", GRID_SQL + f"""
SELECT o_custkey, CAST(month AS VARCHAR) AS month, CASE WHEN pq <> quantity AND pq > 0 THEN coalesce(CAST(parr AS DOUBLE) / nullif(pq, 0) * (quantity - pq), 0) WHEN pq <> quantity AND pq = 0 THEN CAST(arr AS DOUBLE) ELSE 0 END AS seat_change_arr,
 CASE WHEN pc = product_category OR (pc <> product_category AND pr = product_ranking) THEN {PRICE} ELSE 0 END AS price_change_arr, CASE WHEN pr <> product_ranking THEN coalesce({PRICE}, 0) ELSE 0 END AS tier_change_arr,
 CASE WHEN pq <> quantity THEN quantity - pq ELSE 0 END AS seat_change_quantity, coalesce(CAST(arr AS DOUBLE) / nullif(quantity, 0) - CAST(parr AS DOUBLE) / nullif(pq, 0), 0) AS annual_price_per_seat_change FROM p""")
def _(t):
    df = R.arr_change_reason(change(t))
    return df.select("o_custkey", "month", "seat_change_quantity", "seat_change_arr", "price_change_arr", "tier_change_arr", "annual_price_per_seat_change")


@query("rev_5_retention", f"""
SELECT o_custkey, CAST(a.month AS VARCHAR) AS original_month, CAST(CAST(a.month + INTERVAL 12 MONTH AS DATE) AS VARCHAR) AS retention_month, CAST(a.arr AS DOUBLE) AS original_mrr, CAST(b.arr AS DOUBLE) AS retention_mrr, CAST(coalesce(b.arr, 0) AS DOUBLE) AS net_retention_mrr,
 CAST(CASE WHEN coalesce(b.arr, 0) > 0 THEN least(b.arr, a.arr) ELSE 0 END AS DOUBLE) AS gross_retention_mrr, CASE WHEN b.arr IS NULL AND a.arr > 0 THEN 'Cancelled' WHEN b.arr < a.arr THEN 'Downgraded' WHEN b.arr > a.arr THEN 'Upgraded' ELSE 'Maintained' END AS churn_type
FROM ({ARR_SQL}) a LEFT JOIN (SELECT o_custkey, month, arr FROM ({ARR_SQL})) b USING (o_custkey) WHERE b.month = a.month + INTERVAL 12 MONTH OR 1 = 0
UNION ALL SELECT o_custkey, CAST(a.month AS VARCHAR), CAST(CAST(a.month + INTERVAL 12 MONTH AS DATE) AS VARCHAR), CAST(a.arr AS DOUBLE), NULL, 0, 0, 'Cancelled' FROM ({ARR_SQL}) a WHERE (o_custkey, CAST(a.month + INTERVAL 12 MONTH AS DATE)) NOT IN (SELECT (o_custkey, month) FROM ({ARR_SQL}))""")
def _(t):
    return R.retention(monthly(t), "o_custkey", "month", "arr")


PAIR_SQL = f"""SELECT a.o_custkey, a.month, a.arr AS om, b.arr AS nm, a.quantity AS os, b.quantity AS ns, a.product_ranking AS orank, b.product_ranking AS nrank, a.product_category AS oc, b.product_category AS nc, CASE WHEN a.quantity > 20 THEN 'Seats' ELSE 'Minutes' END AS ou
 FROM ({ARR_SQL}) a JOIN ({ARR_SQL}) b ON a.o_custkey = b.o_custkey AND b.month = a.month + INTERVAL 12 MONTH"""


@query("rev_6_retention_reason", f"""
SELECT o_custkey, CAST(month AS VARCHAR) AS month, CASE WHEN nm = 0 THEN 'Cancelled' WHEN nm < om THEN 'Downgraded' WHEN nm > om THEN 'Upgraded' ELSE 'Maintained' END AS retention_type,
 CASE WHEN oc = nc AND om > nm AND os > ns AND po > pn THEN 'Price Change/Seat Change Mix' WHEN oc = nc AND om < nm AND os < ns AND po < pn THEN 'Price Change/Seat Change Mix' WHEN oc = nc AND om > nm AND os > ns THEN 'Seat Change' WHEN oc = nc AND om < nm AND os < ns THEN 'Seat Change'
  WHEN oc = nc AND om <> nm THEN 'Price Change' WHEN os = ns AND om > nm AND orank < nrank THEN 'Price Change' WHEN os = ns AND om < nm AND orank > nrank THEN 'Price Change' WHEN oc <> nc AND os = ns THEN 'Product Change' WHEN oc <> nc AND os <> ns THEN 'Product Change/Seat Change Mix' ELSE 'Unknown' END AS reason,
 CASE WHEN nrank = 0 OR orank = 0 THEN 'Not Valid' WHEN orank = nrank THEN 'Maintained' WHEN orank > nrank THEN 'Downgraded' ELSE 'Upgraded' END AS plan_change,
 CASE WHEN ou <> 'Seats' THEN 'Not Valid' WHEN os = ns THEN 'Maintained' WHEN os > ns THEN 'Contraction' ELSE 'Expansion' END AS seat_change, round(CASE WHEN ou = 'Seats' THEN pn - po END, 4) AS price_per_seat_change
FROM (SELECT *, CAST(om AS DOUBLE) / nullif(os, 0) AS po, CAST(nm AS DOUBLE) / nullif(ns, 0) AS pn FROM ({PAIR_SQL}))""")
def _(t):
    m = monthly(t)
    cols = {"arr": "m", "quantity": "s", "product_ranking": "rank", "product_category": "c"}
    now = m.select("o_custkey", "month", *[F.col(c).alias("o" + n) for c, n in cols.items()])
    later = m.select("o_custkey", F.add_months("month", -12).alias("month"), *[F.col(c).alias("n" + n) for c, n in cols.items()])
    df = now.join(later, ["o_custkey", "month"]).withColumn("unit", F.when(F.col("os") > 20, "Seats").otherwise("Minutes"))
    return df.select(
        "o_custkey", "month", R.retention_type("om", "nm").alias("retention_type"), R.retention_reason("om", "oc", "orank", "os", "nm", "nc", "nrank", "ns").alias("reason"),
        R.plan_change("orank", "om", "nrank", "nm").alias("plan_change"), R.seat_change("os", "unit", "om", "ns", F.lit("Seats"), "nm").alias("seat_change"),
        F.round(R.price_per_seat_change("om", "os", "unit", "nm", "ns", F.lit("Seats")), 4).alias("price_per_seat_change"))


@query("rev_7_cohort_age", f"""
SELECT o_custkey, CAST(month AS VARCHAR) AS month, CAST(c AS VARCHAR) AS cohort_month, date_diff('month', c, month) AS months_since_start, date_diff('quarter', c, month) AS quarters_since_start FROM (SELECT *, MIN(month) OVER (PARTITION BY o_custkey) AS c FROM ({ARR_SQL}))""")
def _(t):
    return R.cohort_age(monthly(t).select("o_custkey", "month"), ["o_custkey"], "month")


@query("rev_8_charge_delta", """
SELECT o_orderkey, CAST(coalesce(prev, 0) AS DOUBLE) AS previous_mrr, CAST(CASE WHEN is_last AND (o_orderstatus = 'F' OR (o_orderstatus = 'O' AND o_orderdate + INTERVAL 365 DAY <= TIMESTAMP '2001-06-30')) THEN -coalesce(prev, 0) ELSE mrr - coalesce(prev, 0) END AS DOUBLE) AS delta_mrr
FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS mrr, lag(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS prev, lead(o_orderkey) OVER w IS NULL AS is_last FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))""")
def _(t):
    status = F.when(F.col("o_orderstatus") == "F", "Cancelled").when(F.col("o_orderstatus") == "O", "Active").otherwise("Draft")
    df = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", money("o_totalprice").alias("mrr"), status.alias("status"), F.date_add("o_orderdate", 365).alias("end_date"))
    out = R.charge_delta(df, ["o_custkey"], ["o_orderdate", "o_orderkey"], "mrr", "status", "end_date", "2001-06-30", chunk=by_day("o_orderdate"))
    return out.select("o_orderkey", "previous_mrr", "delta_mrr")


@query("rev_9_amortise", """
SELECT o_orderkey, n AS term_months, round(CAST(o_totalprice AS DOUBLE) / nullif(n, 0), 6) AS mrr, CAST(e + 1 AS VARCHAR) AS effective_end
FROM (SELECT *, CAST(round(date_diff('month', s, e) + (day(e) - day(s)) / 31.0) AS INTEGER) AS n FROM (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS s, last_day(o_orderdate + CAST(o_custkey % 18 AS INTEGER) * INTERVAL 1 MONTH) AS e FROM orders))""")
def _(t):
    s = F.trunc("o_orderdate", "month")
    df = t.orders.select("o_orderkey", "o_totalprice", s.alias("s"), F.last_day(F.add_months("o_orderdate", (F.col("o_custkey") % 18).cast("int"))).alias("e"))
    return R.amortise(df, "o_totalprice", "s", "e").select("o_orderkey", "term_months", F.round("mrr", 6).alias("mrr"), "effective_end")


WF_SQL = """
WITH s AS (SELECT o_custkey AS contract, l_orderkey AS line, l_returnflag AS segment, year(o_orderdate) * 12 + month(o_orderdate) AS c, greatest(year(o_orderdate) * 12 + month(o_orderdate), year(l_shipdate) * 12 + month(l_shipdate)) AS p, CAST(l_extendedprice AS DECIMAL(18,2)) AS x FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
 b AS (SELECT contract, line, segment, a AS as_of, p, SUM(x) AS amount FROM (SELECT *, unnest(generate_series(c, p)) AS a FROM s) GROUP BY 1, 2, 3, 4, 5),
 l AS (SELECT contract, line, segment, MIN(lo) AS lo FROM (SELECT *, MIN(p) OVER (PARTITION BY contract, line) AS lo, rank() OVER (PARTITION BY contract, line ORDER BY as_of DESC, p DESC) AS r FROM b) WHERE r = 1 GROUP BY 1, 2, 3),
 g AS (SELECT l.contract, l.line, l.segment, unnest(generate_series(lo, hi)) AS p FROM l JOIN (SELECT contract, MAX(p) AS hi FROM b GROUP BY 1) e USING (contract)),
 f AS (SELECT contract, line, segment, p AS as_of, p, 0 AS amount FROM g WHERE (line, p) NOT IN (SELECT (line, p) FROM b WHERE as_of = p)),
 u AS (SELECT * FROM b UNION ALL SELECT * FROM f),
 r AS (SELECT line, segment, as_of, SUM(a) OVER (PARTITION BY line, segment ORDER BY as_of ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM (SELECT line, segment, as_of, SUM(amount) AS a FROM u WHERE as_of = p GROUP BY 1, 2, 3))"""


@query("rev_10_waterfall", WF_SQL + """
SELECT u.as_of AS as_of_period, u.segment, COUNT(*) AS n, CAST(SUM(amount) AS DOUBLE) AS amount, CAST(SUM(coalesce(prior, 0)) AS DOUBLE) AS prior_total, """ + ", ".join(
    f"CAST(SUM(CASE WHEN (p - 1) // 12 = {y} THEN amount ELSE 0 END) AS DOUBLE) AS y{y}" for y in range(1995, 2002)) + " FROM u LEFT JOIN r USING (line, segment, as_of) GROUP BY 1, 2")
def _(t):
    num = lambda c: F.year(c) * 12 + F.month(c)
    df = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    df = df.select(F.col("o_custkey").alias("contract"), F.col("l_orderkey").alias("line"), F.col("l_returnflag").alias("segment"), num("o_orderdate").alias("c"), F.greatest(num("o_orderdate"), num("l_shipdate")).alias("p"), money("l_extendedprice").alias("x"))
    out = R.waterfall(df, "line", "contract", "segment", "c", "p", "x")
    # Summed by year first: two decimal sums a row instead of nine.
    out = out.groupBy("as_of_period", "segment", F.floor((F.col("period") - 1) / 12).alias("year")).agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"), F.sum("prior_total").alias("prior_total"))
    return out.groupBy("as_of_period", "segment").agg(F.sum("n").alias("n"), F.sum("amount").alias("amount"), F.sum("prior_total").alias("prior_total"),
                                                      *[F.sum(F.when(F.col("year") == y, F.col("amount")).otherwise(0)).alias(f"y{y}") for y in range(1995, 2002)])


@query("rev_11_renewals", """
SELECT o_custkey, CAST(MIN(e) FILTER (e >= DATE '1999-06-01') AS VARCHAR) AS next_renewal_month, CAST(MAX(e) FILTER (e < DATE '1999-06-01') AS VARCHAR) AS last_renewal_month FROM (SELECT o_custkey, CAST(date_trunc('month', o_orderdate + INTERVAL 12 MONTH) AS DATE) AS e FROM orders) GROUP BY 1""")
def _(t):
    df = t.orders.select("o_custkey", F.add_months(F.trunc("o_orderdate", "month"), 12).alias("e"))
    return R.renewals(df, "o_custkey", "e", "1999-06-17")


@query("rev_12_base_currency", """
SELECT n_regionkey, y, round(SUM(CAST(CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END * CASE WHEN n_regionkey = 1 THEN o_totalprice ELSE o_totalprice * rate END AS DECIMAL(18,4))), 2)::DOUBLE AS amount FROM
 (SELECT n_regionkey, year(o_orderdate) AS y, o_orderstatus, o_totalprice, 0.5 + n_regionkey * 0.25 + (year(o_orderdate) - 1995) * 0.125 AS rate FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) GROUP BY 1, 2""")
def _(t):
    years = t.orders.select(F.year("o_orderdate").alias("y")).distinct()
    rates = years.select("y", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("n_regionkey"))
    rates = rates.withColumn("average_rate", 0.5 + F.col("n_regionkey") * 0.25 + (F.col("y") - 1995) * 0.125)
    lines = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("n_regionkey", F.year("o_orderdate").alias("y"), "o_orderstatus", "o_totalprice")
    out = R.to_base_currency(lines, rates, ["y", "n_regionkey"], "o_totalprice", "n_regionkey", 1, sign=F.when(F.col("o_orderstatus") == "F", -1).otherwise(1))
    return out.groupBy("n_regionkey", "y").agg(F.round(F.sum(F.col("actual_amount").cast("decimal(18,4)")), 2).alias("amount"))


@query("rev_13_paid_share", """
SELECT o_orderkey, round(CAST(o_totalprice AS DOUBLE) / (o_totalprice * (o_custkey % 3 + 1)), 6) AS pct_paid, CASE WHEN s <= 250 THEN '[01] 0-250' WHEN s <= 500 THEN '[02] 250-500' WHEN s <= 1000 THEN '[03] 500-1K' WHEN s <= 2500 THEN '[04] 1K-2.5K' WHEN s <= 5000 THEN '[05] 2.5K-5K' WHEN s <= 10000 THEN '[06] 5K-10K' WHEN s <= 25000 THEN '[07] 10K-25K' WHEN s <= 50000 THEN '[08] 25K-50K' WHEN s <= 100000 THEN '[09] 50K-100K' WHEN s <= 500000 THEN '[10] 100K-500K' WHEN s <= 1000000 THEN '[11] 500K-1M' ELSE '[12] 1M+' END AS arr_bucket,
 CASE WHEN n <= 5 THEN '[01] 1-5' WHEN n <= 7 THEN '[02] 6-7' WHEN n <= 10 THEN '[03] 8-10' WHEN n <= 15 THEN '[04] 11-15' ELSE '[05] 16-50' END AS seat_bucket
FROM (SELECT *, SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey, o_orderstatus) AS s, COUNT(*) OVER (PARTITION BY o_custkey, o_orderstatus) AS n FROM orders)""")
def _(t):
    df = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", money("o_totalprice").alias("arr"), (F.col("o_custkey") % 3 + 1).alias("years"), F.lit(1).alias("quantity"))
    return R.paid_share(df, ["o_custkey", "o_orderstatus"], "arr", "arr", "years", "quantity").select("o_orderkey", F.round("pct_paid", 6).alias("pct_paid"), "arr_bucket", "seat_bucket")


@query("rev_14_net_cost", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) + coalesce(c, 0) AS DOUBLE) AS total_cost, CAST(c AS DOUBLE) AS total_credits FROM orders LEFT JOIN (SELECT l_orderkey, -SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS c FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON l_orderkey = o_orderkey""")
def _(t):
    usage = t.orders.select("o_orderkey", money("o_totalprice").alias("cost"))
    credits = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), (-money("l_extendedprice")).alias("credit"))
    return R.net_cost(usage, credits, "o_orderkey", "cost", "credit").select("o_orderkey", "total_cost", "total_credits")


# Lineitem rows are snapshots of the order's deal: taken at ship date, closing a little later.
SNAP_SQL = """SELECT l_orderkey, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS q, CAST(date_trunc('quarter', l_shipdate + CAST(l_quantity AS INTEGER) * INTERVAL 1 DAY) AS DATE) AS cq, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS oq,
 date_diff('day', date_trunc('quarter', l_shipdate), l_shipdate) % 9 + 1 AS d, l_linestatus, l_returnflag, o_orderpriority FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""


@query("rev_15_pipeline_movement", f"""
SELECT deal, CAST(quarter AS VARCHAR) AS quarter, first_day, CASE WHEN st = 5 THEN '1. Starting' WHEN w THEN '4. Web Direct' WHEN b AND st IS NULL THEN '2. Created & Landed' ELSE '3. Pulled in' END AS pipeline_type
FROM (SELECT l_orderkey AS deal, q AS quarter, MIN(d) AS first_day, MAX(d) FILTER (d <= 5 AND l_returnflag <> 'R') AS st, bool_or(l_returnflag = 'R') AS w, bool_or(oq = q AND l_linestatus = 'O') AS b FROM ({SNAP_SQL}) WHERE q = cq AND o_orderpriority <> '5-LOW' GROUP BY 1, 2)""")
def _(t):
    df = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey"))
    q = lambda c: F.trunc(c, "quarter")
    df = df.select("l_orderkey", q("l_shipdate").alias("q"), q(F.date_add("l_shipdate", F.col("l_quantity").cast("int"))).alias("cq"), q("o_orderdate").alias("oq"),
                   (F.datediff("l_shipdate", q("l_shipdate")) % 9 + 1).alias("d"), "l_linestatus", "l_returnflag", "o_orderpriority")
    return R.pipeline_movement(df, "l_orderkey", "q", "cq", "oq", "d", F.col("o_orderpriority") != "5-LOW", F.col("l_returnflag") == "R", F.col("l_linestatus") == "O")


@query("rev_16_pipeline_velocity", """
WITH f AS (SELECT *, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS q, date_diff('day', date_trunc('quarter', o_orderdate), o_orderdate) + 1 AS d FROM orders),
 m AS (SELECT o_orderstatus AS k, q, d, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS open_arr, SUM(CASE WHEN o_orderpriority LIKE '1%' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS urgent_arr FROM f GROUP BY 1, 2, 3),
 t AS (SELECT l_linestatus AS k, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS q, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS target FROM lineitem GROUP BY 1, 2),
 g AS (SELECT k, q, unnest(generate_series(1, 90)) AS d FROM t UNION SELECT k, q, d FROM m)
SELECT k, CAST(g.q AS VARCHAR) AS q, CAST(g.d AS BIGINT) AS d, CAST(coalesce(open_arr, 0) AS DOUBLE) AS open_arr, CAST(coalesce(urgent_arr, 0) AS DOUBLE) AS urgent_arr, CAST(coalesce(target, 0) AS DOUBLE) AS target FROM g LEFT JOIN m USING (k, q, d) LEFT JOIN t USING (k, q)""")
def _(t):
    df = t.orders.select(F.col("o_orderstatus").alias("k"), F.trunc("o_orderdate", "quarter").alias("q"), (F.datediff("o_orderdate", F.trunc("o_orderdate", "quarter")) + 1).alias("d"), "o_totalprice", "o_orderpriority")
    targets = t.lineitem.select(F.col("l_linestatus").alias("k"), F.trunc("l_shipdate", "quarter").alias("q"), money("l_extendedprice").alias("x"))
    return R.pipeline_velocity(df, targets, ["k"], "q", "d", 90, "x", open_arr=F.sum(money("o_totalprice")), urgent_arr=F.sum(F.when(F.col("o_orderpriority").startswith("1"), money("o_totalprice")).otherwise(0)))


@query("rev_17_qtd_metrics", """
SELECT c_nationkey, CAST(SUM(x) FILTER (q = DATE '1999-05-01' AND o_orderstatus = 'O') AS DOUBLE) AS qtd_open, CAST(SUM(x) FILTER (q = DATE '1999-05-01' AND o_orderstatus = 'F') AS DOUBLE) AS qtd_won, COUNT(*) FILTER (q = DATE '1999-05-01' AND o_orderstatus = 'O') AS qtd_open_deals,
 CAST(SUM(x) FILTER (q BETWEEN DATE '1999-05-01' AND DATE '2000-05-01' AND o_orderstatus = 'O') AS DOUBLE) AS next_4q_open, CAST(SUM(x) FILTER (q = DATE '1998-05-01' AND o_orderstatus = 'F') AS DOUBLE) AS minus_1_year_won
FROM (SELECT c_nationkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS x, CAST(date_trunc('quarter', date_trunc('month', o_orderdate) - INTERVAL 1 MONTH) + INTERVAL 1 MONTH AS DATE) AS q FROM orders JOIN customer ON c_custkey = o_custkey) GROUP BY 1""")
def _(t):
    df = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).select("c_nationkey", "o_orderstatus", money("o_totalprice").alias("x"), CAL.fiscal_start("quarter", "o_orderdate").alias("q"))
    out = R.qtd_metrics(df, ["c_nationkey"], "q", "1999-06-17", "x", F.col("o_orderstatus") == "O", F.col("o_orderstatus") == "F")
    return out.select("c_nationkey", *[F.when(F.col(c) != 0, F.col(c)).alias(c) for c in ("qtd_open", "qtd_won")], "qtd_open_deals", *[F.when(F.col(c) != 0, F.col(c)).alias(c) for c in ("next_4q_open", "minus_1_year_won")])


@query("rev_18_priority_score", """
SELECT o_orderkey, round(g * gw + k * kw, 4) AS combined_score, round((g * gw + k * kw) * u, 4) AS priority_score FROM (SELECT *, coalesce(CAST(gp AS DECIMAL(20,8))::DOUBLE / nullif(SUM(CAST(gp AS DECIMAL(20,8))) OVER (PARTITION BY c_nationkey, o_custkey)::DOUBLE, 0), 0) AS gw,
 coalesce(CAST(kp AS DECIMAL(20,8))::DOUBLE / nullif(SUM(CAST(kp AS DECIMAL(20,8))) OVER (PARTITION BY c_nationkey)::DOUBLE, 0), 0) AS kw FROM (SELECT *, p * (g / nullif(g + k, 0)) AS gp, p * (k / nullif(g + k, 0)) AS kp FROM
 (SELECT o_orderkey, o_custkey, c_nationkey, 6 - CAST(o_orderpriority[1] AS INTEGER) AS p, o_totalprice AS g, c_acctbal AS k, CASE WHEN o_orderstatus = 'O' THEN 2.5 ELSE 1 END::DOUBLE AS u FROM orders JOIN customer ON c_custkey = o_custkey)))""")
def _(t):
    df = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    df = df.select("o_orderkey", "o_custkey", "c_nationkey", (6 - F.substring("o_orderpriority", 1, 1).cast("int")).alias("p"), "o_totalprice", "c_acctbal", F.when(F.col("o_orderstatus") == "O", 2.5).otherwise(1.0).alias("u"))
    out = R.priority_score(df, "c_nationkey", "o_custkey", "p", "o_totalprice", "c_acctbal", "u")
    return out.select("o_orderkey", F.round("combined_score", 4).alias("combined_score"), F.round("priority_score", 4).alias("priority_score"))


@query("rev_19_prune_terms", """
SELECT o_orderkey FROM (SELECT *, rank() OVER (PARTITION BY o_custkey, s ORDER BY (o_orderdate, o_orderkey) DESC) AS r FROM (SELECT *, lead(e) OVER w = e OR lead(e, 2) OVER w = e OR lead(fy) OVER w = fy OR lead(s) OVER w = s OR MIN(s) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 1 FOLLOWING AND 14 FOLLOWING) < s AS old
 FROM (SELECT *, year(e) AS fy FROM (SELECT *, CAST(date_trunc('month', o_orderdate + CAST(o_totalprice % 500 AS INTEGER) * INTERVAL 1 DAY) AS DATE) AS s, CAST(date_trunc('month', o_orderdate + 365 * INTERVAL 1 DAY + CAST(o_totalprice % 700 AS INTEGER) * INTERVAL 1 DAY) AS DATE) AS e FROM (SELECT * REPLACE (floor(o_totalprice) AS o_totalprice) FROM orders)))
 WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) WHERE NOT coalesce(old, false)) WHERE r = 1""")
def _(t):
    price = F.floor("o_totalprice").cast("int")
    df = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", F.trunc(F.date_add("o_orderdate", price % 500), "month").alias("s"), F.trunc(F.date_add("o_orderdate", 365 + price % 700), "month").alias("e"))
    df = df.withColumn("version", F.struct("o_orderdate", "o_orderkey")).withColumn("fy", F.year("e"))
    return R.prune_terms(df, "o_custkey", "version", "s", "e", "fy", look_ahead=14, chunk=by_day("o_orderdate")).select("o_orderkey")
