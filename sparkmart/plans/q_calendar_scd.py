"""CAL and SCD queries."""

from datetime import datetime

from pyspark.sql import functions as F

from sparkmart.functions import money, surrogate_key, trunc_to
from sparkmart.operators import calendar as CAL, scd as S, topk, windows as wn
from sparkmart.plans.registry import by_day, by_minute, dsum, query

SPINE_SQL = "SELECT CAST(unnest(generate_series(date_trunc('year', (SELECT MIN(o_orderdate) FROM orders)), (SELECT MAX(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS DATE) AS d"


def spine(t, grain="day"):
    bounds = t.orders.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return CAL.date_spine(bounds, F.trunc("lo", "year"), "hi", grain)


@query("cal_1_date_spine", f"SELECT CAST(d AS VARCHAR) AS date_day FROM ({SPINE_SQL})")
def _(t):
    return spine(t)


# Written over a spine padded to whole years, with windows where the operator uses arithmetic.
PAD = "SELECT CAST(unnest(generate_series(date_trunc('year', (SELECT MIN(o_orderdate) FROM orders)) - INTERVAL 1 YEAR, date_trunc('year', (SELECT MAX(o_orderdate) FROM orders)) + INTERVAL 26 MONTH - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d"
DIM_SQL = f"""
WITH p AS ({PAD}), a AS (SELECT d, CASE WHEN month(d) < 2 THEN year(d) ELSE year(d) + 1 END AS fy, CASE WHEN month(d) < 2 THEN 4 WHEN month(d) < 5 THEN 1 WHEN month(d) < 8 THEN 2 WHEN month(d) < 11 THEN 3 ELSE 4 END AS fq FROM p),
b AS (SELECT *, MIN(d) OVER (PARTITION BY fy, fq) AS fqs, MAX(d) OVER (PARTITION BY fy, fq) AS fqe, MIN(d) OVER (PARTITION BY fy) AS fys, MAX(d) OVER (PARTITION BY fy) AS fye,
 row_number() OVER (PARTITION BY fy, fq ORDER BY d) AS dfq, row_number() OVER (PARTITION BY fy ORDER BY d) AS dfy, row_number() OVER (PARTITION BY year(d), quarter(d) ORDER BY d) AS dq, row_number() OVER (PARTITION BY year(d) ORDER BY d) AS dy,
 MIN(d) OVER (PARTITION BY year(d)) AS ys, MAX(d) OVER (PARTITION BY year(d)) AS ye, MIN(d) OVER (PARTITION BY year(d), quarter(d)) AS qs, MAX(d) OVER (PARTITION BY year(d), quarter(d)) AS qe,
 MIN(d) OVER (PARTITION BY year(d), month(d)) AS ms, MAX(d) OVER (PARTITION BY year(d), month(d)) AS me, CAST(d - dayofweek(d) * INTERVAL 1 DAY AS DATE) AS ws FROM a),
c AS (SELECT *, 12 - date_diff('day', d, fqe) // 7 AS wn, fy || '-Q' || fq AS fqn, fy || '-' || strftime(d, '%b') AS fmn FROM b WHERE d IN ({SPINE_SQL}))
"""


@query("cal_2_date_dim", DIM_SQL + """
SELECT CAST(d AS VARCHAR) AS date_day, CAST(d AS VARCHAR) AS date_actual, strftime(d, '%a') AS day_name, month(d) AS month_actual, year(d) AS year_actual, quarter(d) AS quarter_actual, dayofweek(d) + 1 AS day_of_week, CAST(ws AS VARCHAR) AS first_day_of_week,
 weekofyear(CASE WHEN dayofweek(d) = 0 THEN d + 1 ELSE d END) AS week_of_year, day(d) AS day_of_month, dq AS day_of_quarter, dy AS day_of_year, fy AS fiscal_year, fq AS fiscal_quarter, dfq AS day_of_fiscal_quarter, dfy AS day_of_fiscal_year,
 monthname(d) AS month_name, CAST(ms AS VARCHAR) AS first_day_of_month, CAST(me AS VARCHAR) AS last_day_of_month, CAST(ys AS VARCHAR) AS first_day_of_year, CAST(ye AS VARCHAR) AS last_day_of_year, CAST(qs AS VARCHAR) AS first_day_of_quarter, CAST(qe AS VARCHAR) AS last_day_of_quarter,
 CAST(fqs AS VARCHAR) AS first_day_of_fiscal_quarter, CAST(fqe AS VARCHAR) AS last_day_of_fiscal_quarter, CAST(fys AS VARCHAR) AS first_day_of_fiscal_year, CAST(fye AS VARCHAR) AS last_day_of_fiscal_year,
 CAST(date_diff('day', date_trunc('week', fys), date_trunc('week', d)) // 7 + 1 AS INTEGER) AS week_of_fiscal_year, CASE WHEN month(d) = 1 THEN 12 ELSE month(d) - 1 END AS month_of_fiscal_year, CAST(ws + 6 AS VARCHAR) AS last_day_of_week,
 year(d) || '-Q' || quarter(d) AS quarter_name, fqn AS fiscal_quarter_name, 'FY' || substr(fqn, 3, 7) AS fiscal_quarter_name_fy, dense_rank() OVER (ORDER BY fqn) AS fiscal_quarter_number_absolute, fmn AS fiscal_month_name, 'FY' || substr(fmn, 3, 8) AS fiscal_month_name_fy,
 CASE WHEN strftime(d, '%m%d') = '0101' THEN 'New Year''s Day' WHEN strftime(d, '%m%d') = '1225' THEN 'Christmas Day' WHEN strftime(d, '%m%d') = '1226' THEN 'Boxing Day' END AS holiday_desc, strftime(d, '%m%d') IN ('0101', '1225', '1226') AS is_holiday,
 CAST(CAST(date_trunc('month', fqe) AS DATE) AS VARCHAR) AS last_month_of_fiscal_quarter, date_trunc('month', fqe) = d AS is_first_day_of_last_month_of_fiscal_quarter, CAST(CAST(date_trunc('month', fye) AS DATE) AS VARCHAR) AS last_month_of_fiscal_year,
 date_trunc('month', fye) = d AS is_first_day_of_last_month_of_fiscal_year, CAST(CAST(ms + INTERVAL 1 MONTH + INTERVAL 7 DAY AS DATE) AS VARCHAR) AS snapshot_date_fpa, CAST(CAST(ms + INTERVAL 1 MONTH + INTERVAL 44 DAY AS DATE) AS VARCHAR) AS snapshot_date_billings,
 day(me) AS days_in_month_count, CASE WHEN wn < 5 THEN wn WHEN wn < 9 THEN wn - 4 ELSE wn - 8 END AS week_of_month_normalised, 90 - date_diff('day', d, fqe) AS day_of_fiscal_quarter_normalised, wn AS week_of_fiscal_quarter_normalised,
 365 - date_diff('day', d, fye) AS day_of_fiscal_year_normalised, CASE WHEN (date_diff('day', d, fqe) - 6) % 7 = 0 OR d = fqs THEN 1 ELSE 0 END AS is_first_day_of_fiscal_quarter_week FROM c""")
def _(t):
    return CAL.date_dim(spine(t))


@query("cal_3_normalised_fiscal", DIM_SQL + """
SELECT CAST(fqs AS VARCHAR) AS first_day_of_fiscal_quarter, MIN(90 - date_diff('day', d, fqe)) AS first_normalised, MAX(90 - date_diff('day', d, fqe)) AS last_normalised, COUNT(DISTINCT wn) AS weeks FROM c GROUP BY 1""")
def _(t):
    dim = CAL.date_dim(spine(t))
    return dim.groupBy("first_day_of_fiscal_quarter").agg(F.min("day_of_fiscal_quarter_normalised").alias("first_normalised"), F.max("day_of_fiscal_quarter_normalised").alias("last_normalised"),
                                                          F.count_distinct("week_of_fiscal_quarter_normalised").alias("weeks"))


@query("cal_4_allocate_daily", f"""
WITH m AS (SELECT o_orderstatus, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, {dsum('o_totalprice')} AS target FROM orders GROUP BY 1, 2),
d AS (SELECT o_orderstatus, day, CAST(target / day(last_day(month)) AS DECIMAL(28,6)) AS x FROM (SELECT *, CAST(unnest(generate_series(month, last_day(month), INTERVAL 1 DAY)) AS DATE) AS day FROM m))
SELECT o_orderstatus, CAST(day AS VARCHAR) AS target_date, round(x, 2)::DOUBLE AS daily_target, round(SUM(x) OVER (PARTITION BY o_orderstatus, day - dayofweek(day) * INTERVAL 1 DAY ORDER BY day ROWS UNBOUNDED PRECEDING), 2)::DOUBLE AS wtd_target,
 round(SUM(x) OVER (PARTITION BY o_orderstatus, date_trunc('month', day) ORDER BY day ROWS UNBOUNDED PRECEDING), 2)::DOUBLE AS mtd_target, round(SUM(x) OVER (PARTITION BY o_orderstatus, date_trunc('quarter', day - INTERVAL 1 MONTH) ORDER BY day ROWS UNBOUNDED PRECEDING), 2)::DOUBLE AS qtd_target,
 round(SUM(x) OVER (PARTITION BY o_orderstatus, CASE WHEN month(day) < 2 THEN year(day) ELSE year(day) + 1 END ORDER BY day ROWS UNBOUNDED PRECEDING), 2)::DOUBLE AS ytd_target FROM d""")
def _(t):
    m = t.orders.groupBy("o_orderstatus", trunc_to("month", "o_orderdate").cast("date").alias("month")).agg(F.sum(money("o_totalprice")).cast("double").alias("target"))
    df = CAL.allocate_daily(m, ["o_orderstatus"], "month", "target")
    return df.select("o_orderstatus", "target_date", *[F.round(c, 2).alias(c) for c in ("daily_target", "wtd_target", "mtd_target", "qtd_target", "ytd_target")])


@query("cal_5_ramp_status", """
WITH p AS (SELECT o_custkey, CAST(MIN(o_orderdate) AS DATE) AS s, CAST(MAX(o_orderdate) AS DATE) AS e FROM orders GROUP BY 1),
 r AS (SELECT *, last_day(s + CASE WHEN day(s) < 14 THEN 1 ELSE 2 END * INTERVAL 1 MONTH) AS ramp_end FROM p), d AS (SELECT *, CAST(unnest(generate_series(s, e + INTERVAL 30 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM r)
SELECT CAST(date_trunc('month', day)::DATE AS VARCHAR) AS month, CASE WHEN day <= ramp_end THEN 'Ramping' WHEN day <= e THEN 'Active' END AS ramp_status, COUNT(*) AS person_days FROM d GROUP BY 1, 2""")
def _(t):
    people = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e"))
    df = CAL.ramp_status(people, "s", "e", F.date_add("e", 30))
    return df.groupBy(F.trunc("date_actual", "month").alias("month"), "ramp_status").agg(F.count(F.lit(1)).alias("person_days"))


@query("cal_6_month_range", """
SELECT user_id, CAST(CAST(unnest(generate_series(MIN(date_trunc('month', ts)), MAX(date_trunc('month', ts)) + INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS DATE) AS VARCHAR) AS month FROM events GROUP BY 1""")
def _(t):
    return CAL.month_range(t.events.select("user_id", F.trunc("ts", "month").alias("m")), "user_id", "m")


# ---------------------------------------------------------------- SCD

RAW_SQL = """SELECT user_id, event_type, CAST(epoch(CAST(ts AS DATE)) AS BIGINT) AS up, strftime(ts, '%Y-%m-%d') AS task FROM events QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1"""
DISTINCT_SQL = f"SELECT user_id, event_type, make_timestamp(MIN(up) * 1000000) AS valid_from, make_timestamp(MAX(up) * 1000000) AS max_uploaded_at, MAX(task) AS max_task_instance FROM ({RAW_SQL}) GROUP BY 1, 2"
SCD2_SQL = f"""SELECT d.user_id, event_type, valid_from, coalesce(lead(valid_from) OVER (PARTITION BY d.user_id ORDER BY valid_from) - INTERVAL 1 MILLISECOND, CASE WHEN k.task <> (SELECT MAX(max_task_instance) FROM ({DISTINCT_SQL})) THEN k.seen END) AS valid_to
 FROM ({DISTINCT_SQL}) d JOIN (SELECT user_id, MAX(max_task_instance) AS task, MAX(max_uploaded_at) AS seen FROM ({DISTINCT_SQL}) GROUP BY 1) k USING (user_id)"""


def full_copies(t):
    """The last event of a user and day stands for the row of that day's full copy."""
    day = F.to_date("ts")
    ev = topk.latest_per_key(t.events.select("user_id", "event_type", "ts", "event_id", day.alias("day")), ["user_id", "day"], [F.desc("ts"), F.desc("event_id")])
    return ev.select("user_id", "event_type", F.unix_seconds(F.col("day").cast("timestamp")).alias("_uploaded_at"), F.col("day").cast("string").alias("_task_instance"))


def scd2(t):
    return S.scd_type_2(S.distinct_source(full_copies(t)), "user_id")


@query("scd_1_distinct_source", DISTINCT_SQL)
def _(t):
    return S.distinct_source(full_copies(t))


@query("scd_2_type_2", f"SELECT *, valid_to IS NULL AS is_currently_valid FROM ({SCD2_SQL})")
def _(t):
    return scd2(t)


def state_at(t, until, since=None):
    """Latest row per user among the events of a period."""
    ev = t.events.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    if since:
        ev = ev.filter(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    ev = topk.latest_per_key(ev.select("user_id", "event_type", "ts", "event_id"), ["user_id"], [F.desc("ts"), F.desc("event_id")])
    return ev.select("user_id", "event_type", F.col("ts").alias("updated_at"))


def state_sql(until, since="2000-01-01"):
    return f"SELECT user_id, event_type, ts AS updated_at FROM events WHERE ts < TIMESTAMP '{until}' AND ts >= TIMESTAMP '{since}' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"


T1, T2 = "2024-01-12", "2024-01-20"
CUR_SINCE = "2024-01-16"


def two_snapshots(t, fn):
    first = state_at(t, T1)
    prev = fn(S.empty_snapshot(first), first, datetime.fromisoformat(T1))
    return fn(prev, state_at(t, T2, CUR_SINCE), datetime.fromisoformat(T2))


@query("scd_3_snapshot_timestamp", f"""
SELECT p.user_id, p.event_type, p.updated_at, p.updated_at AS valid_from, c.updated_at AS valid_to, md5(concat_ws('|', p.user_id, p.updated_at)) AS scd_id FROM ({state_sql(T1)}) p LEFT JOIN ({state_sql(T2, CUR_SINCE)}) c ON c.user_id = p.user_id AND c.updated_at > p.updated_at
UNION ALL SELECT user_id, event_type, updated_at, updated_at, NULL, md5(concat_ws('|', user_id, updated_at)) FROM ({state_sql(T2, CUR_SINCE)})""")
def _(t):
    return two_snapshots(t, lambda p, c, now: S.snapshot_ts(p, c, "user_id", "updated_at", now))


@query("scd_4_snapshot_check", f"""
WITH p AS ({state_sql(T1)}), c AS ({state_sql(T2, CUR_SINCE)})
SELECT p.user_id, p.event_type, TIMESTAMP '{T1}' AS valid_from, CASE WHEN c.event_type <> p.event_type THEN TIMESTAMP '{T2}' END AS valid_to FROM p LEFT JOIN c USING (user_id)
UNION ALL SELECT c.user_id, c.event_type, TIMESTAMP '{T2}', NULL FROM c LEFT JOIN p USING (user_id) WHERE p.user_id IS NULL OR c.event_type <> p.event_type""")
def _(t):
    out = two_snapshots(t, lambda p, c, now: S.snapshot_check(p, c, "user_id", ["event_type"], now))
    return out.drop("updated_at", "scd_id")


@query("scd_5_hard_deletes", f"""
WITH p AS ({state_sql(T1)}), c AS ({state_sql(T2, CUR_SINCE)})
SELECT p.user_id, p.updated_at AS valid_from, CASE WHEN c.user_id IS NULL THEN TIMESTAMP '{T2}' ELSE c.updated_at END AS valid_to FROM p LEFT JOIN c USING (user_id) UNION ALL SELECT user_id, updated_at, NULL FROM c""")
def _(t):
    out = two_snapshots(t, lambda p, c, now: S.snapshot_ts(p, c, "user_id", "updated_at", now, hard_deletes=True))
    return out.select("user_id", "valid_from", "valid_to")


CHANGES_SQL = "SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate AS valid_from, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to FROM orders"


def status_history(t):
    """Order status of a customer, each valid until the customer's next order."""
    df = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("valid_from"))
    return wn.lead(df, "valid_to", "o_custkey", ["valid_from", "o_orderkey"], "valid_from", chunk=by_day("valid_from"))


@query("scd_6_snapshot_spine", f"""
SELECT md5(o_custkey || '-' || CAST(m AS VARCHAR)) AS unique_key, o_custkey, o_orderkey, CAST(m AS VARCHAR) AS date_actual FROM (SELECT * FROM ({CHANGES_SQL}) QUALIFY row_number() OVER (PARTITION BY o_custkey, date_trunc('month', valid_from) ORDER BY valid_from DESC, o_orderkey DESC) = 1)
JOIN (SELECT CAST(unnest(generate_series(DATE '1996-01-01', DATE '2001-12-31', INTERVAL 1 MONTH)) AS DATE) AS m) ON CAST(valid_from AS DATE) <= m AND (CAST(valid_to AS DATE) > m OR valid_to IS NULL)""")
def _(t):
    df = S.snapshot_spine(status_history(t), "o_custkey", "1996-01-15", "2001-12-31", "month", "o_orderkey")
    return df.select("unique_key", "o_custkey", "o_orderkey", "date_actual")


@query("scd_7_spine_daily", f"""
SELECT CAST(d AS VARCHAR) AS snapshot_date, COUNT(*) AS valid_rows, CAST(SUM(o_orderkey) AS BIGINT) AS keys FROM ({CHANGES_SQL}) JOIN (SELECT CAST(unnest(generate_series(DATE '2001-05-02', DATE '2001-06-30', INTERVAL 1 DAY)) AS DATE) AS d)
 ON CAST(valid_from AS DATE) <= d AND (CAST(valid_to AS DATE) > d OR valid_to IS NULL) GROUP BY 1""")
def _(t):
    df = S.spine_daily(status_history(t), "2001-05-01", "2001-06-30")
    return df.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("valid_rows"), F.sum("o_orderkey").alias("keys"))


@query("scd_8_collapse_islands", f"""
SELECT o_custkey, island, o_orderstatus, MIN(valid_from) AS valid_from, CASE WHEN COUNT(*) = COUNT(valid_to) THEN MAX(valid_to) END AS valid_to FROM (SELECT *, CAST(SUM(ch) OVER (PARTITION BY o_custkey ORDER BY valid_from, o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM
 (SELECT *, CASE WHEN lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY valid_from, o_orderkey) <> o_orderstatus THEN 1 ELSE 0 END AS ch FROM ({CHANGES_SQL}))) GROUP BY 1, 2, 3""")
def _(t):
    return S.collapse_islands(status_history(t), "o_custkey", "o_orderstatus", "valid_from", "valid_to", "o_orderkey", chunk=by_day("valid_from"))


@query("scd_9_overlap_audit", """
SELECT l_suppkey, probe, COUNT(*) AS valid_rows FROM (SELECT l_suppkey, l_shipdate AS a, l_shipdate + CAST(l_quantity AS INTEGER) * INTERVAL 1 DAY AS b FROM lineitem) JOIN (VALUES (TIMESTAMP '1996-02-02'), (TIMESTAMP '1998-04-04'), (TIMESTAMP '2000-06-06')) v(probe) ON probe BETWEEN a AND b
GROUP BY 1, 2 HAVING COUNT(*) <> 1""")
def _(t):
    df = t.lineitem.select("l_suppkey", F.col("l_shipdate").alias("valid_from"), F.expr("l_shipdate + make_dt_interval(int(l_quantity))").alias("valid_to"))
    return S.overlaps_on(df, "l_suppkey", ["1996-02-02", "1998-04-04", "2000-06-06"])


@query("scd_9_overlap_exact", """
SELECT o_orderkey FROM (SELECT o_orderkey, a, MAX(b) OVER (PARTITION BY o_custkey ORDER BY a, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS open_until FROM (SELECT *, o_orderdate AS a, o_orderdate + CAST(round(o_totalprice / 5000) AS INTEGER) * INTERVAL 1 DAY AS b FROM orders)) WHERE a < open_until""")
def _(t):
    df = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").alias("valid_from"), F.expr("o_orderdate + make_dt_interval(int(round(o_totalprice / 5000)))").alias("valid_to"))
    return S.overlaps(df, "o_custkey", "o_orderkey", chunk=by_day("valid_from")).select("o_orderkey")


@query("scd_10_multi_current", "SELECT o_custkey, COUNT(*) AS current_rows FROM orders WHERE o_orderstatus = 'O' GROUP BY 1 HAVING COUNT(*) > 1")
def _(t):
    return S.multi_current(t.orders.withColumn("is_currently_valid", F.col("o_orderstatus") == "O"), "o_custkey")


@query("scd_11_hash_diff", """
SELECT c_custkey, md5(c_name || '-' || c_mktsegment) AS content_hash, CASE WHEN c_nationkey < 10 THEN TIMESTAMP '2024-02-02' ELSE TIMESTAMP '2024-01-01' END AS last_changed FROM customer""")
def _(t):
    segment = F.when(F.col("c_nationkey") < 10, "OTHER").otherwise(F.col("c_mktsegment"))
    prior = t.customer.select(surrogate_key("c_name", segment).alias("content_hash"), F.lit("2024-01-01").cast("timestamp_ntz").alias("last_changed"))
    return S.hash_diff(t.customer.select("c_custkey", "c_name", "c_mktsegment"), prior, ["c_name", "c_mktsegment"], datetime(2024, 2, 2)).select("c_custkey", "content_hash", "last_changed")


def _half(kind, n):
    return f"SELECT user_id, event_id AS {n}_id, ts AS {n}_from, coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts + INTERVAL 1 DAY) AS {n}_to FROM events WHERE event_type IN ({kind})"


@query("scd_12_intersect_histories", f"""
SELECT a_id, b_id, greatest(a_from, b_from) AS overlap_from, least(a_to, b_to) AS overlap_to FROM ({_half("'view', 'signup'", 'a')}) a JOIN ({_half("'error'", 'b')}) b ON a.user_id = b.user_id AND a_from < b_to AND b_from < a_to""")
def _(t):
    def half(kinds, n):
        ev = wn.lead(t.events.filter(F.col("event_type").isin(*kinds)).select("user_id", "event_id", "ts"), "nxt", "user_id", ["ts", "event_id"], "ts", chunk=by_minute())
        return ev.select("user_id", F.col("event_id").alias(f"{n}_id"), F.col("ts").alias(f"{n}_from"), F.coalesce("nxt", F.col("ts") + F.expr("INTERVAL 1 DAY")).alias(f"{n}_to"))
    out = S.intersect_histories(half(["view", "signup"], "a"), half(["error"], "b"), "user_id", ("a_from", "a_to"), ("b_from", "b_to"))
    return out.select("a_id", "b_id", "overlap_from", "overlap_to")


@query("scd_13_as_was", f"""
SELECT f.o_custkey, f.o_orderkey, d.event_type FROM ({CHANGES_SQL}) f LEFT JOIN (SELECT * FROM ({SCD2_SQL}) WHERE valid_from <= TIMESTAMP '2024-01-15' AND (valid_to IS NULL OR valid_to > TIMESTAMP '2024-01-15')) d ON d.user_id = f.o_custkey
WHERE f.valid_from <= TIMESTAMP '2024-01-15' AND (f.valid_to IS NULL OR f.valid_to > TIMESTAMP '2024-01-15')""")
def _(t):
    dim = scd2(t).drop("is_currently_valid").withColumnRenamed("user_id", "o_custkey")
    return S.as_was(status_history(t), {"o_custkey": dim}, "2024-01-15").select("o_custkey", "o_orderkey", "event_type")


@query("scd_14_definition_validity", """
SELECT user_id, event_type, CAST(day AS VARCHAR) AS day, CAST(MIN(day) OVER (PARTITION BY user_id) AS VARCHAR) AS date_first_added, CAST(MIN(day) OVER (PARTITION BY user_id, event_type) AS VARCHAR) AS valid_from_date, CAST(MAX(day) OVER (PARTITION BY user_id, event_type) AS VARCHAR) AS valid_to_date
FROM (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events)""")
def _(t):
    df = t.events.select("user_id", "event_type", F.to_date("ts").alias("day")).distinct()
    return S.definition_validity(df, ["user_id"], ["user_id", "event_type"], "day")


@query("scd_15_backfill_row", f"""
SELECT o_custkey, o_orderkey, o_orderstatus, valid_from, valid_to FROM ({CHANGES_SQL}) UNION ALL SELECT -1, -1, 'missing', TIMESTAMP '1990-01-01', TIMESTAMP '1994-12-31 23:59:59.999'""")
def _(t):
    return S.backfill_row(status_history(t), {"o_custkey": -1, "o_orderkey": -1, "o_orderstatus": "missing"}, "1990-01-01", "1995-01-01")
