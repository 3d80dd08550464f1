"""EVT and MAT queries."""

from pyspark.sql import functions as F

from sparkmart.functions import money, ratio
from sparkmart.operators import events as E, joins as J, matching as M, windows as wn
from sparkmart.plans.registry import by_minute, dsum, query

GAP = 6 * 3600


@query("evt_1_unify_events", """
WITH u AS (SELECT 'order placed' AS event_name, 'plan' AS stage_name, o_orderkey AS event_id, o_orderdate AS event_at, o_custkey AS user_id, o_custkey % 25 AS parent_id FROM orders UNION ALL SELECT 'item shipped', 'ship', l_partkey, l_shipdate, NULL, l_suppkey FROM lineitem
 UNION ALL SELECT 'app ' || event_type, 'use', event_id, ts, user_id, NULL FROM events)
SELECT event_name, stage_name, COUNT(*) AS n, COUNT(user_id) AS with_user, COUNT(f) AS known_user, CAST(SUM(date_diff('day', f, event_at)) AS BIGINT) AS user_days, COUNT(s_name) AS known_parent FROM u LEFT JOIN (SELECT o_custkey AS k, MIN(o_orderdate) AS f FROM orders GROUP BY 1) ON k = user_id LEFT JOIN supplier ON s_suppkey = parent_id GROUP BY 1, 2""")
def _(t):
    specs = [E.EventSpec("order placed", "plan", t.orders, "o_orderkey", "o_orderdate", "o_custkey", F.col("o_custkey") % 25),
             E.EventSpec("item shipped", "ship", t.lineitem, "l_partkey", "l_shipdate", None, "l_suppkey"),
             E.EventSpec(F.concat(F.lit("app "), "event_type"), "use", t.events, "event_id", "ts", "user_id")]
    users = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.min("o_orderdate").alias("created_at"))
    parents = t.supplier.select(F.col("s_suppkey").alias("id"), F.lit("1990-01-01").cast("timestamp_ntz").alias("created_at"), F.col("s_name").alias("name"))
    df = E.unify_events(specs, users, parents)
    return df.groupBy("event_name", "stage_name").agg(F.count(F.lit(1)).alias("n"), F.count("user_id").alias("with_user"), F.count("user_created_at").alias("known_user"),
                                                      F.sum("days_since_user_creation").alias("user_days"), F.count("parent_name").alias("known_parent"))


@query("evt_2_event_daily", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, user_id, event_type, COUNT(*) AS event_count FROM events GROUP BY ALL")
def _(t):
    return E.event_daily(t.events, "ts", ["user_id", "event_type"])


SESSION_SQL = """SELECT *, CAST(SUM(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_index FROM
 (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > 21600000000 THEN 1 ELSE 0 END AS nw FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""


def views(t):
    return t.events.select("event_id", "user_id", "ts", "event_type")


@query("evt_3_page_views", f"SELECT event_id, session_index, row_number() OVER (PARTITION BY user_id, session_index ORDER BY ts, event_id) AS page_view_in_session, md5(user_id || '-' || session_index) AS session_id FROM ({SESSION_SQL})")
def _(t):
    return E.page_views(views(t), "user_id", "ts", "event_id", GAP, by_minute()).select("event_id", "session_index", "page_view_in_session", "session_id")


@query("evt_3_sessions", f"SELECT user_id, session_index, MIN(ts) AS session_start, MAX(ts) AS session_end, COUNT(*) AS page_views FROM ({SESSION_SQL}) GROUP BY 1, 2")
def _(t):
    return E.sessions(views(t), "user_id", "ts", "event_id", GAP, by_minute())


@query("evt_4_funnel", f"""
SELECT user_id, session_index, MIN(ts) FILTER (event_type = 'view') AS start_at, MIN(ts) FILTER (event_type = 'purchase') AS success_at, COUNT(*) FILTER (event_type = 'purchase') > 0 AS reached_success FROM ({SESSION_SQL}) GROUP BY 1, 2 HAVING COUNT(*) FILTER (event_type = 'view') > 0""")
def _(t):
    df = E.sessionize(views(t), "user_id", "ts", "event_id", GAP, by_minute())
    return E.funnel(df, ["user_id", "session_index"], "ts", F.col("event_type") == "view", F.col("event_type") == "purchase")


@query("evt_5_event_quality", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, COUNT(*) FILTER (event_type <> 'error') AS good_events, COUNT(*) FILTER (event_type = 'error') AS bad_events, round(COUNT(*) FILTER (event_type = 'error')::DOUBLE / COUNT(*), 6) AS bad_share FROM events GROUP BY 1""")
def _(t):
    df = E.event_quality(t.events.filter("event_type <> 'error'"), t.events.filter("event_type = 'error'"), "ts")
    return df.withColumn("bad_share", F.round("bad_share", 6))


BROKEN_SQL = "CASE WHEN event_type = 'error' THEN left(props, 5) WHEN event_type = 'signup' THEN replace(props, 'k', 'z') ELSE props END"


@query("evt_6_bad_events", f"""
SELECT DISTINCT line, ts AS failed_at, e AS errors, md5(line || '-' || ts || '-' || e) AS bad_event_key FROM (SELECT {BROKEN_SQL} AS line, ts, CASE WHEN event_type = 'error' THEN 'not json' WHEN event_type = 'signup' THEN 'missing k' END AS e FROM events) WHERE e IS NOT NULL""")
def _(t):
    broken = F.when(F.col("event_type") == "error", F.substring("props", 1, 5)).when(F.col("event_type") == "signup", F.replace("props", F.lit("k"), F.lit("z"))).otherwise(F.col("props"))
    df = E.bad_events(t.events.select("ts", broken.alias("line")), "line", "ts", ["k"])
    return df.select("line", "failed_at", F.array_join("error_array", ",").alias("errors"), "bad_event_key")


@query("evt_7_anonymise", "SELECT event_id, ts, event_type, n FROM events JOIN (SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1) USING (event_type)")
def _(t):
    kinds = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return E.anonymise_events(t.events, ["user_id", "props", "value"], kinds, "event_type")


@query("evt_8_assignment_events", """
WITH n AS (SELECT o_orderkey, o_custkey, o_orderstatus, 's' || (o_custkey % 100) AS a, 's' || (o_orderkey % 100) AS b FROM orders), r AS (SELECT o_orderkey, 'assigned' AS event, 0 AS rank_in_event, a AS u FROM n WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderkey, 'assigned', 1, b FROM n WHERE o_orderstatus = 'F'
 UNION ALL SELECT o_orderkey, 'unassigned', 0, b FROM n WHERE o_orderstatus = 'O' UNION ALL SELECT o_orderkey, 'reassigned', 0, b FROM n WHERE o_orderstatus = 'P') SELECT o_orderkey, event, rank_in_event, s_suppkey FROM r JOIN supplier ON 's' || s_suppkey = u""")
def _(t):
    a, b = F.concat(F.lit("@s"), (F.col("o_custkey") % 100).cast("string")), F.concat(F.lit("@s"), (F.col("o_orderkey") % 100).cast("string"))
    note = (F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("assigned to "), a, F.lit(", "), b))
            .when(F.col("o_orderstatus") == "O", F.concat(F.lit("assigned to "), a, F.lit(" and unassigned "), b)).otherwise(F.concat(F.lit("Reassigned to "), b)))
    users = t.supplier.select("s_suppkey", F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("user_name"))
    return E.assignment_events(t.orders.select("o_orderkey", note.alias("note")), users, "note", ["o_orderkey"])


@query("evt_9_days_active", "SELECT user_id, date_diff('day', MIN(ts), coalesce(MAX(ts) FILTER (event_type = 'purchase'), MIN(ts))) AS days_active FROM events GROUP BY 1")
def _(t):
    df = t.events.groupBy("user_id").agg(F.min("ts").alias("a"), F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("b"))
    return df.select("user_id", E.days_active("a", "b").alias("days_active"))


# ---------------------------------------------------------------- matching

def _score_sql(group, org, role, user, src):
    return f"""
WITH d AS (SELECT DISTINCT {group} AS g, {org} AS o, {role} AS r, {user} AS u FROM {src}), tr AS (SELECT g, COUNT(DISTINCT u) FILTER (r = 'creator') AS tc, COUNT(DISTINCT u) FILTER (r = 'owner') AS tow, COUNT(DISTINCT u) FILTER (r = 'user') AS tu, COUNT(DISTINCT u) AS tm, COUNT(DISTINCT o) AS orgs FROM d GROUP BY 1),
 p AS (SELECT g, o, COUNT(*) FILTER (r = 'creator') AS nc, COUNT(*) FILTER (r = 'owner') AS nw, COUNT(*) FILTER (r = 'user') AS nu FROM d WHERE o IS NOT NULL GROUP BY 1, 2),
 s AS (SELECT *, nc + nw + nu AS m, coalesce(nc / nullif(tc, 0), 0) * 0.6 + coalesce(nw / nullif(tow, 0), 0) * 0.3 + coalesce(nu / nullif(tu, 0), 0) * 0.1 AS us, CASE WHEN (nc + nw + nu) / tm > 0.5 THEN 1 ELSE 0 END AS dom, ((nc > 0 AND nu > 0)::INT + (nc > 0 AND nw > 0)::INT + (nw > 0 AND nu > 0)::INT) / 3 AS sim FROM p JOIN tr USING (g)),
 k AS (SELECT *, (us + dom + sim) / 3 * 100 AS cs, MAX(nu) OVER (PARTITION BY g) AS u1, MAX(nw) OVER (PARTITION BY g) AS w1, coalesce(nth_value(nu, 2) OVER (PARTITION BY g ORDER BY nu DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0) AS u2, coalesce(nth_value(nw, 2) OVER (PARTITION BY g ORDER BY nw DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0) AS w2 FROM s),
 b AS (SELECT *, round(coalesce(m / nullif(tm, 0), 0), 2) >= 0.5 AS mu, round(coalesce(nw / nullif(tow, 0), 0), 2) >= 0.5 AS mo FROM k QUALIFY row_number() OVER (PARTITION BY g ORDER BY round(cs, 9) DESC, o) = 1)
SELECT g AS group_id, o AS org_id, m AS org_members, tm AS total_members, round(us, 6) AS user_score, round(cs, 6) AS combined_score, CASE WHEN nc > 0 AND nu = u1 AND orgs = 1 AND mu THEN 7 WHEN nc > 0 AND nu = u1 AND orgs = 1 THEN 6 WHEN nc > 0 AND nu = u1 AND u1 > u2 AND mu THEN 6 WHEN nw > 0 AND nu = u1 AND orgs = 1 AND mu THEN 7
 WHEN nw > 0 AND nu = u1 AND u1 > u2 AND mu THEN 6 WHEN nw > 0 AND nw = w1 AND w1 > w2 AND mo THEN 5 WHEN nw > 0 AND nc > 0 AND w1 > w2 THEN 4 WHEN nc > 0 AND nu > 0 AND u1 > u2 THEN 4 WHEN nc > 0 AND (nu > 0 OR nw > 0) THEN 3 WHEN nw > 0 THEN 2 WHEN nu > 0 THEN 1 ELSE 0 END AS match_type FROM b"""


def _score(df):
    return df.select("group_id", "org_id", "org_members", "total_members", F.round("user_score", 6).alias("user_score"), F.round("combined_score", 6).alias("combined_score"), "match_type")


ROLE_SQL = "CASE o_orderstatus WHEN 'F' THEN 'creator' WHEN 'O' THEN 'owner' ELSE 'user' END"


def role():
    return F.when(F.col("o_orderstatus") == "F", "creator").when(F.col("o_orderstatus") == "O", "owner").otherwise("user")


@query("mat_1_match_score", _score_sql("c_nationkey * 100 + c_custkey % 97", "CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END", ROLE_SQL, "c_custkey", "orders JOIN customer ON c_custkey = o_custkey"))
def _(t):
    df = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    org = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    return _score(M.match_score(df, F.col("c_nationkey") * 100 + F.col("c_custkey") % 97, org, role(), "c_custkey"))


@query("mat_2_account_score", _score_sql("l_suppkey", "n_name", ROLE_SQL, "o_custkey", "lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey"))
def _(t):
    df = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    return _score(M.match_score(df, "l_suppkey", "n_name", role(), "o_custkey"))


@query("mat_3_attribution", """
WITH c AS (SELECT user_id, MIN(ts) AS conv_at, arg_min(value, (ts, event_id)) AS val FROM events WHERE event_type = 'purchase' GROUP BY 1), l AS (SELECT user_id, MIN(ts) AS lead_at FROM events WHERE event_type = 'signup' GROUP BY 1),
 t AS (SELECT e.user_id, e.event_id, e.ts, val, lead_at FROM events e JOIN c USING (user_id) JOIN l USING (user_id) WHERE event_type IN ('view', 'click') AND ts <= conv_at),
 a AS (SELECT *, event_id = arg_min(event_id, (ts, event_id)) OVER w AS f, event_id = coalesce(arg_max(event_id, (ts, event_id)) FILTER (ts <= lead_at) OVER w, arg_min(event_id, (ts, event_id)) OVER w) AS l, event_id = arg_max(event_id, (ts, event_id)) OVER w AS k, COUNT(*) OVER w AS n FROM t WINDOW w AS (PARTITION BY user_id)),
 o AS (SELECT *, n - SUM(CASE WHEN f OR l OR k THEN 1 ELSE 0 END) OVER (PARTITION BY user_id) AS others FROM a)
SELECT event_id, round(w, 6) AS weight, round(w * val, 6) AS attributed FROM (SELECT *, CASE WHEN f OR l OR k THEN (f::INT * 0.3 + l::INT * 0.3 + k::INT * 0.3)::DOUBLE * CASE WHEN others > 0 THEN 1 ELSE 1 / 0.9::DOUBLE END ELSE 0.1::DOUBLE / others END AS w FROM o)""")
def _(t):
    ev = t.events.select("event_id", "user_id", "ts", "event_type", "value")
    conv = ev.filter("event_type = 'purchase'").groupBy("user_id").agg(F.min("ts").alias("conv_at"), F.min_by("value", F.struct("ts", "event_id")).alias("val"))
    lead = ev.filter("event_type = 'signup'").groupBy("user_id").agg(F.min("ts").alias("lead_at"))
    touches = ev.filter(F.col("event_type").isin("view", "click")).select("event_id", "user_id", "ts")
    df = M.attribute(touches, conv.join(lead, "user_id"), "user_id", "ts", "event_id", "lead_at", "conv_at", "val")
    return df.select("event_id", F.round("weight", 6).alias("weight"), F.round("attributed", 6).alias("attributed"))


@query("mat_4_three_way_status", """
SELECT match_status, COUNT(*) AS n FROM (SELECT CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN 'paid all matching' WHEN b.k IS NULL AND a.k IS NOT NULL THEN 'order without usage' WHEN a.k IS NULL AND b.k IS NOT NULL THEN 'usage without order' ELSE 'account only' END AS match_status
 FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_totalprice > 450000) a FULL JOIN (SELECT DISTINCT user_id AS k FROM events) b ON a.k = b.k FULL JOIN (SELECT c_custkey AS k FROM customer) c ON c.k = coalesce(a.k, b.k)) GROUP BY 1""")
def _(t):
    lists = {"orders": t.orders.filter("o_totalprice > 450000").select(F.col("o_custkey").alias("k")).distinct(), "usage": t.events.select(F.col("user_id").alias("k")).distinct(), "accounts": t.customer.select(F.col("c_custkey").alias("k"))}
    df = J.full_match(lists, "k", [(("orders", "usage", "accounts"), "paid all matching"), (("orders", "accounts"), "order without usage"), (("usage", "accounts"), "usage without order"), (("accounts",), "account only")])
    return df.groupBy("match_status").agg(F.count(F.lit(1)).alias("n"))


@query("mat_5_amount_disambiguation", """
WITH m AS (SELECT l_orderkey AS k, l_suppkey AS cand, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS amt, MIN(l_shipdate) AS since FROM lineitem GROUP BY 1, 2), n AS (SELECT k, COUNT(*) AS c FROM m GROUP BY 1), j AS (SELECT m.*, c, CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM m JOIN n USING (k) JOIN orders ON o_orderkey = k),
 t AS (SELECT k, cand, 0 AS tier, 'only candidate' AS tier_name FROM j WHERE c = 1 UNION ALL SELECT k, cand, 1, 'amount fits' FROM j WHERE c > 1 AND amt BETWEEN total * 0.25 AND total * 0.5 UNION ALL SELECT k, cand, 2, 'earliest' FROM j WHERE c > 1 QUALIFY rank() OVER (PARTITION BY k ORDER BY since, cand) = 1)
SELECT k, cand, tier_name FROM t QUALIFY rank() OVER (PARTITION BY k ORDER BY tier) = 1""")
def _(t):
    from sparkmart.operators import topk
    # Lines are dealt by order once: candidates, their number and the join with the order use that one shuffle.
    lines = t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_suppkey").alias("cand"), "l_extendedprice", "l_shipdate").filter("k IS NOT NULL").repartition("k")
    m = lines.groupBy("k", "cand").agg(F.sum(money("l_extendedprice")).alias("amt"), F.min("l_shipdate").alias("since"))
    j = m.withColumn("c", F.count(F.lit(1)).over(wn.window("k"))).join(t.orders.select(F.col("o_orderkey").alias("k"), money("o_totalprice").alias("total")), "k")
    many = j.filter("c > 1")
    tiers = [("only candidate", j.filter("c = 1")), ("amount fits", many.filter(F.col("amt").between(F.col("total") * F.lit(0.25).cast("decimal(3,2)"), F.col("total") * F.lit(0.5).cast("decimal(2,1)")))),
             ("earliest", topk.latest_per_key(many, ["k"], ["since", "cand"]))]
    return J.fallback_match([(name, df.select("k", "cand")) for name, df in tiers], "k")


@query("mat_6_linear_attribution", """
SELECT l_orderkey, l_linenumber, l_partkey, touch_count, campaign_count, round(o_totalprice / touch_count, 6) AS value_per_touch, round(o_totalprice / campaign_count, 6) AS value_per_campaign FROM lineitem JOIN orders ON o_orderkey = l_orderkey
 JOIN (SELECT l_orderkey AS k, COUNT(DISTINCT l_partkey) AS touch_count, COUNT(DISTINCT l_returnflag) AS campaign_count FROM lineitem GROUP BY 1) ON k = l_orderkey""")
def _(t):
    touches = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "o_totalprice")
    df = M.linear_attribution(touches, ["l_orderkey"], "l_partkey", "l_returnflag", "o_totalprice")
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "touch_count", "campaign_count", F.round("value_per_touch", 6).alias("value_per_touch"), F.round("value_per_campaign", 6).alias("value_per_campaign"))


@query("mat_7_pre_conversion_weights", """
SELECT event_id, round(CASE WHEN ts <= c THEN 1.0::DOUBLE / COUNT(*) FILTER (ts <= c) OVER (PARTITION BY user_id) ELSE 0 END, 6) AS weight FROM events JOIN (SELECT user_id, MIN(ts) AS c FROM events WHERE event_type = 'purchase' GROUP BY 1) USING (user_id)""")
def _(t):
    conv = t.events.filter("event_type = 'purchase'").groupBy("user_id").agg(F.min("ts").alias("c"))
    df = M.pre_conversion_weights(t.events.select("event_id", "user_id", "ts").join(conv, "user_id"), "user_id", "event_id", "ts", "c")
    return df.select("event_id", F.round("weight", 6).alias("weight"))
