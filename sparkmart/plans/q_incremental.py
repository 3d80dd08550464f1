"""INC queries: batch operators and their streaming jobs."""

from datetime import datetime

from pyspark.sql import functions as F

from sparkmart.functions import money
from sparkmart.operators import incremental as I
from sparkmart.plans.registry import query
from sparkmart.sources import sinks as W
from sparkmart.streaming import jobs as J

CUT = "2024-01-15"


def split(t, cut=CUT):
    """Target (before the cut) and source (everything)."""
    ev = t.events.drop("props")
    return ev.filter(F.col("ts") < F.lit(cut).cast("timestamp_ntz")), ev


def latest(df):
    from sparkmart.operators import topk
    return topk.latest_per_key(df, ["user_id"], [F.desc("ts"), F.desc("event_id")])


def stream(t):
    return J.read_stream(t.spark, f"{t.folder}/events*.parquet", t.events.schema)


@query("inc_1_increment", f"SELECT event_id FROM events WHERE ts >= (SELECT MAX(ts) FROM events WHERE ts < TIMESTAMP '{CUT}')")
def _(t):
    target, source = split(t)
    return I.increment(source, target, "ts").select("event_id")


@query("inc_1_increment_stream", "SELECT event_id, user_id FROM events")
def _(t):
    return J.increment(t.spark, f"{t.folder}/events*.parquet", t.events.schema, W.scratch(t.spark, "increment")).select("event_id", "user_id")


@query("inc_2_upsert", """
SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def _(t):
    target, source = split(t)
    batch = source.filter(F.col("ts") >= F.lit(CUT).cast("timestamp_ntz"))
    return I.upsert(latest(target), batch, "user_id", [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type")


@query("inc_2_upsert_stream", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def _(t):
    return J.upsert(stream(t), "user_id", [F.desc("ts"), F.desc("event_id")], W.scratch(t.spark, "upsert")).select("user_id", "event_id", "event_type")


FIRST_SQL = f"SELECT DISTINCT user_id FROM events WHERE event_type = 'signup' AND ts < TIMESTAMP '{CUT}'"


@query("inc_3_insert_new", f"SELECT user_id, 'old' AS src FROM ({FIRST_SQL}) UNION ALL SELECT DISTINCT user_id, 'new' FROM events WHERE user_id NOT IN ({FIRST_SQL})")
def _(t):
    target, source = split(t)
    old = target.filter("event_type = 'signup'").select("user_id").distinct().withColumn("src", F.lit("old"))
    return I.insert_new(old, source.select("user_id").distinct().withColumn("src", F.lit("new")), "user_id")


@query("inc_4_known_only", f"SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-03' UNION ALL SELECT event_id FROM events WHERE ts >= TIMESTAMP '{CUT}' AND user_id IN (SELECT user_id FROM events WHERE ts < TIMESTAMP '2024-01-03')")
def _(t):
    target, source = split(t, "2024-01-03")
    return I.known_only(target, source.filter(F.col("ts") >= F.lit(CUT).cast("timestamp_ntz")), "user_id").select("event_id")


@query("inc_5_overlap", "SELECT event_id, user_id FROM events")
def _(t):
    # The target misses rows of the last minutes before its watermark; the overlap brings them in.
    target, source = split(t)
    newest = target.select(F.max("ts")).scalar()
    holes = target.filter(~((F.col("event_type") == "view") & (F.col("ts") >= newest - F.expr("INTERVAL 30 MINUTES")) & (F.col("ts") < newest)))
    return I.with_overlap(holes, source, "ts", "event_id", [F.desc("ts")]).select("event_id", "user_id")


@query("inc_5_dedupe_stream", "SELECT event_id, event_type FROM events")
def _(t):
    twice = stream(t).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return J.dedupe(twice, "ts", "event_id", W.scratch(t.spark, "dedupe")).select("event_id", "event_type")


@query("inc_6_backfill", "SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, COUNT(*) AS n, MAX(CASE WHEN year(o_orderdate) = 1998 AND month(o_orderdate) = 3 THEN 2 ELSE 1 END) AS version FROM orders GROUP BY 1, 2")
def _(t):
    path = W.scratch(t.spark, "backfill")
    W.write_monthly(t.orders.withColumn("version", F.lit(1)), "o_orderdate", path)
    march = t.orders.filter((F.year("o_orderdate") == 1998) & (F.month("o_orderdate") == 3))
    W.overwrite_months(march.withColumn("version", F.lit(2)), "o_orderdate", path)
    return t.spark.read.parquet(path).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"), F.max("version").alias("version"))


TUMBLE_SQL = "SELECT date_trunc('hour', ts)::TIMESTAMP AS window_start, date_trunc('hour', ts)::TIMESTAMP + INTERVAL 1 HOUR AS window_end, event_type, COUNT(*) AS events FROM events GROUP BY 1, 2, 3"


@query("inc_7_tumble", TUMBLE_SQL)
def _(t):
    return I.tumble(t.events, "ts", "1 hour", ["event_type"])


@query("inc_7_tumble_stream", TUMBLE_SQL)
def _(t):
    return J.tumble_counts(stream(t), "ts", "1 hour", ["event_type"], W.scratch(t.spark, "tumble"))


@query("inc_8_slide", """
SELECT CAST(d AS VARCHAR) AS window_end, event_type, COUNT(*) AS events, COUNT(DISTINCT user_id) AS distinct_user_id FROM events JOIN (SELECT CAST(unnest(generate_series((SELECT MIN(CAST(ts AS DATE)) FROM events), (SELECT MAX(CAST(ts AS DATE)) FROM events) + INTERVAL 27 DAY, INTERVAL 1 DAY)) AS DATE) AS d)
 ON CAST(ts AS DATE) BETWEEN d - 27 AND d GROUP BY 1, 2""")
def _(t):
    return I.slide(t.events, "ts", 28, ["event_type"], "user_id")


SESSION_SQL = """SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 6 HOUR AS session_end, COUNT(*) AS events FROM (SELECT *, SUM(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM
 (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS nw FROM events)) GROUP BY user_id, s"""


@query("inc_9_session", SESSION_SQL)
def _(t):
    return I.session(t.events, "ts", "6 hours", ["user_id"])


@query("inc_9_session_hot_keys", f"SELECT s.*, total, high FROM ({SESSION_SQL}) s JOIN (SELECT user_id, session_start, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, MAX(value) AS high FROM (SELECT e.*, MAX(session_start) AS session_start FROM events e JOIN ({SESSION_SQL}) x ON x.user_id = e.user_id AND x.session_start <= e.ts GROUP BY ALL) GROUP BY 1, 2) USING (user_id, session_start)".replace("s.*", "s.user_id, s.session_start, session_end, events"))
def _(t):
    return I.sessions(t.events, "ts", 6 * 3600, ["user_id"], ["events"], {"total": money("value")}, highs={"high": "value"})


@query("inc_9_session_stream", f"SELECT * FROM ({SESSION_SQL}) WHERE session_end <= (SELECT MAX(ts) - INTERVAL 30 MINUTE FROM events)")
def _(t):
    return J.session_counts(stream(t), "ts", "6 hours", ["user_id"], W.scratch(t.spark, "sessions"))


@query("inc_10_stream_enrich", "SELECT event_id, c_mktsegment FROM events LEFT JOIN customer ON c_custkey = user_id")
def _(t):
    dim = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return J.enrich(stream(t).select("event_id", "user_id"), dim, "user_id", W.scratch(t.spark, "enrich")).select("event_id", "c_mktsegment")


@query("inc_11_route_stream", "SELECT event_id, CASE WHEN event_type = 'error' THEN 'bad' ELSE 'good' END AS side FROM events")
def _(t):
    broken = F.when(F.col("event_type") == "error", F.substring("props", 1, 4)).otherwise(F.col("props"))
    good, bad = J.route(stream(t).withColumn("props", broken), F.try_parse_json(broken).isNull(), W.scratch(t.spark, "route"))
    return good.select("event_id", F.lit("good").alias("side")).unionByName(bad.select("event_id", F.lit("bad").alias("side")))


@query("inc_12_last_changed_stream", "SELECT DISTINCT user_id, md5(event_type) AS content_hash, TIMESTAMP '2024-02-01' AS last_changed FROM events")
def _(t):
    return J.last_changed(stream(t), "user_id", ["event_type"], datetime(2024, 2, 1), W.scratch(t.spark, "changed"))
