"""Headline queries, and the rewrites against their plain forms.

Prints one JSON line: seconds per query (median of BENCH_RUNS warm runs, every result row
produced) and, under "plain", the same question asked the obvious way.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import functions as F

from sparkmart.functions import money
from sparkmart.operators import windows as wn
from sparkmart.plans.registry import Tables, all_queries
from sparkmart.session import local_session

HEADLINE = [
    "ag_1_group_by", "ag_6_by_levels", "ag_10_percentiles", "jn_1_star", "jn_7_interval_explosion", "jn_8_asof", "jn_9_range_lookup",
    "wn_10_running_total", "wn_15_count_distinct_over", "tk_3_latest_per_key", "tk_3_latest_narrow", "hier_1_lineage", "scd_2_type_2",
    "rev_1_mrr_monthly", "rev_3_arr_change", "rev_10_waterfall", "met_11_xmau", "evt_3_sessions", "mat_1_match_score", "cls_21_slugify",
]


def plain_interval(t):
    df = t.lineitem.select("l_partkey", "l_returnflag", F.to_date("l_shipdate").alias("s"), F.col("l_quantity").cast("int").alias("q"))
    df = df.withColumn("e", F.date_add("s", F.col("q") * 10)).withColumn("s", F.trunc("s", "month"))
    months = t.spark.range(1).select(F.explode(F.sequence(F.lit("1994-01-01").cast("date"), F.lit("2004-12-01").cast("date"), F.expr("INTERVAL 1 MONTH"))).alias("month"))
    return df.join(months, (F.col("month") >= F.col("s")) & (F.col("month") < F.col("e"))).groupBy("month", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))


def plain_range(t):
    bands = t.part.select("p_partkey", (F.col("p_partkey") * 60).cast("double").alias("lo"), (F.col("p_partkey") * 60 + 49.5 + F.col("p_size")).alias("hi"))
    return t.orders.select("o_orderkey", "o_totalprice").join(bands, F.col("o_totalprice").between(F.col("lo"), F.col("hi"))).select("o_orderkey", "p_partkey")


def plain_distinct(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", F.size(F.collect_set("l_partkey").over(wn.window("l_suppkey"))).alias("n"))


def plain_latest(t):
    order = F.struct("ts", "event_id")
    return t.events.groupBy("user_id").agg(F.max_by(F.struct("event_id", "ts", "event_type", "value"), order).alias("r")).select("user_id", "r.*")


def plain_lineage(t):
    t.customer.filter("c_mktsegment <> 'MACHINERY'").selectExpr("c_custkey AS id", "CASE WHEN c_custkey >= 10 THEN c_custkey div 10 END AS parent").createOrReplaceTempView("forest")
    return t.spark.sql("""
        WITH RECURSIVE n AS (SELECT id, parent FROM forest UNION ALL SELECT DISTINCT f.parent, CAST(NULL AS BIGINT) FROM forest f LEFT ANTI JOIN forest p ON f.parent = p.id WHERE f.parent IS NOT NULL),
        r(id, lineage) AS (SELECT id, array(id) FROM n WHERE parent IS NULL UNION ALL SELECT n.id, array_append(r.lineage, n.id) FROM r JOIN n ON n.parent = r.id)
        SELECT * FROM r""")


def plain_levels(t):
    df = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    parts = [df.groupBy(F.col(c).cast("string").alias("id")).agg(F.sum(money("o_totalprice")).alias("arr")) for c in ("c_custkey", "n_nationkey", "n_regionkey")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def plain_running(t):
    return t.events.select("event_id", F.sum(money("value")).over(wn.window("user_id", ["ts", "event_id"], wn.RUNNING)).alias("spent"))


PLAIN = {
    "jn_7_interval_explosion": plain_interval, "jn_9_range_lookup": plain_range, "wn_15_count_distinct_over": plain_distinct, "tk_3_latest_per_key": plain_latest,
    "hier_1_lineage": plain_lineage, "ag_6_by_levels": plain_levels, "wn_10_running_total": plain_running,
}


def seconds(run, runs) -> float:
    """Median of the runs after a first one that warms up."""
    took = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        took.append(time.perf_counter() - start)
    return round(statistics.median(took[1:]), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    registry, tables = all_queries(), Tables(spark, folder)
    timed = {key: seconds(lambda q=registry[key]: q(spark, folder), runs) for key in HEADLINE}
    plain = {key: seconds(lambda fn=fn: fn(tables), runs) for key, fn in PLAIN.items()}
    print(json.dumps({"metric": "headline queries", "value": round(sum(timed.values()), 3), "unit": "sec", "queries": timed, "plain": plain, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
