"""SRC queries. Operators that write go through a fresh folder beside the checkpoints and are read back."""

from datetime import datetime

from pyspark.sql import functions as F, types as T

from sparkmart.functions import money
from sparkmart.plans.registry import query
from sparkmart.sources import readers as R, sinks as W, versions as V


@query("src_1_seed", "SELECT n_nationkey, CASE WHEN n_regionkey <> 2 THEN n_name END AS n_name, n_regionkey FROM nation")
def _(t):
    path = W.scratch(t.spark, "seed")
    name = F.when(F.col("n_regionkey") == 2, "NULL").otherwise(F.col("n_name"))
    t.nation.select("n_nationkey", name.alias("n_name"), "n_regionkey").write.option("header", True).csv(path)
    return R.read_seed(t.spark, path, "n_nationkey int, n_name string, n_regionkey int")


@query("src_2_explode_json_rows", """
SELECT event_id, unnest([event_type, 'twin']) AS name, unnest([user_id, user_id + 1]) AS score FROM events WHERE event_type <> 'error' UNION ALL SELECT event_id, NULL, NULL FROM events WHERE event_type = 'error'""")
def _(t):
    doc = F.when(F.col("event_type") != "error", F.format_string('[{"name": "%s", "score": %d}, {"name": "twin", "score": %d}]', "event_type", "user_id", F.col("user_id") + 1))
    return R.explode_json_rows(t.events.select("event_id", doc.alias("jsontext")), "jsontext", "name: string, score: bigint", outer=True)


@query("src_3_join_log_streams", """
SELECT a.event_id // 2 AS correlation_id, a.event_id, a.value AS size_bytes, b.ts AS accessed_at FROM events a JOIN events b ON b.event_id = a.event_id + 1 WHERE a.event_id % 2 = 0""")
def _(t):
    # Consecutive events stand for the two log lines of one request.
    kind = F.when(F.col("event_id") % 2 == 0, "blob downloaded").otherwise("access")
    log = t.events.select(F.floor(F.col("event_id") / 2).alias("correlation_id"), kind.alias("msg"), "event_id", "value", "ts")
    return R.join_log_streams(log, "msg", "blob downloaded", "access", "correlation_id", ["event_id", F.col("value").alias("size_bytes")], [F.col("ts").alias("accessed_at")])


@query("src_4_event_tsv", "SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, props, NULL::VARCHAR AS contexts FROM events")
def _(t):
    path = W.scratch(t.spark, "tsv")
    t.events.select(F.concat_ws("\t", "event_id", "event_type", "props")).write.option("compression", "gzip").text(path)
    return R.read_event_tsv(t.spark, path, ["event_id", "event_type", "props", "contexts"])


@query("src_5_hour_partitions", """
SELECT 'output/' || strftime(h, '%Y/%m/%d/%H') AS partition, COUNT(event_id) AS events FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:00:00', INTERVAL 1 HOUR)) AS h) LEFT JOIN events ON date_trunc('hour', ts) = h GROUP BY 1""")
def _(t):
    read = R.read_hours(t.events, "ts", "202401").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    df = R.partitions_for(t.spark, "202401").join(read, "hour", "left")
    return df.select("partition", F.coalesce("n", F.lit(0)).alias("events"))


@query("src_6_incremental_window", "SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10 11:30:00' AND TIMESTAMP '2024-01-12 11:30:00'")
def _(t):
    return R.incremental_window(t.events, "ts", datetime(2024, 1, 10, 12), datetime(2024, 1, 20), datetime(2024, 1, 15), 48).select("event_id")


@query("src_7_id_chunks", "SELECT (l_orderkey - (SELECT MIN(l_orderkey) FROM lineitem)) // 1000 AS chunk, MIN(l_orderkey) AS first_id, MAX(l_orderkey) AS last_id, COUNT(*) AS rows FROM lineitem GROUP BY 1")
def _(t):
    return R.id_chunks(t.lineitem, "l_orderkey", 1000)


@query("src_8_append_full_copy", """
SELECT c_custkey, c_name, _uploaded_at, 'task_' || _uploaded_at AS _task_instance FROM customer CROSS JOIN (VALUES (1700000000), (1700003600)) v(_uploaded_at)""")
def _(t):
    path = W.scratch(t.spark, "copies")
    for at in (1700000000, 1700003600):
        W.append_full_copy(t.customer.select("c_custkey", "c_name"), path, at, f"task_{at}")
    return t.spark.read.parquet(path)


@query("src_9_probe_load", "SELECT l_orderkey, l_partkey FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) ORDER BY l_orderkey, l_partkey LIMIT 100000")
def _(t):
    return R.probe_load(t.lineitem.select("l_orderkey", "l_partkey").distinct(), "l_orderkey", ["l_orderkey", "l_partkey"], 100_000)


@query("src_10_schema_drift", "SELECT COUNT(*) AS rows_checked, false AS metadata_only, true AS column_lost FROM orders")
def _(t):
    same = W.schema_changed(t.orders, t.orders.withColumn("_uploaded_at", F.lit(1)))
    drift = W.schema_changed(t.orders, t.orders.drop("o_orderstatus"))
    return t.orders.agg(F.count(F.lit(1)).alias("rows_checked")).select("rows_checked", F.lit(same).alias("metadata_only"), F.lit(drift).alias("column_lost"))


@query("src_11_swap_write", "SELECT c_custkey, c_mktsegment FROM customer")
def _(t):
    path = W.scratch(t.spark, "swap")
    W.swap_write(t.customer.select("c_custkey", F.lit("old").alias("c_mktsegment")), path)
    W.swap_write(t.customer.select("c_custkey", "c_mktsegment"), path)
    return t.spark.read.parquet(path)


@query("src_11_versions", "SELECT c_custkey, c_mktsegment FROM customer")
def _(t):
    path = W.scratch(t.spark, "versions")
    V.publish(t.customer.select("c_custkey", F.lit("old").alias("c_mktsegment")), path)
    V.publish(t.customer.select("c_custkey", "c_mktsegment"), path)
    return V.read(t.spark, path)


@query("src_12_changed_parts", "SELECT o_orderstatus AS part, COUNT(*) AS rows, o_orderstatus <> 'P' AS kept FROM orders GROUP BY 1")
def _(t):
    path = W.scratch(t.spark, "parts")
    V.publish(t.orders, path, "o_orderstatus")
    before = V.manifest(t.spark, path).select("file").collect()
    V.publish(t.orders.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "P", -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))), path, "o_orderstatus")
    return V.manifest(t.spark, path).groupBy("part").agg(F.max("rows").alias("rows"), F.bool_and(F.col("file").isin(*[r.file for r in before])).alias("kept"))


@query("src_12_write_if_changed", "SELECT 'same rows in another order' AS step, false AS wrote, COUNT(*) AS rows FROM orders UNION ALL SELECT 'one value changed', true, COUNT(*) FROM orders")
def _(t):
    path = W.scratch(t.spark, "changed")
    W.write_if_changed(t.orders, path)
    same = W.write_if_changed(t.orders.orderBy(F.desc("o_orderkey")), path)
    other = W.write_if_changed(t.orders.withColumn("o_custkey", F.when(F.col("o_orderkey") == 1, -1).otherwise(F.col("o_custkey"))), path)
    n = t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
    return n.select(F.inline(F.array(
        F.struct(F.lit("same rows in another order").alias("step"), F.lit(same).alias("wrote"), F.col("rows")),
        F.struct(F.lit("one value changed").alias("step"), F.lit(other).alias("wrote"), F.col("rows")))))


@query("src_13_clean_landing", "SELECT c_custkey AS Customer_Key, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS Segment_Name, 1700000000 AS _updated_at FROM customer")
def _(t):
    df = t.customer.select(F.col("c_custkey").alias("Customer Key"), F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias("Segment/Name"))
    return W.clean_landing(df, 1700000000)


@query("src_14_reconcile_counts", "SELECT (SELECT COUNT(*) FROM orders) AS source_rows, (SELECT COUNT(*) FROM lineitem) AS target_rows, (SELECT COUNT(*) FROM orders) = (SELECT COUNT(*) FROM lineitem) AS matches")
def _(t):
    return W.reconcile_counts(t.orders, t.lineitem)


@query("src_15_rows_since_max", "SELECT event_id FROM events WHERE ts > (SELECT MAX(ts) FROM events WHERE event_type = 'error')")
def _(t):
    return R.rows_since_max(t.events, t.events.filter("event_type = 'error'"), "ts").select("event_id")


@query("src_16_read_day", "SELECT event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'")
def _(t):
    return R.read_day(t.events, "ts", "2024-01-10").select("event_id")


@query("src_17_rollup_clones", """
SELECT o_orderkey, o_custkey, o_totalprice::DOUBLE AS o_totalprice, CASE WHEN y = 1998 THEN NULL ELSE TRY_CAST(left(o_orderpriority, 1) AS INTEGER) END AS priority, 'orders_' || y || '0108' AS original_table_name, y || '-01-08' AS snapshot_date
FROM (SELECT *, year(o_orderdate) AS y FROM orders) WHERE y BETWEEN 1997 AND 1999""")
def _(t):
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType()), T.StructField("priority", T.IntegerType())])
    clones = {}
    for y in range(1996, 2000):
        df = t.orders.filter(F.year("o_orderdate") == y).select("o_orderkey", F.col("o_custkey").cast("string"), "o_totalprice", F.substring("o_orderpriority", 1, 1).alias("priority"))
        clones[f"orders_{y}0108"] = df.drop("priority") if y == 1998 else df
        clones[f"orders_{y}0115"] = df
    return R.rollup_clones(clones, schema, last="orders_19960108", days=[8])


@query("src_18_recent_sample", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-23' ORDER BY ts DESC, event_id LIMIT 5000000")
def _(t):
    return R.recent_sample(t.events, "ts", "event_id", 7, 5_000_000, "2024-01-30").select("event_id")


@query("src_19_pump", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31'")
def _(t):
    path = W.scratch(t.spark, "pump")
    W.pump(t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority"), path, "o_orderdate", "1998-01-01", "1998-12-31", order=["o_orderkey"])
    return t.spark.read.option("header", True).schema("o_orderkey bigint, o_orderdate timestamp_ntz, o_orderstatus string, o_orderpriority string").csv(path).drop("o_orderdate")


@query("src_20_write_monthly", "SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, COUNT(*) AS n FROM orders GROUP BY 1, 2")
def _(t):
    path = W.scratch(t.spark, "monthly")
    W.write_monthly(t.orders, "o_orderdate", path)
    return R.read_monthly(t.spark, path).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))


def monthly_parts(t):
    parts = {f"events_2024_{w:02d}": t.events.filter(F.weekofyear("ts") == w).select("event_id", "ts", "value") for w in range(1, 6)}
    parts["events_2024_01_scratch"] = t.events.select("event_id", "ts", "value")
    parts["other_2024_01"] = t.events.select("event_id", "ts", "value")
    return parts


@query("src_21_union_partitions", "SELECT event_id FROM events WHERE weekofyear(ts) BETWEEN 1 AND 5")
def _(t):
    return R.union_partitions(monthly_parts(t), r"events_\d{4}_\d{2}", "scratch").select("event_id")


@query("src_22_union_partitions_recent", "SELECT event_id FROM events WHERE weekofyear(ts) BETWEEN 1 AND 5 AND ts >= TIMESTAMP '2024-01-21'")
def _(t):
    return R.union_partitions_recent(monthly_parts(t), r"events_\d{4}_\d{2}", "ts", 10, "2024-01-31", "scratch").select("event_id")


@query("src_23_union_relations", """
SELECT 'customer' AS source_relation, c_custkey AS id, c_acctbal AS balance, NULL AS size FROM customer UNION ALL SELECT 'part', p_partkey, NULL, p_size FROM part""")
def _(t):
    return R.union_relations({"customer": t.customer.selectExpr("c_custkey AS id", "c_acctbal AS balance"), "part": t.part.selectExpr("p_partkey AS id", "p_size AS size")})


@query("src_24_backup", "SELECT s_suppkey, s_name, '2024-01-31' AS day FROM supplier")
def _(t):
    root = W.scratch(t.spark, "backup")
    W.backup(t.supplier, root, "2024-01-31")
    return t.spark.read.parquet(root).select("s_suppkey", "s_name", "day")


@query("src_25_pack_columns", """
SELECT c_custkey, '{"c_nationkey":' || c_nationkey || CASE WHEN c_mktsegment <> 'BUILDING' THEN ',"segment":"' || c_mktsegment || '"' ELSE '' END || '}' AS packed FROM customer""")
def _(t):
    df = t.customer.select("c_custkey", "c_nationkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"))
    return R.pack(df, ["c_nationkey", "segment"], "packed")
