"""Chunked windows must equal plain ones, whatever the skew."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import events as E, joins as J, windows as wn


@pytest.fixture(scope="module")
def df(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(150):
        # Key 1 holds most rows, some rows have no key, values have gaps.
        key = rnd.choice([1, 1, 1, 1, 2, 3, None])
        ts = datetime(2024, 1, 1) + timedelta(minutes=rnd.randint(0, 20000)) if rnd.random() > 0.08 else None
        rows.append((i, key, ts, rnd.choice([None, 1, 2, 5, 9]), rnd.choice("abc")))
    return spark.createDataFrame(rows, "id int, k int, ts timestamp_ntz, v int, c string").cache()



def chunks():
    day = F.to_date("ts")
    return [wn.HotKeys(day, 30), wn.HotKeys(F.date_trunc("hour", "ts"), 0)]


ORDER = ["ts", "id"]
OPS = {
    "row_number": lambda d, ch: wn.row_number(d, "o", "k", ORDER, chunk=ch),
    "rank": lambda d, ch: wn.rank(d.withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz")), "o", "k", "ts", chunk=ch),
    "lag": lambda d, ch: wn.lag(d, "o", "k", ORDER, "v", chunk=ch),
    "lag_default": lambda d, ch: wn.lag(d, "o", "k", ORDER, "c", default="none", chunk=ch),
    "lead": lambda d, ch: wn.lead(d, "o", "k", ORDER, "v", chunk=ch),
    "last_known": lambda d, ch: wn.last_known(d, "o", "k", ORDER, "v", chunk=ch),
    "last_known_before": lambda d, ch: wn.last_known(d, "o", "k", ORDER, "v", include_current=False, chunk=ch),
    "next_known": lambda d, ch: wn.next_known(d, "o", "k", ORDER, "v", chunk=ch),
    "sum": lambda d, ch: wn.running(d, "o", "k", ORDER, "v", chunk=ch),
    "sum_before": lambda d, ch: wn.running(d, "o", "k", ORDER, "v", include_current=False, chunk=ch),
    "count": lambda d, ch: wn.running(d, "o", "k", ORDER, "v", agg="count", chunk=ch),
    "count_before": lambda d, ch: wn.running(d, "o", "k", ORDER, "v", agg="count", include_current=False, chunk=ch),
    "min": lambda d, ch: wn.running(d, "o", "k", ORDER, "v", agg="min", chunk=ch),
    "max": lambda d, ch: wn.running(d, "o", "k", ORDER, "v", agg="max", include_current=False, chunk=ch),
    "row_number_desc": lambda d, ch: wn.row_number(d, "o", "k", [F.desc("ts"), F.desc("id")], chunk=ch),
    "rank_desc": lambda d, ch: wn.rank(d.withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz")), "o", "k", F.desc("ts"), chunk=ch),
    "sum_desc": lambda d, ch: wn.running(d, "o", "k", [F.desc("ts"), "id"], "v", chunk=ch),
    "max_before_desc": lambda d, ch: wn.running(d, "o", "k", [F.col("ts").desc(), "id"], "v", agg="max", include_current=False, chunk=ch),
    "change": lambda d, ch: wn.change_counter(d, "o", "k", ORDER, "c", chunk=ch),
    "session": lambda d, ch: E.sessionize(d, "k", "ts", "id", 7200, ch).withColumnRenamed("session_index", "o"),
    "views": lambda d, ch: E.page_views(d, "k", "ts", "id", 7200, ch).withColumnRenamed("page_view_in_session", "o"),
}


def result(d):
    return sorted((r["id"], r["o"]) for r in d.select("id", "o").collect())


@pytest.mark.parametrize("name", OPS)
def test_chunked_equals_plain(df, name):
    plain = result(OPS[name](df, None))
    for chunk in chunks():
        assert result(OPS[name](df, chunk)) == plain, chunk


def test_rank_of_value(df):
    for desc in (False, True):
        order = F.col("v").desc() if desc else F.col("v").asc()
        want = result(df.withColumn("o", F.rank().over(wn.window("k", order))))
        assert result(wn.rank_of_value(df, "o", "k", "v", descending=desc)) == want
        band = lambda v: F.floor(v / 3)
        assert result(wn.rank_of_value(df, "o", "k", "v", descending=desc, chunk=band)) == want


def test_cut_offsets_refuse_other_orders(df):
    for order in ([F.desc("ts"), "id"], [F.col("ts").asc_nulls_last(), "id"]):
        with pytest.raises(ValueError):
            wn.lag(df, "o", "k", order, "v", chunk=wn.HotKeys(F.to_date("ts"), 30))
    with pytest.raises(ValueError):
        wn.running(df, "o", "k", [F.col("ts").desc_nulls_first(), "id"], "v", chunk=wn.HotKeys(F.to_date("ts"), 30))


def test_halo_equals_plain(df):
    w = wn.window("k", ORDER)
    want = {r["id"]: (r["a"], r["b"], r["s"]) for r in df.select(
        "id", F.lag("v", 3).over(w).alias("a"), F.lead("v", 2).over(w).alias("b"), F.sum("v").over(w.rowsBetween(-2, 1)).alias("s")).collect()}
    exprs = {"a": lambda w: F.lag("v", 3).over(w), "b": lambda w: F.lead("v", 2).over(w), "s": lambda w: F.sum("v").over(w.rowsBetween(-2, 1))}
    for chunk in chunks():
        got = wn.halo(df, "k", ORDER, 3, 2, 7, exprs, chunk)
        assert {r["id"]: (r["a"], r["b"], r["s"]) for r in got.collect()} == want
        assert got.count() == df.count()


def test_asof_and_nearest_with_hot_keys(spark, df):
    df = df.filter("ts is not null")
    points, facts = df.filter("id % 2 = 0"), df.filter("id % 2 = 1")
    # Some versions overlap, some are open, some share a start.
    until = F.when(F.col("id") % 3 == 0, F.col("ts") + F.expr("INTERVAL 5 DAYS")).when(F.col("id") % 3 == 1, F.col("ts") + F.expr("INTERVAL 3 HOURS"))
    scd = facts.select("k", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("f"), F.when(F.col("id") % 7 != 1, until).alias("t"), F.col("id").alias("hit"))
    plain = facts.select("k", F.col("ts").alias("f"), F.col("id").alias("hit"))
    for chunk in (None, lambda c: wn.HotKeys(F.to_date(c), 20)):
        got = {r["id"]: r["hit"] for r in J.asof(points, "ts", scd, "k", "f", "t", ["hit"], "id", chunk=chunk).collect()}
        near = {r["id"]: r["hit"] for r in J.nearest(points, "ts", plain, "f", "k", "id", ["hit"], chunk=chunk).collect()}
        ps, ss, fs = points.collect(), scd.collect(), facts.collect()
        assert len(got) == len(near) == len(ps)
        far = datetime(9999, 1, 1)
        for p in ps:
            valid = [s for s in ss if p["k"] is not None and s["k"] == p["k"] and s["f"] <= p["ts"] <= (s["t"] or far)]
            top = max(((s["f"], s["t"] or far) for s in valid), default=None)
            assert got[p["id"]] in ([s["hit"] for s in valid if (s["f"], s["t"] or far) == top] or [None])
            same = [f for f in fs if p["k"] is not None and f["k"] == p["k"]]
            gap = min((abs(f["ts"] - p["ts"]) for f in same), default=None)
            assert near[p["id"]] in ([f["id"] for f in same if abs(f["ts"] - p["ts"]) == gap] or [None])
        inner = J.asof(points, "ts", scd, "k", "f", "t", ["hit"], "id", chunk=chunk, how="inner")
        assert {r["id"] for r in inner.collect()} == {i for i, h in got.items() if h is not None}


def test_top_k_prunes_before_the_shuffle(spark, df):
    from sparkmart.operators import topk
    plan = topk.latest_per_key(df, ["k"], [F.desc("ts"), "id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
