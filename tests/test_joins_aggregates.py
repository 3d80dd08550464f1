"""Joins, aggregates, matching and quality on hand-made rows."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import aggregates as A, joins as J, matching as M, quality as Q, revenue as R, topk, usage as U, windows as wn
from tests.plans import findings, physical


def test_not_in_follows_sql(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    sub = lambda *v: spark.createDataFrame([(x,) for x in v], "k int")
    ks = lambda d: sorted((r["k"] for r in d.collect()), key=str)
    assert ks(J.anti(df, sub(1), "k")) == [2, None]
    assert ks(J.anti(df, sub(1), "k", null_aware=True)) == [2]
    assert ks(J.anti(df, sub(1, None), "k", null_aware=True)) == []
    assert ks(J.anti(df, sub(), "k", null_aware=True)) == [1, 2, None]


def test_range_lookup_edges(spark):
    points = spark.createDataFrame([(i, float(v)) for i, v in enumerate([-5, 0, 9.99, 10, 25, 30, 1000])], "id int, x double")
    ranges = spark.createDataFrame([("a", 0.0, 10.0), ("b", 10.0, 29.5), ("c", -7.0, -5.0)], "r string, lo double, hi double")
    for width in (1, 7, 100):
        out = J.range_lookup(points, "x", ranges, "lo", "hi", width)
        assert sorted((r["id"], r["r"]) for r in out.collect()) == [(0, "c"), (1, "a"), (2, "a"), (3, "a"), (3, "b"), (4, "b")]
        assert not findings(physical(out))


def test_overlap_join_equals_brute_force(spark):
    rnd = random.Random(3)
    make = lambda: [(rnd.randint(1, 3), i, *sorted(rnd.sample(range(60), 2))) for i in range(40)]
    a, b = make(), make()
    for rows in (a, b):  # open ends, the end of time, a NULL key
        rows += [(1, 100, 7, None), (2, 101, 30, None), (2, 102, 5, 2_000_000_000), (None, 103, 1, None)]
    a[0], b[0] = (1, 0, 7, 7), (1, 0, 7, 7)
    a = [x for x in a if x[0] is not None] + [(None, 103, 1, None)]
    da = spark.createDataFrame(a, "k int, ai int, af int, at int")
    db = spark.createDataFrame(b, "k int, bi int, bf int, bt int")
    got = J.overlap_join(da, db, "k", ("af", "at"), ("bf", "bt"), lambda c: F.floor(c / 5))
    end = lambda x: 10**9 if x is None else x
    want = sorted((x[1], y[1]) for x in a for y in b if x[0] is not None and x[0] == y[0] and x[2] <= end(y[3]) and y[2] <= end(x[3]))
    assert sorted((r["ai"], r["bi"]) for r in got.collect()) == want


def test_explode_interval_is_half_open(spark):
    df = spark.createDataFrame([(1, "2020-01-15", "2020-03-01"), (2, "2020-01-01", "2020-01-01"), (3, "2020-01-31", "2020-02-02")], "id int, s string, e string")
    out = J.explode_interval(df, F.to_date("s"), F.to_date("e"))
    assert sorted((r["id"], str(r["month"])) for r in out.collect()) == [(1, "2020-01-01"), (1, "2020-02-01"), (3, "2020-01-01"), (3, "2020-02-01")]


def test_percentiles_with_ties_and_one_row(spark):
    import statistics
    data = [("a", float(v)) for v in [1, 1, 1, 2, 9, 9, 100]] + [("b", 5.0)] + [("c", float(v)) for v in range(1000)]
    df = spark.createDataFrame(data + [("a", None)], "g string, v double")
    for width in (0.5, 10, 10_000):
        got = {(r["g"], r["q"]): r["value"] for r in A.percentiles(df, ["g"], "v", [0.0, 0.25, 0.5, 1.0], width).collect()}
        assert got[("a", 0.5)] == 2 and got[("a", 0.0)] == 1 and got[("a", 1.0)] == 100 and got[("b", 0.25)] == 5
        assert got[("c", 0.25)] == pytest.approx(statistics.quantiles(range(1000), n=4, method="inclusive")[0])


def test_approximate_percentile_rank_error(spark):
    df = spark.range(10_000).select(F.lit("x").alias("g"), (F.col("id") * 7 % 10_000).cast("double").alias("v"))
    got = A.group(df, ["g"], p=F.percentile_approx("v", 0.9, 1000)).collect()[0]["p"]
    assert abs(got - 9000) <= 10_000 / 1000 * 2


def test_rollup_keeps_real_nulls(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2), (None, None, 4)], "p string, q string, n int")
    got = {(r["p"], r["q"]): r["n"] for r in A.rollup_total(df, ["p", "q"], n=F.sum("n")).collect()}
    assert got == {("a", "x"): 1, ("a", None): 2, (None, None): 4, ("a", "Total"): 3, (None, "Total"): 4, ("Total", "Total"): 7}


def test_column_values_guard(spark):
    with pytest.raises(ValueError):
        A.column_values(spark.range(50).withColumn("c", F.col("id")), "c", F.count(F.lit(1)), limit=10)


def test_revenue_edges(spark):
    d = lambda m: datetime(2020, m, 1).date()
    df = spark.createDataFrame([(1, d(1), 100.0, 2, 1, "p"), (1, d(2), 100.0, 4, 1, "p"), (1, d(4), 50.0, 4, 2, "q"), (2, d(1), 10.0, 0, 0, "z")],
                               "k int, month date, arr double, quantity int, product_ranking int, product_category string")
    out = R.arr_change_reason(R.arr_change(df, "k", "month", ["arr", "quantity", "product_ranking", "product_category"]))
    got = {(r["k"], r["month"].month): (r["type_of_arr_change"], r["seat_change_arr"], r["price_change_arr"]) for r in out.collect()}
    assert got[(1, 1)][0] == "New" and got[(1, 2)] == ("No Impact", 100.0, -100.0) and got[(1, 3)][0] == "Churn"
    assert got[(1, 4)][0] == "Expansion" and got[(1, 5)][0] == "Churn" and got[(2, 2)][0] == "Churn"
    ch = spark.createDataFrame([(1, "2020-01-15", "2020-03-10", 5), (1, "2020-02-01", None, 7), (2, "2020-01-02", "2020-01-20", 9)], "k int, s string, e string, v int")
    facts = R.mrr_monthly(ch, F.to_date("s"), F.to_date("e"), ["k"], "2020-04-20", {"v": F.col("v")})
    assert sorted((r["k"], r["charge_month"].month, r["v"]) for r in facts.collect()) == [(1, 2, 12), (1, 3, 12), (1, 4, 7)]
    assert spark.range(1).select(R.retention_type(F.lit(0), F.lit(0)), R.plan_change(F.lit(0), F.lit(5), F.lit(1), F.lit(5))).collect()[0][:] == ("Maintained", "Not Valid")


def test_match_score(spark):
    rows = [(1, "x", "creator", 1), (1, "x", "owner", 1), (1, "x", "user", 2), (1, None, "user", 3), (2, "x", "user", 1), (2, "y", "user", 2), (3, None, "user", 9)]
    got = {r["group_id"]: (r["org_id"], r["match_type"]) for r in M.match_score(spark.createDataFrame(rows, "g int, o string, r string, u int"), "g", "o", "r", "u").collect()}
    assert got == {1: ("x", 7), 2: ("x", 1)}


def test_attribution_weights_sum_to_one(spark):
    touches = spark.createDataFrame([(k, i, datetime(2020, 1, i)) for k, n in ((1, 1), (2, 2), (3, 6)) for i in range(1, n + 1)], "k int, touch int, ts timestamp_ntz")
    conv = spark.createDataFrame([(k, datetime(2020, 1, 2), datetime(2020, 2, 1), 100.0) for k in (1, 2, 3)], "k int, lead_at timestamp_ntz, conv_at timestamp_ntz, value double")
    for model in M.MODELS:
        out = M.attribute(touches, conv, "k", "ts", "touch", "lead_at", "conv_at", "value", model).groupBy("k").agg(F.sum("weight").alias("w"))
        for r in out.collect():
            assert r["w"] == pytest.approx(1.0), (model, r)


def test_quality(spark):
    df = spark.createDataFrame([(1, "a", datetime(2024, 1, 16)), (1, "b", datetime(2024, 1, 20)), (None, None, datetime(2024, 1, 16))], "k int, v string, at timestamp_ntz")
    assert Q.not_null(df, "k").count() == 1 and Q.unique(df, "k").count() == 1 and Q.unique_combination(df, ["k", "v"]).count() == 0
    assert Q.at_least_one(df, "v").count() == 0 and Q.at_least_one(df.filter("v IS NULL"), "v").count() == 1
    assert Q.accepted_values(df, "v", ["a"]).collect()[0]["value"] == "b"
    assert Q.relationships(df, "k", spark.createDataFrame([(2,)], "k2 int"), "k2").count() == 2
    assert Q.expression_is_true(df, "k > 0").count() == 1
    assert Q.new_rows_per_day(df, "at", "2024-01-17", 3).count() == 1      # Tuesday, two rows
    assert Q.new_rows_per_day(df, "at", "2024-01-21", 3).count() == 0      # Saturday is not checked
    assert Q.golden_records(df.select("k", "v"), df.select("k", F.when(F.col("v") != "b", F.col("v")).alias("v"))).count() == 1
    assert Q.missing_columns(df, ["K", "x"]) == ["x"] and Q.missing_tables(spark, ["no_such_table"]) == ["no_such_table"]


def test_usage_edges(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([5, 8, 3, None, 4])], "k int, n int, v int")
    assert [r["v_change"] for r in U.monthly_change(df, "v", "k", "n").orderBy("n").collect()] == [5, 3, 3, None, 4]
    assert spark.range(1).select(U.pct_reporting(F.lit(0), F.lit(0)), U.usage_estimate(F.lit(10), F.lit(0.5)), U.usage_estimate(F.lit(10), F.lit(0.0))).collect()[0][:] == (0.0, 20.0, 10.0)


def test_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (3,)], "k int")
    assert [r["k"] for r in topk.drop_duplicated(df, "k").collect()] == [2]
    assert sorted(r[:] for r in topk.duplicates(df, "k").collect()) == [(1, 2), (3, 3)]


def test_plans_scale(spark):
    from sparkmart.plans.registry import all_queries
    for key in ("jn_7_interval_explosion", "jn_8_asof", "jn_9_range_lookup", "jn_10_overlap", "jn_14_not_in_null_aware", "jn_17_cumulative_eligibility", "wn_15_count_distinct_over",
                "rev_1_mrr_monthly", "rev_10_waterfall", "met_8_counter_adoption", "evt_3_sessions", "dq_7_monthly_within_stdevs"):
        bad = [f for f in findings(physical(all_queries()[key](spark, "/root/testdata/sf0.001"))) if not f.startswith("global window")]
        assert not bad, (key, bad)
    assert wn.HotKeys(F.lit(1)).rows == 1_000_000


def test_full_match_keeps_null_keys_apart(spark):
    a = spark.createDataFrame([(1, "x"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(1, "y"), (2, "z"), (None, "m")], "k int, v string")
    got = J.full_match({"a": a, "b": b}, "k", [(("a", "b"), "both"), (("a",), "only a"), (("b",), "only b")]).collect()
    assert sorted((r["k"] or 0, r["a_v"] or "", r["b_v"] or "", r["match_status"]) for r in got) == [(0, "", "m", "only b"), (0, "n", "", "only a"), (1, "x", "y", "both"), (2, "", "z", "only b")]


def test_adoption_counts_a_subscription_once(spark):
    from sparkmart.operators import usage as U
    d = __import__("datetime").date
    use = spark.createDataFrame([(d(2024, 3, 1), 1, d(2024, 1, 1)), (d(2024, 3, 1), 1, d(2024, 2, 1)), (d(2024, 3, 1), 2, d(2023, 12, 1))], "month date, s int, rel date")
    counters = spark.createDataFrame([("m", d(2024, 1, 1)), ("n", d(2023, 1, 1))], "metric string, rel date")
    got = {r["metric"]: r["pct_with_counter"] for r in U.adoption(use, counters, "month", "s", "rel", "metric", "rel").filter("month = '2024-03-01'").collect()}
    assert got == {"m": 0.5, "n": 1.0}


def test_overlap_reads_all_into_an_empty_target(spark):
    from sparkmart.operators import incremental as I
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "k int, t string").select("k", F.col("t").cast("timestamp_ntz").alias("ts"))
    assert I.with_overlap(rows.limit(0), rows, "ts", "k", [F.desc("ts")]).count() == 2
