"""Addresses and prefixes, metric dictionaries, sliding distinct counts, sessions of hot keys."""

import ipaddress
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkmart.functions.ip import parse_ip
from sparkmart.operators import incremental as I, joins as J, metrics as M, usage as U

FOLDER = "/root/testdata/sf0.001"
ODD = ["1.2.3.4", "1.2.3.4/0", "255.255.255.255/32", "::", "::1/0", "fe80::/10", "::ffff:1.2.3.4/97", "1::2::3", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9",
       "1.2.3.256", "1.2.3", "g::1", "::1/129", "1.2.3.4/33", "1.2.3.4/", "/8", "", None, "1.2.3.4/8/8", ":::", "1:::2", "::1.2.3.4.5", "12345::", "ABCD::EF/64", "1.2.3.4/-1"]


def test_parse_ip_against_the_standard_library(spark):
    rng = random.Random(1)
    texts = ODD + [f"{ipaddress.IPv6Address(rng.getrandbits(128) & ~(0xFFFFFFFF << rng.randrange(100)))}/{rng.randrange(129)}" for _ in range(60)]
    texts += [f"{ipaddress.IPv4Address(rng.getrandbits(32))}/{rng.randrange(33)}" for _ in range(60)]
    for r in spark.createDataFrame([(x,) for x in texts], "ip string").select("ip", parse_ip("ip").alias("p")).collect():
        try:
            n = None if not r.ip or r.ip.endswith("/") else ipaddress.ip_interface(r.ip)
        except ValueError:
            n = None
        if n is None:
            assert r.p is None, r
            continue
        width = 8 if n.version == 4 else 32
        want = (n.version, n.network.prefixlen, *(f"{int(x):0{width}x}" for x in (n.ip, n.network[0], n.network[-1])))
        assert (r.p.family, r.p.prefix, r.p.hex_ip, r.p.hex_ip_range_start, r.p.hex_ip_range_end) == want
        assert (r.p.ipv4, r.p.ipv4_range_start, r.p.ipv4_range_end) == (tuple(int(x) for x in (n.ip, n.network[0], n.network[-1])) if width == 8 else (None, None, None))


def test_longest_prefix_wins(spark):
    nets = [("10.0.0.0/8", 1), ("10.1.0.0/16", 2), ("10.1.2.0/24", 3), ("10.1.2.0/24", 9), ("2001:db8::/32", 4), ("2001:db8::/48", 5), ("::/0", 6), ("nonsense", 7)]
    ips = ["10.1.2.3", "10.1.3.3", "10.2.2.2", "11.0.0.1", "2001:db8::1", "2001:db8:1::", "fe80::1", "bad", None, "10.1.2.3"]
    df = spark.createDataFrame(list(enumerate(ips)), "n int, ip string")
    got = {r.n: r.net for r in J.prefix_lookup(df, "ip", spark.createDataFrame(nets, "prefix string, net int"), "prefix", ["net"], "net").collect()}
    assert [got[i] for i in range(len(ips))] == [3, 2, 1, None, 5, 4, 6, None, None, 3]


def scans(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_a_dictionary_scans_a_table_once(spark):
    orders, customer = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("orders", "customer"))
    by = M.Join("customer", (("o_custkey", "c_custkey"),), unique=True)
    specs = {f"n{i}": M.count("orders", where=F.col("o_totalprice") > i * 1000) for i in range(20)}
    specs |= {f"d{i}": M.distinct("orders", "o_custkey", F.col("o_totalprice") > i * 1000, [by]) for i in range(5)}
    specs |= {f"g{i}": M.groups("orders", "o_custkey", lambda n, i=i: n > i) for i in range(5)} | {"status": M.distinct("orders", "o_orderstatus")}
    out = M.run_metrics({"orders": orders, "customer": customer}, specs, "2024-01-31")
    assert scans(out) == 2 and out.count() == len(specs)
    got = {r.metric: r.value for r in out.collect()}
    per = {r[0]: r[1] for r in orders.groupBy("o_custkey").count().collect()}
    assert [got[f"g{i}"] for i in range(5)] == [sum(n > i for n in per.values()) for i in range(5)]


def test_metrics_of_nothing_and_nulls(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (1, None), (1, 3.0), (2, 4.0)], "k int, v double")
    specs = {"rows": M.count("t"), "values": M.count("t", "v"), "keys": M.distinct("t", "k"), "pairs": M.groups("t", "k", lambda n: n == 2), "big": M.groups("t", "k", lambda n: n >= 1, F.col("v") > 2),
             "none": M.total("t", "v", F.col("v") > 9), "avg": M.total("t", "v", how="avg"), "ratio": M.combined(F.try_divide, "values", "rows"), "unknown": M.combined(lambda a: a + 1, "none")}
    got = {r.metric: r.value for r in M.run_metrics({"t": df}, specs, "d").collect()}
    assert got == {"rows": 5.0, "values": 4.0, "keys": 2.0, "pairs": 2.0, "big": 2.0, "none": None, "avg": 2.5, "ratio": 0.8, "unknown": None}
    got = {r.metric: r.value for r in M.run_metrics({"t": df.limit(0)}, specs, "d").collect()}
    assert got["rows"] == got["keys"] == got["pairs"] == 0.0 and got["avg"] is None


@pytest.mark.parametrize("days", [1, 3, 28])
def test_sliding_distinct_counts(spark, days):
    rng = random.Random(days)
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(days=rng.randrange(60), hours=rng.randrange(24)), rng.choice(["a", "b"]), rng.choice([None, *range(5)])) for _ in range(70)]
    got = {(r.window_end, r.k): (r.events, r.distinct_u) for r in I.slide(spark.createDataFrame(rows, "ts timestamp_ntz, k string, u int"), "ts", days, ["k"], "u").collect()}
    want = {}
    for d in range(60 + days):
        end = (start + timedelta(days=d)).date()
        for k in "ab":
            inside = [r for r in rows if r[1] == k and 0 <= (end - r[0].date()).days < days]
            if inside:
                want[end, k] = (len(inside), len({r[2] for r in inside} - {None}))
    assert got == want


def test_a_value_costs_no_copy_per_window(spark):
    """Rows behind the running totals follow the user-days, not their windows."""
    df = spark.range(400).select(F.timestamp_seconds(F.col("id") * 86400).cast("timestamp_ntz").alias("ts"), F.lit(7).alias("u"))
    plan = I.slide(df, "ts", 28, [], "u")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("explode(sequence") <= 1
    last = {r.window_end: r.distinct_u for r in I.slide(df, "ts", 28, [], "u").collect()}
    assert set(last.values()) == {1} and len(last) == 400 + 27


def test_sessions_of_a_hot_key(spark):
    rng = random.Random(6)
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(seconds=rng.randrange(400_000)), 1 if rng.random() < 0.5 else rng.randrange(9), float(i)) for i in range(600)] + [(None, 1, 1.0), (start, None, 1.0)]
    rows += [(start + timedelta(days=9, seconds=1800 * i), 3, 0.0) for i in range(4)]  # exactly the gap apart: one session
    df = spark.createDataFrame(rows, "ts timestamp_ntz, u int, v double")
    cols = ["u", "session_start", "session_end", "events", "high"]
    mine = I.sessions(df, "ts", 1800, "u", ["events"], highs={"high": "v"})
    plain = I.session(df, "ts", "30 minutes", ["u"], events=F.count(F.lit(1)), high=F.max("v"))
    assert sorted(map(repr, mine.select(cols).collect())) == sorted(map(repr, plain.select(cols).collect()))


def test_adoption_without_users(spark):
    usage = spark.createDataFrame([("2024-01-01", 1, "2024-01-01"), ("2024-03-01", 1, "2023-01-01")], "m string, s int, r string").selectExpr("CAST(m AS DATE) AS month", "s", "CAST(r AS DATE) AS r")
    counters = spark.createDataFrame([("old", "2024-01-01"), ("new", "2024-03-01")], "metric string, r string").selectExpr("metric", "CAST(r AS DATE) AS r")
    got = {(r.metric, str(r.month)): r.pct_with_counter for r in U.adoption(usage, counters, "month", "s", "r", "metric", "r").collect()}
    assert got == {("old", "2024-01-01"): 1.0, ("old", "2024-03-01"): 0.0, ("new", "2024-03-01"): 0.0}


def test_a_suite_scans_a_table_once(spark):
    from sparkmart.plans.q_privacy_quality import SUITE, line_suite
    from sparkmart.plans.registry import Tables

    suite = line_suite(Tables(spark, FOLDER))
    assert len(SUITE) == 20 and scans(suite.report()) == 1 + 3  # lineitem, and one a related table
    failed = suite.failures()
    report = {r.test: r for r in suite.report().collect()}
    assert set(failed) == {n for n, r in report.items() if not r.passed} and {n: df.count() for n, df in failed.items()} == {n: report[n].violations for n in failed}
