"""Plans and partitions that decide how operators grow: few passes, no key that takes all rows into one task."""

import random
import re
from collections import Counter

from pyspark.sql import Row, functions as F

from sparkmart.operators import events as E, hierarchy as H, joins as J, metrics as M, revenue as R


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def settings(spark, **values):
    """Sets `spark.sql.*` values and returns a function that puts the old ones back."""
    names = {"spark.sql." + k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    return lambda: [spark.conf.set(k, v) for k, v in before.items()]


def test_events_without_a_user_are_not_dealt_to_one_task(spark):
    back = settings(spark, autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    try:
        rows = spark.range(0, 400, 1, 4).select(F.col("id").alias("k"), F.lit("2024-01-02").cast("timestamp_ntz").alias("at"), F.when(F.col("id") == 7, 1).alias("user"))
        users = spark.createDataFrame([(1, "x")], "id long, name string").withColumn("created_at", F.lit("2024-01-01").cast("timestamp_ntz"))
        out = E.unify_events([E.EventSpec("a", "s", rows, "k", "at", "user")], users, users)
        got = out.withColumn("task", F.spark_partition_id()).collect()
        assert len(got) == 400
        assert [(r.event_id, r.user_name, r.days_since_user_creation) for r in got if r.user_name] == [(7, "x", 1)]
        assert len({r.task for r in got if r.user_id is None}) == 4
    finally:
        back()


def test_each_tier_is_computed_once(spark):
    tiers = [("few", spark.range(0, 3)), ("more", spark.range(1, 5)), ("all", spark.range(0, 6))]
    out = J.fallback_match([(n, df.select(F.when(F.col("id") < 5, F.col("id")).alias("k"), "id")) for n, df in tiers], "k")
    assert physical(out).count("Range (") == 3
    assert sorted((r.id, r.tier_name) for r in out.collect()) == [(0, "few"), (1, "few"), (2, "few"), (3, "more"), (4, "more"), (5, "all")]
    assert out.columns == ["k", "id", "tier_name"]


def test_lists_of_values_do_not_carry_other_metrics(spark):
    df = spark.createDataFrame([Row(a=1, b=1, c=2.0), Row(a=1, b=2, c=None), Row(a=None, b=2, c=3.0)])
    specs = {f"n{i}": M.count("t", where=F.col("a") > i) for i in range(6)} | {"a": M.distinct("t", "a"), "b": M.distinct("t", "b", F.col("a").isNotNull()), "twice": M.groups("t", "b", lambda n: n > 1), "c": M.total("t", "c"), "none": M.distinct("t", "b", F.col("a") > 5)}
    out = M.run_metrics({"t": df}, specs, "d")
    # The longest aggregate has a count per metric of one column, and the one sum; not one per metric.
    grouped = re.findall(r"HashAggregate\(keys=\[__k.*?functions=\[(.*?)\], output", physical(out).replace("Sort", "").replace("Object", "")) or [physical(out)]
    assert max(g.count("partial_") for g in grouped) == M.COUNTS + 1
    assert {r.metric: r.value for r in out.collect()} == {"n0": 2.0, **{f"n{i}": 0.0 for i in range(1, 6)}, "a": 1.0, "b": 2.0, "twice": 1.0, "c": 5.0, "none": 0.0}


def test_percentiles_by_flag_meet_the_lines_without_a_shuffle(spark, tmp_path):
    from sparkmart.plans.registry import all_queries
    back = settings(spark, autoBroadcastJoinThreshold="-1")
    try:
        rows = spark.range(0, 2000, 1, 3).select(F.when(F.col("id") % 2 == 0, "A").otherwise("R").alias("l_returnflag"), F.col("id").cast("double").alias("l_extendedprice"))
        rows.write.parquet(f"{tmp_path}/lineitem.parquet")
        out = all_queries()["ag_11_percentile_approx"](spark, str(tmp_path))
        assert "SortMergeJoin" not in physical(out)
        assert sorted(tuple(r) for r in out.collect()) == [("A", True, True), ("R", True, True)]
    finally:
        back()


def waterfall_by_hand(rows):
    """(contract, line, segment, as of, period, amount, prior) by the definition, month by month."""
    b = Counter()
    for contract, line, segment, c, p, x in rows:
        for a in range(c, p + 1):
            b[contract, line, segment, a, p] += x
    for (contract, line), hi in {k: max(r[4] for r in rows if (r[0], r[1]) == k and r[3] <= r[4]) for k in {(r[0], r[1]) for r in rows if r[3] <= r[4]}}.items():
        mine = [r for r in rows if (r[0], r[1]) == (contract, line) and r[3] <= r[4]]
        end = max(r[4] for r in rows if r[0] == contract and r[3] <= r[4])
        for segment in {r[2] for r in mine if r[4] == hi}:
            for p in set(range(min(r[4] for r in mine), end + 1)) - {r[4] for r in mine}:
                b[contract, line, segment, p, p] += 0
    own = Counter()
    for (_, line, segment, a, p), x in b.items():
        if a == p:
            own[line, segment, a] += x
    prior = {k: sum(x for (ln, sg, a), x in own.items() if (ln, sg) == k[:2] and a < k[2]) for k in own}
    return sorted((*k, x, prior.get((k[1], k[2], k[3]), 0)) for k, x in b.items())


def test_waterfall_keeps_zero_rows_as_stretches(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(150):
        c = rng.randrange(1, 20)
        rows.append((rng.randrange(4), rng.randrange(9), rng.choice("AB"), c, c + rng.randrange(-1, 5), rng.randrange(1, 9)))
    rows.append((0, 0, "A", 30, 40, 1))
    df = spark.createDataFrame(rows, "contract long, line long, segment string, c int, p int, x long").withColumn("x", F.col("x").cast("decimal(18,2)"))
    out = R.waterfall(df, "line", "contract", "segment", "c", "p", "x")
    # Months are written out once, in the end.
    assert physical(out).count("Generate explode(sequence") == 1 and "array_except" not in physical(out)
    assert out.columns == ["contract", "line", "segment", "as_of_period", "period", "amount", "prior_total"]
    assert sorted((*r[:5], int(r.amount), int(r.prior_total)) for r in out.collect()) == waterfall_by_hand(rows)


def test_parentage_reads_lineages_once(spark):
    texts = {1: "1,2,3", 4: "4,5,3", 6: "6,3", 7: "7", 8: "8,9", 10: "10,9"}
    at = {1: 3, 4: 2, 6: 1, 7: 5, 8: None, 10: None}
    lineage = F.create_map(*[F.lit(x) for k, v in texts.items() for x in (k, v)])
    cohort = F.create_map(*[F.lit(x) for k, v in at.items() for x in (k, v)])
    rows = spark.range(1, 11).filter(F.col("id").isin(*texts))
    out = H.lineage_parentage(rows.select(F.col("id").cast("string").alias("id"), F.try_element_at(lineage, F.col("id").cast("int")).alias("lineage")), "id", rows.select("id", F.try_element_at(cohort, F.col("id").cast("int")).alias("cohort")), "cohort")
    # Once for the lineages and once for the cohorts.
    assert physical(out).count("Range (") == 2
    # 3 sits deepest with 1 and 4; 4 is earlier and takes 1. Without cohorts the smaller id, as text, wins.
    got = {r.child: (r.ultimate_parent, r.cohort) for r in out.collect()}
    assert got == {"1": ("4", 2), "2": ("1", 3), "3": ("4", 2), "4": ("4", 2), "5": ("4", 2), "6": ("6", 1), "7": ("7", 5), "8": ("10", None), "9": ("10", None), "10": ("10", None)}
