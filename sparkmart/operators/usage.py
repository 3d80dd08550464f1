"""Product usage metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkmart.functions import as_col, boundary_diff, div0, ratio
from sparkmart.operators import aggregates as agg, joins, topk, windows as wn
from sparkmart.operators.windows import join_back, window


def ping_diff(df, col, keys, order, chunk=None) -> DataFrame:
    """All-time counter minus its last reported value."""
    out = wn.last_known(df, "__prev", keys, order, col, include_current=False, chunk=chunk)
    return out.withColumn(f"{col}_since_last_ping", as_col(col) - F.col("__prev")).drop("__prev")


def ping_range(df, col, keys, month) -> DataFrame:
    """First and last month in which a counter was reported."""
    seen = F.when(as_col(col).isNotNull(), as_col(month))
    return wn.partition_agg(df, keys, **{f"{col}_first_ping_month": F.min(seen), f"{col}_last_ping_month": F.max(seen)})


def ping_smooth(df, col, keys, order, days_since, days_in_month, chunk=None) -> DataFrame:
    """Spread each difference evenly over the months since the ping before."""
    daily = ratio(f"{col}_since_last_ping", days_since)
    out = wn.next_known(df, f"{col}_estimated_daily", keys, order, daily, chunk=chunk)
    return out.withColumn(f"{col}_smoothed", F.round(F.col(f"{col}_estimated_daily") * as_col(days_in_month)).cast("long"))


def ping_estimate(df, col, month) -> DataFrame:
    """Smoothed value inside the counter's reported range, NULL outside."""
    m = as_col(month)
    outside = (m <= F.col(f"{col}_first_ping_month")) | (m > F.col(f"{col}_last_ping_month"))
    return df.withColumn(f"{col}_estimated_monthly", F.when(~F.coalesce(outside, F.lit(False)), F.col(f"{col}_smoothed")))


def monthly_from_cumulative(df, instance, metric, at, value, tiebreak) -> DataFrame:
    """Monthly value of an all-time counter, also scaled to 28 days.

    One row per instance, metric and month is kept first, so the windows hold months.
    """
    keys = [instance, metric]
    last = topk.latest_per_period(df, keys, at, "month", tiebreak)
    w = window(keys, F.date_trunc("month", as_col(at)))
    out = last.withColumn("last_ping_at", F.lag(at).over(w)).withColumn("last_ping_value", F.coalesce(F.lag(value).over(w), F.lit(0)))
    days = boundary_diff("day", "last_ping_at", at)
    out = out.withColumn("days_since_last_ping", days).withColumn("monthly_value", as_col(value) - F.col("last_ping_value"))
    return out.withColumn("normalized_monthly_value", ratio(F.col("monthly_value") * 28, F.coalesce(days, F.lit(1))))


def monthly_change(df, col, keys, order, chunk=None) -> DataFrame:
    """Growth since the row before; a reset counter counts from zero."""
    out = wn.lag(df, "__prev", keys, order, col, chunk=chunk)
    diff = as_col(col) - F.col("__prev")
    return out.withColumn(f"{col}_change", F.when(diff >= 0, diff).otherwise(as_col(col))).withColumn(f"{col}_is_used", as_col(col)).drop("__prev")


def pct_reporting(reporting, not_reporting) -> Column:
    return div0(as_col(reporting).cast("double"), as_col(reporting) + as_col(not_reporting))


def usage_estimate(recorded, pct) -> Column:
    """Recorded usage plus what the silent share would add."""
    recorded, pct = as_col(recorded).cast("double"), as_col(pct)
    return recorded + div0(recorded * (1 - pct), pct)


def totals_with_estimates(facts, shares, on, recorded, hosted: Column) -> DataFrame:
    """Recorded and estimated totals; hosted usage is complete and is not extrapolated."""
    own = facts.filter(~hosted).join(shares, on).withColumn("percent_reporting", pct_reporting("reporting_count", "not_reporting_count"))
    host = facts.filter(hosted).select("*", F.lit(1).cast("long").alias("reporting_count"), F.lit(0).cast("long").alias("not_reporting_count"), F.lit(1.0).alias("percent_reporting"))
    both = own.unionByName(host)
    total = F.round(usage_estimate(recorded, "percent_reporting"))
    return both.withColumn("total_with_estimate", total).withColumn("estimated_usage", F.round(total - as_col(recorded)))


def adoption(usage, counters, month, subscription, release, metric, metric_release) -> DataFrame:
    """Share of subscriptions, per month and metric, on a version that has the counter.

    A subscription counts once a month, with its newest release of that month. Counting
    per month and release comes first; a running total from the newest release down then
    answers every counter of a release at once. Metrics meet the totals through an equi
    join on (month, release). A month without usage has no row; where nobody has the
    counter, the share is 0.
    """
    usage = usage.groupBy(month, subscription).agg(F.max(as_col(release)).alias("__r")).filter(F.col(subscription).isNotNull())
    counts = usage.groupBy(month, "__r").agg(F.count(F.lit(1)).alias("__n"))
    totals = usage.groupBy(month).agg(F.count(F.lit(1)).alias("__all"))
    releases = counters.select(as_col(metric_release).alias("__r")).distinct()
    last = usage.select(F.max(month)).scalar()
    wanted = releases.filter(F.col("__r") <= last).select("__r", F.explode(F.sequence(F.col("__r"), last, F.expr("INTERVAL 1 MONTH"))).alias(month), F.lit(True).alias("__want"))
    merged = counts.unionByName(wanted, allowMissingColumns=True).groupBy(month, "__r").agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("__n"), F.bool_or("__want").alias("__want"))
    merged = wn.running(merged, "__with", [month], F.desc("__r"), "__n").filter("__want").select(month, "__r", "__with")
    merged = join_back(merged, totals, [month], "inner")
    own = counters.select(as_col(metric).alias("metric"), as_col(metric_release).alias("__r")).distinct()
    return own.join(merged, "__r").select(month, "metric", ratio("__with", "__all").alias("pct_with_counter"))


def metric_versions(df, keys, version_id, version, instance) -> DataFrame:
    """First and last version in which a metric was seen and the number of instances."""
    return df.groupBy(*keys).agg(
        F.min(version_id).alias("first_version_id"), F.min_by(version, version_id).alias("first_version"),
        F.max(version_id).alias("last_version_id"), F.max_by(version, version_id).alias("last_version"),
        F.count_distinct(instance).alias("instances"))


def xmau(events, ts, user, group, levels: dict, paid, tiebreak, days=28) -> DataFrame:
    """Active users in the last `days` of each month, per level value and plan.

    A group counts as paid when its last event of the window was. levels: {level:
    column}; a NULL column value is left out. Users are made distinct per level once,
    which also yields the total over both plans.
    """
    day = F.to_date(as_col(ts))
    end = F.last_day(day)
    ev = events.filter(day >= F.date_sub(end, days - 1)).withColumn("month", F.trunc(day, "month"))
    flag = ev.groupBy(group, "month").agg(F.max_by(as_col(paid), F.struct(as_col(ts), as_col(tiebreak))).alias("__paid"))
    ev = join_back(ev, flag, [group, "month"])
    pairs = F.array(*[F.struct(F.lit(n).alias("level"), as_col(c).cast("string").alias("name")) for n, c in levels.items()])
    rows = ev.select("month", as_col(user).alias("__u"), "__paid", F.inline(pairs)).filter("name IS NOT NULL").distinct()
    total = rows.select("month", "level", "name", "__u").distinct().groupBy("month", "level", "name").agg(F.count(F.lit(1)).alias("n")).withColumn("plan", F.lit("total"))
    split = rows.groupBy("month", "level", "name", F.when(F.col("__paid"), "paid").otherwise("free").alias("plan")).agg(F.count(F.lit(1)).alias("n"))
    return total.select("month", "level", "name", "plan", F.col("n").alias("active_users")).unionByName(split.select("month", "level", "name", "plan", F.col("n").alias("active_users")))


def stages_per_org(df, org, month, stage, user, stages) -> DataFrame:
    """Active stages per organisation and month, and users per stage as columns."""
    per = df.select(org, month, stage, user).distinct().groupBy(org, month, stage).agg(F.count(user).alias("__u"))
    return per.groupBy(org, month).agg(F.count_if(F.col("__u") > 0).alias("active_stage_count"), *[F.max(F.when(as_col(stage) == s, F.col("__u"))).alias(f"{s}_stage") for s in stages])


def last_ping(df, installation, at, tiebreak) -> DataFrame:
    return topk.latest_per_period(df, [installation], at, "month", tiebreak)


def stage_sum(df, by, mapping: dict, users) -> DataFrame:
    """Users of accounts in which any feature of a stage changed: {stage: [change columns]}."""
    out = []
    for stage, cols in mapping.items():
        used = F.greatest(*[as_col(c) for c in cols], F.lit(0)) > 0
        out.append(F.coalesce(F.sum(F.when(used, as_col(users))), F.lit(0)).alias(f"{stage}_sum"))
    return df.groupBy(*by).agg(*out)


def iqr_fence(df, by, col, width, k=3.0) -> DataFrame:
    """Total and count inside the upper fence Q3 + k (Q3 - Q1)."""
    q = agg.percentiles_wide(df, by, col, {"q1": 0.25, "q3": 0.75}, width)
    fence = q.select(*by, (F.col("q3") + (F.col("q3") - F.col("q1")) * k).alias("outer_boundary"))
    return join_back(df, fence, list(by), "inner").filter(as_col(col) <= F.col("outer_boundary"))


def scorecard(df, by, col, width, cut=0.1, qs=None) -> DataFrame:
    """Percentiles after dropping everything at or below the `cut` quantile."""
    qs = qs or {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p80": 0.8, "p90": 0.9, "pmax": 1.0}
    low = agg.percentiles_wide(df, by, col, {"outlier": cut}, width)
    kept = join_back(df, low, list(by), "inner").filter(as_col(col) > F.col("outlier"))
    return agg.percentiles_wide(kept, by, col, qs, width)


def stage_durations(df, keys, stage, entered, tiebreak, as_of, chunk=None) -> DataFrame:
    """Next stage, days until it, days in the whole pipeline and the current flag."""
    order = [entered, tiebreak]
    out = wn.lead(df, "__next", keys, order, F.struct(as_col(stage).alias("s"), as_col(entered).alias("e")), chunk=chunk)
    out = wn.partition_agg(out, keys, __first=F.min(entered), __last=F.max(entered))
    end = F.coalesce(F.col("__next.e"), F.lit(as_of).cast("timestamp_ntz"))
    return (out.withColumn("next_stage", F.col("__next.s")).withColumn("days_in_stage", boundary_diff("day", entered, end))
            .withColumn("days_in_pipeline", boundary_diff("day", "__first", "__last")).withColumn("is_current_stage", F.col("__next").isNull()).drop("__next", "__first", "__last"))


def headcount(people, by, hired, left, first, last) -> DataFrame:
    """Per month: heads at start and end, average, hires, separations and 12-month retention.

    Heads are running sums of hires minus separations over one row per month, instead
    of one row per person and month.
    """
    move = lambda c, name: people.filter(as_col(c).isNotNull()).groupBy(*by, F.trunc(as_col(c), "month").alias("month")).agg(F.count(F.lit(1)).alias(name))
    grid = people.select(*by).distinct().withColumn("month", F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))))
    out = grid.join(move(hired, "hires"), [*by, "month"], "left").join(move(left, "separations"), [*by, "month"], "left").fillna(0, ["hires", "separations"])
    before = people.groupBy(*by).agg((F.count_if(as_col(hired) < first) - F.count_if(as_col(left) < first)).alias("__opening"))
    net = F.col("hires") - F.col("separations")
    out = join_back(out, before, list(by)).withColumn("headcount_end", F.col("__opening") + F.sum(net).over(window(by, "month", wn.RUNNING))).drop("__opening")
    out = out.withColumn("headcount_start", F.col("headcount_end") - net).withColumn("headcount_average", (F.col("headcount_start") + F.col("headcount_end")) / 2)
    year = window(by, F.desc("month"), (0, 11))
    out = out.withColumn("rolling_12_separations", F.sum("separations").over(year)).withColumn("rolling_12_headcount", F.avg("headcount_average").over(year))
    return out.withColumn("retention", 1 - ratio("rolling_12_separations", "rolling_12_headcount"))


def feature_table(df, key, ts, end, delta_days, measures: dict, target: Column) -> DataFrame:
    """Model features per customer from two windows before `end` and a target after it.

    measures: {name: aggregate input}; period 1 is the latest window, period 2 the one before.
    One conditional aggregate reads the table once.
    """
    age = F.datediff(F.lit(end).cast("date"), F.to_date(as_col(ts)))
    p1, p2, future = (age >= 0) & (age < delta_days), (age >= delta_days) & (age < 2 * delta_days), (age < 0) & (age >= -delta_days)
    cols = []
    for name, c in measures.items():
        cols += [F.sum(F.when(p1, c).otherwise(0)).alias(f"{name}_p1"), F.sum(F.when(p2, c).otherwise(0)).alias(f"{name}_p2"), F.count_if(p1).alias("events_p1") if name == next(iter(measures)) else F.max(F.when(p1, c)).alias(f"{name}_max_p1")]
    out = df.filter(age.between(-delta_days, 2 * delta_days - 1)).groupBy(key).agg(*cols, F.coalesce(F.sum(F.when(future, target)), F.lit(0)).alias("target_value"))
    first = next(iter(measures))
    return out.withColumn(f"{first}_growth", F.col(f"{first}_p1") - F.col(f"{first}_p2")).withColumn("is_target", (F.col("target_value") > 0).cast("int"))


def open_items(items, key, created, closed, first, last, history, valid_from, valid_to, cols, chunk) -> DataFrame:
    """One row per item and day from creation until it closes, with age and the
    attributes valid at the end of that day."""
    lo = F.greatest(F.to_date(as_col(created)), F.lit(first).cast("date"))
    hi = F.least(F.coalesce(F.to_date(as_col(closed)), F.lit(last).cast("date")), F.lit(last).cast("date"))
    days = items.filter(lo <= hi).withColumn("day", F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))))
    days = days.withColumn("open_age_days", boundary_diff("day", created, "day")).withColumn("__at", F.date_add("day", 1).cast("timestamp_ntz") - F.expr("INTERVAL 1 MICROSECOND"))
    return joins.asof(days, "__at", history, key, valid_from, valid_to, cols, "day", chunk=chunk).drop("__at")


def latest_runs(df, item, started, finished, tiebreak) -> DataFrame:
    """Seconds of the latest run of each item."""
    last = topk.latest_per_key(df, [item], [as_col(started).desc(), as_col(tiebreak).desc()])
    micros = F.unix_micros(as_col(finished).cast("timestamp")) - F.unix_micros(as_col(started).cast("timestamp"))
    return last.select(item, F.round(micros / 1000000, 6).alias("run_seconds"))


def last_success(df, item, at, ok, tiebreak) -> DataFrame:
    """Latest passing run of the items whose latest run fails: one aggregate."""
    order = F.struct(as_col(at).alias("at"), as_col(tiebreak).alias("tie"))
    out = df.groupBy(item).agg(F.max_by(as_col(ok), order).alias("__ok"), F.max(F.when(as_col(ok), order)).alias("__last"))
    return out.filter(~F.col("__ok") & F.col("__last").isNotNull()).select(item, F.col("__last.at").alias("last_success_at"))
