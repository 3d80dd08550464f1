"""Recurring revenue, retention and finance reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkmart.functions import as_col, boundary_diff, least_strict, ratio
from sparkmart.operators import calendar as cal, classify as cls, windows as wn
from sparkmart.operators.windows import join_back, window


def _month_from(d) -> Column:
    """First month start on or after a date."""
    return F.trunc(F.date_add(F.last_day(F.date_sub(as_col(d), 1)), 1), "month")


def mrr_monthly(charges, start, end, keys, as_of, sums: dict) -> DataFrame:
    """Charges to monthly facts: a charge counts in every month with start <= month < end.

    Open charges run to `as_of`; sums: {output: value column}. A charge adds its value in
    its first month and takes it back in the month it has ended, so it costs two rows
    however long it runs. The deltas combine before the shuffle; a running total over the
    months of a key restores the monthly values.
    """
    first = _month_from(F.to_date(as_col(start)))
    until = _month_from(F.coalesce(F.to_date(as_col(end)), F.date_add(F.lit(as_of).cast("date"), 1)))
    moves = F.array(F.struct(first.alias("__m"), F.lit(1).alias("__sign")), F.struct(until.alias("__m"), F.lit(-1).alias("__sign")))
    rows = charges.filter(first < until).select(*keys, *[as_col(c).alias(n) for n, c in sums.items()], F.inline(moves))
    signed = lambda n: F.sum(F.when(F.col("__sign") > 0, F.col(n)).otherwise(-F.col(n)))
    deltas = rows.groupBy(*keys, "__m").agg(F.sum("__sign").alias("__live"), *[signed(n).alias(n) for n in sums])
    w = window(keys, "__m")
    run = w.rowsBetween(*wn.RUNNING)
    levels = deltas.select(*keys, "__m", F.lead("__m").over(w).alias("__next"), F.sum("__live").over(run).alias("__live"), *[F.sum(n).over(run).alias(n) for n in sums])
    months = F.explode(F.sequence("__m", F.add_months("__next", -1), F.expr("INTERVAL 1 MONTH"))).alias("charge_month")
    return levels.filter("__live > 0").select(*keys, months, *sums)


def split_by(df, keys, dim, values: dict, cols) -> DataFrame:
    """Totals and per-value parts of each column in one pass: {prefix: value}; the rest is 'other'."""
    known = as_col(dim).isin(*values.values())
    aggs = [F.sum(as_col(c)).alias(f"total_{c}") for c in cols]
    for prefix, v in values.items():
        aggs += [F.sum(F.when(as_col(dim) == v, as_col(c))).alias(f"{prefix}_{c}") for c in cols]
    aggs += [F.sum(F.when(~known, as_col(c))).alias(f"other_{c}") for c in cols]
    return df.groupBy(*keys).agg(*aggs)


def change_type(arr, previous, row) -> Column:
    arr, previous, row = as_col(arr), as_col(previous), as_col(row)
    return cls.case([
        (row == 1, "New"), ((arr == 0) & (previous > 0), "Churn"), ((arr < previous) & (arr > 0), "Contraction"),
        ((arr > previous) & (row > 1), "Expansion"), (arr == previous, "No Impact")])


def arr_change(df, key, month, cols, arr="arr") -> DataFrame:
    """Month-by-month change per account, with a zero row after the last paid month.

    Input has one row per key and month; `cols` lists numeric columns to carry
    (missing months count 0). The windows hold one row per month of an account.
    """
    keys = [key] if isinstance(key, str) else list(key)
    months = cal.month_range(df, keys, month, out=month)
    grid = months.join(df, [*keys, month], "left")
    numeric = {c for c, t in df.dtypes if c in cols and t != "string"}
    for c in cols:
        if c in numeric:
            grid = grid.withColumn(c, F.coalesce(c, F.lit(0)))
    w = window(keys, month)
    for c in cols:
        prev = F.lag(c).over(w)
        grid = grid.withColumn(f"previous_{c}", F.coalesce(prev, F.lit(0)) if c in numeric else prev)
    grid = grid.withColumn("month_no", F.row_number().over(w))
    return grid.withColumn("type_of_arr_change", change_type(arr, f"previous_{arr}", "month_no"))


def arr_change_reason(df, arr="arr", qty="quantity", category="product_category", rank="product_ranking") -> DataFrame:
    """Split the change into seats, price and tier."""
    a, pa, q, pq = F.col(arr), F.col(f"previous_{arr}"), F.col(qty), F.col(f"previous_{qty}")
    r, pr, c, pc = F.col(rank), F.col(f"previous_{rank}"), F.col(category), F.col(f"previous_{category}")
    per_seat = ratio(a, q) - ratio(pa, pq)
    price = q * per_seat
    seat = F.when((pq != q) & (pq > 0), F.coalesce(ratio(pa, pq) * (q - pq), F.lit(0.0))).when((pq != q) & (pq == 0), a.cast("double")).otherwise(0.0)
    return (
        df.withColumn("seat_change_arr", seat)
        .withColumn("price_change_arr", F.when((pc == c) | ((pc != c) & (pr == r)), price).otherwise(0.0))
        .withColumn("tier_change_arr", F.when(pr != r, F.coalesce(price, F.lit(0.0))).otherwise(0.0))
        .withColumn("seat_change_quantity", F.when(pq != q, q - pq).otherwise(0))
        .withColumn("annual_price_per_seat_change", F.coalesce(per_seat, F.lit(0.0)))
    )


def retention(df, key, month, mrr, months=12) -> DataFrame:
    """Net and gross retention: a month's revenue against the same key's a year later."""
    keys = [key] if isinstance(key, str) else list(key)
    now = df.select(*keys, as_col(month).alias("original_month"), F.add_months(as_col(month), months).alias("retention_month"), as_col(mrr).alias("original_mrr"))
    later = df.select(*keys, as_col(month).alias("retention_month"), as_col(mrr).alias("retention_mrr"))
    out = now.join(later, [*keys, "retention_month"], "left")
    net = F.coalesce("retention_mrr", F.lit(0))
    return (out.withColumn("net_retention_mrr", net)
            .withColumn("gross_retention_mrr", F.when(net > 0, least_strict(net, "original_mrr")).otherwise(0))
            .withColumn("churn_type", retention_type("original_mrr", net)))


def retention_type(original, new) -> Column:
    o, n = as_col(original), as_col(new)
    return cls.case([((n == 0) & (o > 0), "Cancelled"), ((n < o) & (n > 0), "Downgraded"), (n > o, "Upgraded"), (n == o, "Maintained")], "Other")


def retention_reason(o_mrr, o_category, o_rank, o_seats, n_mrr, n_category, n_rank, n_seats) -> Column:
    """Why revenue moved: price, seats, product or a mix. Same category and both price
    and seats moving the same way is a mix; seats alone, price alone, product next."""
    om, oc, orank, os_ = (as_col(c) for c in (o_mrr, o_category, o_rank, o_seats))
    nm, nc, nrank, ns = (as_col(c) for c in (n_mrr, n_category, n_rank, n_seats))
    down, up, same = om > nm, om < nm, oc == nc
    cheaper, dearer = ratio(om, os_) > ratio(nm, ns), ratio(om, os_) < ratio(nm, ns)
    return cls.case([
        ((down & same & (os_ > ns) & cheaper) | (up & same & (os_ < ns) & dearer), "Price Change/Seat Change Mix"),
        ((down & same & (os_ > ns)) | (up & same & (os_ < ns)), "Seat Change"),
        ((down & same & (os_ <= ns)) | (up & same & (os_ >= ns)), "Price Change"),
        ((os_ == ns) & ((down & (orank < nrank)) | (up & (orank > nrank))), "Price Change"),
        (~same & (os_ == ns), "Product Change"),
        (~same & (os_ != ns), "Product Change/Seat Change Mix"),
        ((nm == 0) & (om > 0), "Cancelled")], "Unknown")


def plan_change(o_rank, o_mrr, n_rank, n_mrr) -> Column:
    orank, om, nrank, nm = (as_col(c) for c in (o_rank, o_mrr, n_rank, n_mrr))
    return cls.case([((nm == 0) & (om > 0), "Cancelled"), ((nrank == 0) | (orank == 0), "Not Valid"), (orank == nrank, "Maintained"),
                     (orank > nrank, "Downgraded"), (orank < nrank, "Upgraded")])


def seat_change(o_seats, o_unit, o_mrr, n_seats, n_unit, n_mrr) -> Column:
    os_, ou, om, ns, nu, nm = (as_col(c) for c in (o_seats, o_unit, o_mrr, n_seats, n_unit, n_mrr))
    return cls.case([((nm == 0) & (om > 0), "Cancelled"), (~((ou == "Seats") & (nu == "Seats")), "Not Valid"), (os_ == ns, "Maintained"),
                     (os_ > ns, "Contraction"), (os_ < ns, "Expansion")])


def price_per_seat_change(o_mrr, o_seats, o_unit, n_mrr, n_seats, n_unit) -> Column:
    return F.when((as_col(o_unit) == "Seats") & (as_col(n_unit) == "Seats"), ratio(n_mrr, n_seats) - ratio(o_mrr, o_seats))


def cohort_age(df, key, month) -> DataFrame:
    """Months and quarters since the key's first month."""
    out = wn.partition_agg(df, key, cohort_month=F.min(month))
    return out.withColumn("months_since_start", boundary_diff("month", "cohort_month", month)).withColumn("quarters_since_start", boundary_diff("quarter", "cohort_month", month))


def charge_delta(df, keys, order, col, status, end, as_of, chunk=None) -> DataFrame:
    """Change against the previous segment; the last segment of a cancelled or expired
    subscription gives back what the previous one had."""
    df = wn.lag(df, "__prev", keys, order, col, chunk=chunk)
    df = wn.last_in_period(df, "__last", keys, order)
    previous = F.coalesce("__prev", F.lit(0))
    ended = (F.lower(as_col(status)) == "cancelled") | ((F.lower(as_col(status)) == "active") & (F.to_date(as_col(end)) <= F.lit(as_of).cast("date")))
    return (df.withColumn(f"previous_{col}", previous)
            .withColumn(f"delta_{col}", F.when(ended & (F.col("__last") == 1), -previous).otherwise(as_col(col) - previous)).drop("__prev", "__last"))


def amortise(df, amount, start, end) -> DataFrame:
    """Monthly value of a one-off amount over its rounded months; ends the day after."""
    months = F.round(F.months_between(F.to_date(as_col(end)), F.to_date(as_col(start))), 0)
    return (df.withColumn("term_months", months.cast("int")).withColumn("mrr", ratio(amount, months))
            .withColumn("effective_end", F.date_add(F.to_date(as_col(end)), 1)))


def waterfall(schedule, line, contract, segment, created, period, amount) -> DataFrame:
    """Revenue waterfall: what was scheduled per line as of each period, zero rows for
    the periods a contract outlives its lines, and the total released before.

    Periods are month numbers. What is scheduled for a period changes only when a row is created, so
    a running total along the creation periods gives the amount of every stretch of as-of periods,
    and only stretches are windowed and joined; their as-of periods are written out last. Zero rows
    are stretches as well. What was released before each of a line's months is a running total of its
    own, handed over as a map, bounded by the calendar.
    """
    keys = [contract, line, segment]
    valid = schedule.filter(as_col(created) <= as_col(period)).select(*keys, as_col(created).alias("__created"), as_col(period).alias("period"), as_col(amount).alias("__x"))
    plan = valid.groupBy(*keys, "__created", "period").agg(F.sum("__x").alias("amount"))
    along = window([*keys, "period"], "__created")
    steps = plan.select(*keys, "period", F.col("__created").alias("__from"), F.coalesce(F.lead("__created").over(along) - 1, F.col("period")).alias("__until"),
                        F.sum("amount").over(window([*keys, "period"], "__created", wn.RUNNING)).alias("amount"))
    # A line's last row has its last period, both as period and as as-of period; the segments scheduled
    # there are the ones carried on. The months a line has are a set bounded by the calendar, so the missing
    # ones need no anti join: they are the stretches between those months, and from the last one to the
    # contract's end.
    whole = valid.groupBy(contract, line).agg(F.max("period").alias("__last"), F.collect_set(F.struct("period", as_col(segment).alias("segment"))).alias("__held"))
    ends = valid.groupBy(contract).agg(F.max("period").alias("__end"))
    grid = whole.filter(as_col(line).isNotNull()).join(ends, contract)
    months = F.array_sort(F.array_distinct(F.col("__held.period")))
    after = lambda m, i: F.struct((m + 1).alias("__from"), F.coalesce(F.get("__months", i + 1) - 1, F.col("__end")).alias("__until"))
    gaps = F.filter(F.transform("__months", after), lambda g: g["__from"] <= g["__until"])
    carried = F.filter("__held", lambda h: h["period"] == F.col("__last"))
    filler = (grid.withColumn("__months", months).select(contract, line, carried.alias("__carried"), F.inline(gaps))
              .select(contract, line, F.explode("__carried.segment").alias(segment), "__from", "__until"))
    # Released: rows whose as-of period is their own. Those of fillers add nothing, but they have a total before.
    own = valid.groupBy(line, segment, "period").agg(F.sum("__x").alias("__own"))
    own = own.withColumn("__through", F.coalesce(F.sum("__own").over(window([line, segment], "period", wn.RUNNING)), F.lit(0)))
    known = own.groupBy(line, segment).agg(F.max("period").alias("__hi"), F.max_by("__through", "period").alias("__total"), F.array_sort(F.collect_list(F.struct("period", "__through"))).alias("__own"))
    idle = filler.groupBy(line, segment).agg(F.collect_set(F.struct("__from", "__until")).alias("__idle"))
    known = join_back(known, idle, [line, segment])
    # Up to the last released month the total before is looked up by month, where the month has a row; later it is the whole total.
    before = lambda a: F.coalesce(F.try_element_at(F.filter("__own", lambda o: o["period"] < a), F.lit(-1))["__through"], F.lit(0))
    has = lambda a: F.exists("__own", lambda o: o["period"] == a) | F.exists("__idle", lambda g: a.between(g["__from"], g["__until"]))
    span = F.filter(F.sequence(F.col("__own")[0]["period"], "__hi"), lambda a: F.coalesce(has(a), F.lit(False)))
    total = own.schema["__through"].dataType
    known = known.select(line, segment, "__hi", "__total", F.map_from_entries(F.transform(span, lambda a: F.struct(a, before(a).cast(total)))).alias("__before"))
    rows = steps.unionByName(filler.withColumn("amount", F.lit(0).cast(steps.schema["amount"].dataType)), allowMissingColumns=True)
    rows = join_back(rows, known, [line, segment]).withColumn("as_of_period", F.explode(F.sequence("__from", "__until")))
    prior = F.when(F.col("as_of_period") > F.col("__hi"), F.col("__total")).otherwise(F.try_element_at("__before", F.col("as_of_period")))
    return rows.select(*keys, "as_of_period", F.coalesce("period", "as_of_period").alias("period"), "amount", F.coalesce(prior, F.lit(0)).alias("prior_total"))


def renewals(df, key, end_month, as_of) -> DataFrame:
    """Next and last renewal month relative to the month of `as_of`."""
    now = F.trunc(F.lit(as_of).cast("date"), "month")
    e = as_col(end_month)
    return df.groupBy(key).agg(F.min(F.when(e >= now, e)).alias("next_renewal_month"), F.max(F.when(e < now, e)).alias("last_renewal_month"))


def to_base_currency(lines, rates, on, amount, entity, base_entity, rate="average_rate", sign: Column | None = None) -> DataFrame:
    """Ledger amounts in the base currency; the base entity's lines need no rate."""
    out = lines.join(rates, on, "left")
    value = F.when(as_col(entity) == base_entity, as_col(amount).cast("double")).otherwise(as_col(amount).cast("double") * as_col(rate))
    return out.withColumn("actual_amount", value * (sign if sign is not None else F.lit(1)))


def paid_share(df, group, charge, arr, years, quantity) -> DataFrame:
    """Share of the contract value paid, with value and seat buckets of the whole group."""
    out = wn.partition_agg(df, group, __arr=F.sum(as_col(arr)), __qty=F.sum(as_col(quantity)))
    return (out.withColumn("pct_paid", ratio(F.abs(as_col(charge)), as_col(arr) * as_col(years)))
            .withColumn("arr_bucket", cls.arr_bucket("__arr")).withColumn("seat_bucket", cls.seat_bucket("__qty")).drop("__arr", "__qty"))


def net_cost(usage, credits, key, cost, credit) -> DataFrame:
    total = credits.groupBy(key).agg(F.sum(F.coalesce(as_col(credit), F.lit(0))).alias("total_credits"))
    return usage.join(total, key, "left").withColumn("total_cost", as_col(cost) + F.coalesce("total_credits", F.lit(0)))


def pipeline_movement(snapshots, key, quarter, close_quarter, created_quarter, day, eligible, web, created_ok) -> DataFrame:
    """Where a deal closing in its snapshot quarter came from: there at the start, web
    direct, created and landed, or pulled in. One conditional aggregate decides all.

    A deal seen only before day 5 of the quarter neither starts nor counts as created.
    """
    q, d = as_col(quarter), as_col(day)
    closing = snapshots.filter(as_col(eligible) & (q == as_col(close_quarter)))
    web, early = as_col(web), d <= 5
    born = (as_col(created_quarter) == q) & as_col(created_ok)
    agg = closing.groupBy(as_col(key).alias("deal"), q.alias("quarter")).agg(
        F.max(F.when(early & ~web, d)).alias("__start"), F.bool_or(web).alias("__web"), F.bool_or(born).alias("__born"), F.min(d).alias("first_day"))
    kind = cls.case([
        (F.col("__start") == 5, "1. Starting"), (F.col("__web"), "4. Web Direct"),
        (F.col("__born") & F.col("__start").isNull(), "2. Created & Landed")], "3. Pulled in")
    return agg.withColumn("pipeline_type", kind).drop("__start", "__web", "__born")


def pipeline_velocity(df, targets, keys, quarter, day, days, target, **metrics: Column) -> DataFrame:
    """Metrics per key and day of the quarter against the quarter's target; every target
    has a row for each day, and days without a target stay."""
    measured = df.groupBy(*keys, quarter, day).agg(*[c.alias(n) for n, c in metrics.items()])
    plan = targets.groupBy(*keys, quarter).agg(F.sum(as_col(target)).alias("target"))
    grid = plan.select(*keys, quarter, F.explode(F.sequence(F.lit(1), F.lit(days))).alias(day))
    both = grid.unionByName(measured.select(*keys, quarter, day)).distinct()
    out = join_back(join_back(both, measured, [*keys, quarter, day]), plan, [*keys, quarter])
    return out.select(*keys, quarter, day, *[F.coalesce(n, F.lit(0)).alias(n) for n in metrics], F.coalesce("target", F.lit(0)).alias("target"))


def qtd_metrics(df, keys, close_quarter, today, amount, is_open, is_won) -> DataFrame:
    """Open and won value of this fiscal quarter, of the coming four, and won a year ago."""
    now = cal.fiscal_start("quarter", F.lit(today).cast("date"))
    q, x = as_col(close_quarter), as_col(amount)
    part = lambda cond: F.sum(F.when(cond, x).otherwise(0))
    ahead = (q >= now) & (q <= F.add_months(now, 12))
    return df.groupBy(*keys).agg(
        part((q == now) & as_col(is_open)).alias("qtd_open"), part((q == now) & as_col(is_won)).alias("qtd_won"),
        F.count_if((q == now) & as_col(is_open)).alias("qtd_open_deals"), part(ahead & as_col(is_open)).alias("next_4q_open"),
        part((q == F.add_months(now, -12)) & as_col(is_won)).alias("minus_1_year_won"))


def priority_score(df, account, deal, priority, growth_arr, keep_arr, urgency) -> DataFrame:
    """Request score: priority split into growth and retention by value, each weighted by
    its share within the deal or the account."""
    g, k = F.coalesce(as_col(growth_arr), F.lit(0)).cast("double"), F.coalesce(as_col(keep_arr), F.lit(0)).cast("double")
    out = (df.withColumn("growth_priority", as_col(priority) * F.coalesce(ratio(g, g + k), F.lit(0.0)))
           .withColumn("retention_priority", as_col(priority) * F.coalesce(ratio(k, g + k), F.lit(0.0))))
    out = wn.share_of_or_zero(out, "growth_weight", [account, deal], F.col("growth_priority").cast("decimal(20,8)"))
    out = wn.share_of_or_zero(out, "retention_weight", [account], F.col("retention_priority").cast("decimal(20,8)"))
    out = out.withColumn("combined_score", g * F.col("growth_weight") + k * F.col("retention_weight"))
    return out.withColumn("priority_score", F.col("combined_score") * as_col(urgency))


def prune_terms(df, key, version, start, end, end_year, look_ahead: int, chunk=None) -> DataFrame:
    """Latest valid version of each renewal term.

    A version is superseded when one of the next two ends alike, the next one ends in
    the same fiscal year or starts alike, or any of the next `look_ahead` starts earlier. The rule itself looks no further ahead.
    """
    s = as_col(start)
    tests = {
        "__n_end1": lambda w: F.lead(as_col(end)).over(w), "__n_end2": lambda w: F.lead(as_col(end), 2).over(w), "__n_year": lambda w: F.lead(as_col(end_year)).over(w),
        "__n_start": lambda w: F.lead(s).over(w), "__n_min": lambda w: F.min(s).over(w.rowsBetween(1, look_ahead)),
    }
    if chunk is None:
        w = window(key, version)
        for n, fn in tests.items():
            df = df.withColumn(n, fn(w))
    else:
        df = wn.halo(df, key, version, 0, look_ahead, 10_000, tests, chunk)
    old = ((F.col("__n_end1") == as_col(end)) | (F.col("__n_end2") == as_col(end)) | (F.col("__n_year") == as_col(end_year))
           | (F.col("__n_start") == s) | (F.col("__n_min") < s))
    kept = df.filter(~F.coalesce(old, F.lit(False))).drop(*tests)
    keys = [key] if isinstance(key, str) else list(key)
    return kept.withColumn("__r", F.rank().over(window([*keys, s], as_col(version).desc()))).filter("__r = 1").drop("__r")
