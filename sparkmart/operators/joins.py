"""Joins that need more than `df.join`.

Equi joins leave the physical choice to Spark: it broadcasts a side whose
measured size is under the threshold and splits skewed partitions at run time.
The operators here turn range, interval and as-of conditions into equi joins on
a bucket or into one sorted pass, so no plan falls back to a nested loop and no
key group is paired with itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sparkmart.functions import as_col
from sparkmart.functions.ip import network_of, parse_ip
from sparkmart.operators import topk, windows as wn
from sparkmart.operators.windows import join_back


def _and(conds):
    return reduce(lambda a, b: a & b, conds)


def star(fact, *dims) -> DataFrame:
    """Inner joins of a fact to its dimensions: (dim, fact key, dim key)."""
    for dim, fk, dk in dims:
        fact = fact.join(dim, fact[fk] == dim[dk])
    return fact


def left_composite(a, b, keys: dict) -> DataFrame:
    """Left join on several differently named keys."""
    return a.join(b, _and([a[x] == b[y] for x, y in keys.items()]), "left")


def full_match(lists: dict, key, statuses) -> DataFrame:
    """Full outer join of keyed lists with one presence flag each and a match status.

    One union and one aggregate do the work of a chain of full joins; each list
    holds a key at most once. NULL keys match nothing: each stays a row of its own list.
    Value columns that several lists have are named list_column. statuses: [(names that
    must be present, label)].
    """
    names = list(lists)
    held = [c for df in lists.values() for c in df.columns if c != key]
    lists = {n: df.select(key, *[F.col(c).alias(f"{n}_{c}" if held.count(c) > 1 else c) for c in df.columns if c != key]) for n, df in lists.items()}
    parts = [df.select(key, *[c for c in df.columns if c != key]).withColumn(f"in_{n}", F.lit(True)) for n, df in lists.items()]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    values = [c for c in both.columns if c != key and not c.startswith("in_")]
    merged = both.filter(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.coalesce(F.bool_or(f"in_{n}"), F.lit(False)).alias(f"in_{n}") for n in names],
        *[F.max(c).alias(c) for c in values])
    alone = both.filter(F.col(key).isNull()).withColumns({f"in_{n}": F.coalesce(f"in_{n}", F.lit(False)) for n in names})
    merged = merged.unionByName(alone)
    status = None
    for present, label in statuses:
        cond = _and([F.col(f"in_{n}") if n in present else ~F.col(f"in_{n}") for n in names])
        status = F.when(cond, label) if status is None else status.when(cond, label)
    return merged.withColumn("match_status", status)


def right_spine(facts, spine, key) -> DataFrame:
    """Every row of the spine, with facts where there are any."""
    return facts.join(spine, key, "right")


def cross_param(df, **scalars: Column) -> DataFrame:
    """Attach single values; pass scalar subqueries (`other.agg(...).scalar()`)."""
    for name, value in scalars.items():
        df = df.withColumn(name, value)
    return df


def densify(keys, low: Column, high: Column, out, step="INTERVAL 1 DAY") -> DataFrame:
    """Keys x calendar: each key row explodes its own range, nothing is cross joined."""
    return keys.withColumn(out, F.explode(F.sequence(low, high, F.expr(step))))


def explode_interval(df, start, end, out="month", unit="month") -> DataFrame:
    """One row per period of the half-open interval [start, end).

    The calendar is generated from the row, which replaces a range join of the
    table to a date dimension.
    """
    first = F.trunc(as_col(start), unit) if unit in ("month", "year", "week", "quarter") else F.to_date(as_col(start))
    last_day = F.date_sub(F.to_date(as_col(end)), 1)
    ok = F.to_date(as_col(start)) < F.to_date(as_col(end))
    return df.filter(ok).withColumn(out, F.explode(F.sequence(first, last_day, F.expr(f"INTERVAL 1 {unit}"))))


def asof(df, ts, scd, key, valid_from, valid_to, cols, tiebreak, chunk=None, how="left") -> DataFrame:
    """Attributes valid at a point in time: valid_from <= ts <= valid_to, latest start wins.

    Both inputs are merged into one ordered pass per key that carries the last validity
    row forward, so cost is linear in both sides. Only a point whose last row has ended is
    looked up once more, among the rows that reach over the start of a later one; a history
    without overlaps has none. Of equal starts the one that ends last wins, an open one
    before all. NULL keys match nothing. `chunk` maps a time column to a chunk (see
    `windows`) for hot keys; `tiebreak` is unique within a key and time.
    """
    keys = [key] if isinstance(key, str) else list(key)
    known = _and([as_col(k).isNotNull() for k in keys])
    lost, df, scd = df.filter(~known), df.filter(known), scd.filter(known)
    payload = F.struct(as_col(valid_to).alias("__to"), *[as_col(c) for c in cols])
    right = scd.select(*keys, as_col(valid_from).alias("__t"), F.lit(0).alias("__side"), payload.alias("__p"))
    left = df.withColumn("__t", as_col(ts)).withColumn("__side", F.lit(1))
    merged = left.unionByName(right, allowMissingColumns=True)
    merged = merged.withColumn("__open", (F.col("__p").isNotNull() & F.col("__p")["__to"].isNull()).cast("int")).withColumn("__end", F.col("__p")["__to"])
    order = [F.col("__t"), F.col("__side"), F.col("__open"), F.col("__end"), F.col(tiebreak)]
    merged = wn.last_known(merged, "__hit", keys, order, "__p", chunk=None if chunk is None else chunk(F.col("__t")))
    hit = F.when((F.col("__hit")["__to"].isNull()) | (F.col("__t") <= F.col("__hit")["__to"]), F.col("__hit"))
    out = merged.filter("__side = 1").withColumn("__ended", F.col("__hit").isNotNull() & hit.isNull()).withColumn("__hit", hit)
    # Rows that are still valid when a later one starts can serve a point after that one's end.
    spans = scd.select(*keys, as_col(valid_from).alias("__t"), as_col(valid_to).alias("__to"), payload.alias("__q"))
    spans = wn.lead(spans.withColumn("__o", F.coalesce(F.col("__to").isNull().cast("int"), F.lit(0))), "__later", keys, ["__t", "__o", "__to"], "__t", chunk=None if chunk is None else chunk(F.col("__t")))
    long = spans.filter(F.col("__later").isNotNull() & (F.col("__to").isNull() | (F.col("__to") > F.col("__later"))))
    finish = lambda rows: rows.withColumns({c: F.col("__hit")[c] for c in cols}).select(*df.columns, *[c for c in cols if c not in df.columns])
    if long.isEmpty():  # the history alone says that no version overlaps another: one pass is all
        return finish(out.filter(F.col("__hit").isNotNull())) if how == "inner" else finish(out).unionByName(lost, allowMissingColumns=True)
    long = long.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__t").alias("__f"), "__to", "__q")
    missed = out.filter("__ended").select(*keys, "__t", tiebreak)
    reach = _and([F.col(k) == F.col(f"__k_{k}") for k in keys]) & (F.col("__f") <= F.col("__t")) & (F.col("__to").isNull() | (F.col("__to") >= F.col("__t")))
    best = F.max_by("__q", F.struct("__f", F.col("__to").isNull(), "__to"))
    found = missed.join(long, reach).groupBy(*keys, "__t", tiebreak).agg(best.alias("__again"))
    again = [F.col(c).alias(f"__j_{c}") for c in (*keys, "__t", tiebreak)]
    out = out.join(found.select(*again, "__again"), _and([F.col(c).eqNullSafe(F.col(f"__j_{c}")) for c in (*keys, "__t", tiebreak)]) & F.col("__ended"), "left")
    out = out.withColumn("__hit", F.coalesce("__hit", "__again"))
    return finish(out.filter(F.col("__hit").isNotNull())) if how == "inner" else finish(out).unionByName(lost, allowMissingColumns=True)


def range_lookup(df, point, ranges, low, high, width) -> DataFrame:
    """Rows joined to every range with low <= point <= high, without an equi key.

    Ranges are spread over buckets of `width`; a point has one bucket, so each
    match is found exactly once. Choose a width near the usual range length.
    """
    bucket = lambda c: F.floor(as_col(c) / width).cast("long")
    spread = ranges.withColumn("__b", F.explode(F.sequence(bucket(low), bucket(high))))
    points = df.withColumn("__b", bucket(point))
    return points.join(spread, (points["__b"] == spread["__b"]) & (as_col(point) >= as_col(low)) & (as_col(point) <= as_col(high))).drop("__b")


def prefix_lookup(df, ip, prefixes, prefix, cols, tiebreak) -> DataFrame:
    """Columns of the longest prefix (CIDR, version 4 or 6) that holds each row's address; NULL without one.

    Distinct addresses are cut to every prefix length in use, 162 at most, and met by one equi
    join on (family, length, network); the longest hit wins. Of equal prefixes the one with the
    smallest `tiebreak` counts. Malformed addresses and prefixes match nothing.
    """
    nets = prefixes.withColumn("__n", parse_ip(prefix)).filter("__n IS NOT NULL").select(
        F.col("__n.family").alias("__f"), F.col("__n.prefix").alias("__bits"), F.col("__n.start_hi").alias("__hi"), F.col("__n.start_lo").alias("__lo"),
        F.struct(*[as_col(c) for c in cols]).alias("__p"), as_col(tiebreak).alias("__tie"))
    nets = nets.groupBy("__f", "__bits", "__hi", "__lo").agg(F.min_by("__p", "__tie").alias("__p"))
    used = nets.select("__f", "__bits").distinct().agg(F.collect_set(F.struct("__f", "__bits")).alias("u")).select("u").scalar()
    known = df.select(as_col(ip).alias("__ip")).distinct().withColumn("__a", parse_ip("__ip")).filter("__a IS NOT NULL")
    cut = known.withColumn("__u", F.explode(used)).filter(F.col("__u.__f") == F.col("__a.family"))
    hi, lo = network_of(F.col("__a.family"), F.col("__u.__bits"), F.col("__a.hi"), F.col("__a.lo"))
    cut = cut.select("__ip", F.col("__a.family").alias("__f"), F.col("__u.__bits").alias("__bits"), hi.alias("__hi"), lo.alias("__lo"))
    best = cut.join(nets, ["__f", "__bits", "__hi", "__lo"]).groupBy("__ip").agg(F.max_by("__p", "__bits").alias("__p"))
    out = df.withColumn("__ip", as_col(ip)).join(best, "__ip", "left")
    return out.select(*[F.col(c) for c in df.columns if c not in cols], *[F.col("__p")[c].alias(c) for c in cols])


def overlap_join(a, b, key, a_span, b_span, unit) -> DataFrame:
    """Pairs of intervals of one key that overlap, with their intersection.

    Spans are (from, to) column names, both ends included and distinct between the sides;
    a NULL end is open, and so is the end of an overlap of two open ones. Of two that
    overlap, one holds the start of the other. `unit` maps a time to a whole number that
    never decreases. An interval is filed in the cells, of the smallest power of two that is
    no shorter than itself, that it touches: two at most, one cell in all if it is open. A start
    looks into its cell of every size in use, so no copy depends on how long an interval is.
    """
    keys = [key] if isinstance(key, str) else list(key)

    def held(wide, wide_span, starts, start_span, strict) -> DataFrame:
        low, high = unit(F.col(wide_span[0])).cast("long"), unit(F.col(wide_span[1])).cast("long")
        size = F.when(high.isNull(), F.lit(-1)).otherwise(F.length(F.bin(F.greatest(high - low, F.lit(0)))))
        cell = lambda x, n: F.when(n < 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftright", x, F.greatest(n, F.lit(0))))
        filed = wide.withColumn("__n", size).withColumn("__c", F.explode(F.array_distinct(F.array(cell(low, F.col("__n")), F.coalesce(cell(high, F.col("__n")), F.lit(0).cast("long"))))))
        sizes = filed.select("__n").distinct().agg(F.collect_set("__n").alias("s")).select("s").scalar()  # 65 sizes at most
        at = unit(F.col(start_span[0])).cast("long")
        looking = starts.withColumn("__n", F.explode(sizes)).withColumn("__c", cell(at, F.col("__n")))
        found = filed.join(looking, [*keys, "__n", "__c"]).drop("__n", "__c")
        inside = F.col(wide_span[0]) < F.col(start_span[0]) if strict else F.col(wide_span[0]) <= F.col(start_span[0])
        return found.filter(inside & (F.col(wide_span[1]).isNull() | (F.col(start_span[0]) <= F.col(wide_span[1]))) & (F.col(start_span[1]).isNull() | (F.col(start_span[1]) >= F.col(start_span[0]))))

    joined = held(a, a_span, b, b_span, False).unionByName(held(b, b_span, a, a_span, True))
    return joined.withColumn("overlap_from", F.greatest(a_span[0], b_span[0])).withColumn("overlap_to", F.least(a_span[1], b_span[1]))


def offset_self_join(df, keys, month, months, cols, prefix="prior_") -> DataFrame:
    """The same key's values `months` earlier (one row per key and month)."""
    shifted = df.select(*keys, F.add_months(as_col(month), months).alias(month), *[as_col(c).alias(prefix + c) for c in cols])
    return df.join(shifted, [*keys, month], "left")


def parent_of(df, id_col, parent_col, cols) -> DataFrame:
    """Attributes of the parent row, the row's own where it has none."""
    parents = df.select(as_col(id_col).alias("__pid"), *[as_col(c).alias(f"__p_{c}") for c in cols])
    out = df.join(parents, df[parent_col] == parents["__pid"], "left")
    for c in cols:
        out = out.withColumn(f"parent_{c}", F.when(F.col("__pid").isNull(), as_col(c)).otherwise(F.col(f"__p_{c}")))
    return out.drop("__pid", *[f"__p_{c}" for c in cols])


def anti(df, sub, key, null_aware=False) -> DataFrame:
    """Rows whose key is not in `sub` (same column name).

    With `null_aware` NOT IN holds: a NULL in `sub` rejects every row and a NULL
    key is rejected unless `sub` is empty. Spark's own null-aware anti join must
    broadcast `sub`; here two scalars carry the NULL rule and the join is an
    ordinary one.
    """
    out = df.join(sub.select(key), key, "left_anti")
    if not null_aware:
        return out
    facts = sub.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("k"))
    n, k = facts.select("n").scalar(), facts.select("k").scalar()
    return out.filter((n == 0) | (F.col(key).isNotNull() & (n == k)))


def semi(df, sub, key) -> DataFrame:
    return df.join(sub.select(key), key, "left_semi")


def cumulative_eligibility(weights, spine, start, month, value, out) -> DataFrame:
    """For every month, the total value of entries that started in it or before.

    Equals the inequality join `month >= start` followed by a sum; here entries are
    summed per start month and one running total over the months finishes it.
    """
    per_month = weights.groupBy(as_col(start).alias(month)).agg(F.sum(as_col(value)).alias("__v"))
    merged = per_month.unionByName(spine.select(month).withColumn("__spine", F.lit(True)), allowMissingColumns=True)
    totals = merged.groupBy(month).agg(F.sum("__v").alias("__v"), F.bool_or("__spine").alias("__spine"))
    totals = wn.running(totals, out, [], month, "__v")
    return totals.filter("__spine").select(month, out)


def explode_join(df, col, out, outer=False) -> DataFrame:
    """Lateral flatten of an array column."""
    fn = F.explode_outer if outer else F.explode
    return df.withColumn(out, fn(as_col(col)))


def eq_all(a, b, keys, cols) -> DataFrame:
    """Null-safe row equality on all columns: rows of `a` found unchanged in `b`."""
    conds = [a[k] == b[k] for k in keys] + [a[c].cast("string").eqNullSafe(b[c].cast("string")) for c in cols]
    return a.join(b, _and(conds), "left_semi")


def fallback_match(tiers: list[tuple[str, DataFrame]], key) -> DataFrame:
    """Matches of the first tier that has any for a key; later tiers fill the rest.

    All tiers meet in one union, and a rank by tier keeps the best: each tier is computed once, and
    worse tiers that meet a better one in a task are dropped before the shuffle. The rank has a key
    column of its own, so that tiers dealt alike do not share tasks and add up their memory there.
    """
    parts = [df.withColumn("tier", F.lit(i)).withColumn("tier_name", F.lit(name)) for i, (name, df) in enumerate(tiers)]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return topk.top_k(both.withColumn("__key", F.struct(key)), ["__key"], "tier", 1, ties=True).drop("tier", "__key")


def map_key_join(df, map_col, keys, key) -> DataFrame:
    """Entries of a map column whose key is listed, with the list's attributes."""
    entries = df.select("*", F.explode(as_col(map_col)).alias(key, "map_value")).drop(map_col)
    return entries.join(keys, key)


def nearest(df, ts, other, other_ts, key, tiebreak, cols, chunk=None) -> DataFrame:
    """The other row of the same key closest in time, the earlier one on a tie; NULL keys match nothing.

    Carries the last row before and the first row after into each row, so cost is
    linear where pairing all rows of a key would be quadratic.
    """
    lost, df, other = df.filter(F.col(key).isNull()), df.filter(F.col(key).isNotNull()), other.filter(F.col(key).isNotNull())
    payload = F.struct(as_col(other_ts).alias("__at"), *[as_col(c) for c in cols])
    right = other.select(key, as_col(other_ts).alias("__t"), F.lit(0).alias("__side"), payload.alias("__p"))
    left = df.withColumn("__t", as_col(ts)).withColumn("__side", F.lit(1))
    merged = left.unionByName(right, allowMissingColumns=True)
    order = [F.col("__t"), F.col("__side"), F.col(tiebreak)]
    merged, cut = wn.cut(merged, key, None if chunk is None else chunk(F.col("__t")))
    merged = wn.last_known(merged, "__before", key, order, "__p", chunk=cut)
    merged = wn.next_known(merged, "__after", key, order, "__p", chunk=cut).drop("__cut")
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    back = micros(F.col("__t")) - micros(F.col("__before")["__at"])
    ahead = micros(F.col("__after")["__at"]) - micros(F.col("__t"))
    pick = F.when(F.col("__after").isNull() | (back <= ahead), F.col("__before")).otherwise(F.col("__after"))
    out = merged.filter("__side = 1").withColumn("__hit", F.when(F.col("__before").isNull(), F.col("__after")).otherwise(pick))
    for c in cols:
        out = out.withColumn(c, F.col("__hit")[c])
    out = out.withColumn("nearest_at", F.col("__hit")["__at"]).drop("__t", "__side", "__p", "__before", "__after", "__hit")
    return out.unionByName(lost, allowMissingColumns=True)
