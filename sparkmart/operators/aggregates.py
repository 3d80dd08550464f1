"""Aggregations. Sums and counts combine on the map side, so a hot group costs one row per task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sparkmart.functions import as_col, ratio
from sparkmart.operators import windows as wn
from sparkmart.operators.windows import join_back


def group(df, by, **aggs: Column) -> DataFrame:
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in aggs.items()])


def having(df, by, condition, **aggs: Column) -> DataFrame:
    return group(df, by, **aggs).filter(condition)


def rollup_total(df, cols, total="Total", **aggs: Column) -> DataFrame:
    """ROLLUP whose subtotal rows say 'Total'; real NULLs stay NULL (told apart by grouping())."""
    out = df.rollup(*cols).agg(*[c.alias(n) for n, c in aggs.items()], *[F.grouping(c).alias(f"__g_{c}") for c in cols])
    for c in cols:
        out = out.withColumn(c, F.when(F.col(f"__g_{c}") == 1, total).otherwise(F.col(c)))
    return out.drop(*[f"__g_{c}" for c in cols])


def by_levels(df, levels: dict, **aggs: Column) -> DataFrame:
    """The same aggregate at several levels stacked as (level, id): one scan with grouping sets."""
    keys = [c for c in levels.values()]
    df = df.select("*", *[as_col(c).cast("string").alias(f"__k_{n}") for n, c in levels.items()])
    names = list(levels)
    sets = [[F.col(f"__k_{n}")] for n in names]
    out = df.groupingSets(sets, *[F.col(f"__k_{n}") for n in names]).agg(
        *[c.alias(a) for a, c in aggs.items()], *[F.grouping(f"__k_{n}").alias(f"__g_{n}") for n in names])
    level, ident = F.lit(None).cast("string"), F.lit(None).cast("string")
    for n in names:
        level = F.when(F.col(f"__g_{n}") == 0, n).otherwise(level)
        ident = F.when(F.col(f"__g_{n}") == 0, F.col(f"__k_{n}")).otherwise(ident)
    assert len(keys) == len(names)
    return out.select(level.alias("level"), ident.alias("id"), *aggs)


def management_cut(actual, target, dims, metrics, actual_value, target_value) -> DataFrame:
    """Actual and target per metric with subtotals per leading dimension, and their ratio.

    `metrics` names the values of the `metric` column to lay out as columns.
    """
    def cut(df, value, suffix):
        sums = {f"{m}_{suffix}": F.sum(F.when(F.col("metric") == m, as_col(value))) for m in metrics}
        return rollup_total(df, dims, **sums)

    a, t = cut(actual, actual_value, "actual"), cut(target, target_value, "target")
    out = join_back(a, t, dims, "left")
    for m in metrics:
        out = out.withColumn(f"{m}_attainment", F.round(ratio(f"{m}_actual", f"{m}_target"), 6))
    return out


def array_agg_sorted(col, distinct=True) -> Column:
    """Sorted array of a bounded domain's values."""
    return F.array_sort(F.collect_set(as_col(col)) if distinct else F.collect_list(as_col(col)))


def listagg(col, sep=",", distinct=True) -> Column:
    return F.array_join(array_agg_sorted(as_col(col).cast("string"), distinct), sep)


def percentiles(df, by, col, qs, width) -> DataFrame:
    """Exact interpolated percentiles, one row per group and quantile.

    `percentile` holds all values of a group in one task. Here values are counted in
    bins of `width`; prefix sums over the bins say which bins hold the wanted ranks,
    and only the values of those bins are ranked, as distinct values with counts.
    """
    by = list(by)
    rows = df.select(*by, as_col(col).cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    rows = rows.withColumn("__bin", F.floor(F.col("__v") / width))
    bins = rows.groupBy(*by, "__bin").agg(F.count(F.lit(1)).alias("__n"))
    bins = wn.running(bins, "__prior", by, "__bin", "__n", include_current=False).withColumn("__prior", F.coalesce("__prior", F.lit(0)))
    bins = wn.partition_agg(bins, by, __total=F.sum("__n"))
    wanted = F.array(*[
        F.struct(F.lit(float(q)).alias("q"), side.alias("rank"), F.lit(name).alias("side"))
        for q in qs
        for name, side in (("lo", F.floor(F.lit(float(q)) * (F.col("__total") - 1))), ("hi", F.ceil(F.lit(float(q)) * (F.col("__total") - 1))))
    ])
    here = F.filter(wanted, lambda w: (w["rank"] >= F.col("__prior")) & (w["rank"] < F.col("__prior") + F.col("__n")))
    targets = bins.withColumn("__w", F.explode(here)).select(*by, "__bin", "__prior", "__total", "__w.*")
    needed = targets.select(*by, "__bin").distinct().withColumn("__need", F.lit(True))
    inside = join_back(rows, needed, by + ["__bin"], "inner").groupBy(*by, "__bin", "__v").agg(F.count(F.lit(1)).alias("__c"))
    inside = wn.running(inside, "__before", by + ["__bin"], "__v", "__c", include_current=False)
    inside = inside.withColumn("__before", F.coalesce("__before", F.lit(0)))
    at = F.col("rank") - F.col("__prior")
    hit = join_back(inside, targets, by + ["__bin"], "inner").filter((F.col("__before") <= at) & (at < F.col("__before") + F.col("__c"))).withColumn("__x", F.col("__v"))
    both = hit.groupBy(*by, "q", "__total").agg(
        F.max(F.when(F.col("side") == "lo", F.col("__x"))).alias("__lo"), F.max(F.when(F.col("side") == "hi", F.col("__x"))).alias("__hi"))
    pos = F.col("q") * (F.col("__total") - 1)
    return both.select(*by, "q", (F.col("__lo") + (F.col("__hi") - F.col("__lo")) * (pos - F.floor(pos))).alias("value"))


def percentiles_wide(df, by, col, named: dict, width) -> DataFrame:
    """Percentiles laid out as columns: {output: quantile}."""
    long = percentiles(df, by, col, sorted(set(named.values())), width)
    return long.groupBy(*by).agg(*[F.max(F.when(F.col("q") == float(q), F.col("value"))).alias(n) for n, q in named.items()])


def pivot_values(df, by, col, values, agg, else_value=None, prefix="", suffix="") -> DataFrame:
    """One column per listed value, in a single conditional aggregate.

    agg maps the per-value column to an aggregate, e.g. lambda hit: F.sum(F.when(hit, x)).
    """
    out = []
    for v in values:
        c = agg(as_col(col) == F.lit(v))
        out.append((F.coalesce(c, F.lit(else_value)) if else_value is not None else c).alias(f"{prefix}{v}{suffix}"))
    return df.groupBy(*by).agg(*out)


def column_values(df, col, order: Column, limit: int) -> list:
    """Distinct values of a low-cardinality column, ordered by an aggregate. They become columns on
    the driver, so the caller states how many there may be; more than `limit` is an error."""
    rows = df.filter(as_col(col).isNotNull()).groupBy(as_col(col).alias("v")).agg(order.alias("o")).orderBy(F.desc("o"), "v").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} distinct values: not a column domain")
    return [r["v"] for r in rows]


def melt(df, ids, cols, cast="double", name="field_name", value="value") -> DataFrame:
    typed = df.select(*ids, *[as_col(c).cast(cast).alias(c) for c in cols])
    return typed.unpivot(list(ids), list(cols), name, value)


def latest_toggle(df, keys, action, ts, on="added", off="removed") -> DataFrame:
    """Last add and remove times; the removal is dropped when a later add exists."""
    agg = df.groupBy(*keys).agg(
        F.max(F.when(as_col(action) == on, as_col(ts))).alias("added_at"),
        F.max(F.when(as_col(action) == off, as_col(ts))).alias("__off"))
    removed = F.when((F.col("__off") > F.col("added_at")) | F.col("added_at").isNull(), F.col("__off"))
    return (agg.withColumn("removed_at", removed).drop("__off")
            .withColumn("latest_state", F.when(F.col("removed_at").isNull(), on).otherwise(off)))


def kv_wide(df, keys, k, v, names) -> DataFrame:
    """Key-value rows to columns; the greatest value wins when a key repeats."""
    return df.groupBy(*keys).agg(*[F.max(F.when(as_col(k) == n, as_col(v))).alias(n) for n in names])


def max_rank(col, ranks: dict) -> Column:
    """Highest rank of a group's members, unlisted members counting 0."""
    ranked = reduce(lambda acc, kv: F.when(as_col(col) == kv[0], kv[1]).otherwise(acc), ranks.items(), F.lit(0))
    return F.max(ranked)


def distinct_by(df, by, category, col, categories, prefix="n_") -> DataFrame:
    """Distinct values per category, one column each.

    Values are made distinct once and then counted, so the plan does not expand
    every row once per category.
    """
    once = df.select(*by, as_col(category).alias("__cat"), as_col(col).alias("__v")).filter(F.col("__v").isNotNull()).distinct()
    return once.groupBy(*by).agg(*[F.count_if(F.col("__cat") == c).alias(f"{prefix}{c}") for c in categories])
