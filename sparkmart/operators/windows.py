"""Window operators, each appending one column.

A plain window puts every row of a partition key into one task. Where a key may hold
a large share of the table, pass `chunk`:

* a column expression that never decreases as the first sort column grows, such as a
  calendar period for a time order: every key is cut there;
* `HotKeys(expression)`: only keys above a row limit are cut, the others stay whole. The keys are
  counted when the plan is made; where none is hot, the plan is the plain window.

Rows whose chunk is NULL, as the order column of some is, are a chunk of their own, in
Spark's default place for NULL. Ranks and running aggregates follow a first sort column of
either direction; lag, lead and the nearest known value need ascending columns when cut.

Rows are then windowed inside (key, chunk). What a row must know of earlier chunks
arrives as one seed row per (key, chunk), computed from a summary that combines on the
map side and holds a row per chunk. Seeds join the rows by union, so the rows are
shuffled once, as for the plain window. Chunked orders end in a unique tiebreak
(except for rank); ties of the sort column share a chunk.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sparkmart.functions.nulls import as_col

FULL = (W.unboundedPreceding, W.unboundedFollowing)
RUNNING = (W.unboundedPreceding, W.currentRow)
BEFORE = (W.unboundedPreceding, -1)
AFTER = (1, W.unboundedFollowing)
ONWARD = (W.currentRow, W.unboundedFollowing)

_CHUNK, _HOT = "__chunk", "__hot_cut"


@dataclass(frozen=True)
class HotKeys:
    """Cut only the keys with more than `rows` rows, along `fine`."""

    fine: Column
    rows: int = 1_000_000


@dataclass(frozen=True)
class Cut:
    """A chunk column that `cut` made: NULL for a whole key, else a struct of the chunk."""

    name: str


def _descending(order, mixed=True) -> bool:
    """Whether the first sort column descends. NULLs must stand where Spark puts them by default;
    without `mixed`, all columns must ascend."""
    ways = [re.search(r" (ASC|DESC) NULLS (FIRST|LAST)'>$", str(as_col(c))) for c in _list(order)]
    for m in ways if not mixed else ways[:1]:
        if m and (m[1] == "ASC") != (m[2] == "FIRST"):
            raise ValueError("a cut window needs NULLs in their default place")
        if m and m[1] == "DESC" and not mixed:
            raise ValueError("a cut lag, lead or known value needs an ascending order")
    return bool(ways[0]) and ways[0][1] == "DESC"


def _by_chunk(by, order, frame=None):
    """Window over a key's chunks, in the order of its rows."""
    return window(by, F.col(_CHUNK).desc() if _descending(order) else F.col(_CHUNK).asc(), frame)


def _list(x) -> list:
    if x is None:
        return []
    return list(x) if isinstance(x, (list, tuple)) else [x]


def window(by, order=None, frame=None):
    """WindowSpec from column lists with an explicit row frame."""
    spec = W.partitionBy(*[as_col(c) for c in _list(by)])
    if order is not None:
        spec = spec.orderBy(*[as_col(c) for c in _list(order)])
    return spec.rowsBetween(*frame) if frame else spec


def join_back(df: DataFrame, side: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Attach a one-row-per-key summary; NULL keys match each other.

    A global summary is one row: its values become scalar subqueries.
    """
    if not keys:
        for c in side.columns:
            df = df.withColumn(c, side.select(c).scalar())
        return df
    renamed = side
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys])
    return df.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def cut(df: DataFrame, by, chunk, name="__cut"):
    """Resolve hot keys once: the frame with a chunk column and its name as `Cut`, or the frame as it is
    and None where no key is hot.

    Operators that chain several windows cut first and hand the result on, so the keys
    are counted once.
    """
    by = _list(by)
    if not isinstance(chunk, HotKeys):
        return df, chunk
    if not by:
        return df.withColumn(name, F.struct(chunk.fine.alias("c"))), Cut(name)
    hot = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > chunk.rows).select(*by, F.lit(True).alias("__hot"))
    if hot.isEmpty():
        return df, None
    return join_back(df, hot, by).withColumn(name, F.when(F.col("__hot"), F.struct(chunk.fine.alias("c")))).drop("__hot"), Cut(name)


def _cut(df: DataFrame, by: list[str], chunk) -> DataFrame:
    if isinstance(chunk, Cut):
        return df.withColumn(_CHUNK, F.col(chunk.name))
    return df.withColumn(_CHUNK, F.struct(as_col(chunk).alias("c")))


def _per_chunk(df: DataFrame, keys: list[str], agg: Column) -> DataFrame:
    """Summary of the cut keys; whole keys need none."""
    return df.filter(F.col(_CHUNK).isNotNull()).groupBy(*keys).agg(agg)


def _seeded(rows: DataFrame, seeds: DataFrame, at_end=False) -> DataFrame:
    """Rows and seeds in one frame, ordered by `__seed` first."""
    r, s = (0, 1) if at_end else (1, 0)
    return rows.withColumn("__seed", F.lit(r)).withColumn("__row", F.lit(True)).unionByName(seeds.withColumn("__seed", F.lit(s)), allowMissingColumns=True)


def _unseed(df: DataFrame) -> DataFrame:
    return df.filter("__row").drop("__v", "__o", "__seed", "__row", _CHUNK, _HOT)


# ---------------------------------------------------------------- ranking

def row_number(df, out, by, order, chunk=None) -> DataFrame:
    """ROW_NUMBER; `order` must end in a unique tiebreak."""
    df, chunk = cut(df, by, chunk, _HOT)
    if chunk is None:
        return df.withColumn(out, F.row_number().over(window(by, order)))
    return running(df, out, by, order, F.lit(1).cast("long"), chunk=chunk).drop(_HOT)


def rank(df, out, by, order, chunk=None) -> DataFrame:
    """RANK: one plus the number of rows strictly before."""
    by = _list(by)
    df, chunk = cut(df, by, chunk, _HOT)
    if chunk is None:
        return df.withColumn(out, F.rank().over(window(by, order)))
    df, keys = _cut(df, by, chunk), by + [_CHUNK]
    counts = _per_chunk(df, keys, F.count(F.lit(1)).alias("__n"))
    seeds = counts.select(*keys, F.coalesce(F.sum("__n").over(_by_chunk(by, order, BEFORE)), F.lit(0)).alias("__v"))
    both, inside = _seeded(df, seeds), ["__seed", *_list(order)]
    # Where a seed leads, it counts as one row of the rank and brings the rows before.
    offset = F.coalesce(F.first("__v").over(window(keys, inside, RUNNING)) - 1, F.lit(0))
    return _unseed(both.withColumn(out, (F.rank().over(window(keys, inside)) + offset).cast("long")))


def dense_rank(df, out, by, col, descending=False, chunk=None) -> DataFrame:
    """DENSE_RANK of a column, ranked over its distinct values only."""
    by = _list(by)
    values = df.select(*by, as_col(col).alias("__k")).distinct()
    order = F.col("__k").desc() if descending else F.col("__k").asc()
    ranked = row_number(values, out, by, [order], None if chunk is None else chunk(F.col("__k")))
    df = df.withColumn("__k", as_col(col))
    return join_back(df, ranked, by + ["__k"]).drop("__k")


def rank_of_value(df, out, by, col, descending=False, chunk=None) -> DataFrame:
    """RANK of a column from the counts of its distinct values.

    Equal values are counted, not sorted, so neither a large key nor a value shared by
    most rows weighs on one task. `chunk` maps the value to a band that never decreases
    as the value grows; without it a key's distinct values are one window.
    """
    by = _list(by)
    values = df.groupBy(*by, as_col(col).alias("__k")).agg(F.count(F.lit(1)).alias("__c"))
    order = F.col("__k").desc() if descending else F.col("__k").asc()
    ahead = running(values, "__ahead", by, [order], "__c", include_current=False, chunk=None if chunk is None else chunk(F.col("__k")))
    side = ahead.select(*by, "__k", (F.coalesce("__ahead", F.lit(0)) + 1).alias(out))
    return join_back(df.withColumn("__k", as_col(col)), side, by + ["__k"]).drop("__k")


# ---------------------------------------------------------------- offset

def _neighbour(df, out, by, order, col, default, chunk, forward) -> DataFrame:
    _descending(order, mixed=False)
    order_cols = [as_col(c) for c in _list(order)]
    df = _cut(df.withColumn("__v", F.struct(as_col(col).alias("v"))).withColumn("__o", F.struct(*order_cols)), by, chunk)
    keys = by + [_CHUNK]
    edge = F.min_by("__v", "__o") if forward else F.max_by("__v", "__o")
    step = F.lead if forward else F.lag
    seeds = _per_chunk(df, keys, edge.alias("__e")).select(*keys, step("__e").over(_by_chunk(by, order)).alias("__v"))
    both = _seeded(df, seeds, at_end=forward)
    near = step("__v").over(window(keys, ["__seed", *order_cols]))
    value = near["v"] if default is None else F.when(near.isNull(), F.lit(default)).otherwise(near["v"])
    return _unseed(both.withColumn(out, value))


def lag(df, out, by, order, col, n=1, default=None, chunk=None) -> DataFrame:
    """Value n rows earlier."""
    df, chunk = cut(df, by, chunk, _HOT)
    if chunk is None:
        return df.withColumn(out, F.lag(as_col(col), n, default).over(window(by, order)))
    if n != 1:
        raise ValueError("chunked lag steps one row; use halo() for more")
    return _neighbour(df, out, _list(by), order, col, default, chunk, forward=False)


def lead(df, out, by, order, col, n=1, default=None, chunk=None) -> DataFrame:
    """Value n rows later."""
    df, chunk = cut(df, by, chunk, _HOT)
    if chunk is None:
        return df.withColumn(out, F.lead(as_col(col), n, default).over(window(by, order)))
    if n != 1:
        raise ValueError("chunked lead steps one row; use halo() for more")
    return _neighbour(df, out, _list(by), order, col, default, chunk, forward=True)


def _nearest_known(df, out, by, order, col, frame, chunk, forward) -> DataFrame:
    _descending(order, mixed=False)
    order_cols = [as_col(c) for c in _list(order)]
    value = as_col(col)
    df = _cut(df.withColumn("__v", value).withColumn("__o", F.when(value.isNotNull(), F.struct(*order_cols))), by, chunk)
    keys = by + [_CHUNK]
    edge = F.min_by("__v", "__o") if forward else F.max_by("__v", "__o")
    pick, side = (F.first, AFTER) if forward else (F.last, BEFORE)
    seeds = _per_chunk(df, keys, edge.alias("__e")).select(*keys, pick("__e", ignorenulls=True).over(_by_chunk(by, order, side)).alias("__v"))
    both = _seeded(df, seeds, at_end=forward)
    return _unseed(both.withColumn(out, pick("__v", ignorenulls=True).over(window(keys, ["__seed", *order_cols], frame))))


def last_known(df, out, by, order, col, include_current=True, chunk=None) -> DataFrame:
    """Last non-NULL value up to here (LAG IGNORE NULLS when the current row is excluded)."""
    frame = RUNNING if include_current else BEFORE
    df, chunk = cut(df, by, chunk, _HOT)
    if chunk is None:
        return df.withColumn(out, F.last(as_col(col), ignorenulls=True).over(window(by, order, frame)))
    return _nearest_known(df, out, _list(by), order, col, frame, chunk, forward=False)


def next_known(df, out, by, order, col, chunk=None) -> DataFrame:
    """First non-NULL value from here on (back-fill)."""
    df, chunk = cut(df, by, chunk, _HOT)
    if chunk is None:
        return df.withColumn(out, F.first(as_col(col), ignorenulls=True).over(window(by, order, ONWARD)))
    return _nearest_known(df, out, _list(by), order, col, ONWARD, chunk, forward=True)


# ---------------------------------------------------------------- whole partition

def partition_agg(df, by, **aggs: Column) -> DataFrame:
    """Unordered aggregates of the whole partition: aggregate, then join back."""
    by = _list(by)
    side = df.groupBy(*by).agg(*[c.alias(name) for name, c in aggs.items()])
    return join_back(df, side, by)


def first_value(df, out, by, order, col) -> DataFrame:
    """FIRST_VALUE over the whole partition; `order` lists ascending columns."""
    key = F.struct(*[as_col(c) for c in _list(order)])
    return partition_agg(df, by, **{out: F.min_by(as_col(col), key)})


def last_value(df, out, by, order, col) -> DataFrame:
    """LAST_VALUE over the whole partition; `order` lists ascending columns."""
    key = F.struct(*[as_col(c) for c in _list(order)])
    return partition_agg(df, by, **{out: F.max_by(as_col(col), key)})


def nth_value(df, out, by, order, col, n) -> DataFrame:
    """NTH_VALUE over the whole partition, NULL when it has fewer rows.

    Row n of each key is found with a rank filter, which Spark prunes before the
    shuffle, so the key's other rows never meet in one task.
    """
    by = _list(by)
    ranked = df.withColumn("__rn", F.row_number().over(window(by, order))).filter(F.col("__rn") <= n)
    nth = ranked.filter(F.col("__rn") == n).select(*by, as_col(col).alias(out))
    return join_back(df, nth, by)


def count_distinct_over(df, out, by, col) -> DataFrame:
    """COUNT(DISTINCT) OVER, which Spark's windows lack."""
    return partition_agg(df, by, **{out: F.count_distinct(as_col(col))})


def listagg_distinct_over(df, out, by, col, sep=",") -> DataFrame:
    """Sorted distinct values of the partition as text. Values are made distinct
    before they are collected, so the list grows with the domain, not the rows."""
    by = _list(by)
    side = (
        df.select(*by, as_col(col).cast("string").alias("__v")).filter(F.col("__v").isNotNull()).distinct()
        .groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list("__v")), sep).alias(out))
    )
    return join_back(df, side, by)


def share_of(df, out, by, col) -> DataFrame:
    """RATIO_TO_REPORT: value over partition total, NULL when the total is 0."""
    side = partition_agg(df, by, __total=F.sum(as_col(col)))
    return side.withColumn(out, F.try_divide(as_col(col).cast("double"), F.col("__total").cast("double"))).drop("__total")


def share_of_or_zero(df, out, by, col) -> DataFrame:
    """Share of partition, 0 when the total is 0."""
    side = share_of(df, out, by, col)
    return side.withColumn(out, F.coalesce(F.col(out), F.lit(0.0)))


# ---------------------------------------------------------------- running and rolling

def running(df, out, by, order, col, agg="sum", include_current=True, chunk=None) -> DataFrame:
    """Running sum / count / min / max up to the current (or the previous) row."""
    by = _list(by)
    frame = RUNNING if include_current else BEFORE
    fn = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}[agg]
    value = as_col(col)
    df, chunk = cut(df, by, chunk, _HOT)
    if chunk is None:
        return df.withColumn(out, fn(value).over(window(by, order, frame)))
    if agg == "count":
        value, fn = value.isNotNull().cast("long"), F.sum
    df, keys = _cut(df.withColumn("__v", value), by, chunk), by + [_CHUNK]
    seeds = _per_chunk(df, keys, fn("__v").alias("__p")).select(*keys, fn("__p").over(_by_chunk(by, order, BEFORE)).alias("__s"))
    both = _seeded(df, seeds.withColumnRenamed("__s", "__v"))
    total = fn("__v").over(window(keys, ["__seed", *_list(order)], frame))
    return _unseed(both.withColumn(out, F.coalesce(total, F.lit(0)) if agg == "count" else total))


def change_counter(df, out, by, order, col, chunk=None) -> DataFrame:
    """Counter that grows by one whenever the value differs from the row before.

    The first row starts island 0; NULL equals NULL.
    """
    df, chunk = cut(df, by, chunk)
    df = lag(df, "__prev", by, order, F.struct(as_col(col).alias("x")), chunk=chunk)
    changed = F.when(F.col("__prev").isNull(), 0).when(F.col("__prev")["x"].eqNullSafe(as_col(col)), 0).otherwise(1)
    df = df.withColumn("__changed", changed)
    return running(df, out, by, order, "__changed", chunk=chunk).drop("__prev", "__changed", "__cut")


def halo(df, by, order, before, after, chunk_rows, exprs: dict[str, callable], chunk=None) -> DataFrame:
    """Fixed-size row frames over keys of any size.

    Rows are numbered per key, cut into runs of `chunk_rows`, and the rows a frame
    may reach across a cut are copied into the neighbouring run. `exprs` maps each
    output to a function of the WindowSpec. Copies are dropped afterwards.
    """
    by = _list(by)
    if chunk_rows < max(before, after):
        raise ValueError("a run must be at least as long as the frame")
    df = row_number(df, "__rn", by, order, chunk)
    pos = F.col("__rn") - 1
    run, at = F.floor(pos / chunk_rows), F.pmod(pos, F.lit(chunk_rows))
    runs = F.array_compact(F.array(
        run,
        F.when(at >= chunk_rows - before, run + 1) if before else F.lit(None).cast("long"),
        F.when((at < after) & (run > 0), run - 1) if after else F.lit(None).cast("long"),
    ))
    spread = df.withColumn("__home", run).withColumn("__run", F.explode(runs))
    w = W.partitionBy(*by, "__run").orderBy("__rn")
    for out, fn in exprs.items():
        spread = spread.withColumn(out, fn(w))
    return spread.filter(F.col("__run") == F.col("__home")).drop("__rn", "__home", "__run")


def rolling(df, out, by, order, col, before, after=0, agg=F.sum, chunk=None, chunk_rows=100_000) -> DataFrame:
    """Aggregate of the `before` rows before to the `after` rows after this one."""
    if chunk is None:
        return df.withColumn(out, agg(as_col(col)).over(window(by, order, (-before, after))))
    fn = lambda w: agg(as_col(col)).over(w.rowsBetween(-before, after))
    return halo(df, by, order, before, after, max(chunk_rows, before, after), {out: fn}, chunk)


def period_to_date(df, by, day, col, periods=("week", "month", "quarter", "year"), prefix="") -> DataFrame:
    """Running sums that restart each period. Input holds one row per key and day,
    so a window holds at most a year of days."""
    d = as_col(day)
    for p in periods:
        name = f"{prefix}{p}_to_date"
        df = df.withColumn(name, F.sum(as_col(col)).over(window([*_list(by), F.date_trunc(p, d)], d, RUNNING)))
    return df


def last_in_period(df, out, by, order) -> DataFrame:
    """1 on the last row of each group, else 0; `order` lists ascending columns."""
    key = F.struct(*[as_col(c) for c in _list(order)])
    side = partition_agg(df, by, __max_key=F.max(key))
    return side.withColumn(out, (F.col("__max_key") == key).cast("int")).drop("__max_key")


def agg_then_window(df, by, out, col, over=None, agg=F.avg) -> DataFrame:
    """Window over an aggregate: group, then relate each group to all groups."""
    grouped = df.groupBy(*_list(by)).agg(col)
    return partition_agg(grouped, over, **{out: agg})
