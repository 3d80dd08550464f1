"""Incremental maintenance, as pure functions of target and batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sparkmart.functions import as_col
from sparkmart.operators import topk
from sparkmart.operators.windows import RUNNING, window


def increment(source, target, ts) -> DataFrame:
    """Source rows at or after the target's high watermark; all rows for an empty target."""
    mark = target.select(F.max(as_col(ts))).scalar()
    return source.filter(mark.isNull() | (as_col(ts) >= mark))


def upsert(target, batch, key, order) -> DataFrame:
    """Delete and insert by key: batch rows, one per key, replace the target's."""
    keys = [key] if isinstance(key, str) else list(key)
    newest = topk.latest_per_key(batch, keys, order)
    return target.join(newest.select(*keys), keys, "left_anti").unionByName(newest.select(*target.columns))


def insert_new(target, batch, key) -> DataFrame:
    """Only rows whose key the target lacks are added."""
    keys = [key] if isinstance(key, str) else list(key)
    return target.unionByName(batch.join(target.select(*keys), keys, "left_anti").select(*target.columns))


def known_only(target, batch, key) -> DataFrame:
    """Only rows whose key the target already has are added."""
    keys = [key] if isinstance(key, str) else list(key)
    return target.unionByName(batch.join(target.select(*keys).distinct(), keys, "left_semi").select(*target.columns))


def with_overlap(target, source, ts, key, order, minutes=30) -> DataFrame:
    """Re-read an overlap before the watermark for late rows and keep one row per key; an empty target takes all."""
    mark = target.select(F.max(as_col(ts))).scalar()
    late = source.filter(mark.isNull() | (as_col(ts) >= mark - F.expr(f"INTERVAL {minutes} MINUTES")))
    return upsert(target, late, key, order)


def tumble(df, ts, width, keys=(), **aggs: Column) -> DataFrame:
    """Tumbling windows; the same call on a stream and on a table."""
    aggs = aggs or {"events": F.count(F.lit(1))}
    out = df.groupBy(F.window(as_col(ts), width).alias("w"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *aggs)


def slide(df, ts, days, keys=(), distinct=None) -> DataFrame:
    """Trailing windows of `days`, one per day: events, and distinct values of a column.

    Nothing is copied to the windows it belongs to. A day's events enter a running total on that
    day and leave it `days` later. A value's days, each with the windows that hold it, are one or
    more unbroken stretches of windows: it enters at the start of a stretch and leaves behind its
    end, so a value costs two rows at most for each of its days, however wide the window.
    """
    day, keys = F.to_date(as_col(ts)), list(keys)
    moves = lambda rows, *cols: rows.select(*keys, F.inline(F.array(F.struct(F.col("day"), *[c.alias(n) for n, c in cols]), F.struct(F.col("out").alias("day"), *[(-c).alias(n) for n, c in cols]))))
    daily = df.groupBy(day.alias("day"), *keys).agg(F.count(F.lit(1)).alias("n")).withColumn("out", F.date_add("day", days))
    deltas = moves(daily, ("__events", F.col("n")), ("__values", F.lit(0).cast("long")))
    if distinct is not None:
        seen = df.select(day.alias("day"), *keys, as_col(distinct).alias("__v")).filter(F.col("__v").isNotNull()).distinct()
        w = window([*keys, "__v"], "day")
        broken = lambda a, b: a.isNull() | (F.datediff(b, a) > days)
        ends = seen.withColumn("__from", broken(F.lag("day").over(w), F.col("day"))).withColumn("__to", broken(F.lead("day").over(w), F.col("day")) | (F.datediff(F.lead("day").over(w), "day") > days))
        came = ends.groupBy("day", *keys).agg(F.count_if("__from").alias("__values"))
        left = ends.groupBy(F.date_add("day", days).alias("day"), *keys).agg((-F.count_if("__to")).alias("__values"))
        deltas = deltas.unionByName(came.unionByName(left).withColumn("__events", F.lit(0).cast("long")))
    steps = deltas.groupBy("day", *keys).agg(F.sum("__events").alias("__events"), F.sum("__values").alias("__values"))
    # One row per day and key: a window holds days, not events.
    so_far = window(keys, "day", RUNNING)
    steps = steps.select("day", *keys, F.sum("__events").over(so_far).alias("events"), F.sum("__values").over(so_far).alias("__values"), F.lead("day").over(window(keys, "day")).alias("__next"))
    until = F.sequence(F.col("day"), F.date_sub("__next", 1), F.expr("INTERVAL 1 DAY"))
    out = steps.filter("events > 0").select(F.explode(until).alias("window_end"), *keys, "events", F.col("__values").alias(f"distinct_{distinct}"))
    return out if distinct is not None else out.drop(f"distinct_{distinct}")


def sessions(df, ts, gap_seconds: float, keys, counts=(), sums=(), lows=(), highs=()) -> DataFrame:
    """Session windows of a table, whose keys may be hot: like `session`, with mergeable measures.

    As there, a row that comes the whole gap after the last still belongs to it. Rows of a key that fall
    into one cell of the gap's width are less than the gap apart, so they share a session whatever else happens. Cells are therefore summed up before anything is shuffled by key,
    and only their ends are put in order: a key with half of all events brings as many rows as it has
    active cells. counts: names of row counts; sums, lows, highs: {output: column}.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    counts = list(counts) or ["events"]
    parts = [(F.count(F.lit(1)), F.sum, n) for n in counts]
    parts += [(F.sum(as_col(c)), F.sum, n) for n, c in dict(sums).items()]
    parts += [(F.min(as_col(c)), F.min, n) for n, c in dict(lows).items()] + [(F.max(as_col(c)), F.max, n) for n, c in dict(highs).items()]
    gap = int(gap_seconds * 1_000_000)
    at = F.unix_micros(as_col(ts).cast("timestamp"))
    cells = df.filter(as_col(ts).isNotNull()).groupBy(*keys, F.expr("0").alias("__z"), F.floor(at / gap).alias("__cell")).agg(
        F.min(as_col(ts)).alias("__lo"), F.max(as_col(ts)).alias("__hi"), *[first.alias(n) for first, _, n in parts]).drop("__z")
    w = window(keys, "__cell")
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    new = F.coalesce((micros("__lo") - F.lag(micros("__hi")).over(w) > gap).cast("int"), F.lit(1))
    numbered = cells.withColumn("__new", new).withColumn("__s", F.sum("__new").over(window(keys, "__cell", RUNNING)))
    out = numbered.groupBy(*keys, "__s").agg(F.min("__lo").alias("session_start"), F.max("__hi").alias("__hi"), *[merge(n).alias(n) for _, merge, n in parts])
    end = F.col("__hi") + F.make_dt_interval(secs=F.lit(gap / 1_000_000))
    return out.select(F.col("session_start"), end.alias("session_end"), *keys, *[n for *_, n in parts])


def session(df, ts, gap, keys, **aggs: Column) -> DataFrame:
    """Session windows by a gap; the same call on a stream and on a table."""
    aggs = aggs or {"events": F.count(F.lit(1))}
    out = df.groupBy(F.session_window(as_col(ts), gap).alias("w"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *keys, *aggs)


def enrich(events, dim, key, how="left") -> DataFrame:
    """Stream-static (or static) enrichment by key."""
    return events.join(dim, key, how)
