"""History: slowly changing dimensions and snapshots."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sparkmart.functions import as_col, surrogate_key
from sparkmart.operators import joins, topk, windows as wn

MS = "INTERVAL 1 MILLISECOND"


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def distinct_source(df, uploaded="_uploaded_at", task="_task_instance") -> DataFrame:
    """Distinct content of full copies with first and last upload and last task."""
    content = [c for c in df.columns if c not in (uploaded, task)]
    at = F.timestamp_seconds(as_col(uploaded)).cast("timestamp_ntz")
    return df.groupBy(*content).agg(F.min(at).alias("valid_from"), F.max(at).alias("max_uploaded_at"), F.max(task).alias("max_task_instance"))


def scd_type_2(source, key, chunk=None) -> DataFrame:
    """Validity intervals from `distinct_source` rows.

    A version ends a millisecond before the next one of its key. The last version
    ends at the key's last upload when the key is missing from the newest task and
    stays open otherwise.
    """
    keys = _keys(key)
    newest = source.select(F.max("max_task_instance")).scalar()
    df = wn.lead(source, "__next", keys, ["valid_from", "max_uploaded_at"], "valid_from", chunk=chunk)
    df = wn.partition_agg(df, keys, __task=F.max("max_task_instance"), __seen=F.max("max_uploaded_at"))
    gone = F.when(F.col("__task") != newest, F.col("__seen"))
    df = df.withColumn("valid_to", F.coalesce(F.col("__next") - F.expr(MS), gone))
    return df.withColumn("is_currently_valid", F.col("valid_to").isNull()).drop("__next", "__task", "__seen", "max_uploaded_at", "max_task_instance")


def _snapshot(prev, cur, key, changed: Column, stamp: Column, now, hard_deletes: bool) -> DataFrame:
    """Next snapshot table from the previous one and the current rows.

    One full join of open versions to current rows decides everything; each joined
    row yields its old version, its new version or both.
    """
    keys = _keys(key)
    attrs = [c for c in cur.columns if c not in keys]
    meta = ["valid_from", "valid_to", "scd_id"]
    now = F.lit(now).cast("timestamp_ntz")
    opened = prev.filter("valid_to IS NULL").alias("p")
    current = cur.withColumn("__cur", F.lit(True)).alias("c")
    on = reduce(lambda a, b: a & b, [F.col(f"p.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys])
    j = opened.withColumn("__prev", F.lit(True)).alias("p").join(current, on, "full")
    has_prev, has_cur = F.col("p.__prev").isNotNull(), F.col("c.__cur").isNotNull()
    replaced = has_prev & has_cur & F.coalesce(changed, F.lit(False))
    ended = F.when(replaced, stamp)
    if hard_deletes:
        ended = ended.when(~has_cur, now)
    names = keys + attrs
    old = F.when(has_prev, F.struct(*[F.col(f"p.{c}").alias(c) for c in names], F.col("p.valid_from").alias("valid_from"),
                                    ended.cast("timestamp_ntz").alias("valid_to"), F.col("p.scd_id").alias("scd_id")))
    scd_id = F.md5(F.concat_ws("|", *[F.col(f"c.{k}").cast("string") for k in keys], stamp.cast("string")))
    new = F.when(has_cur & (~has_prev | replaced), F.struct(
        *[F.col(f"c.{c}").alias(c) for c in names], stamp.cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"), scd_id.alias("scd_id")))
    merged = j.select(F.explode(F.array_compact(F.array(old, new))).alias("r")).select("r.*")
    history = prev.filter("valid_to IS NOT NULL").select(*names, *meta)
    return history.unionByName(merged.select(*names, *meta))


def empty_snapshot(cur: DataFrame) -> DataFrame:
    """A snapshot table without rows, to start from."""
    stamp = F.lit(None).cast("timestamp_ntz")
    return cur.limit(0).select("*", stamp.alias("valid_from"), stamp.alias("valid_to"), F.lit(None).cast("string").alias("scd_id"))


def snapshot_ts(prev, cur, key, updated_at, now: datetime, hard_deletes=False) -> DataFrame:
    """Timestamp strategy: a later `updated_at` closes the open version and opens the next."""
    changed = F.col(f"c.{updated_at}") > F.col(f"p.{updated_at}")
    return _snapshot(prev, cur, key, changed, F.col(f"c.{updated_at}"), now, hard_deletes)


def snapshot_check(prev, cur, key, cols, now: datetime, hard_deletes=False) -> DataFrame:
    """Check strategy: any difference in `cols`, NULLs included, opens a new version at `now`."""
    changed = reduce(lambda a, b: a | b, [~F.col(f"c.{c}").eqNullSafe(F.col(f"p.{c}")) for c in cols])
    return _snapshot(prev, cur, key, changed, F.lit(now).cast("timestamp_ntz"), now, hard_deletes)


def snapshot_spine(df, key, start, as_of, grain="day", tiebreak="scd_id") -> DataFrame:
    """Snapshot rows per period: the last change of each period, for the periods it
    covers (valid_from <= d < valid_to or still open)."""
    kept = topk.latest_per_period(df, _keys(key), "valid_from", grain, tiebreak)
    low = F.trunc(F.lit(start).cast("date"), grain) if grain != "day" else F.lit(start).cast("date")
    begun = F.to_date("valid_from")
    if grain != "day":
        begun = F.when(F.trunc(begun, grain) == begun, begun).otherwise(F.add_months(F.trunc(begun, grain), {"month": 1, "quarter": 3, "year": 12}[grain]))
    first = F.greatest(begun, low)
    last = F.least(F.coalesce(F.date_sub(F.to_date("valid_to"), 1), F.lit(as_of).cast("date")), F.lit(as_of).cast("date"))
    out = kept.filter(first <= last).withColumn("date_actual", F.explode(F.sequence(first, last, F.expr(f"INTERVAL 1 {grain}"))))
    return out.withColumn("is_currently_valid", F.col("valid_to").isNull()).withColumn("unique_key", surrogate_key(*_keys(key), "date_actual"))


def spine_daily(df, last_done, as_of) -> DataFrame:
    """Only the days after `last_done`: one row per version valid on each."""
    first = F.greatest(F.to_date("valid_from"), F.date_add(F.lit(last_done).cast("date"), 1))
    last = F.least(F.coalesce(F.date_sub(F.to_date("valid_to"), 1), F.lit(as_of).cast("date")), F.lit(as_of).cast("date"))
    return df.filter(first <= last).withColumn("snapshot_date", F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))))


def collapse_islands(df, key, value, start, end, tiebreak, chunk=None) -> DataFrame:
    """Merge consecutive rows with an unchanged value into one interval; it stays open if one of them is."""
    keys = _keys(key)
    df = wn.change_counter(df, "island", keys, [start, tiebreak], value, chunk=chunk)
    return df.groupBy(*keys, "island", value).agg(F.min(start).alias(start), F.when(F.bool_and(F.col(end).isNotNull()), F.max(end)).alias(end))


def overlaps_on(df, key, dates, start="valid_from", end="valid_to") -> DataFrame:
    """Keys with more than one valid row on a probe date (ends included)."""
    probes = F.array(*[F.lit(d).cast("timestamp_ntz") for d in dates])
    hit = F.filter(probes, lambda d: (d >= F.col(start)) & (F.col(end).isNull() | (d <= F.col(end))))
    rows = df.select(*_keys(key), F.explode(hit).alias("probe"))
    return rows.groupBy(*_keys(key), "probe").agg(F.count(F.lit(1)).alias("valid_rows")).filter("valid_rows <> 1")


def overlaps(df, key, tiebreak, start="valid_from", end="valid_to", chunk=None) -> DataFrame:
    """Rows that begin before an earlier row of their key has ended."""
    far = F.lit("9999-12-31").cast("timestamp_ntz")
    df = df.withColumn("__end", F.coalesce(as_col(end), far))
    df = wn.running(df, "__open_until", _keys(key), [start, tiebreak], "__end", agg="max", include_current=False, chunk=chunk)
    return df.filter(F.col(start) < F.col("__open_until")).drop("__end", "__open_until")


def multi_current(df, key, flag="is_currently_valid") -> DataFrame:
    """Keys with more than one current row."""
    return df.filter(as_col(flag)).groupBy(*_keys(key)).agg(F.count(F.lit(1)).alias("current_rows")).filter("current_rows > 1")


def hash_diff(df, prior, cols, now: datetime) -> DataFrame:
    """Content hash with the time it last changed; a known hash keeps its time."""
    hashed = df.withColumn("content_hash", surrogate_key(*cols))
    known = prior.groupBy("content_hash").agg(F.min("last_changed").alias("__then"))
    out = hashed.join(known, "content_hash", "left")
    return out.withColumn("last_changed", F.coalesce("__then", F.lit(now).cast("timestamp_ntz"))).drop("__then")


def intersect_histories(a, b, key, a_span, b_span) -> DataFrame:
    """Two attribute histories cut to the times both are valid; two open versions meet in an open one."""
    both = joins.overlap_join(a, b, key, a_span, b_span, lambda c: F.unix_date(F.to_date(c)))
    return both.filter("overlap_to IS NULL OR overlap_to > overlap_from")


def valid_on(df, day, start="valid_from", end="valid_to") -> DataFrame:
    """Versions valid at a date."""
    d = F.lit(day).cast("timestamp_ntz")
    return df.filter((as_col(start) <= d) & (as_col(end).isNull() | (d < as_col(end))))


def as_was(fact_snap, dims: dict, day) -> DataFrame:
    """A fact as it stood on a day, with its dimensions as they stood then.

    Each snapshot is cut to the day before it is joined. dims: {key: snapshot}.
    """
    meta = ["valid_from", "valid_to", "scd_id"]
    out = valid_on(fact_snap, day).drop(*meta)
    for key, snap in dims.items():
        out = out.join(valid_on(snap, day).drop(*meta), key, "left")
    return out


def definition_validity(df, key, definition, day) -> DataFrame:
    """First day of the key, first and last day of each definition of it."""
    df = wn.partition_agg(df, key, date_first_added=F.min(day))
    return wn.partition_agg(df, definition, valid_from_date=F.min(day), valid_to_date=F.max(day))


def backfill_row(df, defaults: dict, first, until) -> DataFrame:
    """Add a synthetic version for the time before the first snapshot."""
    types = dict(df.dtypes)
    row = {**defaults, "valid_from": first, "valid_to": until}
    one = df.sparkSession.range(1).select(*[F.lit(row.get(c)).cast(types[c]).alias(c) for c in df.columns])
    return df.unionByName(one.withColumn("valid_to", F.col("valid_to") - F.expr(MS)))
