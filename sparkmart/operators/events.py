"""Event analytics: unified events, sessions, funnels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sparkmart.functions import as_col, boundary_diff, surrogate_key
from sparkmart.operators import sets, windows as wn


@dataclass(frozen=True)
class EventSpec:
    """One entity table read as events; a table that holds many kinds names them by a column."""

    name: Column | str
    stage: str
    df: DataFrame
    key: Column | str
    at: Column | str
    user: Column | str | None = None
    parent: Column | str | None = None


def unify_events(specs: list[EventSpec], users=None, parents=None) -> DataFrame:
    """One event table from many entity tables.

    The branches only project; enrichment joins run once over the union, not once
    per branch. users / parents: (df with columns id, created_at[, …]).
    """
    parts = []
    for s in specs:
        null = F.lit(None).cast("bigint")
        parts.append(s.df.select(
            (F.lit(s.name) if isinstance(s.name, str) else s.name).alias("event_name"), F.lit(s.stage).alias("stage_name"), as_col(s.key).cast("bigint").alias("event_id"), as_col(s.at).alias("event_at"),
            (as_col(s.user).cast("bigint") if s.user is not None else null).alias("user_id"), (as_col(s.parent).cast("bigint") if s.parent is not None else null).alias("parent_id")))
    out = sets.union_all(*parts).withColumn("event_pk", surrogate_key("event_name", "event_id"))
    for side, name in ((users, "user"), (parents, "parent")):
        if side is not None:
            dim = side.select(F.col("id").alias(f"{name}_id"), F.col("created_at").alias(f"{name}_created_at"), *[F.col(c).alias(f"{name}_{c}") for c in side.columns if c not in ("id", "created_at")])
            out = _with_dimension(out, dim, f"{name}_id")
            out = out.withColumn(f"days_since_{name}_creation", boundary_diff("day", f"{name}_created_at", "event_at"))
    return out


def _with_dimension(df, dim, key) -> DataFrame:
    """Left join on `key`. Rows without a key have no partner and stay out of the join, whose
    shuffle would put all of them into one task."""
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in dim.schema.fields if f.name != key]
    known = df.filter(F.col(key).isNotNull()).join(dim, key, "left")
    return known.unionByName(df.filter(F.col(key).isNull()).select("*", *none))


def event_daily(df, ts, keys) -> DataFrame:
    return df.groupBy(F.to_date(as_col(ts)).alias("event_date"), *keys).agg(F.count(F.lit(1)).alias("event_count"))


def sessionize(df, user, ts, tiebreak, gap_seconds, chunk=None) -> DataFrame:
    """Session number per user: a new one after a silence longer than the gap."""
    order = [ts, tiebreak]
    df, chunk = wn.cut(df, user, chunk, "__session_cut")
    out = wn.lag(df, "__prev", user, order, ts, chunk=chunk)
    micros = lambda c: F.unix_micros(as_col(c).cast("timestamp"))
    new = F.when(F.col("__prev").isNull() | (micros(ts) - micros("__prev") > gap_seconds * 1_000_000), 1).otherwise(0)
    out = out.withColumn("__new", new)
    return wn.running(out, "session_index", user, order, "__new", chunk=chunk).drop("__prev", "__new", "__session_cut")


def page_views(df, user, ts, tiebreak, gap_seconds, chunk=None) -> DataFrame:
    """Events with session key and position within the session."""
    df, chunk = wn.cut(df, user, chunk, "__view_cut")
    out = sessionize(df, user, ts, tiebreak, gap_seconds, chunk)
    out = wn.row_number(out, "page_view_in_session", [user, "session_index"], [ts, tiebreak], chunk=chunk)
    return out.drop("__view_cut").withColumn("session_id", surrogate_key(user, "session_index"))


def sessions(df, user, ts, tiebreak, gap_seconds, chunk=None) -> DataFrame:
    out = sessionize(df, user, ts, tiebreak, gap_seconds, chunk)
    return out.groupBy(user, "session_index").agg(F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count(F.lit(1)).alias("page_views"))


def funnel(df, session, ts, start: Column, success: Column) -> DataFrame:
    """Sessions that reached the start page, with the time of start and of success."""
    out = df.groupBy(*session).agg(F.min(F.when(start, as_col(ts))).alias("start_at"), F.min(F.when(success, as_col(ts))).alias("success_at"))
    return out.filter("start_at IS NOT NULL").withColumn("reached_success", F.col("success_at").isNotNull())


def event_quality(good, bad, ts) -> DataFrame:
    """Good and bad event counts per day, days of either kind included."""
    a = good.groupBy(F.to_date(as_col(ts)).alias("day")).agg(F.count(F.lit(1)).alias("good_events"))
    b = bad.groupBy(F.to_date(as_col(ts)).alias("day")).agg(F.count(F.lit(1)).alias("bad_events"))
    out = a.join(b, "day", "full").fillna(0, ["good_events", "bad_events"])
    return out.withColumn("bad_share", F.col("bad_events") / (F.col("good_events") + F.col("bad_events")))


def split_bad_events(df, payload, required) -> tuple[DataFrame, DataFrame]:
    """(good, bad): bad rows carry the list of what is wrong with the payload."""
    doc = F.try_parse_json(as_col(payload))
    errors = F.array_compact(F.array(
        F.when(doc.isNull(), F.lit("not json")),
        *[F.when(doc.isNotNull() & F.try_variant_get(doc, f"$.{p}", "string").isNull(), F.lit(f"missing {p}")) for p in required]))
    tagged = df.withColumn("error_array", errors)
    return tagged.filter(F.size("error_array") == 0).drop("error_array"), tagged.filter(F.size("error_array") > 0)


def bad_events(df, payload, ts, required) -> DataFrame:
    """Distinct failures with a surrogate key over payload, time and errors."""
    _, bad = split_bad_events(df, payload, required)
    key = surrogate_key(payload, ts, F.array_join("error_array", ","))
    return bad.select(as_col(payload).alias("line"), as_col(ts).alias("failed_at"), "error_array", key.alias("bad_event_key")).distinct()


def anonymise_events(df, drop, kinds=None, on=None) -> DataFrame:
    """Events without their identifying columns, with the event type joined on."""
    out = df.drop(*drop)
    return out.join(kinds, on, "left") if kinds is not None else out


def assignment_events(notes, users, text, keys) -> DataFrame:
    """Rows (event, user, rank) from notes such as 'assigned to @a and unassigned @b'.

    Each part of a note is cut out, its @names are listed in order and matched to users.
    """
    c = as_col(text)
    after = lambda word: F.when(c.contains(word), F.split_part(c, F.lit(word), F.lit(2)))
    parts = {
        "reassigned": F.when(c.startswith("Reassigned"), after("Reassigned to ")),
        "assigned": F.when(c.startswith("assigned to"), F.split_part(after("assigned to "), F.lit("unassigned "), F.lit(1))),
        "unassigned": after("unassigned "),
    }
    listed = F.array(*[F.struct(F.lit(n).alias("event"), F.coalesce(F.regexp_extract_all(p, F.lit(r"@([^\s,]+)"), F.lit(1)), F.array().cast("array<string>")).alias("names")) for n, p in parts.items()])
    rows = notes.select(*keys, F.inline(listed)).select(*keys, "event", F.posexplode("names").alias("rank_in_event", "user_name"))
    return rows.join(users, "user_name").drop("user_name")


def days_active(created, last) -> Column:
    """Days between creation and the last activity, 0 without any."""
    return boundary_diff("day", created, F.coalesce(as_col(last), as_col(created)))
