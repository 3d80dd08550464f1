"""Readers: seeds, event logs, hourly and id-range partitions, clones."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sparkmart.functions import as_col, pack_columns
from sparkmart.operators import sets, windows as wn


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Versioned CSV lookup with declared types; the text NULL is a NULL."""
    return spark.read.schema(schema).option("header", True).option("nullValue", "NULL").csv(path)


def read_event_tsv(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """Positional tab-separated event log (gzip is detected by suffix); all fields are text.
    Missing trailing fields are NULL, quotes are ordinary characters."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return spark.read.schema(schema).option("sep", "\t").option("quote", "").option("mode", "PERMISSIVE").csv(path)


def explode_json_rows(df, col, schema: str, outer=False) -> DataFrame:
    """One row per object of a JSON array column; `schema` types the objects."""
    fn = F.inline_outer if outer else F.inline
    return df.select(*[c for c in df.columns if c != col], fn(F.from_json(as_col(col), f"array<struct<{schema}>>")))


def join_log_streams(df, kind, a, b, key, a_cols, b_cols) -> DataFrame:
    """Two kinds of log lines of one stream rejoined by correlation id."""
    left = df.filter(as_col(kind) == a).select(key, *a_cols)
    right = df.filter(as_col(kind) == b).select(key, *b_cols)
    return left.join(right, key)


def token_range(token: str) -> tuple[datetime, datetime]:
    """Half-open time range of a YYYY, YYYYMM or YYYYMMDD token."""
    if not re.fullmatch(r"\d{4}(\d{2}){0,2}", token):
        raise ValueError(f"not a date token: {token}")
    start = datetime.strptime((token + "0101")[:8] if len(token) < 8 else token, "%Y%m%d")
    if len(token) == 4:
        return start, start.replace(year=start.year + 1)
    if len(token) == 6:
        return start, (start + timedelta(days=32)).replace(day=1)
    return start, start + timedelta(days=1)


def partitions_for(spark: SparkSession, token: str, prefix="output/") -> DataFrame:
    """Hourly partition names of a token."""
    start, end = token_range(token)
    hours = F.explode(F.sequence(F.lit(start).cast("timestamp_ntz"), F.lit(end - timedelta(hours=1)).cast("timestamp_ntz"), F.expr("INTERVAL 1 HOUR")))
    return spark.range(1).select(hours.alias("hour")).withColumn("partition", F.concat(F.lit(prefix), F.date_format("hour", "yyyy/MM/dd/HH")))


def read_hours(df, ts, token: str) -> DataFrame:
    """Rows of a token: a literal range filter, so partitions and row groups are skipped."""
    start, end = token_range(token)
    return df.filter((as_col(ts) >= F.lit(start).cast("timestamp_ntz")) & (as_col(ts) < F.lit(end).cast("timestamp_ntz")))


def window_bounds(last_load, replica_at, run_at, hours, overlap_minutes=30) -> tuple[datetime, datetime]:
    """Extract window: from the last load minus an overlap for late rows, up to the
    replica, the run and `hours` after the start. Without a last load, look back."""
    begin = last_load - timedelta(minutes=overlap_minutes) if last_load else min(replica_at, run_at) - timedelta(hours=hours)
    end = min(replica_at, run_at, begin + timedelta(hours=hours))
    if begin > end:
        raise ValueError("the window begins after it ends")
    return begin, end


def incremental_window(df, ts, last_load, replica_at, run_at, hours, overlap_minutes=30) -> DataFrame:
    begin, end = window_bounds(last_load, replica_at, run_at, hours, overlap_minutes)
    return df.filter(as_col(ts).between(F.lit(begin).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))


def id_chunks(df, key, step=750_000) -> DataFrame:
    """Chunk number, id range and size of a table cut into id ranges."""
    low = df.select(F.min(as_col(key))).scalar()
    chunk = F.floor((as_col(key) - low) / step)
    return df.groupBy(chunk.alias("chunk")).agg(F.min(as_col(key)).alias("first_id"), F.max(as_col(key)).alias("last_id"), F.count(F.lit(1)).alias("rows"))


def jdbc_read_ranged(spark: SparkSession, url: str, table: str, key: str, low: int, high: int, step=750_000, **options) -> DataFrame:
    """Database table read in parallel id ranges of about `step` rows."""
    parts = max(1, -(-(high - low + 1) // step))
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("partitionColumn", key)
    reader = reader.option("lowerBound", low).option("upperBound", high + 1).option("numPartitions", parts)
    return reader.options(**options).load()


def probe_load(df, key, order, n: int) -> DataFrame:
    """First rows of a new table with a key."""
    return df.filter(as_col(key).isNotNull()).orderBy(*order).limit(n)


def read_day(df, ts, day: str) -> DataFrame:
    """One day by a range filter on the stored column."""
    d = F.lit(day).cast("date")
    return df.filter((as_col(ts) >= d.cast("timestamp_ntz")) & (as_col(ts) < F.date_add(d, 1).cast("timestamp_ntz")))


def rollup_clones(clones: dict[str, DataFrame], schema: T.StructType | None = None, last: str | None = None, days=None) -> DataFrame:
    """Dated clones (name_YYYYMMDD) in one table, cast to the target's types.

    Clones newer than `last` are taken, with `days` only those of these days of a month;
    columns a clone lacks are NULL. Without a schema the columns are those of all clones,
    with the type of the newest clone that has them.
    """
    parts = []
    if schema is None:
        found = {f.name: f for _, df in sorted(clones.items(), key=lambda c: c[0][-8:]) for f in df.schema.fields}
        schema = T.StructType(list(found.values()))
    for name, df in sorted(clones.items()):
        day = name[-8:]
        if not re.fullmatch(r"\d{8}", day) or (days is not None and int(day[-2:]) not in days) or (last and day <= last[-8:]):
            continue
        have = set(df.columns)
        cols = [(F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
        parts.append(df.select(*cols, F.lit(name).alias("original_table_name"), F.to_date(F.lit(day), "yyyyMMdd").alias("snapshot_date")))
    if not parts:
        raise ValueError("no clone to roll up")
    return sets.union_all(*parts)


def recent_sample(df, ts, tiebreak, days, n, as_of) -> DataFrame:
    """The newest rows of the last days, at most n (a sampling operator).

    Counts per minute say which minutes fit whole and in which one the sample ends;
    only that minute is ranked, so no task receives the whole sample.
    """
    low = F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp_ntz")
    rows = df.filter(as_col(ts) >= low).withColumn("__minute", F.date_trunc("minute", as_col(ts)))
    counts = rows.groupBy("__minute").agg(F.count(F.lit(1)).alias("__n"))
    counts = wn.running(counts, "__before", [], F.desc("__minute"), "__n", include_current=False)
    quota = counts.select("__minute", (n - F.coalesce("__before", F.lit(0))).alias("__quota"), "__n").filter("__quota > 0")
    kept = rows.join(quota, "__minute")
    whole = kept.filter("__n <= __quota")
    edge = kept.filter("__n > __quota").withColumn("__rn", F.row_number().over(wn.window("__minute", [as_col(ts).desc(), as_col(tiebreak)])))
    edge = edge.filter("__rn <= __quota").drop("__rn")
    return whole.unionByName(edge).drop("__minute", "__quota", "__n")


def rows_since_max(source, target, col) -> DataFrame:
    """Source rows changed after the newest target row; all rows for an empty target."""
    newest = target.select(F.max(as_col(col))).scalar()
    return source.filter(newest.isNull() | (as_col(col) > newest))


def union_partitions(parts: dict[str, DataFrame], like: str, exclude: str | None = None) -> DataFrame:
    """All partitions whose name matches, leaving out scratch ones (substring)."""
    keep = [df for name, df in sorted(parts.items()) if re.match(like, name) and not (exclude and exclude in name)]
    return sets.union_all(*keep, allow_missing=True)


def union_partitions_recent(parts, like, ts, days, as_of, exclude=None) -> DataFrame:
    low = F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp_ntz")
    return union_partitions(parts, like, exclude).filter(as_col(ts) >= low)


def read_monthly(spark: SparkSession, root: str) -> DataFrame:
    """Partition-root read of `write_monthly` output: filters on year and month prune folders."""
    return spark.read.parquet(root)


def union_relations(dfs: dict[str, DataFrame], label="source_relation") -> DataFrame:
    return sets.union_labelled(dfs, label)


def pack(df, cols, out) -> DataFrame:
    return df.withColumn(out, pack_columns(cols)).drop(*cols)
