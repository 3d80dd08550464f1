"""Landing and sinks: appends, swaps, conditional writes, exports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkmart.functions import as_col
from sparkmart.session import ensure_checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written intermediate, beside the shared checkpoints."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _fs(spark, path):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def append_full_copy(df, path, uploaded_at: int, task: str) -> DataFrame:
    """Append a full copy with its load time (epoch seconds) and task name."""
    out = df.withColumn("_uploaded_at", F.lit(uploaded_at).cast("long")).withColumn("_task_instance", F.lit(task))
    out.write.mode("append").parquet(path)
    return out


def schema_changed(source, target, ignore=("_uploaded_at", "_task_instance", "_updated_at")) -> bool:
    """Do the column sets differ, metadata columns aside?"""
    names = lambda df: {c.lower() for c in df.columns} - set(ignore)
    return names(source) != names(target)


def swap_write(df, path) -> None:
    """Write beside the target, then swap the folders: readers never see half a table, but none at all
    between the two renames. `versions.publish` has no such moment."""
    spark = df.sparkSession
    staging, old = f"{path.rstrip('/')}__staging_{uuid.uuid4().hex}", f"{path.rstrip('/')}__old_{uuid.uuid4().hex}"
    df.write.parquet(staging)
    fs, target = _fs(spark, path)
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    had = fs.exists(target)
    if had and not fs.rename(target, jpath(old)):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(jpath(staging), target):
        if had:
            fs.rename(jpath(old), target)
        raise OSError(f"cannot swap in {staging}")
    if had:
        fs.delete(jpath(old), True)


def fingerprint(df) -> DataFrame:
    """Order-free content fingerprint: row count and sum of row hashes."""
    cols = [F.col(f"`{c}`") for c in sorted(df.columns)]
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("hash_sum"))


def content_changed(df, other) -> bool:
    return fingerprint(df).collect() != fingerprint(other).collect()


def write_if_changed(df, path) -> bool:
    """Swap in the new content unless the target already holds it; says whether it wrote."""
    spark = df.sparkSession
    if path_exists(spark, path):
        current = spark.read.parquet(path)
        if not schema_changed(df, current, ()) and not content_changed(df, current):
            return False
    swap_write(df, path)
    return True


def clean_landing(df, loaded_at) -> DataFrame:
    """Header blanks and slashes to underscores, empty text to NULL, load time added."""
    out = df.toDF(*[c.replace(" ", "_").replace("/", "_") for c in df.columns])
    cols = [F.nullif(F.col(c), F.lit("")).alias(c) if t == "string" else F.col(c) for c, t in out.dtypes]
    return out.select(*cols, F.lit(loaded_at).alias("_updated_at"))


def reconcile_counts(source, target) -> DataFrame:
    """Row counts of both sides and whether they agree."""
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    both = n(source, "source_rows").withColumn("target_rows", n(target, "target_rows").scalar())
    return both.withColumn("matches", F.col("source_rows") == F.col("target_rows"))


def pump(df, path, ts=None, start=None, end=None, limit=None, order=None, **options) -> None:
    """Export to quoted CSV with header, optionally one time window.

    All rows go out unless a `limit` is asked for, which needs an order to say which ones stay.
    """
    out = pump_rows(df, ts, start, end, limit, order)
    out.write.mode("overwrite").option("header", True).option("quoteAll", True).options(**options).csv(path)


def pump_rows(df, ts=None, start=None, end=None, limit=None, order=None) -> DataFrame:
    if limit is not None and order is None:
        raise ValueError("a limited export needs an order")
    out = df
    if ts is not None:
        out = out.filter(as_col(ts).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))
    if order is not None:
        out = out.orderBy(*order)
    return out if limit is None else out.limit(limit)


def _by_month(df, ts) -> DataFrame:
    """Rows of a month meet before they are written, so tasks do not each open a file per
    month; a rebalance splits large months again and merges small ones."""
    out = df.withColumn("year", F.year(as_col(ts))).withColumn("month", F.month(as_col(ts)))
    return out.hint("rebalance", F.col("year"), F.col("month"))


def write_monthly(df, ts, path, mode="append") -> None:
    """Route rows to year and month folders."""
    _by_month(df, ts).write.mode(mode).option("maxRecordsPerFile", 5_000_000).partitionBy("year", "month").parquet(path)


def overwrite_months(df, ts, path) -> None:
    """Replace only the months present in `df` (dynamic partition overwrite)."""
    _by_month(df, ts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)


def backup(df, root, day: str) -> str:
    """Full copy under a dated folder."""
    path = f"{root.rstrip('/')}/day={day}"
    df.write.mode("overwrite").parquet(path)
    return path
