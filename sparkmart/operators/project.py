"""Projection, keys, casting and filters."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sparkmart.functions import MISSING_KEY, as_col, surrogate_key
from sparkmart.operators import rules as R


def stage(df: DataFrame, spec: dict) -> DataFrame:
    """Rename and safely cast. spec: {output: (input, type)}; 'timestamp_clamped'
    maps years beyond 9999 to the last representable day."""
    cols = []
    for out, (source, kind) in spec.items():
        c = as_col(source)
        if kind == "timestamp_clamped":
            year = F.split_part(c.cast("string"), F.lit("-"), F.lit(1)).try_cast("long")
            c = F.when(year > 9999, F.lit("9999-12-30").cast("timestamp_ntz")).otherwise(c.try_cast("timestamp_ntz"))
        else:
            c = c.try_cast(kind)
        cols.append(c.alias(out))
    return df.select(*cols)


def star_except(df: DataFrame, cols) -> DataFrame:
    return df.drop(*cols)


def audit(df, created_by, updated_by, created: date, updated: date, as_of: datetime, prior: DataFrame | None = None) -> DataFrame:
    """Audit columns; the load time of the first build survives rebuilds."""
    stamp = F.lit(as_of).cast("timestamp_ntz")
    first = stamp
    if prior is not None:
        oldest = prior.agg(F.min("row_created_at")).scalar()
        first = F.least(oldest, stamp)
    return (
        df.withColumn("created_by", F.lit(created_by)).withColumn("updated_by", F.lit(updated_by))
        .withColumn("model_created_date", F.lit(created)).withColumn("model_updated_date", F.lit(updated))
        .withColumn("row_updated_at", stamp).withColumn("row_created_at", first)
    )


def values(spark, rows, schema) -> DataFrame:
    """Inline relation for sentinel rows and small rule tables."""
    return spark.createDataFrame(rows, schema)


def single_field_dim(df, id_col, id_name, col, name, where: Column | None = None) -> DataFrame:
    """Keyed distinct non-NULL values plus the 'Missing' member."""
    rows = df.filter(as_col(col).isNotNull())
    if where is not None:
        rows = rows.filter(where)
    members = rows.select(surrogate_key(id_col).alias(id_name), as_col(col).alias(name)).distinct()
    missing = df.sparkSession.range(1).select(F.md5(F.lit(MISSING_KEY)).alias(id_name), F.lit(f"Missing {name}").alias(name))
    return members.unionByName(missing)


def valid_events(df, app, tracker, url, ts, event, bad_prefixes, retired: dict) -> DataFrame:
    """Tracked events worth keeping: an app id, a browser tracker off the test hosts
    or a backend tracker, and none of the retired events before their end date."""
    browser = as_col(tracker).startswith("js")
    for p in bad_prefixes:
        browser = browser & ~F.lower(as_col(url)).startswith(p)
    backend = as_col(tracker).startswith("rb")
    gone = F.lit(False)
    for name, until in retired.items():
        gone = gone | ((as_col(event) == name) & (as_col(ts) < F.lit(until).cast("timestamp_ntz")))
    return df.filter(as_col(app).isNotNull() & (browser | backend) & ~F.coalesce(gone, F.lit(False)))


def include_email(c, own_words=(), listed=()) -> Column:
    """'Include' unless empty, machine-made, a test account or listed."""
    c = as_col(c)
    bad = c.isNull()
    for part in [*R.EMAIL_EXCLUDED_PARTS, *own_words]:
        bad = bad | c.contains(part)
    if listed:
        bad = bad | c.isin(*listed)
    return F.when(F.coalesce(bad, F.lit(True)), "Exclude").otherwise("Include")


def exclude_listed(df, seed, key, seed_key=None) -> DataFrame:
    """Rows whose key is not in the seed. Spark broadcasts the seed when its size allows."""
    listed = seed.select(as_col(seed_key or key).alias("__k"))
    return df.join(listed, df[key] == listed["__k"], "left_anti")


def flag_listed(df, seed, key, out, seed_key=None) -> DataFrame:
    """True where the key is in the seed."""
    listed = seed.select(as_col(seed_key or key).alias("__k")).distinct().withColumn("__hit", F.lit(True))
    joined = df.join(listed, df[key] == listed["__k"], "left")
    return joined.withColumn(out, F.coalesce("__hit", F.lit(False))).drop("__k", "__hit")


def filter_users(df, users, key, user_key, state, mode="not_blocked") -> DataFrame:
    """Keep rows of users that are not blocked, or only of blocked users."""
    blocked = users.filter(as_col(state)).select(as_col(user_key).alias("__u"))
    how = "left_anti" if mode == "not_blocked" else "left_semi"
    return df.join(blocked, df[key] == blocked["__u"], how)


def all_of(*conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)
