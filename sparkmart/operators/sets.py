"""Set operations by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from sparkmart.functions.nulls import as_col


def union_all(*dfs, allow_missing=False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def union_distinct(*dfs) -> DataFrame:
    return union_all(*dfs).distinct()


def union_labelled(parts: dict, label: str) -> DataFrame:
    """Union of named relations carrying their name."""
    return union_all(*[df.withColumn(label, F.lit(name)) for name, df in parts.items()], allow_missing=True)


def history_and_current(history, current) -> DataFrame:
    return history.unionByName(current)


def intersect_all(a, b) -> DataFrame:
    return a.intersectAll(b.select(*a.columns))


def except_all(a, b) -> DataFrame:
    return a.exceptAll(b.select(*a.columns))


def blend(old, new, day, cutover) -> DataFrame:
    """Two systems joined at a cut-over date: the old one before it, the new one from it on."""
    cut = F.lit(cutover).cast("timestamp_ntz")
    left = old.filter(as_col(day) < cut).withColumn("system", F.lit("old"))
    right = new.filter(as_col(day) >= cut).withColumn("system", F.lit("new"))
    return left.unionByName(right)
