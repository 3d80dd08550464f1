"""Sort, limit, top-k and duplicates.

A filter on row_number or rank below a constant is pruned before the shuffle
(WindowGroupLimit), so a hot key sends at most k rows per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkmart.functions.nulls import as_col
from sparkmart.operators.windows import window


def order_by(df, *order) -> DataFrame:
    return df.orderBy(*order)


def limit(df, order, n) -> DataFrame:
    """The first n rows of a total order (per-task top n, then one merge)."""
    return df.orderBy(*order).limit(n)


def latest_per_key(df, keys, order) -> DataFrame:
    """One row per key: the first in `order`, which ends in a unique tiebreak."""
    return df.withColumn("__rn", F.row_number().over(window(keys, order))).filter("__rn = 1").drop("__rn")


def latest_narrow(df, keys, value, order) -> DataFrame:
    """One value per key by its greatest order: a plain aggregate without a sort."""
    return df.groupBy(*keys).agg(F.max_by(as_col(value), F.struct(*[as_col(c) for c in order])).alias(value))


def top_k(df, by, order, k, ties=False) -> DataFrame:
    fn = F.rank() if ties else F.row_number()
    return df.withColumn("__rk", fn.over(window(by, order))).filter(F.col("__rk") <= k).drop("__rk")


def latest_per_period(df, keys, ts, unit, tiebreak) -> DataFrame:
    """Latest row per key and calendar period."""
    period = F.date_trunc(unit, as_col(ts))
    w = window([*keys, period], [as_col(ts).desc(), as_col(tiebreak).desc()])
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def latest_state(df, col) -> DataFrame:
    """Rows of the latest load only; the maximum is a scalar subquery."""
    newest = df.select(F.max(as_col(col))).scalar()
    return df.filter(as_col(col) == newest)


def drop_duplicated(df, key) -> DataFrame:
    """Remove every copy of a key that occurs more than once."""
    once = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter("__n = 1").select(key)
    return df.join(once, key, "left_semi")


def duplicates(df, key) -> DataFrame:
    """Keys occurring more than once, with their counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
