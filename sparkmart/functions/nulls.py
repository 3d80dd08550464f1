"""NULL, zero and safe-cast rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

__all__ = [
    "as_col", "div0", "div_null", "least_strict", "greatest_strict", "null_negative",
    "flag_positive", "null_or_missing", "decode", "money", "ratio",
]


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def div0(a, b) -> Column:
    """a / b, 0 when b is 0; NULL in gives NULL out."""
    a, b = as_col(a), as_col(b)
    return F.when(b == 0, F.when(a.isNotNull(), F.lit(0.0))).otherwise(F.try_divide(a, b).cast("double"))


def div_null(a, b) -> Column:
    """a / b, NULL when b is 0."""
    return F.try_divide(as_col(a), as_col(b)).cast("double")


def ratio(a, b) -> Column:
    """Double quotient of two exact sums, NULL on 0."""
    return F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))


def _strict(fn, cols) -> Column:
    cols = [as_col(c) for c in cols]
    known = cols[0].isNotNull()
    for c in cols[1:]:
        known = known & c.isNotNull()
    return F.when(known, fn(*cols))


def least_strict(*cols) -> Column:
    """LEAST that is NULL as soon as one argument is (Spark's skips NULLs)."""
    return _strict(F.least, cols)


def greatest_strict(*cols) -> Column:
    """GREATEST that is NULL as soon as one argument is."""
    return _strict(F.greatest, cols)


def null_negative(c) -> Column:
    """Negative counters mean 'not reported': make them NULL."""
    return F.when(as_col(c) >= 0, as_col(c))


def flag_positive(c) -> Column:
    """1 for a positive count, else 0."""
    return F.when(as_col(c) > 0, 1).otherwise(0)


def null_or_missing(c, name: str) -> Column:
    """Replace NULL and any 'Missing…' value by 'Missing <name>'."""
    c = as_col(c)
    return F.when(c.isNull() | c.startswith("Missing"), F.lit(f"Missing {name}")).otherwise(c)


def decode(c, pairs, default=None) -> Column:
    """Null-safe value map: DECODE(c, k1, v1, …, default)."""
    c = as_col(c)
    out = None
    for key, value in pairs:
        cond = c.eqNullSafe(F.lit(key))
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return out.otherwise(F.lit(default))


def money(c) -> Column:
    """Exact two-place decimal: sums do not depend on the order of addition."""
    return as_col(c).cast("decimal(18,2)")
