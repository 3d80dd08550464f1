"""Semi-structured values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sparkmart.functions.nulls import as_col

__all__ = ["json_path", "variant_to_bool", "variant_to_num", "pack_columns"]


def json_path(c, path: str, as_type: str = "string") -> Column:
    """Typed value at a JSON path of a text column, NULL when absent or not castable."""
    return F.get_json_object(as_col(c), path).try_cast(as_type)


def variant_to_bool(c) -> Column:
    """Safe boolean of any text or variant value."""
    return F.trim(as_col(c).cast("string")).try_cast("boolean")


def variant_to_num(c) -> Column:
    """Safe number rounded to a whole, NULL when the text is not numeric."""
    return F.round(F.trim(as_col(c).cast("string")).try_cast("decimal(38,6)"), 0).cast("bigint")


def pack_columns(cols) -> Column:
    """JSON object with one entry per column, NULLs left out."""
    return F.to_json(F.struct(*[as_col(c) for c in cols]))
