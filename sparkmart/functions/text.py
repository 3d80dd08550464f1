"""Text helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from sparkmart.functions.nulls import as_col

__all__ = [
    "rlike_full", "like_any", "ilike_any", "pad_both", "slugify", "regexp_to_array", "url_parameter",
    "tokens", "path_first", "path_last", "path_to_column", "split_name", "ipv4_number", "version_parts",
]


def rlike_full(c, pattern: str) -> Column:
    """Regex match on the whole string, as the warehouse REGEXP does."""
    return as_col(c).rlike(f"^(?:{pattern})$")


def like_any(c, patterns) -> Column:
    """c LIKE any of the patterns."""
    c = as_col(c)
    out = F.lit(False)
    for p in patterns:
        out = out | c.like(p)
    return out


def ilike_any(c, patterns) -> Column:
    """Case-insensitive LIKE ANY."""
    return like_any(F.lower(as_col(c)), [p.lower() for p in patterns])


def pad_both(c, s: str = " ") -> Column:
    return F.concat(F.lit(s), as_col(c), F.lit(s))


def slugify(c, filler: str = "-") -> Column:
    """Lower-case slug: ' || ' becomes '|', blanks collapse, other characters become filler."""
    c = as_col(c)
    # The first two patterns only run on texts that can hold them.
    c = F.when(c.contains("||"), F.regexp_replace(c, r"\s+\|{2}\s+", "|")).otherwise(c)
    c = F.when(c.contains("  "), F.regexp_replace(c, r"[ ]{2,}", " ")).otherwise(c)
    return F.trim(F.lower(F.regexp_replace(c, r"[^A-Za-z0-9|]", filler)))


def regexp_to_array(c, pattern: str) -> Column:
    """All matches of the pattern, an empty array when there are none."""
    found = F.regexp_extract_all(as_col(c), F.lit(pattern), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def url_parameter(c, name: str) -> Column:
    """Value of a query parameter, NULL when absent."""
    return F.nullif(F.regexp_extract(as_col(c), rf"[?&]{re.escape(name)}=([^&#]*)", 1), F.lit(""))


def tokens(c, delimiters: str = " ") -> Column:
    """Non-empty tokens split on any of the delimiter characters."""
    parts = F.split(as_col(c), "[" + re.escape(delimiters) + "]")
    return F.filter(parts, lambda t: t != "")


def path_first(c, sep: str = ".") -> Column:
    return F.split_part(as_col(c), F.lit(sep), F.lit(1))


def path_last(c, sep: str = ".") -> Column:
    return F.split_part(as_col(c), F.lit(sep), F.lit(-1))


def path_to_column(c, sep: str = ".") -> Column:
    """Dotted path as a column-safe name."""
    return F.replace(as_col(c), F.lit(sep), F.lit("_"))


def split_name(c) -> tuple[Column, Column]:
    """(first token, all that follows the first blank) of a full name."""
    name = F.trim(as_col(c))
    blank = F.position(F.lit(" "), name)
    rest = F.when(blank > 0, F.substring(name, blank + 1, F.length(name))).when(name.isNotNull(), F.lit(""))
    return F.when(blank > 0, F.substring(name, F.lit(1), blank - 1)).otherwise(name), rest


def ipv4_number(c) -> Column:
    """Numeric value of a dotted IPv4 address, NULL when malformed."""
    c = as_col(c)
    octet = r"(25[0-5]|2[0-4]\d|1?\d?\d)"
    parts = F.split(c, r"\.")
    value = sum((parts[i].try_cast("long") * (256 ** (3 - i)) for i in range(4)), F.lit(0))
    return F.when(c.rlike(rf"^{octet}(\.{octet}){{3}}$"), value)


def version_parts(c) -> dict[str, Column]:
    """Cleaned version, prerelease flag, major, minor and major*100+minor."""
    c = as_col(c)
    cleaned = F.regexp_replace(F.nullif(c, F.lit("")), "[^0-9.]+", "")
    major = F.split_part(cleaned, F.lit("."), F.lit(1)).try_cast("int")
    minor = F.split_part(cleaned, F.lit("."), F.lit(2)).try_cast("int")
    return {
        "cleaned_version": cleaned,
        "is_prerelease": F.coalesce(F.lower(c).like("%-pre"), F.lit(False)),
        "major_version": major,
        "minor_version": minor,
        "major_minor_version": F.concat_ws(".", major.cast("string"), minor.cast("string")),
        "major_minor_version_id": major * 100 + minor,
    }
