"""Surrogate keys, date ids, hashes and id formats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sparkmart.functions.nulls import as_col

__all__ = ["surrogate_key", "MISSING_KEY", "keyed_null", "date_id", "date_id_tz", "id15to18", "crc32_text", "salted_hash"]

# Fixed value: key of the 'missing member' row of every dimension.
MISSING_KEY = "-1"


def surrogate_key(*cols) -> Column:
    """md5 of the '-'-joined string forms, NULL counting as ''."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def keyed_null(c) -> Column:
    """Key column with NULL replaced by the missing-member key."""
    return F.coalesce(as_col(c), F.md5(F.lit(MISSING_KEY)))


def date_id(c) -> Column:
    """Integer YYYYMMDD."""
    return F.date_format(as_col(c), "yyyyMMdd").cast("int")


def date_id_tz(c, tz: str = "America/Los_Angeles") -> Column:
    """Integer YYYYMMDD of a UTC timestamp seen in another time zone."""
    return date_id(F.convert_timezone(F.lit("UTC"), F.lit(tz), as_col(c).cast("timestamp_ntz")))


def id15to18(c) -> Column:
    """Case-safe 18-character form of a 15-character record id.

    Each block of five characters yields one checksum character: bit j is set
    when character j is an upper-case letter. Other lengths pass unchanged.
    """
    c = as_col(c)
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ012345")  # fixed value
    check = []
    for start in (1, 6, 11):
        bits = sum(
            (F.when(c.substr(start + j, 1).between("A", "Z"), 1 << j).otherwise(0) for j in range(5)),
            F.lit(0),
        )
        check.append(F.substring(alphabet, bits + 1, F.lit(1)))
    return F.when(F.length(c) == 15, F.concat(c, *check)).otherwise(c)


def crc32_text(c) -> Column:
    """Unsigned CRC-32 of the text (UTF-8 bytes)."""
    return F.crc32(as_col(c).cast("binary"))


def salted_hash(c, salt: str) -> Column:
    """SHA-256 hex of the trimmed, lower-cased value followed by its salt."""
    return F.sha2(F.trim(F.lower(F.concat(as_col(c).cast("string"), F.lit(salt)))), 256)
