"""IP addresses and prefixes, version 4 and 6, as column expressions.

An address is 128 bits, held as two 64-bit integers (`hi`, `lo`); version 4 uses the lower 32 bits
of `lo`. What a step uses more than once it binds to a name (`_let`), so the expression stays as
small as its text: it is evaluated once a row, and the optimizer has nothing to multiply.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from sparkmart.functions.nulls import as_col
from sparkmart.functions.text import ipv4_number

__all__ = ["parse_ip", "network_of"]

QUAD = r"^(.*:)([0-9]{1,3}(?:\.[0-9]{1,3}){3})$"
#: Groups of hex digits, '::' at most once.
SIX = r"^(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*)?(?:::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*)?)?$"


def _let(body: Callable[[Column], Column], **named: Column) -> Column:
    """body of a struct of values, each computed once."""
    return F.get(F.transform(F.array(F.struct(*[c.alias(n) for n, c in named.items()])), lambda x: body(x)), F.lit(0))


def _ones(bits: Column) -> Column:
    """The highest `bits` of 64 bits set, for 0 to 64."""
    return F.when(bits <= 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(-1).cast("long"), F.lit(64) - F.least(bits, F.lit(64))))


def _long(digits: Column) -> Column:
    """16 hex digits as a signed 64-bit integer."""
    return F.conv(digits, 16, -10).cast("long")


def network_of(family: Column, bits: Column, hi: Column, lo: Column) -> tuple[Column, Column]:
    """First address, as (hi, lo), of the prefix of `bits` that holds an address."""
    wide = F.when(family == 4, bits + 96).otherwise(bits)
    return F.when(family == 4, F.lit(0).cast("long")).otherwise(hi.bitwiseAND(_ones(wide))), lo.bitwiseAND(_ones(wide - 64))


def ipv6_digits(address: Column) -> Column:
    """The 32 hex digits of a version 6 address, NULL when malformed: '::' once at most, a dotted quad as its end at most."""

    def filled(x: Column) -> Column:
        gap, missing = x["six"].contains("::"), F.lit(8) - x["n"]
        good = x["six"].rlike(SIX) & F.when(gap, missing >= 1).otherwise(missing == 0)
        zeros = F.concat(F.lit(":"), F.repeat(F.lit("0:"), F.greatest(missing, F.lit(0))))
        return F.when(good, F.split(F.btrim(F.replace(x["six"], F.lit("::"), zeros), F.lit(":")), ":"))

    padded = lambda x: F.lower(F.concat(*[F.lpad(F.get(x["g"], F.lit(i)), 4, "0") for i in range(8)]))
    counted = lambda x: _let(lambda y: _let(padded, g=filled(y)), six=x["six"], n=F.regexp_count(x["six"], F.lit("[0-9A-Fa-f]+")))
    # A dotted quad at the end stands for the last two groups.
    whole = lambda x: F.concat(F.regexp_extract(x["a"], QUAD, 1), F.substring(x["q"], 1, 4), F.lit(":"), F.substring(x["q"], 5, 4))
    quad = F.lpad(F.hex(_let(lambda x: ipv4_number(x["v"]), v=F.regexp_extract(address, QUAD, 2))), 8, "0")
    six = F.when(address.contains("."), _let(whole, a=address, q=quad)).otherwise(address)
    return F.when(address.contains(":"), _let(counted, six=six))


def parse_ip(c) -> Column:
    """Struct of an address or prefix in CIDR form; NULL when malformed.

    family (4 or 6), prefix (32 or 128 without one), hi and lo of the address, start and end of the
    range as hi/lo pairs; ipv4, ipv4_range_start and ipv4_range_end as numbers (version 4); hex_ip,
    hex_ip_range_start and hex_ip_range_end (8 or 32 digits).
    """
    zero = F.lit(0).cast("long")

    def cut(x: Column) -> Column:
        return _let(read, a=F.split_part(x["c"], F.lit("/"), F.lit(1)), p=F.split_part(x["c"], F.lit("/"), F.lit(2)), cuts=F.regexp_count(x["c"], F.lit("/")))

    def read(x: Column) -> Column:
        return _let(known, four=ipv4_number(x["a"]), hex=ipv6_digits(x["a"]), p=x["p"], cuts=x["cuts"])

    def known(x: Column) -> Column:
        family = F.when(x["four"].isNotNull(), 4).when(x["hex"].isNotNull(), 6)
        most = F.when(x["four"].isNotNull(), 32).otherwise(128)
        said = F.when(x["cuts"] == 0, most).when((x["cuts"] == 1) & x["p"].rlike("^[0-9]{1,3}$"), x["p"].try_cast("int"))
        bits = F.when(said <= most, said)
        hi = F.when(x["four"].isNotNull(), zero).otherwise(_long(F.substring(x["hex"], 1, 16)))
        lo = F.coalesce(x["four"], _long(F.substring(x["hex"], 17, 16)))
        return _let(ranged, family=family, bits=bits, hi=hi, lo=lo)

    def ranged(x: Column) -> Column:
        start_hi, start_lo = network_of(x["family"], x["bits"], x["hi"], x["lo"])
        wide = F.when(x["family"] == 4, x["bits"] + 96).otherwise(x["bits"])
        end_hi = F.when(x["family"] == 4, zero).otherwise(start_hi.bitwiseOR(F.bitwise_not(_ones(wide))))
        end_lo = start_lo.bitwiseOR(F.bitwise_not(_ones(wide - 64)))
        told = F.when(x["family"].isNotNull() & x["bits"].isNotNull(), _let(shown, family=x["family"], bits=x["bits"], hi=x["hi"], lo=x["lo"], sh=start_hi, sl=start_lo, eh=end_hi, el=end_lo))
        return told

    def shown(x: Column) -> Column:
        four = lambda v: F.when(x["family"] == 4, x[v])
        digits = lambda a, b: F.lower(F.when(x["family"] == 4, F.lpad(F.hex(x[b]), 8, "0")).otherwise(F.concat(F.lpad(F.hex(x[a]), 16, "0"), F.lpad(F.hex(x[b]), 16, "0"))))
        return F.struct(
            x["family"].alias("family"), x["bits"].alias("prefix"), x["hi"].alias("hi"), x["lo"].alias("lo"),
            x["sh"].alias("start_hi"), x["sl"].alias("start_lo"), x["eh"].alias("end_hi"), x["el"].alias("end_lo"),
            four("lo").alias("ipv4"), four("sl").alias("ipv4_range_start"), four("el").alias("ipv4_range_end"),
            digits("hi", "lo").alias("hex_ip"), digits("sh", "sl").alias("hex_ip_range_start"), digits("eh", "el").alias("hex_ip_range_end"))

    return _let(cut, c=F.trim(as_col(c)))
