"""Sharding by rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkmart.llm.common import hash32, rank_within, stored, whole

#: Hexadecimal digits of MD5 that make the uniform number: 52 bits, exact in a double.
DIGITS = 13


def draw(key: Column, shard: int) -> Column:
    """Uniform in (0, 1), from key and shard alone."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{shard}")).cast("binary"))
    return (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + 0.5) / float(16**DIGITS)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard whose -ln(draw) / weight is smallest, the lower number in a tie.

    A shard's share is its weight's share. As each shard's value depends on nothing but key, shard and
    weight, a new shard only takes rows into itself, and a raised weight only draws rows to its shard.
    """
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("every shard needs a positive weight")
    bids = [F.struct((-F.log(draw(key, s)) / float(w)).alias("bid"), F.lit(s).alias("shard")) for s, w in enumerate(weights)]
    return bids[0]["shard"] if len(bids) == 1 else F.least(*bids)["shard"]


def assign(df: DataFrame, key: str, weights: Sequence[float], shard: str = "shard", slot: str | None = "slot") -> DataFrame:
    """Add each row's shard and, if `slot` is named, its place in it: 0, 1, 2 ... without a gap.

    Slots follow the hash of the key, then the key. NULL keys count as the empty key. Rows of equal
    keys share a shard and take adjacent slots. An empty table stays empty. Columns named like
    `shard` and `slot` are replaced.
    """
    df = df.drop(shard, *([slot] if slot else []))
    out = df.withColumn(shard, rendezvous(F.col(key), weights))
    return out if slot is None else place(out.withColumn("slot_hash", hash32(key)), key, shard, slot)


def place(df: DataFrame, key: str, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """Number the rows of every shard; `df` holds slot_hash and is read twice, so pass it stored if it is costly."""
    ranked = rank_within(df, [shard], "slot_hash", [key], slot)
    return ranked.withColumn(slot, F.col(slot) - 1).drop("slot_hash")


def digest(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Shard table of `documents` under the law `key`; grown_shard is the shard after one more is added."""
    slim = docs.select(
        "doc_id",
        (F.octet_length(whole("text")) + 8).cast("long").alias("size"),
        F.crc32(whole("text").cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    grown = slim.withColumn("grown_shard", rendezvous(F.col("doc_id"), [1.0] * (shards + 1)))
    placed = place(stored(grown.withColumn("shard", rendezvous(F.col("doc_id"), [1.0] * shards)).withColumn("slot_hash", hash32("doc_id"))), "doc_id")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
